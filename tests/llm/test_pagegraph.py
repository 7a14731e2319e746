import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import pagegraph as G
from weftline.llm.pagetree import LEAF, MOST_DEPTH, forest, read_page


@pytest.fixture(scope="module")
def model():
    return G.train(list(G.labelled_pages()))


def texts(html):
    return [t for t in read_page(html).text if t is not None]


def test_blocks_of_a_page():
    assert texts("a<p> b\n <b>c</b>d <br>e<p>f&amp;g&lt;&nbsp;&#233;</p>h") == ["a", "b cd e", "f&g< é", "h"]
    assert texts("<script>var t='</p>';</script>x<style>p{}</style>y<!-- <p>n --><noscript>n</noscript>z") == ["xyz"]
    assert texts("<ul><li>one<li>two<ul><li>in</ul><li>three</ul>") == ["one", "two", "in", "three"]
    assert texts("<table><tr><td>a<td>b<tr><th>c</table>d") == ["a", "b", "c", "d"]
    assert texts("1 < 2 <p title='a > b'>x</p><p class=\"un>closed") == ["1 < 2", "x"]
    assert texts("<p><b>bold<br><p>next</p>") == ["bold", "next"]
    assert texts("") == texts(None) == texts("<div><p> \n</p></div>") == []
    assert texts("end of <a href='x'>text &am") == ["end of text &am"]
    page = read_page("<div class='siteFooter' id=bottom-1><span class='ad slot'>x</span></div>")
    assert ("div", ("site", "footer", "bottom"), False) in page.signature and (LEAF, "div", ("ad", "slot")) in page.signature


def test_deep_and_long_pages(model):
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000 + "<p>y</p>"
    page = read_page(deep)
    assert max(page.depth) == MOST_DEPTH and [t for t in page.text if t] == ["x", "y"]
    words = " ".join(["Long text, with words."] * 100_000)
    out = G.main_texts([f"<article><h1>Title</h1><p>{words}</p></article>", "<a b='" * 50_000, "<!--" * 50_000, "</" * 50_000], model)
    assert out[0] == f"Title\n{words}"


def test_messages_against_enumeration():
    rnd = np.random.default_rng(3)
    for n in (1, 2, 6, 9):
        parent = np.array([-1] + [int(rnd.integers(0, i)) for i in range(1, n)])
        depth = np.zeros(n, np.int64)
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        order = sorted(range(n), key=lambda i: (depth[i], parent[i]))  # within a level, nodes of one parent stand together
        place = {v: k for k, v in enumerate(order)}
        parent = np.array([place[parent[v]] if parent[v] >= 0 else -1 for v in order])
        depth = depth[order]
        node, pair = rnd.normal(size=(n, 2)), rnd.normal(size=(n, 2, 2))
        states = list(itertools.product((0, 1), repeat=n))
        w = np.exp([sum(node[i, y[i]] for i in range(n)) + sum(pair[i, y[parent[i]], y[i]] for i in range(1, n)) for y in states])
        belief, joint, z = G.sum_product(parent, G.levels(depth), node, pair)
        assert np.isclose(z, np.log(w.sum()))
        for i in range(n):
            assert np.isclose(np.exp(belief[i, 1]), sum(p for p, y in zip(w, states) if y[i]) / w.sum())
            for a, b in itertools.product((0, 1), repeat=2):
                if i:
                    assert np.isclose(np.exp(joint[i, a, b]), sum(p for p, y in zip(w, states) if y[parent[i]] == a and y[i] == b) / w.sum())


def test_gradient_by_differences():
    problem = G._Problem(list(G.labelled_pages(12, 5)))
    rnd = np.random.default_rng(4)
    w = rnd.normal(size=sum(problem.sizes)) * 0.3
    _, g = problem.loss(w)
    for i in rnd.choice(len(w), 25, replace=False):
        step = np.zeros_like(w)
        step[i] = 1e-5
        assert np.isclose((problem.loss(w + step)[0] - problem.loss(w - step)[0]) / 2e-5, g[i], atol=1e-6)


def test_held_out_pages(model):
    wrong = total = 0
    for html in G.labelled_pages(200, 77):
        page = read_page(html)
        likely = G.marginals(forest([page]), model)
        told = [(y, m >= 0.5) for t, y, m in zip(page.text, page.label, likely) if t is not None]
        wrong, total = wrong + sum(y != m for y, m in told), total + len(told)
    assert wrong <= 0.01 * total


PROSE = "The river rose by two metres overnight, and the lower streets were closed to traffic."
PAGES = [
    f"<body><header><a href=/>The Daily</a><nav><a href=/a>News</a><a href=/b>Sport</a></nav></header><div class='cookie-banner'>We use cookies to improve this site. <button>Accept</button></div><main><article><h1>Flood</h1><p>{PROSE}</p><div class=ad>Buy boots now, half price.</div><p>{PROSE} Again.</p></article><aside class=sidebar><h3>Most read</h3><ul><li><a href=/1>One</a><li><a href=/2>Two</a></ul></aside></main><section class=comments><h3>2 comments</h3><div class=comment><b>Ann</b><p>I saw it myself, it was terrible, and nobody came to help us.</p></div></section><footer><p>&copy; 2020 The Daily. All rights reserved.</p></footer>",
    f"<div id=wrapper><div id=header><h2>Site</h2></div><ul class=menu><li><a href=/>Home</a><li><a href=/x>About</a></ul><div id=content><div class=post><h1>Flood</h1><p>{PROSE}<p>{PROSE} Again.</div></div><div id=sidebar><form><p>Search our archive of stories.</p><input></form><p>About the author: she writes on weather.</p></div><div id=footer>Imprint and legal notes, all prices with tax.</div></div>",
    f"<nav><a href=/>Home</a></nav><p class=notice>This site is in maintenance today, please come back later.</p><main><h1>Flood</h1><p>{PROSE}</p><p>{PROSE} Again.</p></main><ol class=commentlist><li>First! What a long and sad story, really.</li><li>Agreed, very sad indeed.</li></ol>",
]


def test_pages_as_sites_write_them(model):
    assert G.main_texts(PAGES, model) == [f"Flood\n{PROSE}\n{PROSE} Again."] * 3
    assert G.main_texts(["<nav><a href=/>Home</a></nav><footer>&copy; 2020</footer>", "", None], model) == ["", "", ""]


def test_pages_of_a_table(spark, model):
    rows = [(i, f"u{i}", h) for i, h in enumerate(PAGES)] + [(None, None, None), (7, "u", ""), (7, "u", PAGES[0])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", F.lit(1).alias("text"), F.lit(2).alias("n_chars"))
    want = f"Flood\n{PROSE}\n{PROSE} Again."
    expected = [(i, f"u{i}", want, len(want)) for i in range(3)] + [(None, None, "", 0), (7, "u", "", 0), (7, "u", want, len(want))]
    assert sorted(map(str, (tuple(r) for r in G.extract_pages(df, model=model).collect()))) == sorted(map(str, expected))
    assert G.extract_pages(df.limit(0), model=model).count() == 0


def test_random_markup_never_fails(model):
    rnd = random.Random(5)
    bits = ["<p>", "</p>", "<div class='a", "'>", "<b>", "</b>", "<table>", "<td>", "</table>", "&#x110000;", "&#0;", "<", ">", "\"", "='", "<!--", "-->", "<script>", "</script>", "text ", "<li>", "</ul>", "\x00", "é", "<a href=x>", "</a>", "<svg/>", "<select>", "</html>", "<body>"]
    pages = ["".join(rnd.choices(bits, k=rnd.randrange(60))) for _ in range(400)]
    together = G.main_texts(pages, model)
    assert together == [G.main_texts([p], model)[0] for p in pages]
