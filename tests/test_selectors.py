"""Selectors against a plain search, and as settings and columns use them."""

import random

import pytest

from weftline import config as settings
from weftline.functions import html as H
from weftline.functions.selectors import SelectorError, compiled, select

LIST = """<div class="nav"><a href="/home">Home</a></div><div class="news-list"><ul>
<li class="item"><a href="/a1.html" title="One">1</a><span class="date">2025-03-01</span></li>
<li class="item top"><a href="/a2.html">Two</a></li><li class="page"><a href="/p2">next</a></li>
<li class="item"><b><a href="a3.html" lang="en-GB">Three</a></b></li></ul></div><a id="last" href="/x">x</a>"""


def found(selector, html=LIST):
    return [n.attrs.get("href") for n in select(H.parse(html), selector)]


@pytest.mark.parametrize(
    ("selector", "hrefs"),
    [
        ("div.news-list li.item a[href]", ["/a1.html", "/a2.html", "a3.html"]),
        ("li.item > a", ["/a1.html", "/a2.html"]),
        (".item a", ["/a1.html", "/a2.html", "a3.html"]),
        ("ul > li.item.top a, #last", ["/a2.html", "/x"]),
        ("a", ["/home", "/a1.html", "/a2.html", "/p2", "a3.html", "/x"]),
        ("*.item a:not([title])", ["/a2.html", "a3.html"]),
        ("li:first-child a", ["/a1.html"]),
        ("li:last-child a", ["a3.html"]),
        ("li:nth-child(2n+1) a", ["/a1.html", "/p2"]),
        ("li:nth-child(3) a", ["/p2"]),
        ("li:nth-child(-n + 2) > a", ["/a1.html", "/a2.html"]),
        ("li.top + li a", ["/p2"]),
        ("li.top ~ li a", ["/p2", "a3.html"]),
        ("div:is(.nav, .none) a", ["/home"]),
        ('a[href$=".html"][href^="/a"]', ["/a1.html", "/a2.html"]),
        ("a[href*='A1' i]", ["/a1.html"]),
        ("a[href*='A1']", []),
        ("a[lang|=en]", ["a3.html"]),
        ("li[class~=top] a", ["/a2.html"]),
        ("span.date:only-child, div div a", []),
        ("DIV.news-list A#none", []),
    ],
)
def test_selectors(selector, hrefs):
    assert found(selector) == hrefs


@pytest.mark.parametrize("broken", ["", " ", "a >", "> a", "a,,b", "li..x", "a[href", "a:hover", ":not(a b)", "a:nth-child(x)", "a:not(b", "a & b", "li:first-child(2)"])
def test_broken_selectors_are_errors(broken):
    with pytest.raises(SelectorError):
        compiled(broken)


def test_a_broken_selector_is_a_config_error():
    portal = {"base_url": "https://h"}
    assert settings.build({"portal": portal | {"detail_link_selector": "div.news-list li.item a[href]"}})
    with pytest.raises(settings.ConfigError, match="detail_link_selector"):
        settings.build({"portal": portal | {"detail_link_selector": "li >> a"}})


def naive(node, steps):
    """By the definition, from the right."""
    combinator, test = steps[-1]
    if not test(node):
        return False
    if len(steps) == 1:
        return True
    parent = node.parent
    siblings = [c for c in parent.children if not isinstance(c, str)][: node.place - 1] if parent is not None else []
    ancestors = []
    while parent is not None and parent.parent is not None:
        ancestors.append(parent)
        parent = parent.parent
    around = {" ": ancestors, ">": ancestors[:1] if node.parent is not None and node.parent.parent is not None else [], "+": siblings[-1:], "~": siblings}[combinator]
    return any(naive(n, steps[:-1]) for n in around)


def test_selectors_against_the_definition():
    rnd = random.Random(3)
    for _ in range(150):
        html, open_ = "", []
        for _ in range(rnd.randrange(30)):
            if open_ and rnd.random() < 0.4:
                html += f"</{open_.pop()}>"
            else:
                open_.append(rnd.choice("pqs"))
                html += f"<{open_[-1]}x class='{rnd.choice(['a', 'b', 'a b', ''])}'>".replace("x class", " class")
        root = H.parse(html)
        for _ in range(8):
            selector = rnd.choice(["p", "q", "s", ".a", "*"])
            for _ in range(rnd.randrange(4)):
                selector += rnd.choice([" ", " > ", " + ", " ~ "]) + rnd.choice(["p", "q", ".a", ".b", "*", "s:first-child"])
            steps = compiled(selector).lists[0]
            assert select(root, selector) == [n for n in root.walk() if n is not root and naive(n, steps)], (html, selector)


def test_links_by_selector_as_columns(spark):
    pages = spark.createDataFrame([(1, "https://h/list", LIST), (2, None, None)], "id int, url string, html string")
    got = H.clean_pages(pages, "id", "url", "html", ("links",), "div.news-list li.item a[href]").orderBy("id").collect()
    assert [(x.url, x.title, x.publish_date) for x in got[0].links] == [("https://h/a1.html", "One", "2025-03-01"), ("https://h/a2.html", "Two", ""), ("https://h/a3.html", "Three", "")]
    assert got[1].links == [] and got[0].asDict().keys() == {"id", "links"}
    with pytest.raises(SelectorError):
        H.clean_pages(pages, "id", "url", "html", selector="a >")


def test_deep_pages_take_linear_time():
    html = "<div class=a>" * 3000 + "<a href=x>"
    assert found("div.a div.a div.a div.a div.a div.a > a", html) == ["x"]


def test_names_without_a_semicolon_are_no_references():
    page = H.parse("<h1>a &amp; b&amp</h1><a href='/x?a=1&copy=2&amp;b=3'>R&ampD &notit; &eacute;t&eacute; &#39;&lt;</a><p>&amp;lt &am & &;</p>")
    assert H.title_of(page) == "a & b&amp"
    assert [(x["url"], x["title"]) for x in H.links_of(page, "https://h/")] == [("https://h/x?a=1&copy=2&b=3", "R&ampD &notit; été '<")]
    assert list(page.children[2].texts()) == ["&lt &am & &;"]
