"""Main text of pages by a tree-structured graphical model over their blocks.

Each node of a page's tree (pagetree) is content or not. Node potentials weigh its tag,
the words of its class, id and role, and its counts of words, links and pauses; potentials
between parent and child, by the child's tag, say how a part of an article goes on or ends.
Sum-product messages upward and downward give exact marginals of every node, all pages of a
batch at once, level by level. The model is trained by the gradient of the conditional
likelihood, which the same messages give, on labelled pages: HTML whose elements carry
data-main="1" or "0" for themselves and all below them. That attribute is no feature.

labelled_pages makes such pages by rule: layouts with headers, menus, notices, adverts,
sidebars, forms, related links, comments and footers around and inside articles of many
shapes, over invented words, so that nothing of the pages to be read is learned from.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.pagetree import LEAF, SIZES, Forest, forest, read_page
from weftline.llm.shared import releasing

#: Training pages, passes over them, step and pull to zero of the weights.
PAGES, PASSES, STEP, DECAY = 900, 160, 0.15, 2e-4
#: Characters of HTML whose pages are worked on together.
_TOGETHER = 2_000_000


class Model(NamedTuple):
    named: dict[str, int]
    named_weights: np.ndarray
    bucket_weights: np.ndarray
    pairs: np.ndarray
    kinds: dict[str, int]


def features(signature: tuple) -> list[str]:
    tag = signature[0]
    if tag == LEAF:
        return [f"text in {signature[1]}", *(f"within {w}" for w in signature[2])]
    return [f"tag {tag}", *(f"mark {w}" for w in signature[1]), *(["hidden"] if signature[2] else [])]


def _bucket_index(f: Forest, leaf: np.ndarray) -> np.ndarray:
    """Place of each numeric feature of each node among the weights."""
    starts = np.cumsum((0, *SIZES[:-1]))
    return f.buckets + starts + np.where(leaf, sum(SIZES), 0)[:, None]


def levels(depth: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max(initial=0) + 1)))


def sum_product(parent: np.ndarray, by_depth: list[np.ndarray], node: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Log marginals (n, 2) of nodes, those (n, 2, 2) of a parent and its child, and the sum of log Z.

    node: (n, 2) log potentials; pair: (n, 2, 2) of each node's parent and the node.
    """
    up, sent = node.copy(), np.zeros_like(node)
    for at in reversed(by_depth[1:]):
        both = pair[at] + up[at][:, None, :]
        sent[at] = np.logaddexp(both[:, :, 0], both[:, :, 1])
        # Nodes of one parent stand together within a level, as it is in page order.
        first = np.flatnonzero(np.diff(parent[at], prepend=-1))
        up[parent[at[first]]] += np.add.reduceat(sent[at], first)
    down = np.zeros_like(node)
    joint = np.zeros_like(pair)
    for at in by_depth[1:]:
        above = up[parent[at]] + down[parent[at]] - sent[at]
        both = pair[at] + above[:, :, None]
        down[at] = np.logaddexp(both[:, 0], both[:, 1])
        joint[at] = both + up[at][:, None, :]
    belief = up + down
    z = np.logaddexp(belief[:, 0], belief[:, 1])
    belief -= z[:, None]
    joint -= z[:, None, None]
    return belief, joint, float(z[by_depth[0]].sum())


def _potentials(f: Forest, model: Model) -> tuple[np.ndarray, np.ndarray]:
    known: dict[tuple, tuple[float, int]] = {}
    weight, kind = np.empty(len(f.signature)), np.empty(len(f.signature), np.int64)
    for i, s in enumerate(f.signature):
        got = known.get(s)
        if got is None:
            got = known[s] = (sum(model.named_weights[model.named[x]] for x in features(s) if x in model.named), model.kinds.get(s[0], 0))
        weight[i], kind[i] = got
    leaf = np.array([s[0] == LEAF for s in f.signature], bool)
    node = np.zeros((len(weight), 2))
    node[:, 1] = weight + model.bucket_weights[_bucket_index(f, leaf)].sum(axis=1)
    return node, model.pairs[kind]


def marginals(f: Forest, model: Model) -> np.ndarray:
    """The probability of content of each node."""
    if not len(f.parent):
        return np.zeros(0)
    belief, _, _ = sum_product(f.parent, levels(f.depth), *_potentials(f, model))
    return np.exp(belief[:, 1])


class _Problem:
    """Loss and gradient over labelled pages, weights in one vector."""

    def __init__(self, htmls: list[str]) -> None:
        self.f = f = forest([read_page(h) for h in htmls])
        lists = [features(s) for s in f.signature]
        held: dict[str, int] = {}
        for names in lists:
            for x in names:
                held[x] = held.get(x, 0) + 1
        self.named = {x: i for i, x in enumerate(sorted(x for x, n in held.items() if n > 2))}
        self.kinds = {t: i + 1 for i, t in enumerate(sorted({s[0] for s in f.signature}))}
        found = [[self.named[x] for x in names if x in self.named] for names in lists]
        self.of = np.repeat(np.arange(len(found)), [len(x) for x in found])
        self.name = np.array([i for x in found for i in x], np.int64)
        self.bucket = _bucket_index(f, np.array([s[0] == LEAF for s in f.signature], bool))
        self.kind = np.array([self.kinds[s[0]] for s in f.signature])
        self.levels = levels(f.depth)
        self.inner = f.parent >= 0
        self.sizes = (len(self.named), 2 * sum(SIZES), 4 * (len(self.kinds) + 1))

    def split(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights of names, of buckets, and pair potentials; those of kind 0 are common to all kinds."""
        names, buckets, pairs = np.split(w, np.cumsum(self.sizes[:-1]))
        pairs = pairs.reshape(-1, 2, 2)
        return names, buckets, np.concatenate([pairs[:1], pairs[1:] + pairs[:1]])

    def loss(self, w: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean of the negative log likelihood of a page with decay, and its gradient."""
        f, y, n = self.f, self.f.label, len(self.f.root)
        names, buckets, pairs = self.split(w)
        node = np.zeros((len(y), 2))
        node[:, 1] = np.bincount(self.of, names[self.name], len(y)) + buckets[self.bucket].sum(axis=1)
        pair = pairs[self.kind]
        belief, joint, z = sum_product(f.parent, self.levels, node, pair)
        inner = np.flatnonzero(self.inner)
        above = y[f.parent[inner]]
        score = (y * node[:, 1]).sum() + pair[inner, above, y[inner]].sum()
        off = np.exp(belief[:, 1]) - y
        left = np.exp(joint[inner])
        left[np.arange(len(inner)), above, y[inner]] -= 1
        cell = self.kind[inner][:, None] * 4 + np.arange(4)
        by_kind = np.bincount(cell.ravel(), left.ravel(), self.sizes[2]).reshape(-1, 2, 2)
        by_kind[0] = by_kind[1:].sum(axis=0)
        gradient = np.concatenate([np.bincount(self.name, off[self.of], self.sizes[0]), np.bincount(self.bucket.ravel(), np.repeat(off, len(SIZES)), self.sizes[1]), by_kind.ravel()])
        return (z - score) / n + DECAY / 2 * float(w @ w), gradient / n + DECAY * w


def train(htmls: list[str], passes: int = PASSES) -> Model:
    """A model of labelled pages, the same for the same pages."""
    problem = _Problem(htmls)
    w = np.zeros(sum(problem.sizes))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for i in range(1, passes + 1):
        _, g = problem.loss(w)
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        w -= STEP * (1 - i / (passes + 1)) * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-8)
    names, buckets, pairs = problem.split(w)
    return Model(problem.named, names, buckets, pairs, problem.kinds)


def main_texts(htmls: list[str | None], model: Model) -> list[str]:
    """The main text of each page: its content blocks in page order, one a line."""
    pages = [read_page(h) for h in htmls]
    f = forest(pages)
    likely = marginals(f, model)
    out, at = [], 0
    for p in pages:
        out.append("\n".join(t for t, m in zip(p.text, likely[at : at + len(p.text)].tolist(), strict=True) if t is not None and m >= 0.5))
        at += len(p.text)
    return out


def _grouped(htmls: list[str | None]) -> Iterator[list[str | None]]:
    group, size = [], 0
    for h in htmls:
        group.append(h)
        size += len(h or "")
        if size >= _TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: Model | None = None) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of each row of pages.

    Character references are decoded, white space inside a block (line breaks are such) is
    one space, and blocks are joined by one line feed. Null and empty pages, and pages
    without an article, have an empty text. Ids and urls pass through, null or repeated.
    Pages of any length and nesting are read whole, in time linear in both. An empty table
    gives no rows; other columns play no part.
    """
    model = model or train(list(labelled_pages()))
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t for group in _grouped(b.column(2).to_pylist()) for t in main_texts(group, shared.value)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string")).mapInArrow(releasing(run), f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")


# Words that sites use in classes and ids of the parts of a page.
_MARKS = {
    "menu": "nav menu navbar navigation topnav main-menu nav-links tabs toolbar",
    "header": "header site-header masthead top-bar page-header branding logo-bar",
    "crumbs": "breadcrumb breadcrumbs crumbs path",
    "footer": "footer site-footer page-footer bottom copyright colophon legal",
    "sidebar": "sidebar side-bar widget widgets sidebar-right rail secondary aside column-right infobox toc",
    "notice": "notice cookie cookie-banner cookie-notice alert banner gdpr consent warning paywall message announcement disclaimer subscribe-notice popup modal overlay",
    "advert": "ad ads advert advertisement sponsored promo ad-slot adsbygoogle banner-ad promotion sponsor teaser-ad dfp commercial affiliate",
    "form": "form newsletter signup login search search-box subscribe contact-form survey poll",
    "comments": "comments comment-list comments-area discussion responses comment reply replies disqus reader-comments user-comments feedback thread",
    "related": "related related-posts recommended more-stories read-more see-also popular trending also-like pagination pager next-prev",
    "share": "share social share-buttons social-links sharing follow tags post-tags author-box bio",
    "article": "article content post entry post-content entry-content article-body story story-body main main-content article-content body-text page-content post-body text blog-post news-item",
    "page": "container wrapper page site row col-8 col-md-9 layout inner outer grid app root wrap has-sidebar single-post",
}
_TAGS = {"menu": ("nav", "ul"), "header": ("header",), "footer": ("footer",), "sidebar": ("aside",), "form": ("form",), "article": ("article", "main", "article", "section"), "comments": ("section", "ol"), "notice": ("aside", "section", "p"), "advert": ("aside", "section"), "related": ("section", "aside", "nav")}


class _Writer:
    """Pages by rule from a seeded generator."""

    def __init__(self, seed: int) -> None:
        self.rng, self.plain = random.Random(seed), False

    def some(self, chance: float) -> bool:
        return self.rng.random() < chance

    def many(self, low: int, high: int) -> int:
        return self.rng.randint(low, high)

    def one(self, of):
        return self.rng.choice(of)

    def words(self, n: int) -> str:
        return " ".join("".join(self.one(("ka", "lo", "mi", "ter", "on", "dé", "s", "ra", "nu", "ö", "th")) for _ in range(self.many(1, 4))) for _ in range(n))

    def sentence(self) -> str:
        if self.plain:  # texts without sentences, such as lists of words
            return " ".join([self.words(1)] * self.many(2, 30)) if self.some(0.5) else self.words(self.many(3, 30))
        parts = [self.words(self.many(1, 9)) for _ in range(self.many(1, 3))]
        return ", ".join(parts).capitalize() + self.one((".", ".", ".", ".", "?", "!", ":", ""))

    def prose(self, low: int, high: int) -> str:
        out = " ".join(self.sentence() for _ in range(self.many(low, high)))
        if self.some(0.1):
            cut = out.split(" ")
            at = self.many(0, len(cut) - 1)
            cut[at] = self.one((f'<a href="/x">{cut[at]}</a>', f"<b>{cut[at]}</b>", f"<em>{cut[at]}</em>", f"{cut[at]}<br>", f"<span>{cut[at]}</span>"))
            out = " ".join(cut)
        return out

    def links(self, low: int, high: int, item: str = "li") -> str:
        return "".join(f'<{item}><a href="/{i}">{self.words(self.many(1, 4)).capitalize()}</a></{item}>' for i in range(self.many(low, high)))

    def element(self, kind: str, inner: str, label: int | None = 0, bare: float = 0.25) -> str:
        """inner in an element of that kind of part; bare: the chance of no class or id where the tag says enough."""
        tag = self.one(_TAGS[kind]) if kind in _TAGS and self.some(0.5) else "div"
        telling = tag not in ("div", "section", "ul", "ol", "p") and kind in _TAGS
        marks = ""
        if not (telling and self.some(max(bare, 0.5))) and (kind != "article" or not self.some(bare)):
            names = self.one(_MARKS[kind].split())
            if self.some(0.15):
                names += " " + self.one(_MARKS["page"].split())
            marks = f' {self.one(("class", "class", "id"))}="{names}"'
        if tag in ("ul", "ol") and not inner.startswith("<li"):
            inner = f"<li>{inner}</li>"
        if tag == "p" and "<p" in inner or tag == "p" and "<div" in inner or tag == "p" and "<h" in inner:
            tag = "div"
        main = "" if label is None else f' data-main="{label}"'
        return f"<{tag}{marks}{main}>{inner}</{tag}>"

    def menu(self) -> str:
        items = self.links(3, 9)
        return self.element("menu", self.one((items, f"<ul>{items}</ul>", f"<ul>{items}</ul>", self.links(3, 9, "span"))))

    def header(self) -> str:
        inner = self.one(("", f'<a href="/">{self.words(2)}</a>', f"<h1>{self.words(2)}</h1>", f"<h2>{self.words(2)}</h2>")) + self.one(("", f"<p>{self.words(self.many(2, 8))}</p>", self.words(4)))
        return self.element("header", inner + (self.menu() if self.some(0.4) else "") + (self.form() if self.some(0.2) else ""))

    def footer(self) -> str:
        lines = [f"&copy; {self.words(2)}", f"&copy; {self.words(1)} &middot; {self.prose(1, 3)}", self.prose(1, 3), f"<ul>{self.links(2, 6)}</ul>", f"<p>{self.prose(1, 4)}</p>"]
        return self.element("footer", "".join(self.one(lines) for _ in range(self.many(1, 3))))

    def sidebar(self) -> str:
        parts = [f"<h3>{self.words(2)}</h3><ul>{self.links(2, 7)}</ul>", f"<h3>{self.words(2)}</h3><p>{self.prose(1, 4)}</p>", f"<p>{self.prose(1, 3)}</p>", f"<ul>{self.links(3, 8)}</ul>", self.advert(), f"<p>{self.words(3)}</p>"]
        return self.element("sidebar", "".join(self.one(parts) for _ in range(self.many(1, 4))))

    def notice(self) -> str:
        text = self.prose(1, 4)
        return self.element("notice", self.one((text, f"<p>{text}</p>", f"<p>{text}</p><p>{self.prose(1, 2)}</p>", f'{text} <a href="/ok">{self.words(1)}</a>', f"<h4>{self.words(2)}</h4><p>{text}</p>")), bare=0.05)

    def advert(self) -> str:
        text = self.prose(1, 3)
        return self.element("advert", self.one((text, text, f"<p>{text}</p>", f'<a href="/buy">{text}</a>', f"<h4>{self.words(3)}</h4><p>{text}</p>", f'<p><a href="/go">{self.words(5)}</a></p>')), bare=0.05)

    def form(self) -> str:
        inner = self.one(("", f"<h3>{self.words(3)}</h3>", f"<p>{self.prose(1, 3)}</p>")) + f"<label>{self.words(1)}</label><input name=q>" + self.one(("", f"<p>{self.words(4)}</p>", f"<button>{self.words(1)}</button>", f"<select><option>{self.words(1)}</select>"))
        return f"<form data-main=\"0\"{self.one(('', ' class=' + self.one(_MARKS['form'].split())))}>{inner}</form>" if self.some(0.7) else self.element("form", f"<form>{inner}</form>")

    def comments(self) -> str:
        def comment() -> str:
            who = self.one(("", f'<a href="/u">{self.words(1)}</a>', f"<b>{self.words(1)}</b>", f"<span>{self.words(2)}</span>", f'<div class="author">{self.words(2)}</div>', f"<h4>{self.words(1)}</h4>"))
            text = self.one((f"<p>{self.prose(1, 6)}</p>", self.prose(1, 5), f"<p>{self.prose(1, 4)}</p><p>{self.prose(1, 4)}</p>"))
            return who + text

        shape = self.one(("li", "div", "p", "blockquote", "li", "div", "p", "article"))
        each = self.one((*([""] if shape != "article" else []), ' class="comment"', ' class="comment-body"', ' class="reply"'))
        body = "".join(f"<{shape}{each}>{c}</{shape}>" for c in (comment() for _ in range(self.many(1, 8))))
        return self.element("comments", self.one(("", f"<h3>{self.words(2)}</h3>", f"<h2>{self.words(1)}</h2>")) + (f"<ul>{body}</ul>" if shape == "li" else body) + (self.form() if self.some(0.3) else ""), bare=0.02)

    def related(self) -> str:
        teasers = "".join(f'<div><h4><a href="/{i}">{self.words(4)}</a></h4><p>{self.prose(1, 2)}</p></div>' for i in range(self.many(2, 4)))
        return self.element("related", self.one(("", f"<h3>{self.words(2)}</h3>")) + self.one((f"<ul>{self.links(2, 6)}</ul>", self.links(2, 5, "p"), teasers)), bare=0.05)

    def share(self) -> str:
        return self.element("share", self.one((f"<ul>{self.links(2, 5)}</ul>", self.links(2, 5, "span"), f"<p>{self.words(3)}</p>" + self.links(1, 3, "span"))), bare=0.0)

    def paragraph(self) -> str:
        kind = self.many(0, 39)
        if kind == 0:
            return f"<ul>{''.join(f'<li>{self.prose(1, 2)}</li>' for _ in range(self.many(2, 6)))}</ul>"
        if kind == 1:
            return f"<ol>{''.join(f'<li>{self.words(self.many(1, 6))}</li>' for _ in range(self.many(2, 6)))}</ol>"
        if kind == 2:
            return f"<blockquote>{self.one((self.prose(1, 3), f'<p>{self.prose(1, 3)}</p>'))}</blockquote>"
        if kind == 3:
            rows = "".join(f"<tr><td>{self.words(2)}</td><td>{self.words(1)}</td></tr>" for _ in range(self.many(2, 5)))
            return f"<table>{rows}</table>"
        if kind == 4:
            return f"<pre>{self.words(8)}</pre>"
        if kind == 5:
            return f"<figure><img src=x><figcaption>{self.prose(1, 1)}</figcaption></figure>"
        if kind == 6:
            return f"<div>{self.prose(1, 5)}</div>"
        if kind in (7, 8):
            return f"<{(h := self.one(('h2', 'h3')))}>{self.words(self.many(1, 6))}</{h}>"
        if kind == 9:
            return f'<p>{self.words(2)} <a href="/y">{self.words(self.many(1, 6))}</a></p>'
        if kind == 10:
            return f"<p><b>{self.prose(1, 4)}<br>"
        if kind == 11:
            return f"<section><h2>{self.words(3)}</h2><p>{self.prose(1, 5)}</p></section>"
        if kind in (12, 13):
            return f"<p>{self.words(1).capitalize()}.</p>"
        if kind == 14:
            return f"<p>{' | '.join(self.words(1) for _ in range(self.many(2, 12)))}</p>"
        return f"<p>{self.prose(1, 8)}{self.one(('</p>', '</p>', '</p>', ''))}"

    def article(self) -> str:
        title = self.one(("", "<h1>{}</h1>", "<h1>{}</h1>", "<h1>{}</h1>", "<h2>{}</h2>", "<header><h1>{}</h1></header>", '<h1 class="title">{}</h1>')).format(self.words(self.many(2, 10)).capitalize())
        if self.some(0.1):
            title += f"<p>{self.words(3)}</p>"
        most, self.plain = self.one((1, 3, 12, 30)), self.some(0.2)
        body = [self.paragraph() for _ in range(self.many(1, most))]
        if self.some(0.1):
            body = [self.prose(1, 6) + "<br>" for _ in body[:4]]
        elif self.some(0.2):  # verses, logs, lists of names: many short lines, often the same
            line = f"<p>{self.words(self.many(1, 4))}{self.one(('', '.'))}</p>"
            body += [line if self.some(0.5) else f"<p>{self.words(self.many(1, 5))}.</p>" for _ in range(self.many(2, 40))]
        self.plain = False
        for part, chance in ((self.advert, 0.2), (self.share, 0.12), (self.related, 0.08), (self.form, 0.08), (self.notice, 0.1), (self.sidebar, 0.05)):
            if self.some(chance):
                body.insert(self.many(0, len(body)), part())
        if self.some(0.2):
            body.append(self.comments())
        inner = "".join(body)
        if self.some(0.2):
            inner = f'<div class="{self.one(_MARKS["article"].split())}">{inner}</div>'
        elif self.some(0.1):
            inner = f"<div>{inner}</div>"
        return self.element("article", title + inner, 1, bare=0.4)

    def wrapped(self, inner: str) -> str:
        for _ in range(self.many(0, 2)):
            inner = f"<div{self.one(('', ' class="' + self.one(_MARKS['page'].split()) + '"', ' id="' + self.one(_MARKS['page'].split()) + '"'))}>{inner}</div>"
        return inner

    def page(self) -> str:
        middle = [self.article()] if not self.some(0.05) else []
        for part, chance in ((self.sidebar, 0.4), (self.comments, 0.3), (self.related, 0.25), (self.advert, 0.3), (self.notice, 0.1)):
            if self.some(chance):
                middle.insert(0 if self.some(0.3) else len(middle), part())
        row = self.wrapped("".join(middle))
        if self.some(0.25):
            row = f"<main>{row}</main>"
        top = "".join(part() for part, chance in ((self.notice, 0.25), (self.header, 0.6), (self.menu, 0.6), (self.advert, 0.3), (self.form, 0.1)) if self.some(chance))
        if self.some(0.2):
            top += self.element("crumbs", self.links(2, 4, "span"))
        bottom = "".join(part() for part, chance in ((self.related, 0.1), (self.advert, 0.1), (self.form, 0.1), (self.menu, 0.1), (self.footer, 0.8), (self.notice, 0.15)) if self.some(chance))
        classes = self.one(("", ' class="home page has-sidebar"', ' class="single-post"'))
        return f"<!DOCTYPE html><html><head><title>{self.words(3)}</title><style>p{{}}</style></head><body{classes}>{self.wrapped(top + row + bottom)}</body></html>"


def labelled_pages(n: int = PAGES, seed: int = 13) -> Iterator[str]:
    """n pages with labels, made by rule."""
    writer = _Writer(seed)
    for _ in range(n):
        yield writer.page()


def op13_html(spark, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
