"""Pages as trees of blocks: a linear reading of HTML that keeps what layout and text show.

Nodes are the block elements of a page and its runs of text between block bounds; inline
elements and line breaks are part of such a run. Depth is bounded as in browsers: what
lies deeper hangs on the last element that fits.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import numpy as np

# Elements by the part they play in HTML.
UNSEEN = frozenset("script style noscript template title textarea select button iframe object svg canvas audio video noframes noembed xmp".split())
RAW = frozenset("script style title textarea iframe noscript noframes noembed xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label map mark math meter output picture progress q rp rt ruby s samp small source span strike strong sub sup time track tt u var wbr area embed param br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_P = frozenset("address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul".split())
#: What a start tag closes, and where the search for it ends.
CLOSED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
#: End tags do not look beyond these.
_WALLS = {"table", "td", "th", "html"}
MOST_DEPTH = 512
LEAF = "#text"
#: A run of so many letters weighs as a word at least, for scripts without spaces.
_LETTERS = 8

_TOKEN = re.compile(r"""<(?:!--(?:.*?-->|.*\Z)|[!?][^>]*+(?:>|\Z)|(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?)*+)(?:>|\Z)|/[^>]*+(?:>|\Z))""", re.S)
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden|style|data-main)(?![\w-])(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SENTENCE = re.compile(r"[.!?…。！？](?:\s|$)|[,;:，；]\s")


@lru_cache(8192)
def marks(attrs: str) -> tuple[tuple[str, ...], bool, str | None]:
    """The words of class, id and role, whether the element is hidden, and its label in a training page."""
    words, hidden, label = [], False, None
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id", "role"):
            words += [w.lower() for w in _WORD.findall(value)]
        elif name == "data-main":
            label = value
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        else:
            hidden |= value.lower() != "false"
    return tuple(dict.fromkeys(words)), hidden, label


class Page(NamedTuple):
    """Nodes in page order; of each its parent, depth, last node below it, and signature.

    A signature is (tag, words, hidden) of an element, and (LEAF, parent's tag, words of
    inline elements around) of a text. words, linked and pauses are counts of a text.
    """

    parent: list[int]
    depth: list[int]
    last: list[int]
    signature: list[tuple]
    label: list[int]
    text: list[str | None]
    words: list[int]
    linked: list[int]
    pauses: list[int]


class _Reader:
    def __init__(self) -> None:
        self.page = Page(*([] for _ in Page._fields))
        self.open: list[tuple[str, int]] = []  # block elements and their nodes
        self.inline: list[tuple[str, tuple[str, ...], int]] = []  # inline elements, their words, blocks open before
        self.parts: list[tuple[str, bool]] = []
        self.around: tuple[str, ...] = ()
        self.links = 0
        self.node("html", ("html", (), False), None)

    def node(self, tag: str, signature: tuple, label: str | None, text: str | None = None, counts: tuple[int, int, int] = (0, 0, 0)) -> int:
        p, n = self.page, len(self.page.parent)
        up = self.open[-1][1] if self.open else -1
        p.parent.append(up)
        p.depth.append(p.depth[up] + 1 if up >= 0 else 0)
        p.last.append(n)
        p.signature.append(signature)
        p.label.append(int(label == "1") if label is not None else p.label[up] if up >= 0 else 0)
        p.text.append(text)
        for column, value in zip((p.words, p.linked, p.pauses), counts, strict=True):
            column.append(value)
        if text is None and len(self.open) < MOST_DEPTH:
            self.open.append((tag, n))
        return n

    def flush(self) -> None:
        """Ends the run of text that is open."""
        if self.parts:
            text = " ".join("".join(x for x, _ in self.parts).split())
            if text:
                linked = sum(len(x.split()) for x, a in self.parts if a)
                words = max(text.count(" ") + 1, len(text) // _LETTERS)
                tag = self.open[-1][0]
                self.node(LEAF, (LEAF, tag, self.around), None, text, (words, min(linked, words), len(_SENTENCE.findall(text))))
            self.parts = []
        self.around = ()

    def pop(self, to: int) -> None:
        """Closes blocks until only to are open."""
        while len(self.open) > to:
            _, n = self.open.pop()
            self.page.last[n] = len(self.page.parent) - 1
        while self.inline and self.inline[-1][2] > to:
            self.links -= self.inline.pop()[0] == "a"

    def find(self, tags: set[str], walls: set[str]) -> int | None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in tags:
                return i
            if self.open[i][0] in walls:
                return None
        return None

    def start(self, tag: str, attrs: str) -> None:
        words, hidden, label = marks(attrs) if attrs and ("class" in attrs or "id" in attrs or tag != "a") else ((), False, None)
        if tag == "br":
            self.parts.append((" ", False))
        elif tag in INLINE:
            if tag not in VOID:
                self.inline.append((tag, words, len(self.open)))
                self.links += tag == "a"
                if words:
                    self.around += words
        elif tag == "html" or tag == "body":
            pass
        else:
            self.flush()
            if tag in ENDS_P and (at := self.find({"p"}, _WALLS)):
                self.pop(at)
            if tag in CLOSED:
                tags, walls = CLOSED[tag]
                while at := self.find(tags, walls):
                    self.pop(at)
            if tag not in VOID:
                self.node(tag, (tag, words, hidden), label)
                self.around = tuple(w for _, ws, _ in self.inline for w in ws)

    def end(self, tag: str) -> None:
        if tag in INLINE:
            for i in range(len(self.inline) - 1, -1, -1):
                if self.inline[i][0] == tag and self.inline[i][2] == len(self.open):
                    self.links -= tag == "a"
                    del self.inline[i]
                    break
            return
        self.flush()
        if tag not in ("html", "body") and (at := self.find({tag}, _WALLS - {tag})):
            self.pop(at)

    def read(self, html: str) -> Page:
        at = 0
        while m := _TOKEN.search(html, at):
            if m.start() > at:
                self.said(html[at : m.start()])
            at = m.end()
            if m[2]:
                tag = m[2].lower()
                if m[1]:
                    self.end(tag)
                elif tag in UNSEEN and not m[3].endswith("/"):
                    close = re.compile(rf"</{tag}(?![\w-])[^>]*>?", re.I).search(html, at)
                    if close or tag in RAW:
                        at = close.end() if close else len(html)
                else:
                    self.start(tag, m[3])
        if at < len(html):
            self.said(html[at:])
        self.flush()
        self.pop(0)
        return self.page

    def said(self, raw: str) -> None:
        self.parts.append((unescape(raw) if "&" in raw else raw, self.links > 0))


def read_page(html: str | None) -> Page:
    return _Reader().read(html or "")


class Forest(NamedTuple):
    """Pages side by side: arrays over all their nodes."""

    parent: np.ndarray
    depth: np.ndarray
    root: np.ndarray
    last: np.ndarray
    signature: list[tuple]
    label: np.ndarray
    buckets: np.ndarray
    page: np.ndarray


#: Values of each numeric feature of a node: words, share of links, pauses a word, place, share of the page.
SIZES = (10, 5, 5, 6, 6)


def forest(pages: list[Page]) -> Forest:
    """The pages as one forest, with the numeric features of each node in buckets."""
    sizes = np.array([len(p.parent) for p in pages], np.int64)
    page = np.repeat(np.arange(len(pages)), sizes)
    first = np.cumsum(sizes) - sizes
    shift = first[page]
    column = lambda name: np.array([x for p in pages for x in getattr(p, name)], np.int64)
    parent, last = column("parent"), column("last") + shift
    parent = np.where(parent < 0, -1, parent + shift)
    totals = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(np.stack([column("words"), column("linked"), column("pauses")], 1), axis=0)])
    here = np.arange(len(page))
    words, linked, pauses = (totals[last + 1] - totals[here]).T
    before, whole = totals[here, 0] - totals[first[page], 0], np.maximum(totals[(first + sizes)[page], 0] - totals[first[page], 0], 1)
    some = np.maximum(words, 1)
    buckets = np.stack(
        [
            np.minimum(np.ceil(np.log2(words + 1)).astype(np.int64), SIZES[0] - 1),
            np.ceil(linked / some * (SIZES[1] - 1)).astype(np.int64),
            np.minimum(np.ceil(pauses / some * 16).astype(np.int64), SIZES[2] - 1),
            np.minimum(before * SIZES[3] // whole, SIZES[3] - 1),
            np.ceil(words / whole * (SIZES[4] - 1)).astype(np.int64),
        ],
        1,
    )
    return Forest(parent, column("depth"), here[parent < 0], last, [s for p in pages for s in p.signature], column("label"), buckets, page)
