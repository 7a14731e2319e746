"""CSS selectors over the trees of functions.html.

A selector is a list, by comma, of compounds with combinators between them. All of a page's
matches are found in one walk: a node knows which beginnings of the selector end at it, at
its ancestors and at its earlier siblings, as bits of a number, so time is linear in the
page whatever its depth, and nothing is tried twice.

Known are types, `*`, `.class`, `#id`, `[a]` with the six operators and the flag `i`,
`:first-child`, `:last-child`, `:only-child`, `:nth-child()`, `:empty`, `:not()` and `:is()`
of compounds, and the combinators space, `>`, `+` and `~`. Anything else is a SelectorError.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache
from typing import TYPE_CHECKING, NamedTuple

if TYPE_CHECKING:
    from weftline.functions.html import Node

    Test = Callable[[Node], bool]


class SelectorError(ValueError):
    """A selector that cannot be read."""


_NAME = r"(?:[A-Za-z_\u0080-\U0010ffff-][\w\u0080-\U0010ffff-]*)"
_PART = re.compile(rf"""\.({_NAME})|\#({_NAME})|\[\s*({_NAME})\s*(?:([~|^$*]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\s\]"']+))\s*([iIsS])?\s*)?\]|:({_NAME})(\()?""")
_TYPE = re.compile(rf"\*|{_NAME}")
_STEP = re.compile(r"\s*([>+~])\s*|\s+")
_NTH = re.compile(r"\s*(?:(odd)|(even)|([+-]?\d*)n\s*(?:([+-])\s*(\d+))?|([+-]?\d+))\s*$", re.I)


class Compiled(NamedTuple):
    """For each selector of the list, its compounds with the combinator before each."""

    lists: tuple[tuple[tuple[str, Test], ...], ...]


def _attribute(name: str, op: str, value: str, folded: bool) -> Test:
    name = name.lower()
    if not op:
        return lambda n: name in n.attrs
    fold = str.lower if folded else str
    value = fold(value)
    holds = {
        "=": lambda got: got == value,
        "~=": lambda got: value != "" and value in got.split(),
        "|=": lambda got: got == value or got.startswith(f"{value}-"),
        "^=": lambda got: value != "" and got.startswith(value),
        "$=": lambda got: value != "" and got.endswith(value),
        "*=": lambda got: value != "" and value in got,
    }[op]
    return lambda n: name in n.attrs and holds(fold(n.attrs[name]))


def _elements(node: Node) -> list:
    return [c for c in node.children if not isinstance(c, str)]


def _nth(text: str) -> Test:
    m = _NTH.match(text)
    if not m:
        raise SelectorError(f"cannot read nth-child({text})")
    if m[1] or m[2]:
        a, b = 2, 1 if m[1] else 0
    elif m[6]:
        a, b = 0, int(m[6])
    else:
        a = int(f"{m[3]}1") if m[3] in ("", "+", "-") else int(m[3])
        b = int(f"{m[4]}{m[5]}") if m[5] else 0

    def test(n: Node) -> bool:
        off = n.place - b
        return off == 0 if a == 0 else off % a == 0 and off // a >= 0

    return test


def _pseudo(name: str, inner: str | None) -> Test:
    plain: dict[str, Test] = {
        "first-child": lambda n: n.place == 1,
        "last-child": lambda n: n.parent is not None and n.place == n.parent.elements,
        "only-child": lambda n: n.parent is not None and n.parent.elements == 1,
        "empty": lambda n: not n.children,
    }
    name = name.lower()
    if inner is None and name in plain:
        return plain[name]
    if inner is not None and name == "nth-child":
        return _nth(inner)
    if inner is not None and name in ("not", "is"):
        lists = compiled(inner).lists
        if any(len(steps) > 1 for steps in lists):
            raise SelectorError(f":{name}() holds compounds only")
        tests = [steps[0][1] for steps in lists]
        return (lambda n: any(t(n) for t in tests)) if name == "is" else (lambda n: not any(t(n) for t in tests))
    raise SelectorError(f"unknown :{name}{'()' if inner is not None else ''}")


def _closing(text: str, at: int) -> int:
    """The place of the bracket that closes one opened before at; quoted text is passed over."""
    depth, quote = 1, ""
    for i in range(at, len(text)):
        c = text[i]
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        else:
            depth += (c == "(") - (c == ")")
            if not depth:
                return i
    raise SelectorError(f"no closing bracket in {text!r}")


def _compound(text: str, at: int) -> tuple[Test, int]:
    """The test of the compound that starts at a place, and where it ends."""
    tests: list[Test] = []
    begun = at
    if m := _TYPE.match(text, at):
        at = m.end()
        if m[0] != "*":
            tag = m[0].lower()
            tests.append(lambda n: n.tag == tag)
    while m := _PART.match(text, at):
        at = m.end()
        if m[1]:
            tests.append(lambda n, name=m[1]: name in n.attrs.get("class", "").split())
        elif m[2]:
            tests.append(lambda n, name=m[2]: n.attrs.get("id") == name)
        elif m[3]:
            tests.append(_attribute(m[3], m[4], next((x for x in m.group(5, 6, 7) if x is not None), ""), (m[8] or "").lower() == "i"))
        else:
            inner = None
            if m[10]:
                close = _closing(text, at)
                inner, at = text[at:close], close + 1
            tests.append(_pseudo(m[9], inner))
    if at == begun:
        raise SelectorError(f"cannot read {text[at:]!r} in selector {text!r}")
    if len(tests) == 1:
        return tests[0], at
    return (lambda n: all(t(n) for t in tests)), at


@cache
def compiled(selector: str) -> Compiled:
    """The selector, read; SelectorError where it cannot be."""
    text, at = selector.strip(), 0
    lists: list[tuple[tuple[str, Test], ...]] = []
    steps: list[tuple[str, Test]] = []
    step = ""
    while True:
        test, at = _compound(text, at)
        steps.append((step, test))
        if at < len(text) and (m := re.compile(r"\s*,\s*").match(text, at)):
            lists.append(tuple(steps))
            steps, step, at = [], "", m.end()
            continue
        if at == len(text):
            lists.append(tuple(steps))
            return Compiled(tuple(lists))
        m = _STEP.match(text, at)
        if not m or m.end() == len(text):
            raise SelectorError(f"cannot read {text[at:]!r} in selector {text!r}")
        step, at = m[1] or " ", m.end()


def test_of(selector: str) -> Test | None:
    """A test of single nodes, if the selector has no combinators."""
    lists = compiled(selector).lists
    if any(len(steps) > 1 for steps in lists):
        return None
    tests = [steps[0][1] for steps in lists]
    return tests[0] if len(tests) == 1 else lambda n: any(t(n) for t in tests)


def select(root: Node, selector: str) -> list:
    """The elements below root that the selector matches, in page order, each once."""
    test = test_of(selector)
    if test:
        return [n for n in root.walk() if n is not root and test(n)]
    # Every step of every list has a bit; a bit stands where the selector up to that step ends.
    steps = [(1 << k, combinator, test, i == 0, i == len(s) - 1) for k, (s, i, combinator, test) in enumerate((s, i, c, t) for s in compiled(selector).lists for i, (c, t) in enumerate(s))]
    final = sum(bit for bit, _, _, _, last in steps if last)
    found, stack = [], [(root, 0, 0)]  # node, bits at it, bits at its ancestors and itself
    order: dict[int, int] = {}
    for i, n in enumerate(root.walk()):
        order[id(n)] = i
    while stack:
        node, here, above = stack.pop()
        before = earlier = 0
        for child in _elements(node):
            bits = 0
            for bit, combinator, test, first, _ in steps:
                reach = -1 if first else above if combinator == " " else here if combinator == ">" else before if combinator == "+" else earlier
                if (first or reach & (bit >> 1)) and test(child):
                    bits |= bit
            if bits & final:
                found.append(child)
            stack.append((child, bits, above | bits))
            before, earlier = bits, earlier | bits
    return sorted(found, key=lambda n: order[id(n)])
