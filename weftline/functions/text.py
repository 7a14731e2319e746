"""Text expressions: missing values, keys and paths, normalisation, segments, evidence windows."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING = "未知"
# Spellings of a missing value.
MISSING_TOKENS = ("-", "—", "–", "－", "无", "N/A", "n/a", "NA", "null", "None")
# Full-width punctuation that stays as it is.
KEPT_PUNCTUATION = "，。？！；：、（）【】“”‘’《》"
CORE_FIELDS = ("graduation_year", "grade", "degree", "major", "city", "employer", "position")
# The characters of Unicode's White_Space property.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
EVIDENCE_WINDOW = 14
SEGMENTS = ("headline", "meta", "body", "tail", "raw")


def let(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c), with c worked out once, however often it stands in there."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def stripped(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def squeezed(c: Column) -> Column:
    """Without any Unicode white space."""
    return F.regexp_replace(c, r"(?U)\s+", "")


def is_missing(c: Column, tokens: Sequence[str] = MISSING_TOKENS, placeholder: str = MISSING) -> Column:
    t = stripped(c.cast("string"))
    return c.isNull() | t.isin("", placeholder, *tokens)


def fold_missing(c: Column, placeholder: str = MISSING, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    """The stripped value, or the placeholder for any spelling of a missing one."""
    return F.when(is_missing(c, tokens, placeholder), F.lit(placeholder)).otherwise(stripped(c.cast("string")))


def article_key(url: Column) -> Column:
    """First 16 hex digits of the SHA-1 of the trimmed URL; null for a blank one."""
    return F.when(F.length(F.trim(url)) > 0, F.substring(F.sha1(F.trim(url)), 1, 16))


def html_path(url: Column, folder: str = "data/raw_html") -> Column:
    return F.concat(F.lit(folder + "/"), article_key(url), F.lit(".html"))


def image_path(url: Column, image_sha1: Column, suffix: Column, folder: str = "data/images") -> Column:
    return F.concat(F.lit(folder + "/"), article_key(url), F.lit("/"), F.substring(image_sha1, 1, 16), suffix)


def ocr_path(image_sha1: Column, folder: str = "data/ocr_cache") -> Column:
    return F.concat(F.lit(folder + "/"), image_sha1, F.lit(".txt"))


def halfwidth(c: Column) -> Column:
    """Full-width forms to ASCII, the ideographic space to a space; listed punctuation stays."""
    source = "".join(chr(p) for p in range(0xFF01, 0xFF5F) if chr(p) not in KEPT_PUNCTUATION)
    target = "".join(chr(ord(s) - 0xFEE0) for s in source)
    return F.translate(c, source + "　", target + " ")


def normalize(c: Column) -> Column:
    """Half-width, no zero-width marks, single spaces, no blank lines, stripped; null is empty."""
    t = halfwidth(F.coalesce(c, F.lit("")))
    t = F.translate(t, " ​﻿", " ")
    t = F.regexp_replace(t, r"[ \t\r\f\x0B]+", " ")
    t = F.regexp_replace(t, r" *\n *", "\n")
    return stripped(F.regexp_replace(t, r"\n{2,}", "\n"))


def segments(title: Column, text: Column) -> Column:
    """Struct of headline, meta, body, tail and raw, by the number of non-blank lines."""
    raw = F.coalesce(text, F.lit(""))

    def parts(lines: Column) -> Column:
        n, every = F.size(lines), F.array_join(lines, " ")
        # With four lines and more there is a middle, and as no line is blank it is not empty.
        middle = F.array_join(F.slice(lines, F.lit(3), F.greatest(n - 3, F.lit(0))), " ")
        return F.struct(
            F.coalesce(title, F.lit("")).alias("headline"),
            F.when(n == 0, "").when(n <= 2, F.element_at(lines, 1)).otherwise(F.array_join(F.slice(lines, 1, 2), " ")).alias("meta"),
            F.when(n == 0, raw).when(n <= 3, every).otherwise(middle).alias("body"),
            F.when(n >= 3, F.element_at(lines, -1)).otherwise("").alias("tail"),
            raw.alias("raw"),
        )

    return let(F.filter(F.transform(F.split(raw, "\n", -1), stripped), lambda x: x != ""), parts)


def window(text: Column, start: Column, length: Column, width: int = EVIDENCE_WINDOW) -> Column:
    """Stripped text around the 1-based match at start, width characters to each side."""

    def around(at: Column) -> Column:
        left = F.greatest(at - width, F.lit(1))
        return stripped(F.substring(text, left, at + length + width - left))

    return let(start, around)


#: What makes a match depend on the text around it: looking around, anchors, possessive parts.
_CONTEXT = re.compile(r"\(\?[=!<>]|\\[bBAGzZ]|[\^$]|[+*?}]\+")


def match_first(text: Column, patterns: Sequence[str], width: int = EVIDENCE_WINDOW) -> Column:
    """Struct (value, evidence) of the first pattern that matches, null without one.

    The value is group 1. Positions count code points. Each pattern goes over the text once:
    where it does not look around, what it matched stands nowhere further left, and gives
    the value and, by search, the place; else the text is split at the match.
    """
    text = F.coalesce(text, F.lit(""))
    return F.coalesce(*[_match(text, p, width) for p in patterns])


def _match(text: Column, p: str, width: int) -> Column:
    def hit(value: Column, start: Column, length: Column) -> Column:
        return F.struct(value.alias("value"), window(text, start, length, width).alias("evidence"))

    if _matches_nothing(p):
        before = F.length(F.regexp_extract(text, f"(?s)^(.*?)(?:{p})", 1))
        return F.when(text.rlike(p), hit(F.regexp_extract(text, p, 1), before + 1, F.length(F.regexp_extract(text, f"(?s)^.*?({p})", 1))))
    if _CONTEXT.search(p):

        def split(parts: Column) -> Column:
            before, after = F.length(parts[0]), F.length(parts[1])
            return F.when(F.size(parts) == 2, hit(F.regexp_extract(text, p, 1), before + 1, F.length(text) - before - after))

        return let(F.split(text, p, 2), split)
    return let(F.regexp_extract(text, p, 0), lambda whole: F.when(whole != "", hit(F.regexp_extract(whole, p, 1), F.call_function("instr", text, whole), F.length(whole))))


def _matches_nothing(pattern: str) -> bool:
    """Could the pattern match the empty string? True where that is not known."""
    try:
        return re.fullmatch(pattern.replace("(?U)", ""), "") is not None
    except re.error:
        return True


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are worked out once a row, however often later steps use them.

    Projections are merged by the optimiser, which writes an expression out at each use;
    a generator of one row is not merged.
    """
    row = F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    kept = [c for c in df.columns if c not in columns]
    return df.select(*df.columns, row.alias("_once")).select(*kept, *[F.col(f"_once.{name}") for name in columns])


def iso_date(c: Column) -> Column:
    """yyyy-mm-dd of the first date like 2025-6-1, 2025/06/01 or 2025年6月1; else empty."""
    p = r"(20\d{2})\s*[-/年.]\s*(\d{1,2})\s*[-/月.]\s*(\d{1,2})"
    parts = [F.regexp_extract(c, p, i) for i in (1, 2, 3)]
    return F.when(c.rlike(p), F.concat_ws("-", parts[0], F.lpad(parts[1], 2, "0"), F.lpad(parts[2], 2, "0"))).otherwise("")


def escaped(c: Column) -> Column:
    """HTML-escaped."""
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def completeness_text(labels: dict[str, str], placeholder: str = MISSING) -> Column:
    """`7/7`, or `5/7（缺 …）` with the labels of the missing fields."""
    n = len(labels)
    missing = F.array_compact(F.array(*[F.when(F.col(f) == placeholder, F.lit(label)) for f, label in labels.items()]))
    filled = F.lit(n) - F.size(missing)
    head = F.concat(filled.cast("string"), F.lit(f"/{n}"))
    return F.when(F.size(missing) == 0, head).otherwise(F.concat(head, F.lit("（缺 "), F.array_join(missing, "、"), F.lit("）")))
