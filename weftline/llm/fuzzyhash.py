"""Document fingerprints by context-triggered piecewise hashing.

A hash of the last 8 bytes cuts a text where its low k bits are zero, about every 2**k
bytes; each chunk gives one of 64 letters. A window that stood three times within the
3 * 2**k bytes before is a repeat: it cuts where its distance from the last window that is
none is 1/2, 3/2, 5/2 ... times 2**k, so that a long stretch that repeats itself takes its
share of the letters, and the line that each block of a list ends with is cut nowhere. All
this looks at a window and the bytes just before it, so an edit changes letters near it and
no others, and one line more in a list, wherever it is put, is as one more at its end. k
comes from the length, is lowered while there are fewer than 32 cuts, and then raised while
there are over 63, or over 31 at k + 1, so letters cover the whole text. A fingerprint is
`k:letters at k:letters at k + 1:letters at k + 2`, so texts of somewhat different size
still share block sizes. Two fingerprints are compared at the block sizes they share by
the edit distance (insertions and deletions) of their letters, and only if these have a
run in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import textvec as V
from weftline.llm.shared import buckets

#: Bytes of a window.
ROLL = 8
LEAST_K = 2
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
LONGEST = 64
#: A window that stood so often within as many times the block size is a repeat.
TWINS = 3
COMMON_RUN = 7
_ALPHABET = np.frombuffer(LETTERS.encode(), np.uint8)


def fingerprints(texts: list[bytes]) -> list[str]:
    """A fingerprint of each text; it depends on the text alone."""
    out: list[str] = []
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= V.SLICE_BYTES):
            size += len(texts[hi]) + ROLL
            hi += 1
        out += _batch(texts[lo:hi])
        lo = hi
    return out


def _since(roll: np.ndarray) -> np.ndarray:
    """How many places ago each window of one text stood for the TWINS-th last time; very many where it did not."""
    out = np.full(len(roll), np.iinfo(np.int64).max)
    bits = np.uint64(max(1, len(roll).bit_length()))
    key = (roll >> bits << bits) | np.arange(len(roll), dtype=np.uint64)
    key.sort()
    place = (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    key >>= bits
    again = np.flatnonzero(key[TWINS:] == key[:-TWINS]) + TWINS
    out[place[again]] = place[again] - place[again - TWINS]
    return out


class _Text:
    """The windows of one text: their hashes, and how long ago each stood before."""

    def __init__(self, roll: np.ndarray) -> None:
        self.roll, self.since = roll, _since(roll)
        self.known: dict[int, np.ndarray] = {}

    def hashes(self, level: int) -> np.ndarray:
        """Hashes of the windows at a block size of 2**level."""
        if level not in self.known:
            out = self.roll
            repeat = np.flatnonzero(self.since <= TWINS << level)
            if len(repeat):
                last = np.arange(len(out))
                last[repeat] = 0
                far = repeat - np.maximum.accumulate(last)[repeat]
                out = out.copy()
                with np.errstate(over="ignore"):
                    out[repeat] = V.mix64(out[repeat] + far.astype(np.uint64) * np.uint64(V.BASE)) << np.uint64(level) | ((far + (1 << level >> 1)) & ((1 << level) - 1)).astype(np.uint64)
            self.known[level] = out
        return self.known[level]

    def cuts(self, level: int) -> np.ndarray:
        """Ends of chunks."""
        return np.flatnonzero((self.hashes(level) & np.uint64((1 << level) - 1)) == 0) + 1

    def letters(self, level: int, cuts: np.ndarray) -> str:
        n = len(self.roll)
        bounds = np.concatenate([[0], cuts, [n] if n and (not len(cuts) or cuts[-1] < n) else []]).astype(np.int64)
        with np.errstate(over="ignore"):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(V.mix64(self.hashes(level)))])
            each = V.mix64(total[bounds[1:]] - total[bounds[:-1]] + np.uint64(V.BASE))
        return _ALPHABET[(each & np.uint64(63)).astype(np.int64)].tobytes().decode()

    def fingerprint(self) -> str:
        level = max(LEAST_K, int(np.ceil(np.log2(max(len(self.roll), 1) / LONGEST))))
        one = self.cuts(level)
        while len(one) < LONGEST // 2 and level > LEAST_K:
            level -= 1
            one = self.cuts(level)
        two = self.cuts(level + 1)
        while len(one) >= LONGEST or len(two) >= LONGEST // 2:
            level += 1
            one, two = two, self.cuts(level + 1)
        return ":".join([str(level), self.letters(level, one), self.letters(level + 1, two), self.letters(level + 2, self.cuts(level + 2))])


def _batch(texts: list[bytes]) -> list[str]:
    gap = bytes(ROLL)
    buf = np.frombuffer(gap + gap.join(texts), np.uint8)
    lens = np.array([len(t) for t in texts])
    start = np.cumsum(lens + ROLL) - lens
    prefix = V.prefix_hash(buf)
    place = np.arange(len(buf) - ROLL + 1)
    roll = np.zeros(len(buf), np.uint64)
    roll[ROLL - 1 :] = V.substring_hash(prefix, place, place + ROLL)
    return [_Text(roll[s:e]).fingerprint() for s, e in zip(start.tolist(), (start + lens).tolist(), strict=True)]


def _squeezed(s: str) -> str:
    """Runs of one letter are cut to three: long monotony says little."""
    out = []
    for c in s:
        if len(out) < 3 or not out[-1] == out[-2] == out[-3] == c:
            out.append(c)
    return "".join(out)


def _ratio(a: str, b: str) -> float:
    a, b = _squeezed(a), _squeezed(b)
    if not a or not b:
        return float(a == b)
    run = min(COMMON_RUN, max(1, min(len(a), len(b)) // 3))
    grams = {a[i : i + run] for i in range(len(a) - run + 1)}
    if not any(b[i : i + run] in grams for i in range(len(b) - run + 1)):
        return 0.0
    # Longest common subsequence, a bit for each letter of a.
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & where.get(c, 0)
        v = ((v + u) | (v - u)) & full
    common = (v ^ full).bit_count()
    return 2 * common / (len(a) + len(b))


def likeness(x: str, y: str) -> float:
    """0 to 1; 1 for equal fingerprints, 0 for block sizes more than four times apart."""
    if x == y:
        return 1.0
    kx, *xs = x.split(":")
    ky, *ys = y.split(":")
    shift = int(ky) - int(kx)
    shared = list(zip(xs[max(shift, 0) :], ys[max(-shift, 0) :], strict=False))
    # The finest counts; of the others those with letters enough to say something.
    return max((_ratio(a, b) for i, (a, b) in enumerate(shared) if i == 0 or min(len(a), len(b)) >= COMMON_RUN), default=0.0)


def _neighbours(table: pa.Table) -> pa.Table:
    """Result rows of one range of ids, in descending order; copied rows only follow the last."""
    rows = list(zip(table.column("key").to_pylist(), table.column("copied").to_pylist(), table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True))
    own = sorted((r for r in rows if not r[1]), key=lambda r: r[3])
    own.sort(key=lambda r: -r[0])
    after = sorted((r for r in rows if r[1]), key=lambda r: (-r[0], r[3]))[:1]
    columns: list[list] = [[] for _ in range(7)]
    for lo in range(0, len(own), 256):
        part = own[lo : lo + 257] if lo + 256 < len(own) else own[lo:] + after
        now = own[lo : lo + 256]
        edited = [(t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode("utf-8", "surrogatepass") for (*_, t), (*_, n) in zip(now, part[1:], strict=True)]
        prints = fingerprints([t.encode("utf-8", "surrogatepass") for *_, t in part])
        changed = fingerprints(edited)
        for i, (_, _, doc, t) in enumerate(now):
            for c, x in zip(columns, (doc, len(t), hashlib.sha256(edited[i]).hexdigest(), prints[i], changed[i], likeness(prints[i], changed[i]), likeness(prints[i], prints[i + 1])), strict=True):
                c.append(x)
    kinds = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    return pa.table([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs, with its fingerprint and that of its edited text.

    The next document is the one after it by descending doc_id; after the last comes the
    first. A null id comes last, rows that repeat an id in the order of their text. Null
    text is empty. A lone document is its own next. An empty table gives an empty result.

    Rows are dealt by ranges of ids; the first of each range is copied to the range before
    it, so texts move once and no order over all rows is built. What reaches the driver is
    one id a range.
    """
    least = -(1 << 63)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("key", F.coalesce("doc_id", F.lit(least)))
    n = buckets(docs.sparkSession)
    bounds = base.agg(F.percentile_approx("key", [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0]
    bounds = sorted(set(bounds or []))
    base = base.withColumn("range", F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col("key"))) if bounds else F.lit(0))
    tops = [(r["range"], r["top"]) for r in base.groupBy("range").agg(F.max("key").alias("top")).orderBy(F.desc("range")).collect()]
    if tops:
        # The range before this one, in descending order; before the highest stands the lowest.
        target = F.create_map(*[F.lit(x) for i, (_, top) in enumerate(tops) for x in (top, tops[i - 1][0])])
        places = F.filter(F.array(F.struct(F.col("range").alias("to"), F.lit(False).alias("copied")), F.struct(target[F.col("key")].alias("to"), F.lit(True).alias("copied"))), lambda p: p["to"].isNotNull())
        base = base.withColumn("place", F.explode(places)).select("key", "doc_id", "text", F.col("place.to").alias("range"), F.col("place.copied").alias("copied"))
    else:
        base = base.withColumn("copied", F.lit(False))
    return base.groupBy("range").applyInArrow(lambda t: _neighbours(t), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op3_fingerprints(spark, sf_dir: str) -> DataFrame:
    from weftline.llm.shared import documents

    return fingerprint_documents(documents(spark, sf_dir))
