"""Spelling variants: words one edit apart, grouped under the form that is far more frequent.

A run is a maximal run of A-Z, a-z and U+00C0 to U+00FF, A-Z folded. By a hash of its
document's id and the run itself, one run in NOISE loses a code point, which plants typing
errors at a known rate; without noise, runs stand as they are. Words are the distinct
results of at least LEAST_LETTERS code points and LEAST_COUNT occurrences.

Words one edit apart are found by an even-partition pigeonhole join. A word of length L is
indexed by two segments, its first L div 2 code points and the rest, since one edit leaves
one of them whole. A word probes the segments of words of its own length at the same
places, and of words one shorter at the places to which an insertion moves them: the first
segment at the start, the second at the end. A candidate found by both segments counts once
(by the first), and one edit is verified. A segment that many words share is dealt to
several tasks, each with a part of the index and all probes.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm import textvec as V
from weftline.llm.shared import checkpointed, documents, releasing

LEAST_LETTERS, LEAST_COUNT = 6, 5
#: One run in so many loses a code point.
NOISE = 199
#: A form has at least so many times the occurrences of its variant.
RATIO = 5
#: Words of one segment that one task holds.
SALTED = 500
_SLICE = 4 << 20
_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = _ALPHA[0xC3] = True  # 0xC3 opens U+00C0 to U+00FF and no others


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_CRC = _crc_table()
#: Words of more bytes are hashed one by one.
_LONG = 64


def crc32_after(begun: np.ndarray, buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of a text with checksum begun and of buf[start:start + size] after it, for each place."""
    order = np.argsort(-size, kind="stable")
    state, at = ~begun[order].astype(np.uint32), start[order]
    lens = size[order]
    most = int(min(lens[0], _LONG)) if len(lens) else 0
    for k in range(most):
        n = int(np.searchsorted(-lens, -k, side="left"))  # those with more than k bytes
        state[:n] = _CRC[(state[:n] ^ buf[at[:n] + k]) & 0xFF] ^ (state[:n] >> np.uint32(8))
    out = np.empty(len(state), np.uint32)
    out[order] = ~state
    for i in order[: int(np.searchsorted(-lens, -_LONG, side="left"))]:
        out[i] = zlib.crc32(buf[start[i] + _LONG : start[i] + size[i]].tobytes(), int(out[i]))
    return out


def long_runs(buf: np.ndarray, offs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, pa.DictionaryArray]:
    """Document index and text of each run of at least least code points, and the code points of each distinct one."""
    mask = _ALPHA[buf]
    more = (buf >= 0x80) & (buf < 0xC0)
    mask[1:] |= more[1:] & (buf[:-1] == 0xC3)
    start, end = V.runs(mask, offs)
    bytes_before = np.concatenate([[0], np.cumsum(more)])
    letters = (end - start) - (bytes_before[end] - bytes_before[start])
    start, end, letters = (x[letters >= least] for x in (start, end, letters))
    size = end - start
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    texts = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(buf[V.ragged(size) + np.repeat(start, size)]))).dictionary_encode()
    of = np.zeros(len(texts.dictionary), np.int64)
    of[texts.indices.to_numpy()] = letters
    return np.searchsorted(offs, start, side="right") - 1, of, texts


def _counter(least: int, noise: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            begun = np.array([zlib.crc32(f"{i}:".encode()) for i in b.column(0).to_pylist()], np.uint32)
            for lo, hi, buf, offs in V.slices(b.column(1), _SLICE):
                doc, letters, texts = long_runs(V.FOLD[buf], offs, least)
                words = texts.dictionary
                if not len(words):
                    continue
                held, times = np.unique(doc * len(words) + texts.indices.to_numpy(), return_counts=True)
                word = held % len(words)
                lost: Counter[str] = Counter()
                if noise:
                    data, ends = V.utf8(words)
                    h = crc32_after(begun[lo:hi][held // len(words)], data, ends[word], ends[word + 1] - ends[word])
                    hit = np.flatnonzero(h % np.uint32(noise) == 0)
                    for i in hit.tolist():
                        text, at = words[word[i]].as_py(), int(h[i]) % int(letters[word[i]])
                        lost[text[:at] + text[at + 1 :]] += int(times[i])
                    times[hit] = 0
                n = np.bincount(word, times, minlength=len(words)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(n)], names=["word", "n"])
                yield pa.RecordBatch.from_arrays([pa.array(list(lost), pa.string()), pa.array(list(lost.values()), pa.int64())], names=["word", "n"])

    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, noise: int | None = NOISE) -> DataFrame:
    """(word, n) of the words; a null id is written as an empty text in the hash, a null text has no runs."""
    base = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = base.mapInArrow(releasing(_counter(least_letters, noise)), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where((F.col("n") >= least_count) & (F.length("word") >= least_letters))


def _segments(word: str, length: Column) -> Column:
    """The two segments that a word of that length has, as word holds them; the second from the end."""
    half = F.floor(length / 2).cast("int")
    first = F.substring(word, F.lit(1), half)
    second = F.right(F.col(word), length - half)
    return F.array(*(F.struct(length.alias("length"), F.lit(i).alias("place"), s.alias("segment")) for i, s in enumerate((first, second))))


def near_words(words: DataFrame, salted: int = SALTED) -> DataFrame:
    """(word, n, near, near_n) for each ordered pair of words (word, n) one edit apart.

    The edit is one inserted, deleted or replaced code point. Words are distinct and of two
    code points at least.
    """
    length = F.length("word")
    index = words.select("word", "n", F.explode(_segments("word", length)).alias("s")).select("s.*", F.col("word").alias("near"), F.col("n").alias("near_n"))
    probes = words.select("word", "n", F.explode(F.concat(_segments("word", length), _segments("word", length - 1))).alias("s")).select("s.*", "word", "n")
    key = ["length", "place", "segment"]
    hot = index.groupBy(*key).count().where(F.col("count") > salted).select(*key, F.ceil(F.col("count") / salted).cast("int").alias("salts"))
    salts = F.coalesce("salts", F.lit(1))
    index = index.join(hot, key, "left").withColumn("salt", F.pmod(F.xxhash64("near"), salts).cast("int")).drop("salts")
    probes = probes.join(hot, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    half = F.floor(F.col("length") / 2).cast("int")
    by_first = F.substring("word", F.lit(1), half) == F.substring("near", F.lit(1), half)
    found = probes.join(index, [*key, "salt"]).where(
        ((F.length("word") > F.col("length")) | (F.col("word") < F.col("near")))  # of equal length: each pair once
        & ((F.col("place") == 0) | ~by_first)
        & (F.levenshtein("word", "near", 1) == 1)
    )
    found = found.select("word", "n", "near", "near_n")
    return found.unionByName(found.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def variant_groups(words: DataFrame, ratio: int = RATIO, salted: int = SALTED) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each of the distinct words (word, n).

    form is the near word of largest n, of equal n the first in code-point order, if it has
    at least ratio times the occurrences; root is the last that forms lead to. Forms grow
    by ratio at each step, so they hold no cycle, and halving their paths ends soon.
    """
    least = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near")))
    best = near_words(words, salted).groupBy("word", "n").agg(F.count("*").alias("n_near"), least.alias("best"))
    is_form = -F.col("best.m") >= ratio * F.col("n")
    best = checkpointed(best.select("word", "n_near", F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n")))
    paths = best.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = paths.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        paths = checkpointed(paths.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")))
        if paths.where("moved").isEmpty():
            break
        paths = paths.select("word", "root")
    out = words.join(best, "word", "left").join(paths.select("word", "root"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int | None = NOISE) -> DataFrame:
    """variant_groups of the words of docs.

    Null and empty texts give no words. Rows that repeat an id or a text count each by
    itself. A run may be of any length. An empty table gives no rows, and other columns
    play no part.
    """
    return variant_groups(checkpointed(word_counts(docs, id_col, text_col, noise=noise)))


def op12_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))
