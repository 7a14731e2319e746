"""Stupid-backoff language-model scores of documents, by joins of hashed n-gram tables.

S(w | u) = c(u w) / c(u) where the pair occurs in another document, with the document's
own pairs left out of c(u w) so that a text does not vouch for itself; else
ALPHA * c(w) / N. Counts cover the whole corpus.

Tables and exploded n-grams travel as compressed column blocks, dealt by a hash of the
context, so that a bucket holds all counts of its contexts. Contexts with more than
1 / HEAVY of all tokens, at most HEAVY of them, are dealt by the whole pair and take their
count from a small broadcast table. Each bucket sums what it scores by document; pairs
found nowhere else go on to the buckets of their second word, and are joined there to the
table of single words; where that word is one of the frequent, its count is at hand and
the pair goes nowhere. Words are known by 64-bit hashes: of V distinct words some two
share one with a probability of V * V / 2**65, 1e-4 at 60 million words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import textvec as V
from weftline.llm.shared import buckets, checkpointed, freed, releasing

ALPHA = 0.4
HEAVY = 2_000
START = np.uint64(0)
_NO_ID = -(1 << 63)
_TOGETHER = 8 << 20
#: Numbers within a block, by whether there are over 65,536.
_NUMBER = (np.uint16, np.uint32)


def _words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, _, doc, h = V.words(buf, offs)
    return doc, np.maximum(h, np.uint64(1))


def _packed(*columns: np.ndarray) -> bytes:
    """Columns as one block; the first rises and is kept as differences."""
    out = [np.diff(columns[0], prepend=columns[0].dtype.type(0)).tobytes(), *(c.tobytes() for c in columns[1:])]
    return len(columns[0]).to_bytes(8, "little") + zstandard.compress(b"".join(out), 1)


def _unpacked(block: bytes, *kinds: type) -> list[np.ndarray]:
    n, raw, at, out = int.from_bytes(block[:8], "little"), zstandard.decompress(block[8:]), 0, []
    for k in kinds:
        out.append(np.frombuffer(raw, k, n, at))
        at += n * np.dtype(k).itemsize
    out[0] = np.cumsum(out[0], dtype=kinds[0])
    return out


def _bucket(keys: np.ndarray, parts: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (V.mix64(keys * np.uint64(V.BASE)) % np.uint64(parts)).astype(np.int64)


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    new = np.flatnonzero(np.concatenate([[True], bucket[order][1:] != bucket[order][:-1]]))
    for a, b in zip(new, [*new[1:], len(order)], strict=True):
        yield int(bucket[order[a]]), order[a:b]


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    kind, part, block = ([r[i] for r in rows] for i in range(3))
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(part, pa.int32()), pa.array(block, pa.binary())], names=["kind", "part", "block"])


_ROW = "kind int, part int, block binary"


def _summed(*keys: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Distinct keys in order (the first is the major one) with sums of weight."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    at = np.flatnonzero(new)
    return [*(k[at] for k in keys), np.add.reduceat(weight[order], at) if len(at) else weight[:0]]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, document index of each word, word) of bounded runs of rows."""
    for b in batches:
        ids = b.column(0).to_numpy()
        for lo, hi, _, _ in V.slices(b.column(1), _TOGETHER):
            got = [(d + lo + a, w) for a, _, buf, offs in V.slices(b.column(1).slice(lo, hi - lo)) for d, w in [_words(buf, offs)]]
            doc, word = (np.concatenate(c) for c in zip(*got, strict=True))
            if len(doc):
                yield ids, doc, word


def _count_words(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for _, _, word in _slices(batches):
        w, n = np.unique(word, return_counts=True)
        yield _blocks([(0, q, _packed(w[x], n[x].astype(np.int64))) for q, x in _by_bucket(_bucket(w, parts))])


def _add_words(table: pa.Table) -> pa.Table:
    got = [_unpacked(b, np.uint64, np.int64) for b in table.column("block").to_pylist()]
    w, n = _summed(np.concatenate([g[0] for g in got]), weight=np.concatenate([g[1] for g in got]))
    return pa.Table.from_batches([_blocks([(0, table.column("part")[0].as_py(), _packed(w, n))])])


def _explode_pairs(batches: Iterator[pa.RecordBatch], parts: int, heavy: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Distinct (context, word) of each document with its count, by bucket."""
    for ids, doc, word in _slices(batches):
        context = np.concatenate([np.zeros(1, np.uint64), word[:-1]])
        first = np.ones(len(doc), bool)
        first[1:] = doc[1:] != doc[:-1]
        context[first] = START
        order = np.lexsort((word, context))  # doc rises within a pair
        u, w, d = context[order], word[order], doc[order]
        new = np.ones(len(u), bool)
        new[1:] = (u[1:] != u[:-1]) | (w[1:] != w[:-1]) | (d[1:] != d[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(u))).astype(np.uint32)
        u, w, d = u[at], w[at], d[at]
        with np.errstate(over="ignore"):
            key = np.where(np.isin(u, heavy), V.mix64(u + w * np.uint64(V.BASE)), u)
        rows = []
        for q, x in _by_bucket(_bucket(key, parts)):
            # Documents and second words are numbered within the block, by rank.
            named, local = np.unique(ids[d[x]], return_inverse=True)
            seen, code = np.unique(w[x], return_inverse=True)
            wide = [len(named) > 1 << 16, len(seen) > 1 << 16]
            body = _packed(u[x], code.astype(_NUMBER[wide[1]]), local.astype(_NUMBER[wide[0]]), times[x])
            rows.append((1 + wide[0] + 2 * wide[1], q, _joined(_packed(named), _joined(_packed(seen), body))))
        yield _blocks(rows)


def _joined(a: bytes, b: bytes) -> bytes:
    return len(a).to_bytes(4, "little") + a + b


def _split(block: bytes) -> tuple[bytes, bytes]:
    n = int.from_bytes(block[:4], "little")
    return block[4 : 4 + n], block[4 + n :]


def _score_pairs(table: pa.Table, parts: int, heavy: np.ndarray, heavy_count: np.ndarray, frequent: np.ndarray, backed: np.ndarray) -> pa.Table:
    """Sums by document of the pairs known elsewhere and of those with a frequent second word (kind 0), and the others by second word (kind 1).

    frequent are words in order, backed what each of them brings where it is backed off to.
    """
    got = []
    for kind, block in zip(table.column("kind").to_pylist(), table.column("block").to_pylist(), strict=True):
        ids, rest = _split(block)
        words, body = _split(rest)
        (named,), (seen,) = _unpacked(ids, np.int64), _unpacked(words, np.uint64)
        u, code, local, times = _unpacked(body, np.uint64, _NUMBER[(kind - 1) // 2], _NUMBER[(kind - 1) % 2], np.uint32)
        got.append((u, seen[code], named[local], times))
    u, w, doc, times = (np.concatenate(c) for c in zip(*got, strict=True))
    del got
    u, w, doc, times = _summed(u, w, doc, weight=times.astype(np.int64))
    new_u = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
    count_u = np.repeat(np.add.reduceat(times, new_u), np.diff(np.append(new_u, len(u))))
    is_heavy = np.isin(u, heavy)
    if is_heavy.any():
        count_u[is_heavy] = heavy_count[np.searchsorted(heavy, u[is_heavy])]
    new = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (w[1:] != w[:-1])]))
    elsewhere = np.repeat(np.add.reduceat(times, new), np.diff(np.append(new, len(u)))) - times
    found = elsewhere > 0
    gain = times[found] * np.log(elsewhere[found] / count_u[found])
    common = np.flatnonzero(~found & np.isin(w, frequent))
    more = times[common] * backed[np.searchsorted(frequent, w[common])]
    rows = _sums(np.concatenate([doc[found], doc[common]]), np.concatenate([times[found], times[common]]), np.concatenate([gain, more]), parts)
    rest = ~found
    rest[common] = False
    w, doc, times = _summed(w[rest], doc[rest], weight=times[rest])
    rows += [(1, q, _packed(w[x], doc[x], times[x])) for q, x in _by_bucket(_bucket(w, parts))]
    return pa.Table.from_batches([_blocks(rows)])


def _sums(doc: np.ndarray, times: np.ndarray, gain: np.ndarray, parts: int) -> list[tuple]:
    order = np.argsort(doc, kind="stable")
    doc, times, gain = doc[order], times[order], gain[order]
    at = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    if not len(at):
        return []
    d, n, s = doc[at], np.add.reduceat(times, at), np.add.reduceat(gain, at)
    return [(0, q, _packed(d[x], n[x], s[x])) for q, x in _by_bucket(_bucket(d.view(np.uint64), parts))]


def _back_off(rows: pa.Table, words: pa.Table, parts: int, total: int) -> pa.Table:
    """Sums by document of the backed-off words of one bucket, joined to the table of words."""
    if not rows.num_rows:
        return pa.Table.from_batches([_blocks([])])
    w, doc, times = (np.concatenate(c) for c in zip(*(_unpacked(b, np.uint64, np.int64, np.int64) for b in rows.column("block").to_pylist()), strict=True))
    known, count = _unpacked(words.column("block")[0].as_py(), np.uint64, np.int64)
    gain = times * np.log(ALPHA * count[np.searchsorted(known, w)] / total)
    return pa.Table.from_batches([_blocks(_sums(doc, times, gain, parts))])


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct doc_id: doc_id, n_tokens, log_score (natural), mean_log_score.

    Words are separated by white space, A-Z folded; the first word follows a start mark.
    Null, empty and blank texts have no tokens, log_score 0 and a null mean. Rows that repeat
    a doc_id count as parts of one document; a null id is one more document. An empty table
    gives an empty result; other columns play no part.
    """
    spark = docs.sparkSession
    parts = buckets(spark)
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    words = checkpointed(base.mapInArrow(releasing(lambda b: _count_words(b, parts)), _ROW).groupBy("part").applyInArrow(freed(_add_words), _ROW))

    def total_of(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int(_unpacked(x, np.uint64, np.int64)[1].sum()) for x in b.column("block").to_pylist()], pa.int64())], names=["n"])

    total = words.mapInArrow(total_of, "n long").agg(F.sum("n")).first()[0] or 0

    def heavy_of(batches):
        for b in batches:
            for block in b.column("block").to_pylist():
                w, n = _unpacked(block, np.uint64, np.int64)
                x = n * HEAVY > total
                yield pa.RecordBatch.from_arrays([pa.array(w[x].astype(np.int64)), pa.array(n[x])], names=["w", "n"])

    # Fewer than HEAVY words can have more than 1 / HEAVY of the tokens.
    by_word = sorted((r.w % (1 << 64), r.n) for r in words.mapInArrow(heavy_of, "w long, n long").collect())
    heavy_words = np.array([w for w, _ in by_word], np.uint64)

    # A word is a context wherever it is not the last of its text; both counts come from one pass.
    def context_counts(batches):
        for _, doc, word in _slices(batches):
            last = np.ones(len(doc), bool)
            last[:-1] = doc[1:] != doc[:-1]
            w, n = np.unique(word[~last & np.isin(word, heavy_words)], return_counts=True)
            w, n = np.append(w, START), np.append(n, last.sum())
            yield pa.RecordBatch.from_arrays([pa.array(w.astype(np.int64)), pa.array(n.astype(np.int64))], names=["w", "n"])

    counted = sorted((r.w % (1 << 64), r.n) for r in base.mapInArrow(context_counts, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).collect())
    heavy, heavy_count = np.array([w for w, _ in counted], np.uint64), np.array([n for _, n in counted], np.int64)

    pairs = base.mapInArrow(releasing(lambda b: _explode_pairs(b, parts, heavy)), _ROW).groupBy("part")
    backed_off = np.log(ALPHA * np.array([n for _, n in by_word], np.float64) / max(total, 1))
    scored = checkpointed(pairs.applyInArrow(freed(lambda t: _score_pairs(t, parts, heavy, heavy_count, heavy_words, backed_off)), _ROW))

    backed = scored.where("kind = 1").groupBy("part").cogroup(words.groupBy("part")).applyInArrow(freed(lambda r, w: _back_off(r, w, parts, total)), _ROW)

    def add_up(table: pa.Table) -> pa.Table:
        got = [_unpacked(b, np.int64, np.int64, np.float64) for b in table.column("block").to_pylist()]
        doc, n, s = (np.concatenate(c) for c in zip(*got, strict=True))
        order = np.lexsort((s, doc))  # one order of addition, whatever the order of blocks
        doc, n, s = doc[order], n[order], s[order]
        at = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        return pa.table([doc[at], np.add.reduceat(n, at), np.add.reduceat(s, at)], names=["doc_id", "n", "s"])

    sums = scored.where("kind = 0").unionByName(backed).groupBy("part").applyInArrow(add_up, "doc_id long, n long, s double")
    every = base.select("doc_id").distinct().join(sums, "doc_id", "left")
    n, s = F.coalesce("n", F.lit(0).cast("long")), F.coalesce("s", F.lit(0.0))
    return every.select(F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")).alias("doc_id"), n.alias("n_tokens"), s.alias("log_score"), F.when(n > 0, s / n).alias("mean_log_score"))


def op6_backoff(spark, sf_dir: str) -> DataFrame:
    from weftline.llm.shared import documents

    return score_documents(documents(spark, sf_dir))
