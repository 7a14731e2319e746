"""Toxic passages by maximum-scoring segments of token log-odds.

A token is a run of letters (bytes above 127 count as letters), A-Z folded. Its weight is
the log-odds of toxicity among documents that hold it, shrunk by a Dirichlet prior towards
the rate of its opening bytes, and that towards the base rate; a drift is taken off so
that ordinary text falls. One linear scan finds every maximal-scoring passage of a text.
Scores follow extreme-value statistics: lambda solves sum p exp(lambda s) = 1 over clean
tokens and K is fitted to the best passages of clean documents, so a passage of score S in
n tokens is expected K n exp(-lambda S) times by chance. A document's evidence adds up its
significant passages; a logistic curve over it, fitted on labelled documents whose counts
the weights have not seen, gives the score.

Labels are read from about `sample` labelled rows of `sample_bytes` at most outside the
held-out fifth, chosen by a hash of the id, so the model's size is bounded whatever the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import textvec as V
from weftline.llm.shared import held_out, released, releasing

SAMPLE, SAMPLE_BYTES = 7_000, 24_000_000
OPENING = 5
DRIFT = 0.5
PRIOR_WORD, PRIOR_OPENING = 4.0, 8.0
SIGNIFICANT = 0.05
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_EULER = 0.5772156649


def tokens(buf: np.ndarray, offs: np.ndarray):
    """Start, end, document, word hash and opening hash of each token."""
    buf = V.FOLD[buf]
    start, end = V.runs(_LETTER[buf], offs)
    doc = np.searchsorted(offs, start, side="right") - 1
    return start, end, doc, V.span_hash(buf, start, end), V.span_hash(buf, start, np.minimum(end, start + OPENING))


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default, np.float32)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], np.float32(default))


class Model:
    """Weights of words and openings, extreme-value parameters and the final curve."""

    def __init__(self) -> None:
        none = np.zeros(0, np.uint64)
        self.words, self.word_weight = none, np.zeros(0, np.float32)
        self.openings, self.opening_weight = none, np.zeros(0, np.float32)
        self.lam, self.k, self.a, self.b = 1.0, 1.0, -2.0, 0.0

    def learn(self, column: pa.Array, toxic: np.ndarray, fit: np.ndarray) -> None:
        """toxic: label of each text; fit: weights come from these, the curve from the others."""
        if not len(toxic):
            return
        parts = [((doc + lo).astype(np.int32), word, opening) for lo, _, buf, offs in V.slices(column) for _, _, doc, word, opening in [tokens(buf, offs)]]
        doc, word, opening = (np.concatenate(c) for c in zip(*parts, strict=True))
        base = (toxic[fit].sum() + 1) / (fit.sum() + 2)
        of = fit[doc]

        def counts(keys):
            """Distinct keys, documents with them that are toxic, and all documents with them."""
            k, d = keys[of], doc[of]
            order = np.argsort(k, kind="stable")  # d rises within a key
            k, d = k[order], d[order]
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
            k, d = k[new], d[new]
            key, at, n = np.unique(k, return_index=True, return_counts=True)
            return key, np.add.reduceat(toxic[d].astype(np.float64), at) if len(key) else np.zeros(0), n

        def weight(rate):
            return (np.log(rate / (1 - rate)) - math.log(base / (1 - base))).astype(np.float32)

        key, hit, n = counts(opening)
        rate = (hit + PRIOR_OPENING * base) / (n + PRIOR_OPENING)
        keep = n > 1
        self.openings, opening_rate = key[keep], rate[keep].astype(np.float32)
        self.opening_weight = weight(opening_rate)
        key, hit, n = counts(word)
        every, at = np.unique(word, return_index=True)
        prior = _lookup(self.openings, opening_rate, opening[at[np.searchsorted(every, key)]], base)
        rate = (hit + PRIOR_WORD * prior) / (n + PRIOR_WORD)
        keep = n > 1
        self.words, self.word_weight = key[keep], weight(rate[keep])
        self._calibrate(doc, word, opening, toxic, ~fit)

    def weights(self, doc: np.ndarray, word: np.ndarray, opening: np.ndarray) -> np.ndarray:
        """Weights of tokens in text order; a token like the one before it in its text brings no evidence of its own."""
        out = _lookup(self.words, self.word_weight, word, np.nan)
        rest = np.isnan(out)
        out[rest] = _lookup(self.openings, self.opening_weight, opening[rest], 0.0)
        out[1:][(word[1:] == word[:-1]) & (doc[1:] == doc[:-1])] = 0.0
        return out - np.float32(DRIFT)

    def _calibrate(self, doc, word, opening, toxic, use) -> None:
        s = self.weights(doc, word, opening).astype(np.float64)
        clean = s[(~toxic & use)[doc]]
        if len(clean) and clean.max() > 0:
            low, high = 1e-3, 20.0
            for _ in range(60):
                mid = (low + high) / 2
                if np.exp(np.minimum(mid * clean, 700)).mean() > 1:
                    high = mid
                else:
                    low = mid
            self.lam = low
        n = np.bincount(doc, minlength=len(toxic))
        found = [maximal_passages(s[lo:hi]) for lo, hi in _cuts(doc, len(toxic))]
        best = np.array([max((p[2] for p in f), default=0.0) for f in found])
        null = use & ~toxic & (n > 0) & (best > 0)
        if null.any():
            self.k = math.exp(float(np.mean(self.lam * best[null] - np.log(n[null]))) - _EULER)
        x = np.array([self.evidence(f, m) for f, m in zip(found, n, strict=True)])[use]
        self.a, self.b = _curve(x, toxic[use])

    def surprise(self, score: float, n: int) -> float:
        """-ln of the number of such passages expected by chance."""
        return self.lam * score - math.log(self.k * max(n, 1))

    def evidence(self, passages: list, n: int) -> float:
        gains = [self.surprise(p[2], n) for p in passages] or [self.surprise(0.0, n)]
        floor = -math.log(SIGNIFICANT)
        total = sum(g for g in gains if g > floor) or max(gains)
        return math.copysign(math.log1p(abs(total)), total)

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.a + self.b * evidence))))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic intercept and slope, by Newton steps with a weak prior."""
    w, design = np.zeros(2), np.stack([np.ones(len(x)), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + 1e-2 * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hess, grad), -5, 5)
    return float(w[0]), float(w[1])


def _cuts(doc: np.ndarray, n: int) -> list[tuple[int, int]]:
    at = np.searchsorted(doc, np.arange(n + 1)).tolist()
    return list(zip(at[:-1], at[1:], strict=True))


def maximal_passages(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring runs (first, end, score), in linear time over runs of positive weights.

    A candidate is kept with the sum before and at its end. A new one is joined with
    earlier ones back to the last that begins lower, where that one also ends lower.
    """
    up = weights > 0
    if not up.any():
        return []
    edge = np.flatnonzero(np.diff(np.concatenate([[False], up, [False]]).astype(np.int8)))
    total = np.concatenate([[0.0], np.cumsum(weights, dtype=np.float64)])
    first, end = edge[::2], edge[1::2]
    stack: list[list] = []  # first, end, sum before, sum at end, place of the last candidate that begins lower
    for f, e, before, after in zip(first.tolist(), end.tolist(), total[first].tolist(), total[end].tolist(), strict=True):
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= after:
                stack.append([f, e, before, after, j])
                break
            f, before = stack[j][0], stack[j][2]
            del stack[j:]
    return [(f, e, after - before) for f, e, before, after, _ in stack]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model from at most about `sample` labelled documents, and about `sample_bytes` of text, outside the held-out fifth.

    A label is 0 or 1; null labels are left out, and of several for a document the largest counts.
    """
    marked = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out())
    n = marked.count()
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def sampled(share: float) -> DataFrame:
        chosen = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
        # About `sample` narrow rows at most.
        return texts.join(F.broadcast(chosen), "doc_id")

    share = min(1.0, sample / max(n, 1))
    size = sampled(share).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = sampled(share * min(1.0, sample_bytes / max(size, 1)))
    rows = rows.select("text", (F.col("toxic") > 0).alias("toxic"), (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 4).alias("fit"))
    table = rows.toArrow()
    order = np.argsort(_row_hash(table.column("text")), kind="stable")  # the order of rows must not matter
    table = table.take(pa.array(order))
    model = Model()
    if table.num_rows:
        toxic, fit = (table.column(c).to_numpy() for c in ("toxic", "fit"))
        model.learn(table.column("text").combine_chunks(), toxic, fit)
    del table
    released()
    return model


def _row_hash(column: pa.ChunkedArray) -> np.ndarray:
    parts = [V.span_hash(buf, offs[:-1], offs[1:]) for _, _, buf, offs in V.slices(column.combine_chunks())]
    return np.concatenate([np.zeros(0, np.uint64), *parts])


def toxic_passages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, score, predicted, n_passages, passages.

    passages are the significant ones: start and end in bytes, score and expected count.
    A null or empty text, or one without letters, has no passage and the score that this
    deserves. Rows that repeat a doc_id are scored each. Whole texts are read.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(model)  # its size is bounded by the training sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        floor = -math.log(SIGNIFICANT)
        for b in batches:
            score, passages = [], []
            for lo, hi, buf, offs in V.slices(b.column(1)):
                start, end, doc, word, opening = tokens(buf, offs)
                s = m.weights(doc, word, opening)
                for i, (a, z) in enumerate(_cuts(doc, hi - lo)):
                    found = maximal_passages(s[a:z])
                    score.append(m.score(m.evidence(found, z - a)))
                    passages.append(
                        [
                            {"start": int(start[a + f] - offs[i]), "end": int(end[a + e - 1] - offs[i]), "score": float(x), "expected": math.exp(-g)}
                            for f, e, x in found
                            if (g := m.surprise(x, z - a)) > floor
                        ]
                    )
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64()), pa.array([int(x >= 0.5) for x in score], pa.int32()), pa.array([len(p) for p in passages], pa.int32()), pa.array(passages, kind)], names=["doc_id", "score", "predicted", "n_passages", "passages"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(releasing(run), "doc_id long, score double, predicted int, n_passages int, passages array<struct<start: long, end: long, score: double, expected: double>>")


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs that the model does not reject, as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            keep = []
            for lo, hi, buf, offs in V.slices(b.column(at)):
                _, _, doc, word, opening = tokens(buf, offs)
                s = m.weights(doc, word, opening)
                keep += [m.score(m.evidence(maximal_passages(s[a:z]), z - a)) < 0.5 for a, z in _cuts(doc, hi - lo)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(releasing(run), docs.schema)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    from weftline.llm.shared import documents

    docs = documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxic_passages(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted", "n_passages")
