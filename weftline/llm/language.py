"""Language identification by a byte convolutional network, trained and run in numpy.

Bytes are embedded, filters of several widths slide over fixed-length windows, each
filter keeps its largest response, and a softmax layer reads those. Windows tile the
whole text; a document's probabilities are the means over its windows, weighted by the
bytes they hold. Filters of all widths lie in one matrix (zero beyond their width), so a
batch of windows is one matrix product.

The network is trained on at most about `per_language` documents of each language, taken
outside the held-out fifth by a hash of the id: a bound on the sample, not on the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import textvec as V
from weftline.llm.shared import held_out, releasing

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 8
PER_LANGUAGE = 1_500
#: Windows that are learned from one text.
PER_TEXT = 3
UNDETERMINED = "und"
_CHUNK = 256
_REACH = max(WIDTHS)


class ByteNetwork:
    def __init__(self, languages: list[str], seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        n, k = FILTERS * len(WIDTHS), _REACH * EMBEDDING
        self.languages = languages
        self.mask = np.zeros((k, n), np.float32)
        for i, w in enumerate(WIDTHS):
            self.mask[: w * EMBEDDING, i * FILTERS : (i + 1) * FILTERS] = 1
        self.p = {
            "embed": rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
            "filter": (rng.normal(0, 0.3, (k, n)) * self.mask).astype(np.float32),
            "bias": np.zeros(n, np.float32),
            "out": rng.normal(0, 0.2, (n, len(languages))).astype(np.float32),
            "shift": np.zeros(len(languages), np.float32),
        }
        self.p["embed"][0] = 0  # padding

    def _patches(self, windows: np.ndarray) -> np.ndarray:
        """(windows, positions, reach * embedding); windows carry reach - 1 bytes of padding."""
        e = self.p["embed"][windows]
        flat = e.reshape(len(windows), -1)
        positions = windows.shape[1] - _REACH + 1
        s = flat.strides
        return np.lib.stride_tricks.as_strided(flat, (len(windows), positions, _REACH * EMBEDDING), (s[0], s[1] * EMBEDDING, s[1]))

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        patches = self._patches(windows)
        flat = np.ascontiguousarray(patches).reshape(-1, patches.shape[2])
        response = (flat @ self.p["filter"]).reshape(len(windows), patches.shape[1], -1)
        return response.max(1) + self.p["bias"], response, patches

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(windows), len(self.languages)), np.float32)
        for lo in range(0, len(windows), _CHUNK):
            h, _, _ = self.pooled(windows[lo : lo + _CHUNK])
            out[lo : lo + _CHUNK] = _softmax(np.maximum(h, 0) @ self.p["out"] + self.p["shift"])
        return out

    def train(self, windows: np.ndarray, target: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 4e-3) -> None:
        rng = np.random.default_rng(11)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        for _ in range(epochs):
            for chosen in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // batch)):
                x, y, step = windows[chosen].copy(), target[chosen], step + 1
                short = rng.random(len(x)) < 0.3  # short texts are learned too
                keep = rng.integers(6, WINDOW, len(x))
                x[short[:, None] & (np.arange(x.shape[1]) >= keep[:, None])] = 0
                for k, g in self._gradients(x, y).items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)
                self.p["filter"] *= self.mask
                self.p["embed"][0] = 0

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        h, response, patches = self.pooled(x)
        a = np.maximum(h, 0)
        d = _softmax(a @ self.p["out"] + self.p["shift"])
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        dh = (d @ self.p["out"].T) * (h > 0)
        at = response.argmax(1)  # a filter's gradient passes through its best position
        rows = np.arange(len(x))[:, None]
        best = patches[rows, at]
        dfilter = np.einsum("bf,bfk->kf", dh, best)
        dbest = (dh[:, :, None] * self.p["filter"].T[None]).reshape(len(x), -1, _REACH, EMBEDDING)
        dembed = np.zeros_like(self.p["embed"])
        np.add.at(dembed, x[rows[:, :, None], at[:, :, None] + np.arange(_REACH)], dbest)
        return {"embed": dembed, "filter": dfilter * self.mask, "bias": dh.sum(0), "out": a.T @ d, "shift": d.sum(0)}


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def windows_of(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that tile each text, padded with zeros, with their documents and the bytes they hold."""
    lens = np.diff(offs)
    count = -(-lens // WINDOW)
    doc = np.repeat(np.arange(len(lens)), count)
    start = offs[:-1][doc] + V.ragged(count) * WINDOW
    held = np.minimum(WINDOW, offs[1:][doc] - start)
    out = np.zeros((len(doc), WINDOW + _REACH - 1), np.uint8)
    place = np.arange(WINDOW)
    inside = place < held[:, None]
    out[:, :WINDOW][inside] = buf[(start[:, None] + place)[inside]]
    return out, doc, held


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, per_text: int = PER_TEXT) -> ByteNetwork | None:
    """A network from a bounded sample of texts and windows of them; None where no text with a language may be learned from."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    counts = known.groupBy("lang").count().collect()  # one row a language
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, per_language / r["count"]))])
    picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    rows = picked.select("text", "lang", F.xxhash64("doc_id", "text").alias("order"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Some windows of each text, from anywhere in it, chosen by a hash of the text and the place."""
        for b in batches:
            for lo, hi, buf, offs in V.slices(b.column(0)):
                w, doc, _ = windows_of(buf, offs)
                with np.errstate(over="ignore"):
                    own = b.column(2).to_numpy()[lo:hi].view(np.uint64)[doc] if len(doc) else np.zeros(0, np.uint64)
                    key = V.mix64(own + V.ragged(np.bincount(doc, minlength=hi - lo)).astype(np.uint64) * np.uint64(V.BASE))
                by = np.lexsort((key, doc))
                by = by[V.ragged(np.bincount(doc, minlength=hi - lo)) < per_text]
                at = pa.array(doc[by] + lo)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in w[by]], pa.binary()), b.column(1).take(at), b.column(2).take(at), pa.array(key[by].view(np.int64))], names=["window", "lang", "order", "key"])

    # At most about per_language * per_text windows of fixed size for each language reach the driver.
    table = rows.mapInArrow(releasing(cut), "window binary, lang string, order long, key long").toArrow().sort_by([(c, "ascending") for c in ("order", "key", "lang")])
    languages = sorted(r["lang"] for r in counts)
    parts = [np.frombuffer(b"".join(table.column("window").to_pylist()), np.uint8).reshape(-1, WINDOW + _REACH - 1)] if table.num_rows else []
    target = [languages.index(x) for x in table.column("lang").to_pylist()]
    network = ByteNetwork(languages)
    if target:
        network.train(np.concatenate(parts), np.array(target))
    return network


def identify(docs: DataFrame, network: ByteNetwork | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, lang_pred, score.

    A null text, or one without a letter, is `und` with score 0; so is any text if nothing
    was learned. The whole text is read. Rows that repeat a doc_id are judged each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)  # some 10 kB, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        ascii_letter = np.zeros(256, bool)
        ascii_letter[65:91] = ascii_letter[97:123] = True
        for b in batches:
            lang, score = [], []
            for lo, hi, buf, offs in V.slices(b.column(1), 1 << 18):
                letters = np.concatenate([[0], np.cumsum(ascii_letter[buf])])[offs]
                has = np.diff(letters) > 0
                for i in np.flatnonzero(~has & (np.diff(offs) > 0)).tolist():
                    has[i] = any(c.isalpha() for c in buf[offs[i] : offs[i + 1]].tobytes().decode("utf-8", "replace"))
                if net is None or not has.any():
                    lang += [UNDETERMINED] * (hi - lo)
                    score += [0.0] * (hi - lo)
                    continue
                w, doc, held = windows_of(buf, offs)
                p = np.zeros((hi - lo, len(net.languages)))
                np.add.at(p, doc, net.probabilities(w) * held[:, None])
                p /= np.maximum(1, np.diff(offs))[:, None]
                best = p.argmax(1)
                lang += [net.languages[k] if h else UNDETERMINED for k, h in zip(best.tolist(), has.tolist(), strict=True)]
                score += np.where(has, np.minimum(1.0, p[np.arange(hi - lo), best]), 0.0).tolist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    from weftline.llm.shared import documents

    docs = documents(spark, sf_dir)
    return identify(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
