"""Packing of tokenised documents into fixed windows, by best-fit decreasing.

Documents are tokenised where they lie; only the lengths and checksums of pieces travel.
A document longer than a window is first cut into full windows. The other pieces are
dealt by hash into groups of about `group_rows` documents, each packed by itself: pieces
in decreasing length, each into the open window with the least room that holds it, which
a segment tree over capacities finds. Groups keep memory bounded and are packed in
parallel; a group leaves at most a few windows with room.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import textvec as V
from weftline.llm.bytebpe import Encoder
from weftline.llm.shared import freed, releasing

WINDOW = 2048
END_ID = 1
_PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, one a worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class CapacityTree:
    """Open windows by the room left in them, under a segment tree over capacities 0..window."""

    def __init__(self, window: int) -> None:
        self.size = 1 << window.bit_length()
        self.some = bytearray(2 * self.size)  # does a capacity of this span have a window
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        node = self.size + capacity
        while node and not self.some[node]:
            self.some[node] = 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """(capacity, window) of the tightest window with room for length, removed; None without one."""
        node = self.size + length
        if not self.some[node]:
            while node > 1 and (node & 1 or not self.some[node + 1]):  # up until a span to the right has one
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.some[2 * node] else 2 * node + 1
        capacity = node - self.size
        window = self.open[capacity].pop()
        if not self.open[capacity]:
            self.some[node] = 0
            node >>= 1
            while node and not (self.some[2 * node] or self.some[2 * node + 1]):
                self.some[node] = 0
                node >>= 1
        return capacity, window


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece; ties go by the order given."""
    tree, where, offset, made = CapacityTree(window), np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        got = tree.take(n)
        if got is None:
            got, made = (window, made), made + 1
        capacity, w = got
        where[i], offset[i] = w, window - capacity
        if capacity > n:
            tree.add(capacity - n, w)
    return where, offset


def _pieces(batches: Iterator[pa.RecordBatch], path: str, window: int) -> Iterator[pa.RecordBatch]:
    """Pieces of every row; `again` numbers equal rows of a batch, so that they can be dealt apart."""
    enc = encoder(path)
    for b in batches:
        text, met = b.column(1).fill_null(""), Counter()
        for lo, hi, _, _ in V.slices(text, V.SLICE_BYTES):
            ids, cut = enc.encode(text.slice(lo, hi - lo).to_pylist())
            doc = [], [], [], [], [], []
            for i, key in enumerate(b.column(0).slice(lo, hi - lo).to_pylist()):
                own = np.append(ids[cut[i] : cut[i + 1]], np.uint32(END_ID)).astype("<u4")
                for s in range(0, len(own), window):
                    part = own[s : s + window]
                    row = (key, s, len(part), zlib.crc32(part.tobytes()), len(own))
                    for column, x in zip(doc, (*row, met[row]), strict=True):
                        column.append(x)
                    met[row] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in doc], names=[*_PIECE, "again"])


def _pack(table: pa.Table, window: int) -> pa.Table:
    table = table.sort_by([(c, "ascending") for c in _PIECE])  # a null id comes last
    where, offset = best_fit_decreasing(table.column("length").to_numpy(), window)
    # Group in the high bits, so that sequence ids are unique without a count over groups.
    sequence = (table.column("pack_group").to_numpy() << 32) + where
    return table.select(_PIECE).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))


def packed(docs: DataFrame, path: str | None = None, window: int = WINDOW, group_rows: int = 8192, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and END_ID. start is the number of its ids before the piece;
    offset is where the piece stands in its sequence, without gaps from 0. Null and empty
    texts have END_ID alone. Rows that repeat a doc_id, or have none, are packed each for
    itself, ids of any size as they are. An empty table gives no pieces; other columns play no part.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    groups = max(1, round(docs.count() / group_rows))
    kinds = ", ".join(f"{c} long" for c in _PIECE)
    pieces = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(releasing(lambda b: _pieces(b, path, window)), f"{kinds}, again long")
    # Rows without an id, and rows that are alike, are dealt apart by what they hold and by their number.
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "again"), F.lit(groups)))
    return dealt.groupBy("pack_group").applyInArrow(freed(lambda t: _pack(t, window)), f"{kinds}, sequence_id long, offset long")


def op2_packing(spark, sf_dir: str) -> DataFrame:
    from weftline.llm.shared import documents

    return packed(documents(spark, sf_dir))
