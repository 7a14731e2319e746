"""Exact removal of repeated byte passages over a whole corpus, by a run-length index.

A passage of `length` bytes is removed where it also starts earlier in the corpus.

1. Every window of `length` bytes names an anchor: the leftmost smallest hash among its
   `GRAM`-byte grams. Equal windows name equal anchors at the same place inside, so
   windows need comparing only where anchors are equal. About one gram in 35 is an anchor.
2. Anchors travel in compressed blocks, by hash. Where the bytes of all windows of an
   anchor occur earlier in the same form, they repeat as a whole: such copies are folded
   into the first. First forms under an anchor that has several are fetched as text.
3. Those texts are dealt by a longer gram of the windows concerned, of which each share has
   its own, so unrelated ones part.
   Within a group, in corpus order, left halves are indexed and right halves streamed
   against the index, at every level of a binary split: each pair meets at exactly one
   level, the earlier indexed. The index is a run-length compressed Burrows-Wheeler
   transform; windows whose matching statistic reaches `length` repeat an earlier one.
4. Spans meet the texts by document bucket, where the bytes kept are put together.

Texts move by a hash of the document id only; no group of equal passages is gathered
with its documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import textvec as V
from weftline.llm.runindex import RunLengthIndex
from weftline.llm.shared import buckets, checkpointed, documents, freed, ordered, releasing

GRAM = 32
_PLACE_BITS = 20
#: Windows of one long text that are looked at in one go.
_PIECE = 1 << 19
_SPREAD = 1_000_003
#: Bytes of text whose anchors are put in order together, and of pieces that one index holds.
_TOGETHER, _INDEXED = 8 << 20, 1 << 20
#: Parts of the windows of an anchor, by the bytes before it, that are dealt each by itself.
_SHARES = 4
#: Windows' texts that are fetched, and patterns that are streamed, in one go.
_FETCHED, _STREAMED = 1 << 15, 1 << 14


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def _anchors_of(buf: np.ndarray, offs: np.ndarray, length: int):
    """(doc, place, first window, last window, gram hash, form hash) of each anchor run; positions in buf."""
    n = len(buf)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    gram = V.block_hashes(buf, 5)
    place = np.arange(len(gram))
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least = _sliding_min((gram & ~low) | place.astype(np.uint64), length - GRAM + 1)
    at = (least & low).astype(np.int64)[: n - length + 1]
    # Windows that cross a document's end do not exist.
    exists = np.ones(len(at), bool)
    cross = offs[1:-1]
    if len(cross):
        edge = np.zeros(len(at) + 1, np.int64)
        np.add.at(edge, np.clip(cross - length + 1, 0, len(at)), 1)
        np.add.at(edge, np.clip(cross, 0, len(at)), -1)
        exists = np.cumsum(edge[:-1]) == 0
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | ~exists[:-1]
    first = np.flatnonzero(new & exists)
    ends = np.ones(len(at), bool)
    ends[:-1] = (at[1:] != at[:-1]) | ~exists[1:]
    last = np.flatnonzero(ends & exists)
    p = at[first]
    doc = np.searchsorted(offs, first, side="right") - 1
    return doc, p, first, last, gram[p], _forms(gram, p, first, last + length, 2 * length - GRAM)


def _forms(gram: np.ndarray, place: np.ndarray, first: np.ndarray, end: np.ndarray, most: int) -> np.ndarray:
    """Hashes of the bytes from first to end, `most` at most, and of where in them the anchor stands.

    Grams at steps of their length cover the whole; the last ones stand at the end.
    """
    with np.errstate(over="ignore"):
        out = ((place - first).astype(np.uint64) << np.uint64(32)) + (end - first).astype(np.uint64)
        for step in range(0, most, GRAM):
            out = V.mix64(out * np.uint64(V.BASE) + gram[np.minimum(first + step, end - GRAM)])
    return out


def _anchors(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """As _anchors_of, with rows of the column and positions inside their texts."""
    for lo, hi, buf, offs in V.slices(column, _PIECE):
        if hi == lo + 1 and len(buf) > _PIECE:
            for a in range(0, len(buf) - length + 1, _PIECE):
                piece = buf[a : a + _PIECE + length - 1]
                doc, p, s, e, g, f = _anchors_of(piece, np.array([0, len(piece)]), length)
                yield doc + lo, p + a, s + a, e + a, g, f
        else:
            doc, p, s, e, g, f = _anchors_of(buf, offs, length)
            base = offs[doc]
            yield doc + lo, p - base, s - base, e - base, g, f


def _packed(*columns: np.ndarray) -> bytes:
    """Integer columns as one compressed block; a sorted first column is kept as differences."""
    first = np.diff(columns[0], prepend=columns[0].dtype.type(0))
    return zstandard.compress(b"".join(c.tobytes() for c in (first, *columns[1:])), 1)


def _unpacked(block: bytes, *kinds: type) -> list[np.ndarray]:
    raw = zstandard.decompress(block)
    n, out, at = len(raw) // sum(np.dtype(k).itemsize for k in kinds), [], 0
    for k in kinds:
        out.append(np.frombuffer(raw, k, n, at))
        at += n * np.dtype(k).itemsize
    out[0] = np.cumsum(out[0], dtype=out[0].dtype)
    return out


_PLACES = (np.int64, np.int64, np.uint8, np.uint8)
_SPANS = (np.int64, np.int64, np.int64)


def _places(block: bytes) -> list[np.ndarray]:
    return _unpacked(block, *_PLACES)


def _span_rows(order: np.ndarray, start: np.ndarray, end: np.ndarray, parts: int) -> list[tuple[int, bytes]]:
    """(document bucket, block of spans) with touching spans of a document joined."""
    o = np.lexsort((start, order))
    order, start, end = order[o], start[o], end[o]
    out = []
    part = order % _SPREAD % parts
    for b in np.unique(part):
        x = part == b
        d, s, e = order[x], start[x], end[x]
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (s[1:] > e[:-1])
        head = np.flatnonzero(new)
        out.append((int(b), _packed(d[head], s[head], np.maximum.reduceat(e, head))))
    return out


def _blocks(kind: list[int], part: list[int], *more: list) -> pa.RecordBatch:
    names = ["kind", "part", "hashes", "places"]
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(part, pa.int32()), *(pa.array(m, pa.binary()) for m in more)], names=names[: 2 + len(more)])


def _map_anchors(batches: Iterator[pa.RecordBatch], length: int, parts: int, fold: bool) -> Iterator[pa.RecordBatch]:
    """Anchors by hash bucket (kind 0); repeats among the same rows become spans (kind 1)."""
    for b in (x.slice(lo, hi - lo) for x in batches for lo, hi, _, _ in V.slices(x.column(1), _TOGETHER)):
        ids = b.column(0).to_numpy()
        found = [x for x in _anchors(b.column(1), length) if len(x[0])]
        if not found:
            continue
        doc, p, s, e, g, f = (np.concatenate(c) for c in zip(*found, strict=True))
        order = ids[doc]
        with np.errstate(over="ignore"):
            both = V.mix64(g + f * np.uint64(V.BASE))
        o = np.lexsort((s, order))
        o = o[np.argsort(both[o], kind="stable")]
        again = np.zeros(len(o), bool)
        again[1:] = (both[o][1:] == both[o][:-1]) & fold
        r = o[again]
        kind, part, hashes, places = [], [], [], []
        for q, block in _span_rows(order[r], s[r], e[r] + length, parts):
            kind.append(1), part.append(q), hashes.append(b""), places.append(block)
        o = o[~again]
        o = o[np.lexsort((s[o], order[o]))]
        bucket = (g[o] % np.uint64(parts)).astype(np.int64)
        for q in np.unique(bucket):
            x = o[bucket == q]
            kind.append(0), part.append(int(q))
            hashes.append(g[x].tobytes() + f[x].tobytes())
            places.append(_packed(order[x], s[x], (p[x] - s[x]).astype(np.uint8), (e[x] - s[x]).astype(np.uint8)))
        yield _blocks(kind, part, hashes, places)


def _reduce_anchors(table: pa.Table, length: int, parts: int, fold: bool) -> pa.Table:
    """Spans (kind 1) and wanted texts (kind 2) of one hash bucket; spans pass through."""
    kinds, blocks, places = table.column("kind").to_pylist(), table.column("hashes").to_pylist(), table.column("places").to_pylist()
    out = [(1, q, b"", p) for k, q, p in zip(kinds, table.column("part").to_pylist(), places, strict=True) if k == 1]
    got = [(np.frombuffer(h, np.uint64).reshape(2, -1), _places(p)) for k, h, p in zip(kinds, blocks, places, strict=True) if k == 0]
    if got:
        g, f = np.concatenate([h for h, _ in got], 1)
        order, s, left, wide = (np.concatenate([p[i] for _, p in got]) for i in range(4))
        o = np.argsort(g, kind="stable")
        gs = g[o]
        many = np.zeros(len(o), bool)
        many[1:] = gs[1:] == gs[:-1]
        many[:-1] |= gs[1:] == gs[:-1]
        o = o[many]
        o = o[np.lexsort((s[o], order[o], f[o], g[o]))]
        gs, fs = g[o], f[o]
        same_g, same_f = np.zeros(len(o), bool), np.zeros(len(o), bool)
        same_g[1:] = gs[1:] == gs[:-1]
        same_f[1:] = same_g[1:] & (fs[1:] == fs[:-1]) & fold
        r = o[same_f]
        out += [(1, q, b"", block) for q, block in _span_rows(order[r], s[r], s[r] + wide[r] + length, parts)]
        firsts = ~same_f
        group = np.cumsum(~same_g)
        forms = np.bincount(group[firsts], minlength=(group[-1] if len(group) else 0) + 1)
        x = o[firsts & (forms[group] > 1)]
        x = x[np.lexsort((s[x], order[x]))]
        part = order[x] % _SPREAD % parts
        out += [(2, int(q), b"", _packed(order[y], s[y], left[y], wide[y])) for q in np.unique(part) for y in [x[part == q]]]
    return pa.Table.from_batches([_blocks(*map(list, zip(*out, strict=True)))] if out else [], schema=_blocks([], [], [], []).schema)


def _fetch_texts(docs: pa.Table, wanted: pa.Table, length: int, parts: int) -> pa.Table:
    """Texts of wanted windows, in pieces by the longer gram that those windows share; by its hash."""
    hashes, blocks, part = [], [], []
    if docs.num_rows and wanted.num_rows:
        order, s, left, wide = (np.concatenate(c) for c in zip(*map(_places, wanted.column("places").to_pylist()), strict=True))
        buf, offs = V.utf8(docs.column("text"))
        ids = docs.column("order_key").to_numpy()
        by = np.argsort(ids, kind="stable")
        row = by[np.searchsorted(ids[by], order)]
        o = np.argsort(offs[row] + s)
        order, s, left, wide, row = order[o], s[o], left[o].astype(np.int64), wide[o].astype(np.int64), row[o]
        at = offs[row] + s
        # Windows of a share differ by less than `step` in the bytes before the gram, so all have the bytes of its key.
        step = -(-(length - GRAM + 1) // _SHARES)
        for lo in range(0, len(at), _FETCHED):
            x = slice(lo, lo + _FETCHED)
            a, place = at[x], at[x] + left[x]
            found = []
            for before in range(0, length - GRAM + 1, step):
                most = min(before + step - 1, length - GRAM)
                first, last = np.maximum(a, place - most), np.minimum(a + wide[x], place - before)
                ok = np.flatnonzero(last >= first)
                span = np.arange(length - (most - before))
                shared = buf[(place[ok] - before)[:, None] + span].ravel()
                edge = len(span) * np.arange(len(ok) + 1)
                key = V.span_hash(shared, edge[:-1], edge[1:])
                with np.errstate(over="ignore"):
                    key = V.mix64(key + np.uint64(before + 1) * np.uint64(V.BASE))
                found.append((key, order[x][ok], first[ok] - at[x][ok] + s[x][ok], first[ok], last[ok] + length))
            key, doc, start, first, end = (np.concatenate(c) for c in zip(*found, strict=True))
            bucket = (key % np.uint64(parts)).astype(np.int64)
            for q in np.unique(bucket):
                y = np.flatnonzero(bucket == q)
                y = y[np.lexsort((start[y], doc[y]))]
                hashes.append(key[y].tobytes())
                lens = end[y] - first[y]
                text = buf[np.repeat(first[y], lens) + V.ragged(lens)].tobytes()
                blocks.append(len(y).to_bytes(8, "little") + zstandard.compress(doc[y].tobytes() + start[y].tobytes() + lens.astype(np.int64).tobytes() + text, 1))
                part.append(int(q))
    return pa.table([pa.array([0] * len(part), pa.int32()), pa.array(part, pa.int32()), pa.array(hashes, pa.binary()), pa.array(blocks, pa.binary())], names=["kind", "part", "hashes", "places"])


def repeated_windows(group: np.ndarray, pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For pieces in corpus order, the window starts that repeat a window of an earlier piece of the group."""
    marks = [np.zeros(max(0, len(p) - length + 1), bool) for p in pieces]
    by = np.argsort(group, kind="stable")
    new = np.flatnonzero(np.concatenate([[True], group[by][1:] != group[by][:-1]])) if len(by) else np.zeros(0, np.int64)
    size = np.diff(np.append(new, len(by)))
    rank = np.empty(len(by), np.int64)
    rank[by] = V.ragged(size)
    of_size = np.empty(len(by), np.int64)
    of_size[by] = np.repeat(size, size)
    lens = np.array([len(p) for p in pieces], np.int64)
    for level in range(int(size.max() - 1).bit_length() if len(size) else 0):
        # A block of this level is a class of the index, so blocks and groups do not meet.
        _, block = np.unique(group * (int(of_size.max()) + 1) + (rank >> (level + 1)), return_inverse=True)
        side = (rank >> level) & 1
        held = np.flatnonzero((side == 0) & (((rank >> level) + 1) << level < of_size))
        held = held[np.argsort(block[held], kind="stable")]
        now = np.flatnonzero(side == 1)
        now = now[np.argsort(block[now], kind="stable")]
        room = np.cumsum(lens[held] + 1)
        lo = 0
        while lo < len(held):  # a block may go through several indexes
            hi = max(lo + 1, int(np.searchsorted(room, (room[lo - 1] if lo else 0) + _INDEXED, side="right")))
            indexed = held[lo:hi]
            lo = hi
            text = np.frombuffer(b"".join(pieces[i] + b"\xff" for i in indexed.tolist()), np.uint8) + np.uint8(1)
            index = RunLengthIndex(text, np.repeat(block[indexed], lens[indexed] + 1))
            a, z = np.searchsorted(block[now], [block[indexed[0]], block[indexed[-1]] + 1]).tolist()
            for at in range(a, z, _STREAMED):
                part = now[at : min(z, at + _STREAMED)]
                starts = np.cumsum(lens[part]) - lens[part]
                flat = np.frombuffer(b"".join(pieces[i] for i in part.tolist()), np.uint8) + np.uint8(1)
                stats = index.matching_statistics(flat, block[part], starts, lens[part])
                for i, s in zip(part.tolist(), starts.tolist(), strict=True):
                    marks[i] |= stats[s : s + len(marks[i])] >= length
    return marks


def _match_texts(table: pa.Table, length: int, parts: int, fold: bool) -> pa.Table:
    """Spans of the windows that repeat an earlier window of another first form."""
    keys, orders, places, pieces = [], [], [], []
    for h, block in zip(table.column("hashes").to_pylist(), table.column("places").to_pylist(), strict=True):
        n, raw = int.from_bytes(block[:8], "little"), zstandard.decompress(block[8:])
        order, s, lens = np.frombuffer(raw, np.int64, 3 * n).reshape(3, n)
        keys.append(np.frombuffer(h, np.uint64)), orders.append(order), places.append(s)
        ends = 24 * n + np.cumsum(lens)
        pieces += [raw[b - a : b] for a, b in zip(lens.tolist(), ends.tolist(), strict=True)]
    out = []
    if keys:
        key, order, s = map(np.concatenate, (keys, orders, places))
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        x = np.flatnonzero(count[inverse] > 1)
        x = x[np.lexsort((s[x], order[x]))]
        chosen = [pieces[i] for i in x.tolist()]
        # A later piece that equals an earlier one of its group repeats as a whole and need not be streamed.
        seen: set[tuple[int, bytes]] = set()
        copy = np.zeros(len(x), bool)
        for i, (k, p) in enumerate(zip(inverse[x].tolist(), chosen, strict=True)):
            copy[i] = fold and (k, p) in seen
            seen.add((k, p))
        spans = [(order[x[copy]], s[x[copy]], s[x[copy]] + np.array([len(p) for p, c in zip(chosen, copy, strict=True) if c], np.int64))]
        x, chosen = x[~copy], [p for p, c in zip(chosen, copy, strict=True) if not c]
        # Whole groups, a bounded number of bytes at a time.
        by = np.argsort(inverse[x], kind="stable")
        group = inverse[x][by]
        bytes_to = np.cumsum([len(chosen[i]) for i in by.tolist()])
        lo = 0
        while lo < len(by):
            hi = int(np.searchsorted(bytes_to, (bytes_to[lo - 1] if lo else 0) + _INDEXED, side="right"))
            hi = int(np.searchsorted(group, group[max(hi, lo + 1) - 1], side="right"))
            now = by[lo:hi].tolist()
            for i, marks in zip(x[now].tolist(), repeated_windows(group[lo:hi], [chosen[j] for j in now], length), strict=True):
                a, b = V.runs(marks, np.array([0, len(marks)]))
                spans.append((np.full(len(a), order[i]), s[i] + a, s[i] + b - 1 + length))
            lo = hi
        o, a, b = (np.concatenate(c) for c in zip(*spans, strict=True))
        if len(o):
            out = [(1, q, b"", block) for q, block in _span_rows(o, a, b, parts)]
    return pa.Table.from_batches([_blocks(*map(list, zip(*out, strict=True)))] if out else [], schema=_blocks([], [], [], []).schema)


def _cut(docs: pa.Table, spans: pa.Table, with_bytes: bool, as_text: bool, carry: tuple[str, ...]) -> pa.Table:
    """The result rows of one document bucket; kept is put into Arrow slice by slice."""
    ids, whole = docs.column("order_key").to_numpy(), V.utf8(docs.column("text"))[1]
    first, last = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if spans.num_rows and docs.num_rows:
        order, s, e = (np.concatenate(c) for c in zip(*(_unpacked(p, *_SPANS) for p in spans.column("places").to_pylist()), strict=True))
        by = np.argsort(ids, kind="stable")
        base = whole[by[np.searchsorted(ids[by], order)]]
        o = np.argsort(base + s)
        first, last = (base + s)[o], (base + e)[o]
    columns: list[list] = [[], [], [], []]
    kind = pa.string() if as_text else pa.binary()
    kept: list[pa.Array] = [pa.array([], kind)]
    for lo, hi, buf, offs in V.slices(docs.column("text").combine_chunks()):
        x = slice(*np.searchsorted(first, [whole[lo], whole[hi]]).tolist())
        cover = np.zeros(len(buf) + 1, np.int32)
        np.add.at(cover, first[x] - whole[lo], 1)
        np.add.at(cover, last[x] - whole[lo], -1)
        gone = np.cumsum(cover[:-1], dtype=np.int32) > 0
        total = np.concatenate([[0], np.cumsum(gone)])
        start, _ = V.runs(gone, offs)
        per_doc = np.bincount(np.searchsorted(offs, start, side="right") - 1, minlength=hi - lo)
        left, at = buf[~gone].tobytes(), offs - total[offs]
        parts = [left[at[i] : at[i + 1]] for i in range(hi - lo)]
        digests = [hashlib.sha256(k).hexdigest() for k in parts]
        for c, more in zip(columns, (np.diff(offs).tolist(), (total[offs[1:]] - total[offs[:-1]]).tolist(), per_doc.tolist(), digests), strict=True):
            c += more
        kept.append(pa.array([k.decode("utf-8", "ignore") for k in parts] if as_text else parts if with_bytes else [None] * (hi - lo), kind))
    made = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)]
    return pa.table([docs.column("doc_id"), *made, pa.chunked_array(kept, kind), *(docs.column(c) for c in carry)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text" if as_text else "kept", *carry])


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", with_bytes: bool = True, carry: tuple[str, ...] = (), fold: bool = True, as_text: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left), carry.

    Every byte under a `length`-byte string that also starts earlier (a smaller doc_id, or
    the same document further left) is removed, judged on the input. Null text is empty.
    Rows that repeat a doc_id, or have none, come in the order of their text, a null id
    last; equal rows count as one after the other. Overlaps count; matches never cross
    documents. An empty table gives an empty result; other columns play no part.
    `length` must be over 64 and under 127. kept is null without with_bytes. With as_text it
    is a string by the name of text, without the bytes of characters that were cut apart;
    it is made where the bytes are, so that no second worker stands beside the one that cuts.

    With fold, windows' texts that are equal as a whole (by 64-bit hashes of the form, by
    bytes in a group) are known as repeats before the index; without it the index alone
    finds them all, to the same result, from more text.
    """
    if not 2 * GRAM < length < 127:
        raise ValueError("length must be between 65 and 126")
    base = ordered(docs, id_col, text_col, carry)
    parts = max(buckets(docs.sparkSession), -(-docs.count() // 50_000))
    row, block = "kind int, part int, hashes binary, places binary", ["kind", "part", "hashes", "places"]
    dealt = base.withColumn("part", F.pmod(F.pmod("order_key", F.lit(_SPREAD)), F.lit(parts)).cast("int"))
    by_document = dealt.groupBy("part")

    anchors = base.select("order_key", "text").mapInArrow(releasing(lambda b: _map_anchors(b, length, parts, fold)), row)
    # Spans made on the way keep their document bucket in part, so they are dealt by it as well.
    found = checkpointed(anchors.groupBy("part").applyInArrow(freed(lambda t: _reduce_anchors(t, length, parts, fold)), row))
    texts = by_document.cogroup(found.where("kind = 2").groupBy("part")).applyInArrow(freed(lambda d, w: _fetch_texts(d, w, length, parts)), row)
    matched = texts.groupBy("part").applyInArrow(freed(lambda t: _match_texts(t, length, parts, fold)), row)
    spans = found.where("kind = 1").select(block).unionByName(matched)
    kinds = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carry)
    return by_document.cogroup(spans.groupBy("part")).applyInArrow(freed(lambda d, s: _cut(d, s, with_bytes, as_text, carry)), f"doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, {'text string' if as_text else 'kept binary'}{kinds}")


def op4_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), with_bytes=False).drop("kept")
