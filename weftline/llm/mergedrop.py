"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

Text is cut before runs of the space mark, which no piece of such a model crosses. Each
unit's characters wait on an agenda of candidate merges, best score first, then leftmost;
a candidate that comes up is skipped when a keyed hash of the seed, the unit, its
occurrence and the span says so, and otherwise merged if both sides still stand. The key
of an occurrence is a keyed hash of the seed, the document and its place, so each is
segmented by itself. What is remembered of a unit that comes again is its segmentation
without skips and those after one skip, each with the spans that it merges: an occurrence
that skips none of these has it. All others are worked out side by side in numpy: in each
step every unit takes up its best open candidate. Very long units go one by one. Characters without a piece are written as byte pieces. With
dropout 0 the ids are the library's.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import textvec as V

MARK = "▁"
#: Stands for a space mark that was in the text; no valid text holds it.
_LITERAL_MARK = "\udc81"
_UNITS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: Remembered segmentations and units at which a worker starts anew; length of a unit from which it goes alone.
MEMORY = 1_000_000
LONG = 48
_NEVER = np.int32(2**31 - 1)
_K1, _K2, _K3 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93
_ALL = 0xFFFFFFFFFFFFFFFF


class Vocabulary:
    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.byte_ids, self.pieces, self.bytes_of = [0] * 256, {}, []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.bytes_of.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.pieces[piece] = (-sp.get_score(i), i)
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        # Merges by the two pieces, with the rank of the result; 0, the unknown piece, is in none.
        order = {score: rank for rank, score in enumerate(sorted({score for score, _ in self.pieces.values()}))}
        merges = [
            (left[1] << 32 | right[1], order[score], i)
            for piece, (score, i) in self.pieces.items()
            for k in range(1, len(piece))
            if (left := self.pieces.get(piece[:k])) and (right := self.pieces.get(piece[k:]))
        ]
        # A hash table with linear probing, at most a fourth full; key 0 is free.
        self.shift = np.uint64(64 - max(8, (4 * len(merges)).bit_length()))
        size = 1 << 64 - int(self.shift)
        self.merge_key, self.merge_rank, self.merge_id = np.zeros(size, np.int64), np.full(size, _NEVER, np.int32), np.zeros(size, np.int32)
        for key, rank, i in sorted(merges):
            slot = (key * _K1 & _ALL) >> int(self.shift)
            while self.merge_key[slot]:
                slot = (slot + 1) % size
            self.merge_key[slot], self.merge_rank[slot], self.merge_id[slot] = key, rank, i
        self.char_id = np.zeros(0x110000, np.int32)
        for c, (_, i) in self.pieces.items():
            if len(c) == 1:
                self.char_id[ord(c)] = i

    def merges(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of what each pair of pieces merges to."""
        key = (left.astype(np.int64) << np.int64(32)) | right
        with np.errstate(over="ignore"):
            at = ((key.astype(np.uint64) * np.uint64(_K1)) >> self.shift).astype(np.int64)
        found = self.merge_key[at]
        on = np.nonzero((found != key) & (found != 0))
        while len(on[0]):
            at[on] = (at[on] + 1) % len(self.merge_key)
            found = self.merge_key[at[on]]
            on = tuple(x[(found != key[on]) & (found != 0)] for x in on)
        rank = self.merge_rank[at]
        rank[self.merge_key[at] != key] = _NEVER
        return rank, self.merge_id[at]


class DropoutEncoder:
    """Encoder and decoder over one vocabulary, seed and dropout rate."""

    def __init__(self, path: str, seed: int, dropout: float) -> None:
        self.vocabulary, self.seed = Vocabulary(path), seed
        self.limit = round(dropout * 65536)
        self._forget()

    def _forget(self) -> None:
        #: Numbers of remembered units, and units met once.
        self.memory: dict[str, int] = {}
        self.once: set[str] = set()
        #: By number of a segmentation: its ids and, in flat arrays, the spans that it merges and the
        #: segmentations that skip one of them, -1 where not known. Only those without skips have these.
        self.ids: list[bytes] = []
        self.content = np.zeros(0, np.uint64)
        self.first_span = np.zeros(1, np.int64)
        self.spans = np.zeros(0, np.uint64)
        self.after = np.zeros(0, np.int64)

    def _contents(self, units: list[str]) -> np.ndarray:
        """Hashes of units."""
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        lens = np.array([len(u) for u in units], np.int64)
        end = np.cumsum(lens)
        return V.span_hash(points, end - lens, end, 1 << 21)

    def _keyed(self, contents: np.ndarray, variants: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return V.mix64(contents + np.uint64(self.seed * _K1 & _ALL) + variants.astype(np.uint64) * np.uint64(_K3))

    def _bases(self, units: list[str], variants: np.ndarray) -> np.ndarray:
        """Keyed hashes of (seed, unit, variant); a variant is the key of an occurrence."""
        return self._keyed(self._contents(units), variants)

    def _skipped(self, bases: np.ndarray, spans: np.ndarray) -> np.ndarray:
        """Whether each span, as start * _K1 + end * _K2, is skipped."""
        with np.errstate(over="ignore"):
            h = (bases ^ spans) * np.uint64(_K3)
        return (((h ^ (h >> np.uint64(29))) >> np.uint64(13)) & np.uint64(0xFFFF)) < np.uint64(self.limit)

    def _skips(self, unit: str, variant: int):
        base, limit = int(self._bases([unit], np.array([variant]))[0]), self.limit

        def skip(start: int, end: int) -> bool:
            h = (base ^ (start * _K1 + end * _K2 & _ALL)) * _K3 & _ALL
            return (h ^ h >> 29) >> 13 & 0xFFFF < limit

        return skip

    def segment(self, unit: str, variant: int | None) -> list[str]:
        """Pieces of one unit; without a variant none is skipped."""
        known, n = self.vocabulary.pieces, len(unit)
        end, before = list(range(1, n + 1)), list(range(-1, n))  # of the symbol that starts here; 0 once merged away
        agenda = []
        for i in range(n - 1):
            if got := known.get(unit[i : i + 2]):
                agenda.append((got[0], i, i + 1, i + 2))
        heapq.heapify(agenda)
        skip = self._skips(unit, variant) if self.limit and variant is not None else None
        while agenda:
            _, a, b, e = heapq.heappop(agenda)
            if end[a] != b or b >= n or end[b] != e or (skip and skip(a, e)):
                continue
            end[a], end[b] = e, 0
            if e < n:
                before[e] = a
                z = end[e]
                if got := known.get(unit[a:z]):
                    heapq.heappush(agenda, (got[0], a, e, z))
            p = before[a]
            if p >= 0 and (got := known.get(unit[p:e])):
                heapq.heappush(agenda, (got[0], p, a, e))
        out, i = [], 0
        while i < n:
            out.append(unit[i : end[i]])
            i = end[i]
        return out

    def _written(self, pieces: list[str]) -> bytes:
        ids = []
        for s in pieces:
            got = self.vocabulary.pieces.get(s)
            if got:
                ids.append(got[1])
            else:  # a single character
                ids += [self.vocabulary.byte_ids[b] for b in (MARK if s == _LITERAL_MARK else s).encode("utf-8", "surrogatepass")]
        return np.array(ids, "<u4").tobytes()

    def _side_by_side(self, units: list[str], variants: np.ndarray | None, skips: np.ndarray | None = None, merges: list | None = None) -> list[bytes]:
        """Ids of many units, all shorter than LONG, one candidate of each a step; merges takes (units, spans) of each step.

        Without variants only the span of each that skips names is skipped.
        """
        vocabulary, n = self.vocabulary, len(units)
        lens = np.array([len(u) for u in units])
        wide = int(lens.max()) + 1
        inside = np.arange(wide) < lens[:, None]
        symbol = np.zeros((n, wide), np.int32)
        symbol[inside] = vocabulary.char_id[np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)]
        start = np.minimum(np.arange(wide, dtype=np.int64), lens[:, None])
        start = np.concatenate([start, lens[:, None]], 1)
        rank, _ = vocabulary.merges(symbol[:, :-1], symbol[:, 1:])
        rank[np.arange(wide - 1) >= lens[:, None] - 1] = _NEVER
        dropping = bool(self.limit) and variants is not None
        base = self._bases(units, variants) if dropping else skips if skips is not None else np.zeros(n, np.uint64)
        place = np.arange(wide)
        live = np.arange(n)
        sy, st, rk, ba = symbol, start, rank, base
        while len(live):
            at = rk.argmin(1)
            rows = np.arange(len(live))
            going = rk[rows, at] != _NEVER
            if not going.all():
                done = ~going
                symbol[live[done]], start[live[done]] = sy[done], st[done]
                live, sy, st, rk, ba, at = live[going], sy[going], st[going], rk[going], ba[going], at[going]
                rows = np.arange(len(live))
                if not len(live):
                    break
            if dropping or merges is not None:
                with np.errstate(over="ignore"):
                    spans = st[rows, at].astype(np.uint64) * np.uint64(_K1) + st[rows, at + 2].astype(np.uint64) * np.uint64(_K2)
                skip = self._skipped(ba, spans) if dropping else spans == ba
                rk[rows[skip], at[skip]] = _NEVER
                r, j = rows[~skip], at[~skip]
                if merges is not None:
                    merges.append((live[r], spans[r]))
            else:
                r, j = rows, at
            if not len(r):
                continue
            _, merged = vocabulary.merges(sy[r, j], sy[r, j + 1])
            later = place > j[:, None]
            s2, t2, k2 = sy[r], st[r], rk[r]
            s2[:, :-1] = np.where(later[:, :-1], s2[:, 1:], s2[:, :-1])
            s2[np.arange(len(r)), j] = merged
            t2[:, :-1] = np.where(later, t2[:, 1:], t2[:, :-1])
            k2[:, :-1] = np.where(later[:, :-2], k2[:, 1:], k2[:, :-1])
            k2[:, -1] = _NEVER
            q = np.arange(len(r))
            end = t2[:, -1]
            for where, ok in ((j - 1, j > 0), (j, t2[q, np.minimum(j + 1, wide)] < end)):
                x = q[ok]
                k2[x, where[ok]] = vocabulary.merges(s2[x, where[ok]], s2[x, where[ok] + 1])[0]
            k2[q[t2[q, np.minimum(j + 1, wide)] >= end], np.minimum(j[t2[q, np.minimum(j + 1, wide)] >= end], wide - 2)] = _NEVER
            sy[r], st[r], rk[r] = s2, t2, k2
        left = start[:, :wide] < lens[:, None]
        count = left.sum(1)
        flat = symbol[left].astype("<u4").tobytes()
        ends = (4 * np.cumsum(count)).tolist()
        out = [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        for i in np.flatnonzero((left & (symbol == 0)).any(1)).tolist():
            cut = [*start[i, : count[i]].tolist(), int(lens[i])]
            out[i] = self._written([units[i][a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)])
        return out

    def _learn(self, units: list[str], skips: np.ndarray) -> None:
        """Appends the segmentations of units, all shorter than LONG, that skip one span each; 0 is none."""
        counts, spans = [], []
        for lo in range(0, len(units), 4096):
            part, merges = units[lo : lo + 4096], []
            self.ids += self._side_by_side(part, None, skips[lo : lo + 4096], merges)
            whose = np.concatenate([np.zeros(0, np.int64), *(w for w, _ in merges)])
            spans.append(np.concatenate([np.zeros(0, np.uint64), *(x for _, x in merges)])[np.argsort(whose, kind="stable")])
            counts.append(np.bincount(whose, minlength=len(part)))
        self.content = np.concatenate([self.content, self._contents(units)])
        self.first_span = np.concatenate([self.first_span, self.first_span[-1] + np.cumsum(np.concatenate(counts))])
        self.spans = np.concatenate([self.spans, *spans])
        self.after = np.concatenate([self.after, np.full(len(self.spans) - len(self.after), -1)])

    def _first_skips(self, number: np.ndarray, bases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which occurrences skip a span of their segmentation, and the first such span."""
        first = self.first_span[number]
        count = self.first_span[number + 1] - first
        at = V.ragged(count) + np.repeat(first, count)
        skipped = self._skipped(np.repeat(bases, count), self.spans[at])
        hit, place = np.unique(np.repeat(np.arange(len(number)), count)[skipped], return_index=True)
        return hit, at[skipped][place]

    def _occurrences(self, units: list[str], variants: np.ndarray) -> list[bytes]:
        """Ids of each occurrence of a unit."""
        memory, once = self.memory, self.once
        number = np.array([memory.get(u, -1) for u in units], np.int64)
        missing, wanted = np.flatnonzero(number < 0).tolist(), set()
        for i in missing:
            u = units[i]
            if len(u) < LONG:
                wanted.add(u) if u in once else once.add(u)
        if wanted:
            once -= wanted
            new, n = sorted(wanted, key=len), len(self.ids)
            self._learn(new, np.zeros(len(new), np.uint64))
            memory.update(zip(new, range(n, n + len(new)), strict=True))
            number[missing] = [memory.get(units[i], -1) for i in missing]
        alone = np.flatnonzero(number < 0)
        if self.limit:
            known = np.flatnonzero(number >= 0)
            bases = self._keyed(self.content[number[known]], variants[known])
            hit, span = self._first_skips(number[known], bases)
            known, bases = known[hit], bases[hit]
            new, whose = np.unique(span[self.after[span] < 0], return_index=True)
            if len(new):
                whose = known[self.after[span] < 0][whose]
                order = np.argsort([len(units[i]) for i in whose.tolist()], kind="stable")
                self.after[new[order]] = np.arange(len(self.ids), len(self.ids) + len(new))
                self._learn([units[i] for i in whose[order].tolist()], self.spans[new[order]])
            number[known] = self.after[span]
            again, _ = self._first_skips(number[known], bases)
            number[known[again]] = -1
            alone = np.concatenate([alone, known[again]])
        ids = self.ids
        out = [ids[i] if i >= 0 else b"" for i in number.tolist()]
        lens = np.array([len(units[i]) for i in alone.tolist()], np.int64)
        alone, lens = alone[np.argsort(lens, kind="stable")], np.sort(lens)
        short = alone[lens < LONG]
        for lo in range(0, len(short), 4096):
            part = short[lo : lo + 4096]
            for i, x in zip(part.tolist(), self._side_by_side([units[i] for i in part.tolist()], variants[part]), strict=True):
                out[i] = x
        for i in alone[lens >= LONG].tolist():
            out[i] = self._written(self.segment(units[i], int(variants[i])))
        return out

    def encode_batch(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """Ids of texts; a key tells one document's segmentations from another's."""
        if len(self.ids) + len(self.once) >= MEMORY:
            self._forget()
        units, variants, ends = [], [], []
        for text, key in zip(texts, keys, strict=True):
            if MARK in text:
                text = text.replace(MARK, _LITERAL_MARK)
            n = len(units)
            if text:
                units += _UNITS.findall(MARK + text.replace(" ", MARK))
            ends.append(len(units))
            with np.errstate(over="ignore"):
                start = np.uint64((key * _K1 + self.seed * _K2) & _ALL)
                variants.append(V.mix64(np.arange(len(units) - n, dtype=np.uint64) * np.uint64(V.BASE) + start))
        if not units:
            return [np.zeros(0, "<u4") for _ in texts]
        ids = self._occurrences(units, np.concatenate(variants))
        return [np.frombuffer(b"".join(ids[a:b]), "<u4") for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def encode(self, text: str, key: int) -> np.ndarray:
        return self.encode_batch([text], [key])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids made by encode."""
        raw = b"".join(map(self.vocabulary.bytes_of.__getitem__, ids.tolist()))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "surrogatepass")


_ENCODERS: dict[tuple, DropoutEncoder] = {}


def encoder(path: str, seed: int, dropout: float) -> DropoutEncoder:
    """One a worker for each setting."""
    key = (path, seed, dropout)
    if key not in _ENCODERS:
        _ENCODERS[key] = DropoutEncoder(*key)
    return _ENCODERS[key]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def encode_documents(docs: DataFrame, seed: int = 0, dropout: float = 0.1, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row. Null and empty texts have no ids; a null id counts as 0 in the key.

    Rows that repeat id and text have the same ids, once a row; an empty table gives an empty
    result; texts may be of any length, one unit alone included; other columns play no part.
    """
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, seed, dropout)
        for b in batches:
            ids = []
            for lo, hi, _, _ in V.slices(b.column(1)):
                ids += enc.encode_batch(b.column(1).slice(lo, hi - lo).to_pylist(), [k or 0 for k in b.column(0).slice(lo, hi - lo).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return _prepared(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids give the empty text."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, 0, 0.0)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([enc.decode(np.array(i or [], np.int64)) for i in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trips(docs: DataFrame, seed: int = 0, dropout: float = 0.1, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_ids, ids_crc32 (little-endian 32-bit ids), decoded_sha256, lossless."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, seed, dropout)
        for b in batches:
            n, crc, sha, same = [], [], [], []
            for lo, hi, _, _ in V.slices(b.column(1)):
                texts = b.column(1).slice(lo, hi - lo).to_pylist()
                for text, ids in zip(texts, enc.encode_batch(texts, [k or 0 for k in b.column(0).slice(lo, hi - lo).to_pylist()]), strict=True):
                    back = enc.decode(ids)
                    n.append(len(ids)), crc.append(zlib.crc32(ids.tobytes())), same.append(back == text)
                    sha.append(hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(sha, pa.string()), pa.array(same, pa.bool_())], names=["doc_id", "n_ids", "ids_crc32", "decoded_sha256", "lossless"])

    return _prepared(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string, lossless boolean")


def op7_merge_dropout(spark, sf_dir: str) -> DataFrame:
    from weftline.llm.shared import documents

    return round_trips(documents(spark, sf_dir), seed=20, dropout=0.1)
