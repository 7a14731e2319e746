"""Vectorised text primitives shared by the operators of this subpackage.

A batch of texts is one byte buffer with document offsets, straight from Arrow, so no
operator loops over bytes or words in Python. Spans are known by span_hash, a sum of
independent words for each (place, symbol), and blocks of a power of two by block_hashes;
neither has the structure of a polynomial modulo 2**64, under which long words over two
letters can be equal. The polynomial (substring_hash) serves where equality decides
nothing. Work is done in slices of about SLICE_BYTES, which bounds the working set
whatever the size of an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
#: Odd multiplier of the polynomial hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def keyed_table(size: int, seed: int) -> np.ndarray:
    """Pseudo-random 64-bit words made by rule from a seed."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(size, dtype=np.uint64) + np.uint64(seed)) * np.uint64(BASE) + np.uint64(seed))


BYTE_WORDS = keyed_table(256, 0x51ED27)
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + (1 << 18))
        made = []
        for base in (BASE, BASE_INV):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        _POWERS[:] = made
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Prefix sums from which substring_hash takes the hash of any substring."""
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE_WORDS[buf] * powers(len(buf) + 1)[0][:-1], out=out[1:])
    return out


def substring_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of buf[start:end], equal for equal bytes anywhere."""
    with np.errstate(over="ignore"):
        return mix64((prefix[end] - prefix[start]) * powers(len(prefix))[1][start])


#: Places of a span whose words stand in a table; later ones are worked out.
_TABLED = 64
_SPAN_SEED = np.uint64(0xA24BAED4963EE407)
_TABLES: dict[int, np.ndarray] = {}


def _place_words(symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(((place.astype(np.uint64) << np.uint64(21)) | symbols.astype(np.uint64)) * np.uint64(BASE) + _SPAN_SEED)


def span_hash(symbols: np.ndarray, start: np.ndarray, end: np.ndarray, alphabet: int = 256) -> np.ndarray:
    """64-bit hashes of symbols[start:end], equal for equal spans anywhere; symbols are under alphabet, at most 2**21."""
    lens = end - start
    place = ragged(lens)
    got = symbols[place + np.repeat(start, lens)]
    if alphabet > 4096:
        words = _place_words(got, place)
    else:
        if alphabet not in _TABLES:
            at, symbol = np.divmod(np.arange(_TABLED * alphabet), alphabet)
            _TABLES[alphabet] = _place_words(symbol, at)
        words = _TABLES[alphabet][np.minimum(place, _TABLED - 1) * alphabet + got]
        late = np.flatnonzero(place >= _TABLED)
        if len(late):
            words[late] = _place_words(got[late], place[late])
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words, out=total[1:])
    at = np.concatenate([[0], np.cumsum(lens)])
    with np.errstate(over="ignore"):
        return mix64(total[at[1:]] - total[at[:-1]] + lens.astype(np.uint64) * np.uint64(BASE))


def block_hashes(buf: np.ndarray, levels: int) -> np.ndarray:
    """64-bit hashes of the 2**levels bytes at every place, by doubling with a non-linear step."""
    h = BYTE_WORDS[buf]
    for level in range(levels):
        span = 1 << level
        later = h[span:]
        h = h[:-span] * np.uint64(BASE)
        h += later
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
    return h


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole rows; a run is over limit only if it is one row."""
    buf, offs = utf8(column)
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def runs(mask: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True, cut at document bounds."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    inner = offs[(offs > 0) & (offs < len(mask))]
    first[inner] = mask[inner]
    last[inner - 1] = mask[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


#: Bytes that end a word: space and 0x09 to 0x0D.
WORD_BYTE = np.ones(256, bool)
WORD_BYTE[[0x20, *range(0x09, 0x0E)]] = False
#: A-Z to a-z, all other bytes as they are.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def words(buf: np.ndarray, offs: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, document index and hash of each white-space separated word."""
    if fold:
        buf = FOLD[buf]
    start, end = runs(WORD_BYTE[buf], offs)
    doc = np.searchsorted(offs, start, side="right") - 1
    return start, end, doc, span_hash(buf, start, end)


def strings(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[bytes]:
    whole = buf.tobytes()
    return [whole[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]


def ragged(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, concatenated."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
