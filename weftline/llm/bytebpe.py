"""Byte-level BPE ids of whole batches of texts, pre-token by pre-token.

The ids are those of the tokenizers library for the given file. Texts are cut into
pre-tokens in numpy; each distinct pre-token is encoded once by the library and kept in
a sorted table of hashes, so that a frequent one costs a table look-up. Texts with
characters outside the range whose classes are fixed here go to the library whole.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from weftline.llm import textvec as V

#: Code points under this are cut here; their classes do not change between Unicode versions.
PLAIN_LIMIT = 0x250
SPACE, LETTER, NUMBER, OTHER = range(4)
#: Entries of the table of known pre-tokens at which it is started anew.
TABLE_LIMIT = 3_000_000
_SPACES = [*range(9, 14), 0x20, 0x85, 0xA0]
_APOSTROPHE = ord("'")
#: The endings that follow an apostrophe as one pre-token.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(PLAIN_LIMIT)], np.uint8)
    out[_SPACES] = SPACE
    return out


CLASS = _classes()


def pretokens(points: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """First code points of the pre-tokens of concatenated texts; each text starts one."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = CLASS[points]
    text_start = np.zeros(n + 1, bool)
    text_start[offs] = True
    text_start[n] = True
    change = np.ones(n, bool)
    change[1:] = (kind[1:] != kind[:-1]) | text_start[1:n]
    start = change.copy()
    # The last white space of a run before other text stands apart; a plain space joins what follows.
    last = np.zeros(n, bool)
    last[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~text_start[1:n]
    start |= last
    joins = last & (points == 0x20)
    start[1:] &= ~joins[:-1]
    # An apostrophe that starts a pre-token takes one of the known endings with it.
    for a in np.flatnonzero((points == _APOSTROPHE) & start).tolist():
        limit = a + 1
        while limit < n and limit < a + 3 and not text_start[limit]:
            limit += 1
        after = "".join(map(chr, points[a + 1 : limit].tolist()))
        for ending in CONTRACTIONS:
            if after.startswith(ending):
                end = a + 1 + len(ending)
                start[a + 1 : end] = False
                if end < n:
                    start[end] = True
                break
    return np.flatnonzero(start)


class Encoder:
    """Ids of texts, with a table of pre-tokens that lives as long as the worker."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at, self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        encoded = self._encode(texts)
        length = np.array([len(e) for e in encoded], np.int64)
        at = len(self.ids) + np.cumsum(length) - length
        self.ids = np.concatenate([self.ids, np.array([i for e in encoded for i in e], np.uint32)])
        place = np.searchsorted(self.known, hashes)
        self.known, self.at, self.length = np.insert(self.known, place, hashes), np.insert(self.at, place, at), np.insert(self.length, place, length)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, uint32, and the n + 1 offsets of the texts."""
        if len(self.known) > TABLE_LIMIT:
            self._clear()
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        lens = np.array([len(t) for t in texts], np.int64)
        offs = np.concatenate([[0], np.cumsum(lens)])
        if len(points) and points.max() >= PLAIN_LIMIT:
            strange = np.maximum.reduceat(np.append(points, 0), offs[:-1]) >= PLAIN_LIMIT
            strange &= lens > 0
            plain = [("" if s else t) for t, s in zip(texts, strange, strict=True)]
            ids, cut = self.encode(plain)
            whole = iter(self._encode([t for t, s in zip(texts, strange, strict=True) if s]))
            parts = [np.array(next(whole), np.uint32) if s else ids[cut[i] : cut[i + 1]] for i, s in enumerate(strange)]
            return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        start = pretokens(points, offs[:-1][lens > 0])
        end = np.append(start[1:], len(points))
        hashes = V.span_hash(points, start, end, PLAIN_LIMIT)
        if len(hashes):
            place = np.searchsorted(self.known, hashes)
            fresh = self.known[np.minimum(place, len(self.known) - 1)] != hashes if len(self.known) else np.ones(len(hashes), bool)
            if fresh.any():
                f = np.flatnonzero(fresh)
                new, first = np.unique(hashes[f], return_index=True)
                text = "".join(texts)
                pick = f[first]
                self._learn(new, [text[a:b] for a, b in zip(start[pick].tolist(), end[pick].tolist(), strict=True)])
                place = np.searchsorted(self.known, hashes)
        else:
            place = np.zeros(0, np.int64)
        count = self.length[place]
        ids = self.ids[np.repeat(self.at[place], count) + V.ragged(count)]
        total = np.concatenate([[0], np.cumsum(count)])
        return ids, total[np.searchsorted(start, offs)]
