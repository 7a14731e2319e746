"""A run-length compressed Burrows-Wheeler index with sampled run ends, in numpy.

The text is a list of pieces. Bytes are stored as byte + 1 and every piece ends with 0,
an end that differs from all other ends, so that no match crosses a piece (UTF-8 has no
byte 255). Each piece belongs to a class, and a pattern matches pieces of its own class
only: a symbol is a class and a byte. Patterns are streamed right to left, many in
lockstep, and give matching statistics: for each pattern position the length of the
longest match with any piece of the class.
"""

from __future__ import annotations

import numpy as np

#: Lengths whose prefix ranks are kept; suffixes are ordered by 2 * LEVELS[-1] symbols.
LEVELS = (8, 16, 32, 64)


def _dense(keys: np.ndarray, alone: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and the dense rank of each; those alone equal nothing and follow their place."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    step = np.zeros(len(keys), np.int64)
    step[1:] = sorted_keys[1:] != sorted_keys[:-1]
    if alone is not None:
        step[1:] |= alone[order][1:]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(step)
    return order, rank


class RunLengthIndex:
    def __init__(self, symbols: np.ndarray, classes: np.ndarray) -> None:
        """symbols: uint8, the pieces with 0 after each; classes: the class of each symbol's piece."""
        n = len(symbols)
        self.n, self.symbols = n, np.concatenate([symbols, np.zeros(8, np.uint8)])
        word, open_ = np.zeros(n, np.uint64), np.ones(n, bool)
        for j in range(8):  # what follows an end does not count
            now = self.symbols[j : n + j]
            word = (word << np.uint64(8)) | np.where(open_, now, 0)
            open_ &= now != 0
        _, rank = _dense(word)
        _, rank = _dense((classes.astype(np.int64) << np.int64(32)) | rank, ~open_)
        self.ranks = [rank]
        for level in LEVELS[1:]:
            _, rank = self._doubled(rank, level // 2)
            self.ranks.append(rank)
        suffixes, _ = self._doubled(rank, LEVELS[-1])
        # The text is a cycle: before the first symbol stands the last end.
        bwt = ((classes.astype(np.int64) << np.int64(8)) | symbols)[suffixes - 1]
        self.run_start = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
        run_end = np.append(self.run_start[1:], n) - 1
        self.head = bwt[self.run_start]
        self.sample_first, self.sample_last = suffixes[self.run_start], suffixes[run_end]
        length = run_end - self.run_start + 1
        self.by_char = np.argsort(self.head, kind="stable")  # runs of a symbol, in order
        before = np.cumsum(length[self.by_char]) - length[self.by_char]
        self.lf_base = np.empty(len(length), np.int64)
        self.lf_base[self.by_char] = before  # rows start with the symbols in order, so this counts both C and rank
        self.char_runs = self.head[self.by_char] * len(length) + self.by_char

    def _doubled(self, rank: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
        second = np.zeros(self.n, np.int64)
        second[: max(0, self.n - half)] = rank[half:] + 1
        return _dense((rank << np.int64(32)) | second)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Longest common extension of text positions, up to 127."""
        x, y, out = x.copy(), y.copy(), np.zeros(len(x), np.int64)
        for level, rank in zip(LEVELS[::-1], self.ranks[::-1], strict=True):
            inside = (x < self.n) & (y < self.n)
            same = inside & (rank[np.where(inside, x, 0)] == rank[np.where(inside, y, 0)])
            step = same * level
            x, y, out = x + step, y + step, out + step
        for _ in range(7):
            same = (self.symbols[np.minimum(x, self.n)] == self.symbols[np.minimum(y, self.n)]) & (x < self.n) & (y < self.n)
            x, y, out = x + same, y + same, out + same
        return out

    def matching_statistics(self, patterns: np.ndarray, classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Match length at each symbol of patterns (stored as byte + 1), streamed from the right.

        classes, starts, lengths: of each pattern. Lengths above 127 may be reported smaller.
        """
        out = np.zeros(len(patterns), np.int64)
        order = np.argsort(-lengths, kind="stable")
        classes, starts, lengths = classes[order].astype(np.int64) << np.int64(8), starts[order], lengths[order]
        m = len(starts)
        row, pos, length = np.zeros(m, np.int64), np.full(m, self.sample_first[0], np.int64), np.zeros(m, np.int64)
        r = len(self.head)
        for t in range(int(lengths[0]) if m else 0):
            active = int(np.searchsorted(-lengths, -t, side="left"))  # patterns longer than t
            at = starts[:active] + lengths[:active] - 1 - t
            c = classes[:active] | patterns[at]
            k, p, ell = row[:active], pos[:active], length[:active]
            run = np.searchsorted(self.run_start, k, side="right") - 1
            miss = np.flatnonzero(self.head[run] != c)
            if len(miss):
                cm, rm, pm, lm = c[miss], run[miss], p[miss], ell[miss]
                below = np.searchsorted(self.char_runs, cm * r + rm)
                nxt = self.by_char[np.minimum(below, r - 1)]
                prv = self.by_char[np.maximum(below - 1, 0)]
                has_next, has_prev = (below < r) & (self.head[nxt] == cm), (below > 0) & (self.head[prv] == cm)
                down = np.where(has_next, np.minimum(lm, self.common(pm, self.sample_first[nxt])), -1)
                up = np.where(has_prev, np.minimum(lm, self.common(pm, self.sample_last[prv])), -1)
                use_up = up > down
                best = np.maximum(up, down)
                to = np.where(use_up, prv, nxt)
                run[miss] = np.where(best >= 0, to, rm)
                k[miss] = np.where(use_up, self.run_start[np.minimum(prv + 1, r - 1)] - 1, self.run_start[nxt])
                last_run = use_up & (prv == r - 1)
                k[miss[last_run]] = self.n - 1
                p[miss] = np.where(use_up, self.sample_last[prv], self.sample_first[nxt])
                ell[miss] = best
                none = miss[best < 0]
                run[none], k[none], p[none], ell[none] = 0, 0, self.sample_first[0], -1
            found = ell >= 0
            ell += 1
            row[:active] = np.where(found, self.lf_base[run] + k - self.run_start[run], 0)
            pos[:active] = np.where(found, (p - 1) % self.n, self.sample_first[0])
            length[:active] = ell
            out[at] = ell
        return out
