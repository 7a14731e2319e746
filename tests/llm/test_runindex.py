import random

import numpy as np

from weftline.llm.runindex import RunLengthIndex


def test_matching_statistics_against_scan():
    rnd = random.Random(3)
    for case in range(30):
        alphabet = rnd.choice(["ab", "abc", "abcdefgh\x00\xf4"])
        pieces = ["".join(rnd.choices(alphabet, k=rnd.randrange(1, 60))) for _ in range(rnd.randrange(1, 6))]
        if case % 3 == 0:
            pieces.append("ab" * 40)
        patterns = ["".join(rnd.choices(alphabet + "z", k=rnd.randrange(1, 50))) for _ in range(5)] + [pieces[0], pieces[-1][3:] + pieces[0]]
        classes = [rnd.randrange(3) for _ in pieces]
        symbols = np.concatenate([np.append(np.frombuffer(p.encode("latin1"), np.uint8) + 1, 0).astype(np.uint8) for p in pieces])
        of_symbol = np.repeat(classes, [len(p) + 1 for p in pieces])
        flat = np.concatenate([np.frombuffer(p.encode("latin1"), np.uint8) + 1 for p in patterns]).astype(np.uint8)
        lengths = np.array([len(p) for p in patterns])
        starts = np.cumsum(lengths) - lengths
        own = np.array([rnd.randrange(3) for _ in patterns])
        got = RunLengthIndex(symbols, of_symbol).matching_statistics(flat, own, starts, lengths)
        for p, s, c in zip(patterns, starts, own, strict=True):
            for i in range(len(p)):
                want = max(n for n in range(len(p) - i + 1) if n == 0 or any(p[i : i + n] in q for q, k in zip(pieces, classes, strict=True) if k == c))
                assert got[s + i] == want
