import random
import re
import zlib
from collections import Counter

import numpy as np

from pyspark.sql import functions as F

from weftline.llm.variants import crc32_after, near_words, spelling_variants, variant_groups

RUN = re.compile("[A-Za-zÀ-ÿ]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows, noise=199):
    out = Counter()
    for i, t in rows:
        for run in RUN.findall(t or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def grouped(words, ratio=5):
    out = {}
    for w, n in words.items():
        near = [x for x in words if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        out[w] = (best if best and words[best] >= ratio * n else None, n, len(near))
    rows = []
    for w, (form, n, near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, near, words[form] if form else None))
    return sorted(rows)


def check(spark, rows, noise=199):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, spelling_variants(df, noise=noise).collect())) == grouped(counted(rows, noise))


def edits(word, rnd):
    i = rnd.randrange(len(word) + 1)
    letter = rnd.choice("abcéÿ×")
    return rnd.choice([word[:i] + word[i + 1 :], word[:i] + letter + word[i:], word[:i] + letter + word[i + 1 :]])


def test_variants_against_brute_force(spark):
    rnd = random.Random(12)
    roots = ["strand", "strange", "Éternité", "abababab", "aaaaaaa", "verstehen", "canción", "éèéèéè"]
    pool = roots * 40
    for r in roots:
        for _ in range(6):
            pool += [edits(r, rnd)] * rnd.choice([1, 4, 5, 6])
        pool += [edits(edits(r, rnd), rnd)] * 5
    rnd.shuffle(pool)
    rows = [(i * 20, " ".join(pool[i * 9 : i * 9 + 9])) for i in range(len(pool) // 9 + 1)]
    check(spark, rows)
    check(spark, rows, noise=3)
    check(spark, rows, noise=None)


def test_chains_of_forms_lead_to_the_last(spark):
    words = {"abcdefgh": 5, "abcdefg": 25, "abcdef": 125, "abcdeg": 5, "abcdefghi": 1, "zzzzzzz": 7}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert sorted(map(tuple, variant_groups(df).collect())) == grouped(words)


def test_a_hot_segment_is_dealt_and_loses_nothing(spark):
    words = {f"common{a}{b}": 5 for a in "abcdefgh" for b in "abcdefgh"} | {f"common{a}": 30 for a in "abcdefgh"}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    expected = {(a, b) for a in words for b in words if one_edit(a, b)}
    got = near_words(df, salted=4).select("word", "near").collect()
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected


def test_variants_of_odd_tables(spark):
    check(spark, [])
    check(spark, [(1, None), (2, ""), (None, "längere längere Längere längere längere"), (None, "längere")])
    check(spark, [(7, "repeated variant " * 3)] * 4 + [(8, "x" * 300_000 + " " + "variant " * 40_000 + "variants " * 5)])
    rows = [(i, "fields fieldes fields") for i in range(9)]
    odd = spark.createDataFrame(rows, "doc_id long, text string").select("*", *(F.lit(1).alias(c) for c in ("word", "n", "near", "form", "salt", "segment")))
    assert sorted(map(tuple, spelling_variants(odd).collect())) == grouped(counted(rows))


def test_checksums():
    rnd = np.random.default_rng(1)
    buf = rnd.integers(0, 256, 5000).astype(np.uint8)
    start, size = rnd.integers(0, 4000, 300), np.concatenate([rnd.integers(0, 70, 295), [0, 64, 65, 800, 1000]])
    begun = np.array([zlib.crc32(f"{i}:".encode()) for i in range(300)], np.uint32)
    want = [zlib.crc32(f"{i}:".encode() + buf[a : a + n].tobytes()) for i, (a, n) in enumerate(zip(start, size))]
    assert crc32_after(begun, buf, start, size).tolist() == want
