import random
import re

import pytest
from pyspark.sql import functions as F

from weftline.llm.minhash import least_shared, near_duplicates


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute(rows, percent):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        r = find(k)
        low[r] = min(low.get(r, i), i)
    return {(i, len(s), low[find(k)], i == low[find(k)]) for k, (i, s) in enumerate(sets)}


def result(spark, rows, percent):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sig", F.lit(1)).withColumn("value", F.lit("x"))
    return {tuple(r) for r in near_duplicates(df, percent=percent).collect()}


def test_against_all_pairs(spark):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "x y", "Zz"]
    rows = []
    for g in range(12):
        words = rnd.choices(vocabulary, k=rnd.choice([3, 5, 12, 40, 90]))
        for _ in range(rnd.choice([1, 2, 9])):
            copy = list(words)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append((len(rows) * 7 % 1009, " ".join(copy) if g % 2 else "\n".join(copy).upper()))
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "One"), (5004, "one "), (5005, "one two"), (5006, "\U0001f600 b c d e f")]
    for percent in (80, 85):
        assert result(spark, rows, percent) == brute(rows, percent)


def test_table_of_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert {tuple(r) for r in near_duplicates(df, percent=85).collect()} == brute(rows, 85)


def test_large_group_of_near_copies(spark):
    rnd = random.Random(9)
    words = [f"k{i}" for i in range(70)]
    rows = []
    for i in range(260):
        copy = list(words)
        copy[rnd.randrange(70)] = f"edit{i}"
        rows.append((i, " ".join(copy)))
    rnd.shuffle(rows)
    assert result(spark, rows, 85) == brute(rows, 85)


def test_edges(spark):
    assert result(spark, [], 85) == set()
    got = result(spark, [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, None)], 85)
    assert got == {(None, 2, 3, False), (3, 2, 3, True), (4, 0, 4, True)}


@pytest.mark.parametrize("n", [1, 5, 30, 48, 1000])
def test_bound_is_at_most_what_small_sets_share(n):
    assert 1 <= least_shared(n, 48, 85) <= max(1, -(-n * 85 // 100))


def test_floor_of_estimates_keeps_pairs_at_the_threshold():
    import math

    from weftline.llm.minhash import _floor

    for k in (16, 48, 128):
        for percent in (50, 80, 85, 95):
            t = percent / 100
            under = lambda m: sum(math.comb(k, i) * t**i * (1 - t) ** (k - i) for i in range(m))
            floor = _floor(k, percent)
            assert under(sum(m / k < floor for m in range(k + 1))) < 1e-7
            assert floor < t and under(sum(m / k <= floor for m in range(k + 1))) >= 1e-7


def test_many_texts_under_one_id(spark):
    words = [[f"w{g}x{i}" for i in range(40)] for g in range(60)]
    rows = [(None if g % 2 else 7, " ".join(w + [f"end{c}"])) for g, w in enumerate(words) for c in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(df, percent=80).collect()
    assert len(got) == 120 and all(r.component_id == r.doc_id for r in got)
