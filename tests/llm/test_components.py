import random

import pytest

from weftline.llm.components import components


def test_against_union_find(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(120), rnd.randrange(120)) for _ in range(70)] + [(200 + i, 201 + i) for i in range(40)] + [(300, 300 + i) for i in range(1, 50)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            u, v = top(a), top(b)
            parent[max(u, v)] = min(u, v)
    want = {(x, top(x)) for x in list(parent)}
    assert {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == want


def test_none_and_too_few_rounds(spark):
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []
    with pytest.raises(RuntimeError):
        components(spark.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long"), rounds=1)


def test_edges_added_later(spark):
    from weftline.llm.components import joined

    first, second = [(1, 2), (2, 3), (10, 11), (20, 21)], [(3, 11), (30, 31), (5, 31), (1, 3), (7, 7)]
    df = lambda e: spark.createDataFrame(e, "a long, b long")
    got = {tuple(r) for r in joined(components(df(first)), df(second)).collect()}
    assert got == {tuple(r) for r in components(df(first + second)).collect()}
