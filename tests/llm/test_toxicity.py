import random

import numpy as np
from pyspark.sql import functions as F

from weftline.llm.toxicity import maximal_passages, op1_toxicity, toxic_passages, train


def brute(w, lo, hi):
    """The best run, shortest and leftmost, then the same to its left and right."""
    best = None
    for a in range(lo, hi):
        for b in range(a + 1, hi + 1):
            s = sum(w[a:b])
            if s > 0 and (best is None or (s, -(b - a)) > (best[2], -(best[1] - best[0]))):
                best = (a, b, s)
    if best is None:
        return []
    return brute(w, lo, best[0]) + [best] + brute(w, best[1], hi)


def test_maximal_passages_against_definition():
    rnd = random.Random(6)
    for _ in range(300):
        w = [rnd.randrange(-40, 30) + rnd.random() for _ in range(rnd.randrange(0, 22))]
        got = maximal_passages(np.array(w))
        want = brute(w, 0, len(w))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = op1_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in rows}
    assert n[1, 1] >= 0.9 * (n[1, 1] + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.02 * n[0, 0]


def test_edges(spark):
    rows = [(1, "you vile rat and more words"), (2, None), (3, ""), (4, "123 456"), (4, "calm words here"), (None, "vile")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    many = spark.createDataFrame([(i, ("vile rat " if i % 5 == 0 else "fine day ") + f"word{i % 7} and text") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(0, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    model = train(many, labels)
    got = toxic_passages(docs, model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert {r.doc_id for r in got if r.predicted} == {1, None}
    first = next(r for r in got if r.doc_id == 1).passages[0]
    assert rows[0][1][first["start"] : first["end"]] == "vile rat"
    assert toxic_passages(docs.limit(0), model).count() == 0
    empty = train(many.limit(0), labels.limit(0))
    assert len(toxic_passages(docs, empty).collect()) == 6


def test_scores_do_not_depend_on_neighbours(spark):
    many = spark.createDataFrame([(i, ("vile rat " if i % 5 == 0 else "fine day ") + f"word{i % 7} and text") for i in range(400)], "doc_id long, text string")
    model = train(many, spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id long, toxic int"))
    texts = ["vile", "vile rat", "rat", "fine day", "", "vile vile", "vile " * 30_000 + "rat"]
    alone = {t: toxic_passages(spark.createDataFrame([(1, t)], "doc_id long, text string"), model).first().score for t in texts}
    rnd = random.Random(3)
    for parts in (1, 3):
        rows = [(i, t) for i, t in enumerate(rnd.choices(texts, k=60) + ["vile"] * 20)]
        got = toxic_passages(spark.createDataFrame(rows, "doc_id long, text string").coalesce(parts), model).collect()
        assert {(r.doc_id, r.score) for r in got} == {(i, alone[t]) for i, t in rows}
