import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from weftline.llm.backoff import ALPHA, score_documents


def brute(rows):
    pairs, first, single, n = Counter(), Counter(), Counter(), 0
    own = defaultdict(Counter)
    for i, t in rows:
        words = [None] + re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        for u, w in zip(words, words[1:]):
            pairs[u, w] += 1
            first[u] += 1
            single[w] += 1
            own[i][u, w] += 1
            n += 1
    out = {}
    for i in {i for i, _ in rows}:
        s, k = 0.0, 0
        for (u, w), m in own[i].items():
            c = pairs[u, w] - m
            s += m * math.log(c / first[u] if c else ALPHA * single[w] / n)
            k += m
        out[i] = (k, s)
    return out


def check(spark, df):
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    got = score_documents(df).collect()
    assert len(got) == len(want)
    for r in got:
        n, s = want[r.doc_id]
        assert r.n_tokens == n and math.isclose(r.log_score, s, rel_tol=1e-9, abs_tol=1e-9)
        assert (r.mean_log_score is None) == (n == 0)


def test_table_of_documents(spark):
    check(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").repartition(5))


def test_small_vocabulary_and_edges(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choices([f"w{k}" for k in range(40)], k=rnd.randrange(0, 60)))) for i in range(300)]
    rows += [(None, "w1 w2"), (None, "solo"), (3, "w1 w2 w3"), (900, None), (901, ""), (902, " \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("x")).withColumn("n", F.lit(1))
    check(spark, df)
    assert score_documents(df.limit(0)).count() == 0
    assert score_documents(df.where("doc_id = 900")).first().log_score == 0


def test_a_word_that_follows_everything(spark):
    """A hot second word after contexts of one document each is scored where the pair is."""
    rows = [(i, f"only{i} the other{i} the tail{i}") for i in range(200)] + [(500, "the " * 5000)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"))
