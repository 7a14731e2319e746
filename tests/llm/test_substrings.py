import hashlib
import random

from pyspark.sql import functions as F

from weftline.llm.substrings import remove_repeats


def brute(rows, length=100):
    """rows in corpus order."""
    seen, out = set(), []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            if w in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def result(spark, rows, fold=True):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("x")).withColumn("kept", F.lit(1))
    return [(r[0], r[1], r[2], r[3], r[4], bytes(r[5])) for r in remove_repeats(df, fold=fold).collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def check(spark, rows):
    assert sorted(map(str, result(spark, rows))) == sorted(map(str, brute(order(rows))))


def test_planted_passages(spark):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choices("abcdéß", k=rnd.randrange(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(40) for _ in range(6)] + ["x" * 350, "ab " * 90, text(400)]
    rows = []
    for i in range(120):
        parts = [text(rnd.randrange(0, 40))]
        for _ in range(rnd.randrange(0, 4)):
            p = rnd.choice(passages)
            a = rnd.randrange(0, len(p) // 2)
            parts += [p[a : a + rnd.randrange(60, 600)], text(rnd.randrange(0, 6))]
        rows.append((rnd.randrange(10**6), " ".join(parts)))
    rows += [(7, None), (8, ""), (9, "x" * 99), (10, "x" * 100), (11, "x" * 101), (12, "ab" * 3000)]
    rows += [(i + 2_000_000, t) for i, t in rows[:10]]
    rows = list(dict(rows).items())
    check(spark, rows)
    # The index by itself finds what folding finds.
    assert sorted(map(str, result(spark, rows, fold=False))) == sorted(map(str, brute(order(rows))))


def test_near_copies(spark):
    rnd = random.Random(12)
    words = [f"w{rnd.randrange(10**5)}" for _ in range(150)]
    rows = []
    for i in range(60):
        copy = list(words)
        for _ in range(rnd.randrange(5)):
            copy[rnd.randrange(150)] = f"e{rnd.randrange(50)}"
        rows.append((i * 13 % 61, " ".join(copy)))
    check(spark, rows)


def test_edges(spark):
    assert result(spark, []) == []
    long = "the same passage again and again " * 5
    check(spark, [(None, long), (None, long + "x"), (5, long), (5, long), (5, "other"), (4, None)])


def test_long_text(spark):
    rnd = random.Random(13)
    a = "".join(rnd.choices("abcdef ", k=700_000))
    check(spark, [(1, a), (2, a[300_000:620_000] + "!" + a[:1000])])


def test_table_of_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    check(spark, rows)


def test_one_group_in_several_indexes():
    from weftline.llm import substrings

    rnd = random.Random(5)
    core = "".join(rnd.choices("abcd", k=60))
    pieces = [("".join(rnd.choices("ab", k=rnd.randrange(40, 44))) + core + "".join(rnd.choices("ab", k=30))).encode() for _ in range(60)]
    seen, expected = set(), []
    for p in pieces:
        windows = [p[k : k + 100] for k in range(len(p) - 99)]
        expected.append([w in seen for w in windows])
        seen |= set(windows)
    pieces += pieces[:10]
    expected += [[True] * (len(p) - 99) for p in pieces[:10]]
    import numpy as np

    held, substrings._INDEXED, streamed, substrings._STREAMED = substrings._INDEXED, 500, substrings._STREAMED, 3
    try:
        marks = substrings.repeated_windows(np.zeros(len(pieces), np.int64), pieces, 100)
    finally:
        substrings._INDEXED, substrings._STREAMED = held, streamed
    assert [m.tolist() for m in marks] == expected


def test_text_is_made_where_the_bytes_are(spark):
    rnd = random.Random(5)
    long = "".join(rnd.choice("abcdefé€") for _ in range(400))
    rows = [(1, long), (2, "€" + long[3:] + "tail"), (3, None), (4, ""), (5, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("x"))
    cut = remove_repeats(df, as_text=True, carry=("lang",))
    assert {r.doc_id: r.text for r in cut.collect()} == {i: kept.decode("utf-8", "ignore") for i, _, _, _, _, kept in brute(rows)}
    assert cut.schema["text"].dataType.simpleString() == "string" and cut.columns[-1] == "lang"
    # One Python worker for each task of the last stage, not one for the bytes and one for the text.
    from corpus_pipeline import suffix_dedup

    docs = df.select("doc_id", "text", "lang", F.lit("s").alias("source"), F.lit(0).cast("long").alias("n_chars"))
    plan = suffix_dedup(spark, docs, "")._jdf.queryExecution().optimizedPlan().toString()
    last = plan[: plan.index("FlatMapCoGroupsInArrow")]
    assert "MapInArrow" not in last
