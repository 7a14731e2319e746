from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10_000, None, None, "s", None), (10_001, "", "en", None, 0), (10_002, docs.first().text, "en", "s", 1)], docs.schema)
    docs, seen = docs.unionByName(extra), {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
            rows = out.collect()
            assert {r.doc_id for r in rows} <= set(before) and len({r.doc_id for r in rows}) == len(rows)
            assert all(r.n_chars is None or r.n_chars == len(r.text) for r in rows if name in ("line_dedup", "suffix_dedup"))
            seen[name] = {r.doc_id: r.text for r in rows}
            out = spark.createDataFrame(rows, docs.schema)
        docs = out
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i, t in labels.items() if t == 0]
    assert sum(i in seen["toxicity"] for i in clean) >= 0.9 * len(clean)
    assert len(seen["suffix_dedup"]) >= 150
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == set(seen["suffix_dedup"])


def test_run_gives_what_the_stages_give(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_stages_on_an_empty_table_repeated_ids_ties_and_more_columns(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(900_001, "one and the same text of a few words", "en", "s", 1)] * 3 + [(900_001, "another text under that id, quite unlike", "en", "s", 2), (None, "x", "en", "s", 1), (None, None, None, None, None)], base.schema)
    for docs in (base.limit(0), odd.withColumns({"part": F.lit(1), "template": F.lit("x"), "sig": F.lit(2.0)})):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            assert name == "packing" or docs.columns == base.columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
            assert docs.count() <= n
        assert docs.count() == (0 if n == 0 else docs.select("doc_id", "ids_crc32").count())
        if n:
            assert {r.doc_id for r in docs.collect()} == {900_001, None}


def test_near_duplicates_go_row_by_row(spark):
    t, u, v = (" ".join(f"{w}{i}" for i in range(30)) for w in ("alpha", "beta", "gamma"))
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    for rows, want in (
        ([(1, t), (None, t), (None, u)], [(1, t), (None, u)]),
        ([(1, t), (5, t), (5, u)], [(1, t), (5, u)]),
        ([(None, t), (None, t), (2, None), (2, ""), (2, None)], [(None, t), (2, None), (2, ""), (2, None)]),
        ([(3, v + " end"), (3, v), (3, u), (4, v)], [(3, v), (3, u)]),
    ):
        docs = spark.createDataFrame([(i, x, "en", "s", len(x or "")) for i, x in rows], kind).repartition(3)
        out = corpus_pipeline.near_dedup(spark, docs, SF)
        assert out.columns == docs.columns
        assert sorted(map(str, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(str, want))


def test_one_null_id_leaves_the_plan_without_python_rows(spark):
    from weftline.llm.shared import ordered

    docs = spark.range(50).selectExpr("if(id = 7, null, id) as doc_id", "cast(id as string) as text")
    rows = ordered(docs)
    assert sorted(r.order_key for r in rows.collect()) == list(range(50)) and rows.where("doc_id is null").first().order_key == 49
    assert "Python" not in rows._jdf.queryExecution().toString()
