import sqlite3

import pytest
from pyspark.sql import functions as F

from weftline.functions import html as H
from weftline.functions import lexicon as L
from weftline.functions import text as T
from weftline.operators import extract as X
from weftline.operators import records as R
from weftline.operators import search as S
from weftline.sources import crawl as C
from weftline.sources.store import COLUMNS, Store, export_csv
from weftline.streaming.ingest import ingest_manifests

ARTICLE = """<html><head><title>页</title></head><body><div class="nav">导航</div><h1 class="title">学长分享：我的求职之路</h1>
<div class="content"><p>本人是软件工程专业<strong>2025</strong>届本科毕业生，大四在读。</p><script>x()</script>
<p>毕业后到北京工作，签约某某科技有限公司。</p><p>担任算法工程师。</p></div></body></html>"""


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def rows(spark, data, names):
    return spark.createDataFrame(data, names)


def test_seven_fields_of_an_article(spark):
    root = H.parse(ARTICLE)
    df = rows(spark, [(H.title_of(root), H.text_of(root))], "title string, text string")
    r = X.extract(df, "title", "text", L.load()).first()
    assert [r[f] for f in T.CORE_FIELDS] == ["2025", "大四", "本科", "软件工程", "北京", "某某科技有限公司", "算法工程师"]
    assert r.extract_method == "rule" and "graduation_year=2025 ← " in r.evidence


def test_city_inside_a_name_is_no_city(spark):
    df = rows(spark, [("", "毕业于上海大学，现居上海。"), ("", "杭州银行"), ("", "")], "title string, text string")
    assert [r.city for r in X.extract(df, "title", "text", L.load()).collect()] == ["上海", T.MISSING, T.MISSING]


def test_position_needs_a_cue_and_sheds_the_company(spark):
    df = rows(spark, [("", "现任北京满分进出口贸易有限公司总经理"), ("", "教师资格培训")], "title string, text string")
    got = X.extract(df, "title", "text", L.load()).collect()
    assert got[0].position == "总经理" and got[0].employer == "北京满分进出口贸易有限公司"
    assert got[1].position == T.MISSING


def test_strip_location(spark):
    for raw, want in (("在北京的某某公司", "某某公司"), ("北京满分公司", "北京满分公司"), ("的A", "的A"), ("了在于某社", "某社")):
        assert one(spark, X.strip_location(F.lit(raw), ["北京", "上海"])) == want


def test_later_sources_win_and_the_method_is_named(spark):
    hit = "struct<" + ",".join(f"{f}:{X.HIT}" for f in T.CORE_FIELDS) + ">"
    blank = {f: None for f in T.CORE_FIELDS}
    df = rows(spark, [(blank | {"city": ("北京", "在北京")}, blank | {"major": ("法学", "学法学")}), (blank, blank)], f"a {hit}, b {hit}")
    got = X.merge_hits(df, ["a", "b"], ["rule", "llm"]).collect()
    assert (got[0].extract_method, got[0].city, got[0].major, got[0].evidence) == ("hybrid", "北京", "法学", "major=法学 ← 学法学 | city=北京 ← 在北京")
    assert (got[1].extract_method, got[1].evidence, got[1].grade) == ("none", "", T.MISSING)


@pytest.mark.parametrize("raw", [None, "", "  ", "-", "N/A", "无", "未知", " null "])
def test_missing_values_fold(spark, raw):
    assert one(spark, T.fold_missing(F.lit(raw).cast("string"))) == T.MISSING


def test_normalize_agrees_with_its_scalar_twin(spark):
    for t in ("　Ａｂ１！（）  x\n\n \ty ​z", "", " \n "):
        assert one(spark, T.normalize(F.lit(t))) == H.normalized(t)


def test_segments(spark):
    for text, want in (("a\nb", ("a", "a b", "")), ("a\nb\nc", ("a b", "a b c", "c")), ("a\n\nb\nc\nd", ("a b", "c", "d")), ("", ("", "", ""))):
        s = one(spark, T.segments(F.lit("t"), F.lit(text)))
        assert (s.meta, s.body, s.tail, s.headline, s.raw) == (*want, "t", text)


def test_links_images_and_dates_of_a_page():
    page = '<ul><li class="item"><a href="/a?id=1" title="T">x</a><span>2025年6月1日</span></li><li><a href="javascript:x">n</a><a href="/login">l</a></li></ul><img src="i/1.png"><img src="data:x"><img src="logo.png"><img src="i/1.png">'
    root = H.parse(page)
    assert H.links_of(root, "https://h/p/") == [{"url": "https://h/a?id=1", "title": "T", "publish_date": "2025-06-01"}]
    assert H.images_of(root, "https://h/p/") == ["https://h/p/i/1.png"]


def test_manifest_lines(spark):
    lines = ['{"detail_url":"u1","title":"old"}', "", "broken", '{"title":"no url"}', '{"detail_url":"u2","images":[{"sha1":"abc"}]}', '{"detail_url":"u1","title":"new"}']
    got = C.manifest_entries(rows(spark, list(enumerate(lines)), "line_no long, value string")).orderBy("first_no").collect()
    assert [(r.detail_url, r.title) for r in got] == [("u1", "new"), ("u2", None)] and got[1].images[0].sha1 == "abc"


def test_record_arrays_and_templates():
    assert C.records_of({"datas": {"tables": [{"a": 1}]}})[1] == "datas.tables"
    assert C.records_of({"x": {"y": {"z": [{"a": 1}]}}})[1] == "x.y.z"
    assert C.records_of({"x": {"y": {"z": {"w": [{"a": 1}]}}}}) == (None, "")
    assert C.dig({"a": [{"b": 2}]}, "a.0.b") == 2 and C.dig({"a": 1}, "a.b", "d") == "d"
    assert C.fill_template("u/{a.b}/{c}", {"a.b": "1", "c": "2"}) == "u/1/2" and C.fill_template("u/{c}", {}) == ""
    payload = '{"data":{"records":[{"notice_id":7,"notice_title":"T","notice_release_time":"2025-6-1 10:00","notice_link":"https://e","notice_link_state":1},{"title":"x"}]}}'
    refs = C.refs_of(payload, "L", "https://h/{notice_id}")
    assert refs == [{"detail_url": "https://h/7", "list_url": "L", "title": "T", "publish_date": "2025-06-01", "content_url": "https://e"}]
    assert C.refs_of(payload, "L", "https://h/{notice_id}", policy="skip") == []


def test_paging():
    assert C.page_url("https://h/list?x=1", 3) == "https://h/list?x=1&page=3" and C.page_url("https://h/{page}", 2) == "https://h/2"
    q = C.api_query({"pageSize": 15, "start": 0, "end": 15, "all": False, "n": None}, 2)
    assert (q["start"], q["end"], q["all"], q["n"], q["currentPage"]) == ("15", "30", "false", "", "2")
    pages = {1: [{"detail_url": "a"}, {"detail_url": "b"}], 3: [{"detail_url": "b"}, {"detail_url": "c"}], 4: []}
    assert [r["detail_url"] for r in C.all_refs(pages.__getitem__)] == ["a", "b", "c"]
    now = iter([0.0, 0.5, 2.0])
    t, slept = C.Throttle(2.0, lambda: next(now), lambda s: slept.append(s)), []
    assert (t.wait(), t.wait(), slept) == (0.0, 1.5, [1.5])
    tries = []
    with pytest.raises(ValueError):
        C.with_retries(lambda: tries.append(1) or int("x"), 2)
    assert len(tries) == 3


def article(**more):
    base = dict.fromkeys(COLUMNS, "") | {f: f"v-{f}" for f in T.CORE_FIELDS}
    return base | {"source_url": "https://a", "raw_html_path": "p", "crawl_time": "2025-01-01", "graduation_year": "2025", "content_kind": "html"} | more


def articles(spark, *records):
    return rows(spark, [tuple(r[c] for c in COLUMNS) for r in records], ", ".join(f"{c} string" for c in COLUMNS))


def test_upsert_is_idempotent_and_versions_count(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    df = articles(spark, article(), article(source_url="https://b"), article(crawl_time="2025-02-02", city="新"))
    assert store.upsert(df) == 1 and store.upsert(df) == 2 and store.version == 2
    got = {r.source_url: r.city for r in store.read().collect()}
    assert got == {"https://a": "新", "https://b": "v-city"}
    refs = rows(spark, [("https://a",), ("https://c",)], "detail_url string")
    assert [r.detail_url for r in store.fresh(refs).collect()] == ["https://c"]


def test_validation_rules(spark):
    df = articles(spark, article(), article(graduation_year="1980"), article(graduation_year="25"), article(source_url="x", city=T.MISSING), article(raw_html_path=" ", content_kind="ocr"))
    found = R.verdict(df.withColumn("issues", R.issues(["source_url", "raw_html_path", "crawl_time"], {"degree": ["v-degree"]}, 2026))).collect()
    assert [(r.ok, r.needs_review) for r in found] == [(True, False), (False, True), (False, True), (False, True), (False, True)]
    assert [(i.code, i.field) for i in found[3].issues] == [("FIELD_INVALID", "source_url"), ("EXTRACT_INCOMPLETE", "city")]


def test_status_update_checks_its_value(spark):
    df = articles(spark, article())
    assert R.with_status(df, F.lit(True), "approved").first().review_status == "approved"
    with pytest.raises(ValueError):
        R.with_status(df, F.lit(True), "fine")


def test_sample_is_seeded():
    import random

    assert R.sample_indices(100, 0.1, 42) == random.Random(42).sample(range(100), 10)
    assert R.sample_indices(3, 0.01, 1) and R.sample_indices(0, 0.5, 1) == [] and R.sample_indices(5, 0, 1) == []


def test_csv_has_a_mark_and_columns_in_order(spark, tmp_path):
    export_csv(articles(spark, article(city='a"b,c')), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*.csv")
    lines = part.read_bytes().decode("utf-8").splitlines()
    assert lines[0].startswith("﻿article_key,graduation_year") and '"a""b,c"' in lines[1]


def test_bm25_equals_fts5(spark):
    texts = ["the cat sat", "a cat and a cat here", "dogs run", "the cat the cat the dog", "bird", "fish swims far", "Café cats"]
    db = sqlite3.connect(":memory:")
    db.execute("CREATE VIRTUAL TABLE t USING fts5(x)")
    db.executemany("INSERT INTO t(rowid, x) VALUES (?, ?)", list(enumerate(texts)))
    docs = rows(spark, list(enumerate(texts)), "id long, x string")
    for match, phrases in (('"cat"', [["cat"]]), ('"the cat"', [["the", "cat"]]), ('"cat" AND "dog"', [["cat"], ["dog"]]), ('"cafe"', [["cafe"]])):
        want = dict(db.execute("SELECT rowid, bm25(t) FROM t WHERE t MATCH ?", (match,)).fetchall())
        got = {r.id: r.score for r in S.bm25(docs, "id", "x", phrases).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_search_paths(spark):
    df = articles(spark, article(article_key="1", article_title="甲 北京硕士", city="北京"), article(article_key="2", article_title="校园招聘会公告", source_url="https://b"))
    keys = lambda q: [r.article_key for r in S.search(df, q).collect()]
    assert keys(S.Query(("北京",))) == ["1"]
    hit = S.search(df, S.Query(("招聘",), raw_text="招聘")).collect()
    assert [(r.article_key, r.score) for r in hit] == [("2", 0.0)]
    assert keys(S.Query((), {"city": "北京"})) == ["1"] and len(keys(S.Query())) == 2
    assert keys(S.Query(("nothing",))) == []


def test_query_tokens_snippets_and_cache(spark):
    assert one(spark, S.query_tokens(F.lit("就业、招聘；选调 的 就业"))) == ["就业", "招聘", "选调"]
    assert one(spark, S.snippet(F.lit("a<script>招聘会"), ["招聘"])) == "a&lt;script&gt;<em>招聘</em>会"
    assert one(spark, S.keyword_candidates(F.lit("“职”点迷津"))) == ["点迷津", "迷津", "职"]
    cache = S.ResultCache(2)
    for k in "ab":
        cache.put(k, k)
    assert cache.get("a") == "a"
    cache.put("c", "c")
    assert cache.get("b") is None and (cache.hits, cache.misses) == (1, 1)
    a, b = S.Query(("x", "y"), {"m": "1"}), S.Query(("y", "x"), {"m": "1", "n": " "})
    assert a.key(1) == b.key(1) != a.key(2)
    assert S.fetch_estimate(0, a, 2, 2.0) == {"requests": 31, "seconds": 62.0, "allowed": False, "blocked": "disabled"}
    assert S.fetch_estimate(20, a, 2, 2.0) is None


def test_streaming_upserts(spark, tmp_path):
    source, store = tmp_path / "in", Store(spark, str(tmp_path / "store"))
    source.mkdir()

    def records_of(entries):
        return entries.select(F.col("detail_url").alias("source_url"), F.col("title").alias("article_title"), "crawl_time")

    for i, line in enumerate(('{"detail_url":"u","title":"one","crawl_time":"1"}', '{"detail_url":"u","title":"two","crawl_time":"2"}')):
        (source / f"{i}.jsonl").write_text(line)
        ingest_manifests(spark, str(source), store, records_of, str(tmp_path / "ckpt")).awaitTermination()
    assert [(r.source_url, r.article_title) for r in store.read().collect()] == [("u", "two")]
    assert store.version == 2


def test_row_numbers_without_the_driver(spark):
    import random

    from weftline.operators.numbering import numbered

    df = spark.range(1_000_000).selectExpr("(id * 7919) % 1000003 as k", "id % 3 as t")
    rows = numbered(df, ["k"], "n")
    assert rows.selectExpr("min(n)", "max(n)", "count(distinct n)").first() == (0, 999_999, 1_000_000)
    assert rows.alias("a").join(rows.alias("b"), F.expr("a.n + 1 = b.n")).where("a.k > b.k").count() == 0
    picked = {r.k for r in R.review_sample(df, ["k"], 0.0005, 42).select("k").collect()}
    by_rank = sorted((i * 7919) % 1000003 for i in range(1_000_000))
    assert picked == {by_rank[i] for i in random.Random(42).sample(range(1_000_000), 500)}
    assert numbered(df.limit(0), ["k"]).count() == 0 and R.review_sample(df.limit(0), ["k"], 0.5, 1).count() == 0


def test_archive_replay_takes_the_first_page_of_a_path(spark, tmp_path):
    from weftline.plans import registry

    # Later pages come first in the table, in many partitions.
    rows = spark.range(60).select((99 - F.col("id")).alias("page_id"), F.concat(F.lit("https://x/"), F.col("id") % 3).alias("url"), F.repeat(F.lit("h"), (4100 - F.col("id")).cast("int")).alias("html"))
    rows.unionByName(spark.createDataFrame([(1, "https://x/0", "short"), (2, None, "h" * 5000), (3, "https://x/9", None)], "page_id long, url string, html string")).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.archived, r.n) for r in registry.queries()["archive_replay"](spark, str(tmp_path)).collect()}
    assert len(got) == 63 and got[1] == (True, 4100 - 57) and got[2] == got[3] == (False, None)
    assert all(got[99 - i] == (True, 4100 - 57 - i % 3) for i in range(60))
