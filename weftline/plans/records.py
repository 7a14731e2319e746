"""Record, statistics and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import records as R
from weftline.plans.common import FIELDS, LABELLED_SQL, labelled, table
from weftline.sources.store import projected


def dedup_keep_first(spark, d):
    return R.keep_first(table(spark, d, "events"), "event_type", [F.col("ts"), F.col("event_id")]).select("event_type", "event_id")


def manifest_last_wins(spark, d):
    return R.keep_last(table(spark, d, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id", "value")


def upsert_by_key(spark, d):
    o = table(spark, d, "orders")
    new = o.where("o_orderstatus = 'F'").select("o_orderkey", F.lit("new").alias("status"))
    return R.upsert(o.select("o_orderkey", F.lit("old").alias("status")), new, "o_orderkey")


def review_update(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.lit("pending").alias("review_status"), "o_orderstatus")
    return R.with_status(o, F.col("o_orderstatus") == "F", "approved").select("o_orderkey", "review_status")


def existing_urls(spark, d):
    return R.distinct_values(table(spark, d, "pages"), "url")


def manual_review_rows(spark, d):
    rows = labelled(spark, d).withColumn("unknown", R.unknown_fields(FIELDS))
    return rows.where(F.size("unknown") > 0).select("doc_id", F.array_join("unknown", ",").alias("unknown"))


def completeness(spark, d):
    return R.completeness(labelled(spark, d), FIELDS)


def unknown_counts(spark, d):
    return R.unknown_totals(labelled(spark, d), FIELDS)


def method_distribution(spark, d):
    return R.distribution(table(spark, d, "orders"), "o_orderstatus", ["F", "O", "P", "rule", "none"], "none")


def field_source(spark, d):
    o = table(spark, d, "orders").withColumn("method", F.when(F.col("o_orderstatus") == "F", "rule").when(F.col("o_orderstatus") == "O", "llm").otherwise("hybrid"))
    o = o.withColumn("urgent", F.when(F.col("o_orderpriority").startswith("1"), "yes").otherwise("-"))
    return R.field_source(o, ["o_orderpriority", "urgent"], "method")


def facet_topn(spark, d):
    return R.facet_counts(table(spark, d, "part"), ["p_brand", "p_type", "p_size"], 5)


def related_terms(spark, d):
    return R.related(table(spark, d, "part"), ["p_brand", "p_type"], ["Brand#11"], 8)


def stage_counters(spark, d):
    return R.counters(table(spark, d, "events"), {"seen": F.lit(True), "high": F.col("value") > 50, "clicks": F.col("event_type") == "click"})


def hit_source(spark, d):
    """Hits of documents by field and method, one struct a field."""
    def hit(name, when, method):
        return F.when(when, F.struct(F.lit("v").alias("value"), F.lit(method).alias("method"))).alias(name)

    hits = F.struct(hit("lang", F.col("lang") == "en", "rule"), hit("source", F.col("n_chars") > 1000, "llm"))
    return R.hit_source(table(spark, d, "documents").select(hits.alias("hits")), "hits", ["lang", "source"])


def report_cards(spark, d):
    rows = labelled(spark, d).withColumn("article_key", F.col("doc_id").cast("string"))
    entries = table(spark, d, "pages").select(
        F.col("page_id").cast("string").alias("article_key"),
        F.when(F.col("page_id") % 3 == 0, F.col("url")).alias("content_url"),
        F.when(F.length("html") > 4000, F.lit("p")).otherwise("").alias("html_path"),
        F.array_repeat(F.lit("i"), (F.col("page_id") % 4).cast("int")).alias("images"),
    )
    return R.report_cards(rows, entries, FIELDS)


def report_order(spark, d):
    return R.report_order(labelled(spark, d), FIELDS, "doc_id").select("doc_id", "hits")


def report_join(spark, d):
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left").select("c_custkey", "c_mktsegment", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), F.coalesce("total", F.lit(0.0)).alias("total"))


def _validated(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 7 == 0, "").otherwise(F.col("c_name")).alias("c_name"),
        (F.lit(1980) + F.col("c_custkey") % 60).cast("string").alias("graduation_year"),
        F.when(F.col("c_custkey") % 5 == 0, "ftp://x").otherwise("https://x").alias("source_url"),
        F.when(F.col("c_custkey") % 11 == 0, "n/a").otherwise(F.col("c_mktsegment")).alias("degree"),
        F.when(F.col("c_custkey") % 13 == 0, "ocr").otherwise("html").alias("content_kind"),
    )
    found = R.issues(["c_name"], {"degree": ["BUILDING", "MACHINERY"]}, 2026, ["degree"])
    return R.verdict(c.withColumn("issues", found))


def validation_issues(spark, d):
    return _validated(spark, d).select("c_custkey", F.explode("issues").alias("i")).select("c_custkey", "i.*")


def validation_summary(spark, d):
    return _validated(spark, d).groupBy("ok", "needs_review").agg(F.count("*").alias("n"))


_VALID_SQL = """WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_name END AS c_name, 1980 + c_custkey % 60 AS y, c_custkey % 5 = 0 AS bad_url, CASE WHEN c_custkey % 11 = 0 THEN 'n/a' ELSE c_mktsegment END AS degree, c_custkey % 13 = 0 AS ocr FROM customer),
 i AS (SELECT c_custkey, 'FIELD_INVALID' AS code, 'error' AS severity, 'c_name' AS field FROM c WHERE c_name = '' UNION ALL SELECT c_custkey, 'FIELD_OUT_OF_RANGE', 'error', 'graduation_year' FROM c WHERE y NOT BETWEEN 1990 AND 2027
 UNION ALL SELECT c_custkey, 'FIELD_INVALID', 'error', 'source_url' FROM c WHERE bad_url UNION ALL SELECT c_custkey, 'FIELD_INVALID', 'warning', 'degree' FROM c WHERE degree NOT IN ('n/a', 'BUILDING', 'MACHINERY')
 UNION ALL SELECT c_custkey, 'EXTRACT_INCOMPLETE', 'warning', 'degree' FROM c WHERE degree = 'n/a' UNION ALL SELECT c_custkey, 'OCR_NEEDS_REVIEW', 'warning', 'content_kind' FROM c WHERE ocr)"""


def review_sample(spark, d):
    """A fifth of a percent of the documents, picked by seed: sampling is the feature."""
    return R.review_sample(table(spark, d, "documents"), ["doc_id"], 0.002, 42).select("doc_id", "lang")


def scan_sorted(spark, d):
    return R.scan_order(table(spark, d, "orders"), "o_orderdate", "o_orderkey").limit(50).select("o_orderkey", "o_custkey")


def count_rows(spark, d):
    return table(spark, d, "orders").agg(F.count("*").alias("n"))


def row_projection(spark, d):
    return projected(table(spark, d, "labels"), ["doc_id", "quality", "absent"])


def union_dedup(spark, d):
    o = table(spark, d, "orders")
    both = o.where("o_orderstatus = 'F'").select(F.col("o_custkey").cast("string").alias("k"), F.lit(1).alias("side"), "o_orderkey").unionByName(o.where("o_totalprice > 100000").select(F.col("o_custkey").cast("string").alias("k"), F.lit(2).alias("side"), "o_orderkey"))
    return R.keep_first(both, "k", [F.col("side"), F.col("o_orderkey")])


def cross_page_dedup(spark, d):
    return R.keep_first(table(spark, d, "orders").select("o_orderpriority", "o_orderkey"), "o_orderpriority", [F.col("o_orderkey")])


def word_union(spark, d):
    p = table(spark, d, "part")
    return R.value_union(p.select("p_brand"), p.select("p_type"), "word")


def latest_row(spark, d):
    return R.latest(table(spark, d, "events"), ["ts", "event_id"]).select("event_id")


def completeness_text(spark, d):
    rows = labelled(spark, d).withColumn("quality", T.fold_missing(F.col("quality")))
    return rows.select("doc_id", T.completeness_text({"lang": "语言", "source": "来源", "quality": "质量"}).alias("text"))


def benchmark_times(spark, d):
    return R.times(table(spark, d, "events"), "event_type", "value")


_Q = f"trim(quality) = '-' OR trim(quality) = ''"
_FACETS = "SELECT {f} AS value, n FROM (SELECT CAST({c} AS VARCHAR) AS {f}, count(*) AS n FROM part GROUP BY 1 QUALIFY row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) <= {k})"


def _facet_sql(columns, k):
    return "SELECT value, CAST(sum(n) AS BIGINT) AS n FROM (" + " UNION ALL ".join(_FACETS.format(f=f"v{i}", c=c, k=k) for i, c in enumerate(columns)) + ") GROUP BY value"


QUERIES = {
    "dedup_keep_first": (dedup_keep_first, "SELECT event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) = 1"),
    "manifest_last_wins": (manifest_last_wins, "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"),
    "upsert_by_key": (upsert_by_key, "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'new' ELSE 'old' END AS status FROM orders"),
    "review_update": (review_update, "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'approved' ELSE 'pending' END AS review_status FROM orders"),
    "existing_urls": (existing_urls, "SELECT DISTINCT url FROM pages WHERE url <> ''"),
    "manual_review_rows": (manual_review_rows, f"SELECT doc_id, 'quality' AS unknown FROM {LABELLED_SQL} WHERE {_Q}"),
    "completeness": (completeness, f"SELECT round(avg(CAST(lang <> '' AS INT)), 4) AS lang, round(avg(CAST(source <> '' AS INT)), 4) AS source, round(avg(CASE WHEN {_Q} THEN 0.0 ELSE 1.0 END), 4) AS quality FROM {LABELLED_SQL}"),
    "unknown_counts": (unknown_counts, f"SELECT CAST(count(*) FILTER ({_Q}) AS BIGINT) AS unknown_total, CAST(count(*) FILTER (NOT ({_Q})) AS BIGINT) AS complete, CAST(count(*) FILTER ({_Q}) AS BIGINT) AS manual_review FROM {LABELLED_SQL}"),
    "method_distribution": (method_distribution, "SELECT value, count(o_orderkey) AS n FROM (VALUES ('F'), ('O'), ('P'), ('rule'), ('none')) t(value) LEFT JOIN orders ON o_orderstatus = value GROUP BY value"),
    "field_source": (field_source, "SELECT 'o_orderpriority' AS field, count(*) FILTER (o_orderstatus = 'F') AS rule, count(*) FILTER (o_orderstatus = 'O') AS llm FROM orders UNION ALL SELECT 'urgent', count(*) FILTER (o_orderstatus = 'F' AND o_orderpriority LIKE '1%'), count(*) FILTER (o_orderstatus = 'O' AND o_orderpriority LIKE '1%') FROM orders"),
    "facet_topn": (facet_topn, _facet_sql(["p_brand", "p_type", "p_size"], 5)),
    "related_terms": (related_terms, _facet_sql(["p_brand", "p_type"], 50).replace("GROUP BY value", "WHERE lower(value) <> 'brand#11' GROUP BY value ORDER BY n DESC, value LIMIT 8")),
    "stage_counters": (stage_counters, "SELECT count(*) AS seen, count(*) FILTER (value > 50) AS high, count(*) FILTER (event_type = 'click') AS clicks FROM events"),
    "hit_source": (hit_source, "SELECT 'lang' AS field, 'rule' AS method, count(*) AS n FROM documents WHERE lang = 'en' UNION ALL SELECT 'source', 'llm', count(*) FROM documents WHERE n_chars > 1000"),
    "report_cards": (report_cards, f"SELECT * FROM (SELECT count(*) AS total, count(*) FILTER (u) AS external, count(*) FILTER (NOT q) AS complete, count(*) FILTER (q) AS manual FROM (SELECT page_id IS NOT NULL AND page_id % 3 = 0 AND length(url) > 0 AS u, {_Q} AS q FROM {LABELLED_SQL} r LEFT JOIN pages ON page_id = doc_id)), (SELECT count(*) FILTER (length(html) > 4000) AS archived, CAST(sum(page_id % 4) AS BIGINT) AS images FROM pages)"),
    "report_order": (report_order, f"SELECT doc_id, CASE WHEN {_Q} THEN CAST(2 AS INT) ELSE CAST(3 AS INT) END AS hits FROM {LABELLED_SQL}"),
    "report_join": (report_join, "SELECT c_custkey, c_mktsegment, count(o_orderkey) AS n_orders, coalesce(round(sum(o_totalprice), 2), 0.0) AS total FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2"),
    "validation_issues": (validation_issues, f"{_VALID_SQL} SELECT * FROM i"),
    "validation_summary": (validation_summary, f"{_VALID_SQL}, s AS (SELECT c.c_custkey, NOT coalesce(bool_or(severity = 'error'), false) AS ok, coalesce(bool_or(severity = 'error' OR code IN ('EXTRACT_INCOMPLETE', 'OCR_NEEDS_REVIEW')), false) AS needs_review FROM c LEFT JOIN i USING (c_custkey) GROUP BY 1) SELECT ok, needs_review, count(*) AS n FROM s GROUP BY 1, 2"),
    "review_sample": (review_sample, None),
    "scan_sorted": (scan_sorted, "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 50"),
    "count_rows": (count_rows, "SELECT count(*) AS n FROM orders"),
    "row_projection": (row_projection, "SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(CAST(quality AS VARCHAR), '') AS quality, '' AS absent FROM labels"),
    "union_dedup": (union_dedup, "SELECT k, side, o_orderkey FROM (SELECT CAST(o_custkey AS VARCHAR) AS k, 1 AS side, o_orderkey FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT CAST(o_custkey AS VARCHAR), 2, o_orderkey FROM orders WHERE o_totalprice > 100000) QUALIFY row_number() OVER (PARTITION BY k ORDER BY side, o_orderkey) = 1"),
    "cross_page_dedup": (cross_page_dedup, "SELECT o_orderpriority, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1"),
    "word_union": (word_union, "SELECT p_brand AS word FROM part UNION SELECT p_type FROM part"),
    "latest_row": (latest_row, "SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1"),
    "completeness_text": (completeness_text, f"SELECT doc_id, CASE WHEN {_Q} THEN '2/3（缺 质量）' ELSE '3/3' END AS text FROM {LABELLED_SQL}"),
    "benchmark_times": (benchmark_times, "SELECT event_type, min(value) AS best, round(quantile_cont(value, 0.5), 6) AS median FROM events GROUP BY 1"),
}
