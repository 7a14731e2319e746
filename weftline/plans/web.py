"""JSON, URL and paging queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import payload as P
from weftline.functions import text as T
from weftline.plans.common import table
from weftline.sources import crawl as C


def json_dig(spark, d):
    return table(spark, d, "events").select("event_id", C.dig_column(F.col("props"), "k").alias("k"), C.dig_column(F.col("props"), "a.0.b").alias("absent"))


def json_records_explode(spark, d):
    payload = F.to_json(F.struct(F.struct(F.array(F.struct("user_id", "event_type")).alias("records")).alias("data")))
    e = table(spark, d, "events").select("event_id", F.explode(C.records_column(payload)).alias("r"))
    return e.select("event_id", F.explode("r").alias("key", "value"))


#: Payloads around the properties of an event: an array under a usual name; one that only a search
#: finds, beside text that looks like one; one after an array of numbers; one too deep; one on top.
_ENVELOPES = (
    '{"data": {"records": [%1$s]}}',
    '{"zz": {"note": "[{}]", "body": {"hits": [%1$s, {"title": "%2$s"}]}}}',
    '{"rows": [1, 2], "a": {"c": [%1$s]}}',
    '{"a": {"b": {"c": {"d": [%1$s]}}}}',
    "[%1$s]",
)


def json_records_located(spark, d):
    shape = F.element_at(F.array(*[F.format_string(e, "props", "event_type") for e in _ENVELOPES]), (F.col("event_id") % len(_ENVELOPES) + 1).cast("int"))
    rows = P.record_rows(table(spark, d, "events").select("event_id", shape.alias("payload")), "payload", C.LIST_PATHS, levels=C.DEPTH)
    return rows.select("event_id", "at", "place", P.first_filled(F.col("record"), ["title", "k"]).alias("value"))


def json_envelope(spark, d):
    payload = F.format_string('{"code": %s, "msg": "%s", "data": %s, "more": [%s]}', F.col("event_id").cast("string"), F.repeat("event_type", F.lit(30)), "props", "props")
    e = T.once(table(spark, d, "events").select("event_id", payload.alias("payload")), e=P.envelope(F.col("payload")))
    return e.select("event_id", F.array_join("e.names", ",").alias("names"), F.size("e.scalars").alias("n_scalars"), F.col("e.scalars")["code"].alias("code"), F.col("e.scalars")["msg"].alias("msg"))


def payload_roundtrip(spark, d):
    e = table(spark, d, "events").select("event_id", F.to_json(F.struct("user_id", "event_type")).alias("j"))
    return e.select("event_id", F.from_json("j", "user_id long, event_type string").alias("r")).select("event_id", "r.*")


def paging_windows(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", C.page_windows((F.col("o_orderkey") % 4 + 1).cast("int"), 15).alias("w"))
    return o.select("o_orderkey", F.explode("w").alias("w")).select("o_orderkey", "w.*")


def api_query(spark, d):
    q = C.query_string({"page": F.col("o_orderkey"), "type": F.col("o_orderpriority"), "blank": F.lit(None)})
    return table(spark, d, "orders").select("o_orderkey", q.alias("query"))


def total_pages(spark, d):
    e = table(spark, d, "events")
    stated = F.when(F.col("event_id") % 3 == 0, F.col("user_id").cast("string"))
    total = F.when(F.col("event_id") % 3 == 1, F.col("event_id").cast("string"))
    return e.select("event_id", C.total_pages(stated, total, 15).alias("pages"))


def url_template(spark, d):
    url = C.template_column("https://x/{user_id}/{event_type}", {"user_id": F.col("user_id"), "event_type": F.when(F.col("event_type") != "click", F.col("event_type"))})
    return table(spark, d, "events").select("event_id", url.alias("url"))


def title_filter(spark, d):
    return table(spark, d, "part").where(C.title_matches(F.col("p_name"), ["red", "gear", " "])).select("p_partkey", "p_name")


def ok_predicates(spark, d):
    status = F.when(F.col("page_id") % 5 == 0, 404).otherwise(200)
    error = F.when(F.col("page_id") % 7 == 0, "timeout")
    return table(spark, d, "pages").select("page_id", C.usable(status, F.col("html"), error).alias("ok"))


def url_class(spark, d):
    landed = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("https://SSO.example/"), F.col("url"))).otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", C.to_login(F.col("url"), landed).alias("login"), C.kind_of(F.col("url"), F.col("html")).alias("kind"))


def archive_replay(spark, d):
    """Entries of which some have an archived page, joined by the path that follows from the URL.

    Of several pages under one path the first, by page_id, is the archived one.
    """
    pages = table(spark, d, "pages")
    entries = pages.select("page_id", T.html_path(F.col("url")).alias("html_path"))
    archive = pages.where(F.length("html") > 4000).groupBy(T.html_path(F.col("url")).alias("html_path")).agg(F.min(F.struct("page_id", "html"))["html"].alias("html"))
    return C.with_archive(entries, archive).select("page_id", "archived", F.length("html").cast("long").alias("n"))


def manifest_lines(spark, d):
    """Conversations written as manifest lines and read again: the last turn of each counts."""
    t = table(spark, d, "conversations")
    line = t.select("turn", F.struct(F.concat(F.lit("https://x/"), F.col("conv_id").cast("string")).alias("detail_url"), F.col("role").alias("title"), F.lit(200).alias("status_code")).alias("e"))
    entries = C.manifest_entries(line.select(F.to_json("e").alias("value"), F.col("turn").alias("line_no")))
    return entries.select("detail_url", "title", "status_code", "first_no")


def api_query_window(spark, d):
    """Windows of pages by the page number that the order's key gives."""
    o = table(spark, d, "orders").select("o_orderkey", C.page_windows((F.col("o_orderkey") % 3 + 1).cast("int"), 20).alias("w"))
    return o.select("o_orderkey", F.element_at("w", -1).alias("w")).select("o_orderkey", "w.page", "w.start", "w.end")


QUERIES = {
    "json_dig": (json_dig, "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.a[0].b') AS absent FROM events"),
    "json_records_explode": (json_records_explode, "SELECT event_id, 'user_id' AS key, CAST(user_id AS VARCHAR) AS value FROM events UNION ALL SELECT event_id, 'event_type', event_type FROM events"),
    "json_records_located": (json_records_located, """WITH p AS (SELECT event_id, event_id % 5 AS s, event_type, CASE WHEN json_extract_string(props, '$.k') = '0' THEN '' ELSE json_extract_string(props, '$.k') END AS k FROM events)
    SELECT event_id, CASE s WHEN 0 THEN 'data.records' WHEN 1 THEN 'zz.body.hits' WHEN 2 THEN 'a.c' ELSE '' END AS at, CAST(0 AS INT) AS place, coalesce(k, '') AS value FROM p WHERE s <> 3
    UNION ALL SELECT event_id, 'zz.body.hits', CAST(1 AS INT), event_type FROM p WHERE s = 1"""),
    "json_envelope": (json_envelope, "SELECT event_id, 'code,msg,data,more' AS names, CAST(2 AS INT) AS n_scalars, CAST(event_id AS VARCHAR) AS code, left(repeat(event_type, 30), 80) AS msg FROM events"),
    "payload_roundtrip": (payload_roundtrip, "SELECT event_id, user_id, event_type FROM events"),
    "paging_windows": (paging_windows, "SELECT o_orderkey, CAST(p AS INT) AS page, CAST((p - 1) * 15 AS INT) AS start, CAST(p * 15 AS INT) AS end FROM (SELECT o_orderkey, unnest(range(1, o_orderkey % 4 + 2)) AS p FROM orders)"),
    "api_query": (api_query, "SELECT o_orderkey, 'page=' || CAST(o_orderkey AS VARCHAR) || '&type=' || replace(url_encode(o_orderpriority), '%20', '+') || '&blank=' AS query FROM orders"),
    "total_pages": (total_pages, "SELECT event_id, CAST(CASE event_id % 3 WHEN 0 THEN user_id WHEN 1 THEN greatest(1, (event_id + 14) // 15) ELSE 0 END AS INT) AS pages FROM events"),
    "url_template": (url_template, "SELECT event_id, CASE WHEN event_type = 'click' THEN '' ELSE 'https://x/' || CAST(user_id AS VARCHAR) || '/' || event_type END AS url FROM events"),
    "title_filter": (title_filter, "SELECT p_partkey, p_name FROM part WHERE strpos(p_name, 'red') > 0 OR strpos(p_name, 'gear') > 0"),
    "ok_predicates": (ok_predicates, "SELECT page_id, page_id % 5 <> 0 AND length(html) > 0 AND page_id % 7 <> 0 AS ok FROM pages"),
    "url_class": (url_class, "SELECT page_id, page_id % 2 = 0 AS login, CASE WHEN regexp_matches(lower(url), '\\.(png|jpe?g|gif|webp|bmp)$') THEN 'image' WHEN starts_with(lower(ltrim(html)), '<!doctype html') OR starts_with(lower(ltrim(html)), '<html') OR contains(lower(html), '</html>') THEN 'html' ELSE 'other' END AS kind FROM pages"),
    "archive_replay": (archive_replay, "WITH p AS (SELECT page_id, left(sha1(trim(url)), 16) AS k, html FROM pages), a AS (SELECT k, any_value(html) AS html FROM p WHERE length(html) > 4000 GROUP BY k) SELECT page_id, a.html IS NOT NULL AS archived, length(a.html) AS n FROM p LEFT JOIN a USING (k)"),
    "manifest_lines": (manifest_lines, "SELECT 'https://x/' || CAST(conv_id AS VARCHAR) AS detail_url, arg_max(role, turn) AS title, CAST(200 AS INT) AS status_code, min(turn) AS first_no FROM conversations GROUP BY conv_id"),
    "api_query_window": (api_query_window, "SELECT o_orderkey, CAST(o_orderkey % 3 + 1 AS INT) AS page, CAST(o_orderkey % 3 * 20 AS INT) AS start, CAST((o_orderkey % 3 + 1) * 20 AS INT) AS end FROM orders"),
}
