"""Search queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from weftline.functions.text import MISSING
from weftline.operators import records as R
from weftline.operators import search as S
from weftline.operators.lineage import shared_folder
from weftline.operators.textindex import TextIndex
from weftline.plans.common import LABELLED_SQL, labelled, table


def query_tokenize(spark, d):
    return table(spark, d, "benchmark").select("item_id", F.array_join(S.query_tokens("text"), "|").alias("tokens"))


def index_text(spark, d):
    rows = labelled(spark, d).withColumn("quality", F.when(F.trim("quality") == "-", MISSING).otherwise(F.col("quality")))
    return rows.select("doc_id", S.index_text("source", ["lang", "quality"], "text").alias("text"))


def bm25_search(spark, d):
    return _rounded(S.bm25(table(spark, d, "documents"), "doc_id", "text", [["the"], ["was"]]))


def bm25_phrase(spark, d):
    return _rounded(S.bm25(table(spark, d, "documents"), "doc_id", "text", [["of", "the"]]))


def _rounded(df):
    return df.select("doc_id", F.round("score", 6).alias("score"))


def _bm25_sql(phrases: list[list[str]]) -> str:
    def count(p: list[str]) -> str:
        if len(p) == 1:
            return f"len(list_filter(t, lambda x: x = '{p[0]}'))"
        each = " AND ".join(f"t[i + {k}] = '{w}'" for k, w in enumerate(p))
        return f"len(list_filter(range(1, len(t) + 1), lambda i: {each}))"

    fs = ", ".join(f"{count(p)} AS f{i}" for i, p in enumerate(phrases))
    ns = ", ".join(f"count(*) FILTER (f{i} > 0) AS n{i}" for i in range(len(phrases)))
    score = " + ".join(f"greatest(ln((n - n{i} + 0.5) / (n{i} + 0.5)), 1e-6) * f{i} * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * dl / avgdl))" for i in range(len(phrases)))
    held = " AND ".join(f"f{i} > 0" for i in range(len(phrases)))
    return f"""WITH k AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(text)), '[\\p{{L}}\\p{{N}}]+') AS t FROM documents), r AS (SELECT doc_id, len(t) AS dl, {fs} FROM k), s AS (SELECT count(*) AS n, avg(dl) AS avgdl, {ns} FROM r)
    SELECT doc_id, round(-({score}), 6) AS score FROM r, s WHERE {held}"""


def like_fallback(spark, d):
    return table(spark, d, "documents").where(S.like_any(["text", "source"], ["ANDER", "src3"])).select("doc_id", F.lit(0.0).alias("score"))


def field_filter(spark, d):
    docs = table(spark, d, "documents")
    return docs.where(S.field_filter({"lang": "E", "source": "src1", "nope": "x", "text": " "}, docs.columns)).select("doc_id", "lang", "source")


def count_matching(spark, d):
    return table(spark, d, "documents").where(S.like_any(["text"], ["license"])).agg(F.count("*").alias("n"))


def trigram_search(spark, d):
    return _rounded(S.bm25(table(spark, d, "documents"), "doc_id", "text", ["tion", "the"], tokenizer="trigram"))


def _indexed(spark, d, tokenizer):
    """A stored index that was built over one language and then brought up to all documents."""
    docs = table(spark, d, "documents")
    index = TextIndex(spark, f"{shared_folder(spark)}/index-{uuid.uuid4().hex}", tokenizer)
    index.maintain(docs.where("lang = 'en'"), "doc_id", "text", 1)
    index.maintain(docs, "doc_id", "text", 2)
    return index


def indexed_search(spark, d):
    return _rounded(_indexed(spark, d, "unicode61").scores([["the"], ["of", "the"]], "k").select(F.col("k").cast("long").alias("doc_id"), "score"))


def indexed_trigrams(spark, d):
    return _rounded(_indexed(spark, d, "trigram").scores(["tion", "ander"], "k").select(F.col("k").cast("long").alias("doc_id"), "score"))


def _trigram_sql(parts: list[str]) -> str:
    fs = ", ".join(f"len(list_filter(range(1, length(t) + 1), lambda i: substr(t, i, {len(p)}) = '{p}')) AS f{i}" for i, p in enumerate(parts))
    ns = ", ".join(f"count(*) FILTER (f{i} > 0) AS n{i}" for i in range(len(parts)))
    score = " + ".join(f"greatest(ln((n - n{i} + 0.5) / (n{i} + 0.5)), 1e-6) * f{i} * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * dl / avgdl))" for i in range(len(parts)))
    return f"""WITH k AS (SELECT doc_id, lower(text) AS t FROM documents), r AS (SELECT doc_id, greatest(length(t) - 2, 0) AS dl, {fs} FROM k), s AS (SELECT count(*) AS n, avg(dl) AS avgdl, {ns} FROM r)
    SELECT doc_id, round(-({score}), 6) AS score FROM r, s WHERE {" AND ".join(f"f{i} > 0" for i in range(len(parts)))}"""


def _apart_sql(parts: list[str]) -> str:
    """As _trigram_sql, for parts that do not overlap themselves, whose places can be counted by what goes without them."""
    out = _trigram_sql(parts)
    for p in parts:
        out = out.replace(f"len(list_filter(range(1, length(t) + 1), lambda i: substr(t, i, {len(p)}) = '{p}'))", f"(length(t) - length(replace(t, '{p}', ''))) // {len(p)}")
    return out


def _articles(spark, d):
    """Documents in the shape that search reads."""
    docs = table(spark, d, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("article_key"), F.col("source").alias("article_title"), F.col("lang").alias("city"), F.col("text").alias("evidence"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("crawl_time"), F.col("source").alias("source_url"))


def search_page(spark, d):
    """A page of full-text results within one language."""
    found = S.search(_articles(spark, d), S.Query(("the",), {"city": "en"}, limit=7, offset=2))
    return found.select("article_key", F.round("score", 6).alias("score"))


def search_substring(spark, d):
    """The word is no token of any text, so it is looked for as a substring, newest first."""
    found = S.search(_articles(spark, d), S.Query(("rc3",), raw_text="rc3", limit=9))
    return found.select("article_key", "score")


_ARTICLES = "(SELECT CAST(doc_id AS VARCHAR) AS article_key, doc_id, source, lang, concat_ws(' ', trim(source), trim(source), trim(lang), nullif(trim(text), '')) AS t, text FROM documents)"
_SEARCH_PAGE = f"""WITH k AS (SELECT article_key, lang, doc_id, regexp_extract_all(strip_accents(lower(t)), '[\\p{{L}}\\p{{N}}]+') AS w FROM {_ARTICLES}), r AS (SELECT *, len(w) AS dl, len(list_filter(w, lambda x: x = 'the')) AS f FROM k),
    s AS (SELECT count(*) AS n, avg(dl) AS avgdl, count(*) FILTER (f > 0) AS df FROM r)
    SELECT article_key, round(raw, 6) AS score FROM (SELECT article_key, doc_id, -(greatest(ln((n - df + 0.5) / (df + 0.5)), 1e-6) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / avgdl))) AS raw FROM r, s WHERE f > 0 AND lang LIKE '%en%') ORDER BY raw, doc_id DESC LIMIT 7 OFFSET 2"""


def highlights(spark, d):
    found = S.highlights({"lang": "L", "source": "S", "text": "T"}, ["en", "src1", "thing"])
    return table(spark, d, "documents").select("doc_id", F.array_join(found, ",").alias("labels"))


def snippet(spark, d):
    return table(spark, d, "pages").select("page_id", S.snippet(F.col("html"), ["<p>", "<h1"]).alias("snippet"))


_ESC = "replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
_SNIPPET = f"""WITH a AS (SELECT page_id, trim(html) AS t, strpos(trim(html), '<p>') AS p1, strpos(trim(html), '<h1') AS p2 FROM pages),
 b AS (SELECT *, CASE WHEN p1 > 0 AND (p2 = 0 OR p1 <= p2) THEN p1 ELSE p2 END AS p, CASE WHEN p1 > 0 AND (p2 = 0 OR p1 <= p2) THEN '&lt;p&gt;' ELSE '&lt;h1' END AS m FROM a), c AS (SELECT *, greatest(p - 1 - 40, 0) AS s, least(length(t), p - 1 + 120) AS e FROM b)
 SELECT page_id, CASE WHEN p = 0 THEN {_ESC.format("left(t, 120)")} || CASE WHEN length(t) > 120 THEN '…' ELSE '' END ELSE CASE WHEN s > 0 THEN '…' ELSE '' END || replace({_ESC.format("substr(t, s + 1, e - s)")}, m, '<em>' || m || '</em>') || CASE WHEN e < length(t) THEN '…' ELSE '' END END AS snippet FROM c"""


def hit_projection(spark, d):
    rows = labelled(spark, d).withColumn("title", F.when(F.col("quality") == " - ", "").otherwise(F.col("source")))
    return S.hits(rows, "doc_id", "title", ["quality"])


def cache_key(spark, d):
    payload = F.concat(F.lit('{"kw": ["'), F.col("event_type"), F.lit('"]}'))
    return table(spark, d, "events").select("event_id", S.cache_keys(payload, F.col("user_id")).alias("cache_key"))


def cache_prune(spark, d):
    """What a cache of 100 rows keeps: none older than the age, and of the others those used last."""
    kept = R.prune(table(spark, d, "events"), "ts", "value", F.lit("2024-01-02 00:00:00").cast("timestamp"), 100, "event_id")
    return kept.select("event_id", "event_type")


def keyword_candidates(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(S.keyword_candidates(F.col("p_name")), "|").alias("candidates"))


_CANDIDATES = """WITH r AS (SELECT p_partkey, unnest(regexp_extract_all(p_name, '[0-9A-Za-z]+')) AS run, generate_subscripts(regexp_extract_all(p_name, '[0-9A-Za-z]+'), 1) AS i FROM part),
 s AS (SELECT p_partkey, run, i, unnest(range(1, greatest(length(run), 2))) AS k FROM r), c AS (SELECT p_partkey, CASE WHEN length(run) >= 2 THEN substr(run, k) ELSE run END AS c, row_number() OVER (PARTITION BY p_partkey ORDER BY length(run) DESC, i, k) AS n FROM s),
 u AS (SELECT p_partkey, c, min(n) AS n FROM c GROUP BY 1, 2) SELECT p_partkey, string_agg(c, '|' ORDER BY n) AS candidates FROM u GROUP BY 1"""


def page_clamp(spark, d):
    size, skip = S.clamped(F.col("value").cast("int") - 20, F.col("event_id") - 100, 50)
    return table(spark, d, "events").select("event_id", size.alias("size"), skip.alias("skip"))


def fetch_estimate(spark, d):
    found = S.fetch_estimates(F.col("event_id") % 5, 2.0, F.col("event_type") != "click", 60.0, F.col("value") - 50)
    return table(spark, d, "events").select("event_id", found.alias("e")).select("event_id", "e.*")


def cooldown_remaining(spark, d):
    """Seconds until each user may fetch again, at a fixed moment."""
    last = table(spark, d, "events").groupBy("user_id").agg(F.max("ts").alias("last"))
    return last.select("user_id", S.cooldown_left(F.lit("2024-02-01 00:00:00").cast("timestamp"), F.col("last"), 86_400).alias("remaining"))


QUERIES = {
    "query_tokenize": (query_tokenize, "SELECT item_id, array_to_string(list_filter(list_distinct_keep, lambda x: true), '|') AS tokens FROM (SELECT item_id, list_reduce(list_prepend(CAST([] AS VARCHAR[]), list_transform(list_filter(string_split_regex(trim(text), '[\\s,，、;；/|+·。！？!?（）()\\[\\]【】\"''“”‘’]+'), lambda x: x <> ''), lambda x: [x])), lambda a, b: CASE WHEN list_contains(a, b[1]) THEN a ELSE list_concat(a, b) END) AS list_distinct_keep FROM benchmark)"),
    "index_text": (index_text, f"SELECT doc_id, concat_ws(' ', nullif(trim(source), ''), nullif(trim(source), ''), nullif(trim(lang), ''), CASE WHEN trim(quality) <> '-' THEN trim(quality) END, nullif(trim(text), '')) AS text FROM {LABELLED_SQL}"),
    "bm25_search": (bm25_search, _bm25_sql([["the"], ["was"]])),
    "bm25_phrase": (bm25_phrase, _bm25_sql([["of", "the"]])),
    "like_fallback": (like_fallback, "SELECT doc_id, 0.0::DOUBLE AS score FROM documents WHERE lower(text) LIKE '%ander%' OR lower(source) LIKE '%ander%' OR lower(text) LIKE '%src3%' OR lower(source) LIKE '%src3%'"),
    "field_filter": (field_filter, "SELECT doc_id, lang, source FROM documents WHERE lower(lang) LIKE '%e%' AND lower(source) LIKE '%src1%'"),
    "count_matching": (count_matching, "SELECT count(*) AS n FROM documents WHERE lower(text) LIKE '%license%'"),
    "indexed_search": (indexed_search, _bm25_sql([["the"], ["of", "the"]])),
    "indexed_trigrams": (indexed_trigrams, _apart_sql(["tion", "ander"])),
    "trigram_search": (trigram_search, _trigram_sql(["tion", "the"])),
    "search_page": (search_page, _SEARCH_PAGE),
    "search_substring": (search_substring, "SELECT CAST(doc_id AS VARCHAR) AS article_key, 0.0::DOUBLE AS score FROM documents WHERE contains(lower(source), 'rc3') OR contains(lower(lang), 'rc3') OR contains(lower(text), 'rc3') ORDER BY doc_id DESC LIMIT 9"),
    "highlights": (highlights, "SELECT doc_id, concat_ws(',', CASE WHEN contains(lang, 'en') OR contains(lang, 'src1') OR contains(lang, 'thing') THEN 'L' END, CASE WHEN contains(source, 'en') OR contains(source, 'src1') OR contains(source, 'thing') THEN 'S' END, CASE WHEN contains(text, 'en') OR contains(text, 'src1') OR contains(text, 'thing') THEN 'T' END) AS labels FROM documents"),
    "snippet": (snippet, _SNIPPET),
    "hit_projection": (hit_projection, f"SELECT doc_id, CASE WHEN quality = ' - ' THEN '(无标题)' ELSE source END AS title, CASE WHEN trim(quality) = '-' THEN '{MISSING}' ELSE quality END AS quality FROM {LABELLED_SQL}"),
    "cache_key": (cache_key, "SELECT event_id, left(sha256('{\"kw\": [\"' || event_type || '\"]}|v' || CAST(user_id AS VARCHAR)), 32) AS cache_key FROM events"),
    "cache_prune": (cache_prune, "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-02 00:00:00' ORDER BY value DESC, event_id DESC LIMIT 100"),
    "keyword_candidates": (keyword_candidates, _CANDIDATES),
    "page_clamp": (page_clamp, "SELECT event_id, greatest(1, least(CAST(trunc(value) AS INT) - 20, 50)) AS size, greatest(0, event_id - 100) AS skip FROM events"),
    "fetch_estimate": (fetch_estimate, "SELECT event_id, 1 + 15 * (event_id % 5) AS requests, (1 + 15 * (event_id % 5)) * 2.0::DOUBLE AS seconds, CASE WHEN event_type = 'click' THEN 'disabled' WHEN (1 + 15 * (event_id % 5)) * 2 > 60 THEN 'budget' WHEN value > 50 THEN 'cooldown' ELSE '' END AS blocked FROM events"),
    "cooldown_remaining": (cooldown_remaining, "SELECT user_id, CAST(greatest(0, 86400 - (CAST(floor(epoch(TIMESTAMP '2024-02-01 00:00:00')) AS BIGINT) - CAST(floor(epoch(max(ts))) AS BIGINT))) AS BIGINT) AS remaining FROM events GROUP BY 1"),
}
