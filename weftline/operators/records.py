"""Record operators: deduplication, upsert, validation, statistics and review samples."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import CORE_FIELDS, MISSING, fold_missing
from weftline.operators.numbering import numbered

METHODS = ("rule", "llm", "hybrid", "none")
KINDS = ("html", "ocr", "mixed")
LEAST_YEAR = 1990


def _one_of(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row a key, the first by order; rows with a blank key go."""
    return _one_of(df.where(F.length(F.trim(F.col(key))) > 0), [key], order)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row a key, the last by order; order is given as for the last first."""
    return _one_of(df, keys, order)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """A snapshot with new rows in place of old ones of their key; neither side may repeat a key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def with_status(df: DataFrame, chosen: Column, status: str, column: str = "review_status", allowed: Sequence[str] = ("pending", "approved", "rejected")) -> DataFrame:
    """df with the review status of the chosen rows set."""
    if status not in allowed:
        raise ValueError(f"unknown review status {status!r}")
    return df.withColumn(column, F.when(chosen, F.lit(status)).otherwise(F.col(column)))


def unknown_fields(fields: Sequence[str] = CORE_FIELDS) -> Column:
    return F.array_compact(F.array(*[F.when(fold_missing(F.col(f)) == MISSING, F.lit(f)) for f in fields]))


def issues(required: Sequence[str], standards: Mapping[str, Sequence[str]], year_now: int, fields: Sequence[str] = CORE_FIELDS, year: str = "graduation_year", url: str = "source_url", kind: str = "content_kind") -> Column:
    """Array of (code, severity, field): every rule that a record breaks, in order."""

    def issue(broken: Column, code: str, severity: str, field: str) -> Column:
        return F.when(F.coalesce(broken, F.lit(False)), F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.lit(field).alias("field")))

    def known(f: str) -> Column:
        return fold_missing(F.col(f)) != MISSING

    y = F.col(year)
    four = y.rlike(r"(?U)^\d{4}$")
    rules = [issue(F.length(F.trim(F.coalesce(F.col(c), F.lit("")))) == 0, "FIELD_INVALID", "error", c) for c in required]
    rules.append(issue(known(year) & ~four, "FIELD_OUT_OF_RANGE", "error", year))
    rules.append(issue(known(year) & four & ~y.try_cast("int").between(LEAST_YEAR, year_now + 1), "FIELD_OUT_OF_RANGE", "error", year))
    rules.append(issue((F.length(F.col(url)) > 0) & ~F.col(url).rlike("^https?://"), "FIELD_INVALID", "error", url))
    rules += [issue(known(f) & ~F.col(f).isin(*allowed), "FIELD_INVALID", "warning", f) for f, allowed in standards.items() if allowed]
    rules += [issue(~known(f), "EXTRACT_INCOMPLETE", "warning", f) for f in fields]
    rules.append(issue(F.col(kind) == "ocr", "OCR_NEEDS_REVIEW", "warning", kind))
    return F.array_compact(F.array(*rules))


def verdict(df: DataFrame, found: str = "issues") -> DataFrame:
    """df with ok (no error) and needs_review (an error, an unknown field or OCR content)."""
    ok = ~F.exists(found, lambda i: i["severity"] == "error")
    review = ~ok | F.exists(found, lambda i: i["code"].isin("EXTRACT_INCOMPLETE", "OCR_NEEDS_REVIEW"))
    return df.withColumn("ok", ok).withColumn("needs_review", review)


def completeness(df: DataFrame, fields: Sequence[str], missing=lambda c: fold_missing(c) == MISSING) -> DataFrame:
    """One row: for each field the share of rows that have it, to four digits; 0 without rows."""
    return df.agg(*[F.coalesce(F.round(F.avg(F.when(missing(F.col(f)), 0.0).otherwise(1.0)), 4), F.lit(0.0)).alias(f) for f in fields])


def distribution(df: DataFrame, column: str, values: Sequence[str], default: str) -> DataFrame:
    """(value, n) for all listed values, 0 where none, and for others that occur; blank counts as default."""
    c = F.when(F.length(F.trim(F.coalesce(F.col(column), F.lit("")))) == 0, default).otherwise(F.col(column))
    counts = df.groupBy(c.alias("value")).count()
    listed = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, values))).alias("value"))
    return listed.join(counts, "value", "full").select("value", F.coalesce("count", F.lit(0)).cast("long").alias("n"))


def hit_source(df: DataFrame, hits: str = "hits", fields: Sequence[str] = CORE_FIELDS) -> DataFrame:
    """(field, method, n): by which method each field was found, hit by hit; hits hold a method."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(hits)[f]["method"].alias("method")) for f in fields]))
    return df.select(pairs.alias("p")).select("p.*").where("method is not null").groupBy("field", "method").agg(F.count("*").alias("n"))


def field_source(df: DataFrame, fields: Sequence[str], method: str = "extract_method") -> DataFrame:
    """(field, rule, llm): rows of each method that have the field; other methods count for neither."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), (fold_missing(F.col(f)) != MISSING).alias("has")) for f in fields]))
    long = df.select(F.col(method).alias("method"), pairs.alias("p")).select("method", "p.field", "p.has")
    return long.groupBy("field").agg(*[F.sum(F.when(F.col("has") & (F.col("method") == m), 1).otherwise(0)).alias(m) for m in ("rule", "llm")])


def facet_counts(df: DataFrame, fields: Sequence[str], top: int = 50) -> DataFrame:
    """(value, n): the counts of the `top` values of each field, added up over fields."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.trim(F.col(f).cast("string")).alias("value")) for f in fields]))
    counts = df.select(pairs.alias("p")).select("p.*").where(F.col("value").isNotNull() & ~F.col("value").isin("", MISSING)).groupBy("field", "value").count()
    w = Window.partitionBy("field").orderBy(F.desc("count"), "value")
    return counts.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= top).groupBy("value").agg(F.sum("count").alias("n"))


def related(df: DataFrame, fields: Sequence[str], words: Sequence[str], limit: int = 8) -> DataFrame:
    """The most frequent facet values that are not among the words."""
    out = facet_counts(df, fields)
    if words:
        out = out.where(~F.lower("value").isin(*[w.strip().lower() for w in words]))
    return out.orderBy(F.desc("n"), "value").limit(max(1, limit))


def sample_indices(n: int, rate: float, seed: int) -> list[int]:
    """Row numbers of a seeded review sample: at least one of a table that is not empty."""
    if n <= 0 or rate <= 0:
        return []
    return random.Random(seed).sample(range(n), min(n, max(1, math.ceil(n * rate))))


def review_sample(df: DataFrame, order: Sequence[str], rate: float, seed: int) -> DataFrame:
    """The rows of df, in the given order, whose numbers the seed picks; the order must name each row.

    Only the columns of the order are sorted and numbered; whole rows are joined to the
    picks, which a task makes as a table (they follow one another from the seed).
    """
    keys = numbered(df.select(*order), order)
    n = keys.count()

    def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            picks = pa.array(sample_indices(n, rate, seed), pa.int64())
            yield from pa.table({"_row": picks}).to_batches(max_chunksize=1 << 16)

    picks = df.sparkSession.range(1, numPartitions=1).mapInArrow(picked, "_row long")
    return df.join(keys.join(picks, "_row").drop("_row"), list(order), "left_semi")


def scan_order(df: DataFrame, newest: str = "crawl_time", then: str = "source_url") -> DataFrame:
    """Newest rows first, then by name."""
    return df.orderBy(F.desc(newest), F.asc(then))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values of a column that are not blank, once each."""
    return df.select(column).where(F.length(F.trim(F.col(column))) > 0).distinct()


def value_union(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """All values of two one-column tables, once each."""
    return left.toDF(name).union(right.toDF(name)).distinct()


def latest(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The one row that stands last by the columns of the order."""
    return df.agg(F.max_by(F.struct("*"), F.struct(*order)).alias("_r")).select("_r.*")


def counters(df: DataFrame, counted: Mapping[str, Column]) -> DataFrame:
    """One row: how many rows satisfy each condition, in one pass."""
    return df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in counted.items()])


def times(df: DataFrame, by: str, value: str) -> DataFrame:
    """The best and the median of a measure for each name."""
    return df.groupBy(by).agg(F.min(value).alias("best"), F.round(F.percentile(value, F.lit(0.5)), 6).alias("median"))


def unknown_totals(df: DataFrame, fields: Sequence[str] = CORE_FIELDS) -> DataFrame:
    """One row: unknown fields in all, rows without any, rows that need a look."""
    n = F.size(unknown_fields(fields))
    return df.agg(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("unknown_total"), F.count_if(n == 0).alias("complete"), F.count_if(n > 0).alias("manual_review"))


def prune(df: DataFrame, created: str, last_hit: str, oldest: Column, most: int, key: str) -> DataFrame:
    """What a cache keeps: rows not older than `oldest`, and of these the `most` that were used last."""
    return df.where(F.col(created) >= oldest).orderBy(F.desc(last_hit), F.desc(key)).limit(most)


def filled(fields: Sequence[str] = CORE_FIELDS) -> Column:
    """How many of the fields are known."""
    return F.lit(len(fields)) - F.size(unknown_fields(fields))


def report_order(df: DataFrame, fields: Sequence[str] = CORE_FIELDS, date: str = "publish_date") -> DataFrame:
    """Rows with most known fields first, then by date."""
    return df.withColumn("hits", filled(fields)).orderBy(F.desc("hits"), F.asc(date))


def report_cards(rows: DataFrame, entries: DataFrame, fields: Sequence[str] = CORE_FIELDS, key: str = "article_key") -> DataFrame:
    """One row of counts: rows, archived pages, images, outside bodies, complete rows, rows that need a look.

    rows are joined to manifest entries by key; entries hold images, html_path and content_url.
    """
    outside = F.length(F.coalesce("content_url", F.lit(""))) > 0
    of_entries = entries.agg(F.count_if(F.length(F.coalesce("html_path", F.lit(""))) > 0).alias("archived"), F.coalesce(F.sum(F.when(F.col("images").isNotNull(), F.size("images"))), F.lit(0)).cast("long").alias("images"))
    n = F.size(unknown_fields(fields))
    of_rows = rows.join(entries.select(key, "content_url"), key, "left").agg(F.count("*").alias("total"), F.count_if(outside).alias("external"), F.count_if(n == 0).alias("complete"), F.count_if(n > 0).alias("manual"))
    return of_rows.join(of_entries)  # one row each
