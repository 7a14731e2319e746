"""Spark-side helpers of the operators: checkpoint folder, partition counts, prepared input."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.lineage import checkpointed, shared_folder, swept
from weftline.operators.numbering import numbered

__all__ = ["buckets", "checkpointed", "documents", "freed", "held_out", "ordered", "released", "releasing", "shared_folder", "swept"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the documents that no model may learn from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def released() -> None:
    """Gives memory that is free back to the system, as workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def releasing(run: Callable) -> Callable:
    """run over batches of a task, with memory given back at its end."""

    def whole(batches: Iterator[Any]) -> Iterator[Any]:
        yield from run(batches)
        released()

    return whole


def freed(run: Callable) -> Callable:
    """run over one or two whole tables of a group, with memory given back after each."""

    def one(table: pa.Table) -> pa.Table:
        out = run(table)
        released()
        return out

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        out = run(left, right)
        released()
        return out

    return one if run.__code__.co_argcount == 1 else two


def buckets(spark: SparkSession) -> int:
    """As many buckets as the session has shuffle partitions, so that both grow with the input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ordered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(order_key, doc_id, text, carry) with a distinct order_key for every row; null text is empty.

    Where ids are distinct, the key is the id. Otherwise rows are numbered by id, then text,
    a null id last; rows are sorted by their ranges and never gathered. carry names columns
    that go along.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *carry)
    most, rows, named = base.groupBy("doc_id").count().agg(F.max("count"), F.sum("count"), F.sum(F.when(F.col("doc_id").isNotNull(), F.col("count")))).first()
    if (most or 0) <= 1 and rows == named:
        return base.select(F.col("doc_id").alias("order_key"), "*")
    return numbered(base, [F.col("doc_id").asc_nulls_last(), "text"], "order_key").select("order_key", "doc_id", "text", *carry)
