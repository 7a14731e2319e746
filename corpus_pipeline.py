"""Cleaning pipeline over the documents: toxicity, line templates, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All
but the last return the columns of documents, with n_chars of the text as it then stands;
the last returns the pieces of packed sequences.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.minhash import near_duplicates
from weftline.llm.packing import packed
from weftline.llm.shared import ordered, shared_folder
from weftline.llm.substrings import remove_repeats
from weftline.llm.templates import deduplicate_lines
from weftline.llm.toxicity import train, without_toxic

#: SQL cannot express the stages.
ORACLE_SQL = None

_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(rows: DataFrame) -> DataFrame:
    return rows.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long")).select(*_COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject, row by row; null and empty texts stay.

    Rows that repeat an id are judged each by its own text; an empty table stays empty.
    """
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _documents(without_toxic(docs.select(*_COLUMNS), model))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later lines of recurring templates; a document left without words goes.

    Texts that were empty stay. Rows that share an id, or have none, are ordered by their
    text and stay rows of their own; an empty table stays empty.
    """
    lines = deduplicate_lines(docs, carry=("lang", "source"))
    return _documents(lines.where((F.col("n_dropped") == 0) | (F.length(F.trim(F.translate("text", "\n\r\t", "   "))) > 0)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest doc_id, of equal ids with the first text.

    Rows are judged one by one, whatever ids they share; a null id comes after all others,
    so such a row stays only where no other of its group has an id. Rows without words stay.
    """
    rows = ordered(docs.withColumn("no_text", F.col("text").isNull()), carry=("lang", "source", "no_text"))
    kept = near_duplicates(rows, id_col="order_key").where("kept").select(F.col("doc_id").alias("order_key"))
    return _documents(rows.join(kept, "order_key", "left_semi").withColumn("text", F.when(~F.col("no_text"), F.col("text"))))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; a document that repeats as a whole goes.

    Rows that share an id, or have none, are ordered by their text and stay rows of their
    own; empty texts stay, and an empty table stays empty.
    """
    cut = remove_repeats(docs, carry=("lang", "source"), as_text=True).where("n_removed = 0 or n_removed < n_bytes")
    return _documents(cut)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in packed sequences.

    Each row is packed by itself, whatever its id; a null or empty text is its end mark
    alone, and an empty table gives no pieces.
    """
    return packed(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet in the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
