"""Tables and parameter sets of the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Latin terms that stand in for a lexicon, as the shared tables hold no Chinese.
LEXICON = {"article": ["the", "une", "der"], "license": ["License", "licensed"], "city": ["ander", "ten"], "verb": ["was", "est"]}
FIELDS = ("lang", "source", "quality")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels as strings; the placeholder - where there is none."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    return table(spark, sf_dir, "documents").join(labels, "doc_id", "left").withColumn("quality", F.coalesce("quality", F.lit(" - ")))


LABELLED_SQL = "(SELECT d.*, coalesce(CAST(l.quality AS VARCHAR), ' - ') AS quality FROM documents d LEFT JOIN labels l USING (doc_id))"
