"""Incremental ingest: new manifest files are merged into the store, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftline.sources.crawl import file_place, line_place, manifest_entries
from weftline.sources.store import Store


def ingest_manifests(spark: SparkSession, source: str, store: Store, records_of: Callable[[DataFrame], DataFrame], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start a query that upserts the records of each batch of manifest lines.

    Upserts are by key, so a batch that is tried again after a failure gives the same table.
    """
    lines = spark.readStream.schema("value string").text(source).withColumn("place", file_place())

    def merge(batch: DataFrame, _: int) -> None:
        store.upsert(records_of(manifest_entries(batch.withColumn("line_no", line_place(F.col("place"))))))

    writer = lines.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
