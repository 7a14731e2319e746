"""Answers of an outside service (a model, an image reader), each asked for once.

Answers are kept by the key of their content, in Parquet, before any reader sees them, so
a second action, a later run or a lost executor asks nothing again. While a run asks, each
answer also goes into a journal, a small file by key that appears whole, from which another
try of a failed task takes what the first had got. The journal goes when the run's answers
are in Parquet; what runs that died left of theirs is read as well, until compact().
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ResultTable:
    """Answers by key under one folder, which driver and executors reach by the same path."""

    def __init__(self, spark: SparkSession, folder: str | Path) -> None:
        self.spark, self.folder = spark, Path(folder).resolve()

    def _journals(self) -> list[Path]:
        """Folders of journals that hold answers."""
        return [p for p in (self.folder / "journal").glob("*") if any(x.name[0] != "." for x in p.iterdir())]

    def known(self) -> DataFrame:
        """(key, value) of all answers, one a key."""
        kinds = "key string, value string"
        parts = [str(p) for p in (self.folder / "parts").glob("*") if (p / "_SUCCESS").exists()]
        rows = self.spark.read.schema(kinds).parquet(*parts) if parts else self.spark.createDataFrame([], kinds)
        if left := self._journals():
            files = self.spark.read.text([str(p) for p in left], wholetext=True)
            rows = rows.unionByName(files.select(F.col("_metadata.file_name").alias("key"), "value"))
        return rows.where("value is not null").groupBy("key").agg(F.min("value").alias("value"))

    def answers(self, wanted: DataFrame, ask: Callable[[Any], str | None]) -> DataFrame:
        """(key, value, cached) for each distinct key of wanted (key, payload).

        Keys are names of files: hashes in hex. Keys that are not known are asked for, now
        and once each; an answer that is null, or an error, is null in this run, and is
        asked for again in the next. Null payloads have no row.
        """
        run_id, known = uuid.uuid4().hex, self.known()
        journal, part = self.folder / "journal" / run_id, self.folder / "parts" / run_id

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            journal.mkdir(parents=True, exist_ok=True)
            for b in batches:
                values = []
                for key, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    at = journal / key
                    try:
                        values.append(at.read_text(encoding="utf-8"))
                        continue
                    except FileNotFoundError:
                        pass
                    try:
                        value = ask(payload)
                    except Exception:
                        value = None
                    values.append(value)
                    if value is not None:
                        draft = journal / f".{key}.{uuid.uuid4().hex}"
                        draft.write_text(value, encoding="utf-8", newline="")
                        os.replace(draft, at)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(values, pa.string())], names=["key", "value"])

        each = wanted.select("key", "payload").where("payload is not null").groupBy("key").agg(F.min("payload").alias("payload"))
        each.join(known, "key", "left_anti").mapInArrow(run, "key string, value string").write.parquet(str(part))
        new = self.spark.read.schema("key string, value string").parquet(str(part))
        found = known.select("key", "value", F.lit(True).alias("cached")).unionByName(new.withColumn("cached", F.lit(False)))
        self._drop(journal)
        return each.select("key").join(found, "key")

    def _drop(self, journal: Path) -> None:
        for p in journal.glob("*") if journal.exists() else ():
            p.unlink(missing_ok=True)
        for p in journal.glob(".*") if journal.exists() else ():
            p.unlink(missing_ok=True)
        if journal.exists():
            journal.rmdir()

    def compact(self) -> None:
        """All answers in one part, without journals; for when no run is at work."""
        name, before, journals = uuid.uuid4().hex, list((self.folder / "parts").glob("*")), self._journals()
        self.known().write.parquet(str(self.folder / "parts" / name))
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for p in before:
            at = hadoop.Path(str(p))
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
        for p in journals:
            self._drop(p)
