"""Row numbers over a whole table, without one task or the driver seeing it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.lineage import checkpointed

#: Bits of monotonically_increasing_id that count rows within a partition.
_WITHIN = 33


def numbered(df: DataFrame, order: Sequence[str | Column], name: str = "_row") -> DataFrame:
    """df with the number of each row, from 0, in the given order; rows that tie are numbered in some order.

    The table is sorted by range once and kept. A row's number is its place in its
    partition and the rows of the partitions before, of which there are as many as tasks.
    """
    placed = checkpointed(df.orderBy(*order).withColumn(name, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(name), _WITHIN)
    sizes = placed.groupBy(part.alias("part")).count().orderBy("part").collect()  # one row a task
    starts, total = [], 0
    for r in sizes:
        starts.append((r.part, total))
        total += r["count"]
    if not starts:
        return placed
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    within = F.col(name).bitwiseAND(F.lit((1 << _WITHIN) - 1))
    return placed.join(F.broadcast(offsets), part == F.col("_part")).withColumn(name, F.col("_start") + within).drop("_part", "_start")
