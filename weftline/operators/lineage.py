"""Where jobs keep what they cut their lineage with."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir; a folder of this process where it names none.

    The latter serves tests on one machine only: a session whose master is not local must name one.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if not named and not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not named and not context._jsc.sc().getCheckpointDir().isEmpty():
        named = context._jsc.sc().getCheckpointDir().get()
    return (named or tempfile.mkdtemp(prefix="weftline-")).rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut, kept in the shared folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def swept(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files and checkpoints that nothing refers to any more.

    Its cleaner learns of them when the driver collects garbage, which a driver that holds
    little does rarely; jobs of many rounds would keep all rounds on the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
