"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.shared import checkpointed, swept


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v) with u > v; every group is reduced by min, never gathered."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = both.join(low, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the smallest node of its component.

    Nodes may be of any orderable type. Self links and repeated links are harmless;
    no links give no rows. Lineage is cut after each round in the shared folder.
    """
    links = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links, before = checkpointed(links), None
    for _ in range(rounds):
        links = checkpointed(_star(_star(links, True), False))
        swept(links.sparkSession)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def rooted(rows: DataFrame, roots: DataFrame, column: str) -> DataFrame:
    """rows with the root of a column's node; a node without links is its own."""
    return rows.join(roots.select(F.col("node").alias(column), "root"), column, "left").withColumn("root", F.coalesce("root", column))


def joined(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) after edges (a, b) are added; only the roots that they join are looked at."""
    ends = rooted(edges.select("a", "b"), roots, "a").select("b", F.col("root").alias("a_root"))
    ends = rooted(ends, roots, "b").select(F.col("a_root").alias("a"), F.col("root").alias("b"))
    more = components(ends)
    moved = roots.join(more.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return checkpointed(moved.unionByName(more.join(roots.select("node"), "node", "left_anti").select("node", "root")))
