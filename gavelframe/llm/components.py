"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelframe.session import cut


def components(links: DataFrame, one: str, other: str) -> DataFrame:
    """node, component: every node of a link with the smallest node it is connected to.

    Each round links all larger neighbours of a node to its smallest one, then
    all smaller ones, until nothing changes; the links then are stars around
    the components. The minimum per node is an aggregate, so a node with many
    links is combined within each task. Every round is a written table.
    """
    edges = cut(links.select(F.greatest(one, other).alias("u"), F.least(one, other).alias("v")).where("u <> v").distinct(), "links")
    state = _fingerprint(edges)
    while state[0]:
        edges = cut(_small_star(_large_star(edges)), "links")
        before, state = state, _fingerprint(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return cut(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots), "components")


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    low = F.sum((F.xxhash64("u", "v") % 1_000_000_007).cast("long"))
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(low, F.lit(0)).alias("hash")).head()
    return row["n"], row["hash"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(kept).where("u <> v").distinct()
