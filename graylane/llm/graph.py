"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from graylane.llm.common import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours move to its smallest neighbour: the larger ones (large) or the smaller ones and itself."""
    e = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    # the sums move at most one row for each node and task; a node with very many edges is a skewed join that Spark splits
    moved = e.join(least, "u")
    if large:
        return moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    return moved.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))


def _counted(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The written edges, with their number and a sum of hashes observed as they are written: no job of its own."""
    seen = Observation()
    sums = F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    return written(edges.observe(seen, *sums), "graph-edges"), seen.get


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of the edges (u, v), the smallest node that it reaches. Self edges and null ends are dropped."""
    edges, now = _counted(edges.filter("u is not null and v is not null and u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while now != before:
        before = now
        # rows that both halves of a round make twice go in the distinct at its end
        half = _stars(edges, True).filter("u != v")
        edges, now = _counted(_stars(half, False).filter("u != v").select("u", "v").distinct())
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
