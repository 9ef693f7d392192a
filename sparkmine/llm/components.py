"""Connected components of an edge table by alternating large-star and small-star rounds
(Kiveris et al., 2014). Every round is a partial aggregate and a join on narrow rows; a
node with very many edges is joined by a shuffle join that Spark can split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import materialised


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")).withColumn("m", F.least("m", "c"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    star = both.join(_least_neighbour(both), F.col("u") == F.col("c")).filter("v > u")
    return star.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = _least_neighbour(edges)
    star = edges.join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return star.union(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).filter("u > v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge to another one; root is the smallest
    node of its component. ``edges``: two columns of one orderable type; loops, repeated
    and reversed edges don't matter. Each round is written to the shared folder."""
    a, b = edges.columns
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    now, seen = materialised(now, "edges"), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        now = materialised(_small_star(_large_star(now)), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
