"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node onto the node's least neighbour (or itself)."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("_m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.least("_m", "u").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours onto the least of them (edges run downwards: u > v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("_m"))
    moved = edges.join(least, "u")
    down = moved.where("v <> _m").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return down.unionAll(least.select("u", F.col("_m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (u, v: longs), label = least node reachable.

    Edges are contracted until every node hangs on its label; each round is a
    written table, and the work of a hub is spread by partial aggregation and
    joins that Spark can split. Loops (u = v) and repeated edges do no harm."""
    down = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, state = written(down, "components"), None
    while True:
        then = state
        now = written(_small_star(_large_star(now)), "components")
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == then:
            roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("label"))
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(roots)
