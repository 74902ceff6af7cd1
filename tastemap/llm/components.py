"""Connected components of an edge table by alternating star contraction.

Every round shrinks the graph towards one star per component with two shuffles of the
edges; nothing but two counters reaches the driver, and each round starts from a table
written in the shared folder, so a lost executor costs at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _minima(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node sends its larger neighbours to the smallest node it sees."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _minima(both).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node sends itself and its smaller neighbours to the smallest of them."""
    least = _minima(edges)
    moved = (edges.join(least, "u").filter("v > m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two integer columns, any direction,
    repeats and self loops allowed); root is the smallest node it can reach.  Nodes
    without an edge to another node are absent.  Null ends are ignored."""
    a, b = edges.columns[:2]
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("a"), F.col(b).alias("b"))
         .filter("a is not null and b is not null and u > v").select("u", "v").distinct())
    e = written(e, "cc")
    state = _state(e)
    while state[0]:
        e = written(_small_star(_large_star(e)), "cc")
        now = _state(e)
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
