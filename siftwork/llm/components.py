"""Connected components of a graph given as pairs, by large-star and small-star rounds until nothing changes.

Every round is two joins on a vertex and two partial aggregates; no neighbourhood is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """``pairs`` (u long, v long) as one row (id, root) for every vertex in a pair of two; root is the least id it is linked to."""
    edges = staged(pairs.select("u", "v").filter(F.col("u") != F.col("v")).distinct(), "components")
    mark = None
    while True:
        edges = staged(_small_star(_large_star(edges)), "components")
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
