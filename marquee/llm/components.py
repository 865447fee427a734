"""Connected components of a graph given as edges, by alternating large and small stars.

Each round links every node's neighbours to the least node it sees; rounds
are logarithmic in practice. The least neighbour of a node is a partial
aggregation and reaches the edges by a join, so a node of very many edges is
never gathered in one task. Rounds are written to the shared folder, and only the last one stays there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.plans.materialize import materialize, remove_tables


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("w")).select(
        F.col("u").alias("x"), F.least("u", "w").alias("m"))
    return (both.join(least, both.u == least.x).filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v")
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), "m")
    joined = down.join(least, down.u == least.x)
    own = least.select(F.col("x").alias("u"), F.col("m").alias("v"))
    return own.union(joined.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")))


def components(edges: DataFrame, u: str, v: str, name: str = "stars") -> DataFrame:
    """``(node, root)`` of every node that has an edge to another; ``root`` is the least node reachable.

    Loops and repeated edges do not matter; null ends are dropped.
    """
    spark, paths = edges.sparkSession, []
    now = materialize(edges.select(F.col(u).alias("u"), F.col(v).alias("v"))
                      .filter("u is not null and v is not null and u != v").distinct(), name, paths)
    before = None
    while True:
        now = materialize(_small_star(_large_star(now)).distinct(), name, paths)
        remove_tables(spark, paths[:-1])  # nothing reads the round before any more
        paths = paths[-1:]
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select("v", "v").distinct())
        before = state
