"""Ranks of all rows of a segment, not only the best.

``row_number`` over a segment sorts the whole segment in one task. Here rows
are dealt by range of (segment, order) and sorted, so a segment spreads over as many
tasks as its rows need; a row's rank is its place in its task plus the
segment's rows in the tasks before (a prefix sum of one number a task and segment).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators.score import join_on_keys
from marquee.plans.materialize import materialize
from marquee.sources.catalog import SEGMENT_KEYS


def ranked(df: DataFrame, order: Sequence[Column], keys: Sequence[str] = SEGMENT_KEYS, name: str = "rank",
           paths: list[str] | None = None) -> DataFrame:
    """``df`` with ``name``: the place of each row in its segment in ``order``, from 1, as ``row_number`` gives it.

    ``order`` should tell rows apart: rows that are equal in it are ranked in any order, and all go to one task.
    """
    bounds = [F.col(k).asc() for k in keys] + list(order)
    dealt = df.repartitionByRange(*bounds).sortWithinPartitions(*bounds)
    placed = materialize(dealt.withColumn("__at", F.monotonically_increasing_id()), "ranked", paths)
    placed = placed.withColumn("__task", F.shiftright("__at", 33))
    shares = placed.groupBy(*keys, "__task").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__size"))
    before = Window.partitionBy(*keys).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    shares = materialize(shares.withColumn("__before", F.coalesce(F.sum("__size").over(before), F.lit(0))),
                         "shares", paths)  # one row a task and segment
    joined = join_on_keys(placed, shares.drop("__size"), [*keys, "__task"], "inner")
    rank = F.col("__at") - F.col("__first") + F.col("__before") + 1
    return joined.withColumn(name, rank.cast("bigint")).drop("__at", "__task", "__first", "__before")
