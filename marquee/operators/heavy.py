"""Top terms in two passes: mergeable heavy-hitter summaries, then an exact recount.

Counting every term shuffles a row per distinct term, segment and task. Instead

1. each task keeps a frequent-items summary of at most ``tracked`` terms per
   segment; summaries merge, and only they are shuffled. Of ``N`` tokens, a
   summary misjudges no term by more than ``ERROR / tracked * N``, and a term it does
   not report has at most twice that many occurrences;
2. the reported terms that can be among the best are counted exactly.

A segment's list is proven when its last exact count is above what an
unreported term can have; ties at the cut are then known as well. Segments whose lists are not proven (few
tokens, or a flat distribution) are counted in full: the bound decides, not a size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators.score import join_on_keys
from marquee.operators.topk import rank_terms, term_counts
from marquee.plans.materialize import materialize
from marquee.sources.catalog import SEGMENT_KEYS

TRACKED = 10_000
# The summary's guarantee: 3.5 tokens per slot, with at most three quarters of the slots in use.
ERROR = 3.5 * 0.75


def summaries(df: DataFrame, terms: Column, tracked: int = TRACKED, keys: Sequence[str] = SEGMENT_KEYS) -> DataFrame:
    """``(keys..., tokens, reported)``: a segment's number of tokens and its frequent terms with estimates."""
    exploded = df.select(*keys, F.explode_outer(terms).alias("term")).filter(F.col("term").isNotNull())
    return exploded.groupBy(*keys).agg(F.count(F.lit(1)).alias("tokens"),
                                       F.call_function("approx_top_k", F.col("term"), F.lit(tracked), F.lit(tracked))
                                       .alias("reported"))


def candidates(summary: DataFrame, n: int, tracked: int = TRACKED, keys: Sequence[str] = SEGMENT_KEYS) -> DataFrame:
    """``(keys..., term, unseen)``: the reported terms that can be among the ``n`` best.

    ``unseen`` is the most occurrences that an unreported term of the segment can have.
    """
    unseen = F.col("tokens") * F.lit(2 * ERROR / tracked)
    rows = summary.select(*keys, unseen.alias("unseen"), F.inline("reported"))
    best = Window.partitionBy(*keys).orderBy(F.col("count").desc())
    # A segment's reported terms are at most ``tracked`` rows.
    last = F.min(F.when(F.col("__r") <= n, F.col("count"))).over(Window.partitionBy(*keys))
    rows = rows.withColumn("__r", F.row_number().over(best)).withColumn("__last", last)
    return rows.filter(F.col("count") >= F.col("__last") - F.col("unseen")).select(
        *keys, F.col("item").alias("term"), "unseen")


def top_terms_two_pass(df: DataFrame, terms: Column, term_name: str, n: int, tracked: int = TRACKED,
                       keys: Sequence[str] = SEGMENT_KEYS, paths: list[str] | None = None) -> DataFrame:
    """``(keys..., rank, term, count)``: equal to :func:`marquee.operators.topk.top_terms`, ties included.

    ``df`` is read two or three times: give a written table of tokens.
    """
    paths = [] if paths is None else paths
    found = materialize(candidates(summaries(df, terms, tracked, keys), n, tracked, keys), "frequent", paths)
    wanted = found.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("term").alias("__term"), "unseen")
    exploded = df.select(*keys, F.explode_outer(terms).alias(term_name)).filter(F.col(term_name).isNotNull())
    same = F.col(term_name) == F.col("__term")
    for k in keys:
        same = same & exploded[k].eqNullSafe(wanted[f"__k_{k}"])
    # Counted in each task before the shuffle: a row per candidate and task.
    counts = exploded.join(wanted, same).groupBy(*keys, term_name).agg(
        F.count(F.lit(1)).alias("count"), F.min("unseen").alias("unseen"))
    window = Window.partitionBy(*keys).orderBy(F.col("count").desc(), F.col(term_name).asc())
    ranked = counts.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)
    ranked = materialize(ranked, "recounted", paths)
    proven = materialize(ranked.filter((F.col("rank") == n) & (F.col("count") > F.col("unseen"))).select(*keys)
                         .withColumn("__proven", F.lit(True)), "proven", paths)
    sure = join_on_keys(ranked, proven, keys, "inner").select(*keys, "rank", term_name, "count")
    rest = join_on_keys(df, proven, keys, "left_anti")
    return sure.unionByName(rank_terms(term_counts(rest, terms, term_name, keys), term_name, n, keys))
