"""Evaluating new titles against their segment.

The job's rule for a candidate: add it to its segment, score it with the
segment's lists computed *without* it, and min-max scale over the segment
*with* it. Since adding one title changes the segment's range only by that
title's own points ``c``, the scaled value is closed-form::

    lo = least(min_points, c), hi = greatest(max_points, c)

so any number of candidates is one map-only pass joined to two small
per-segment tables, with no copy of the catalogue per candidate.
:func:`candidate_success_union` keeps the literal union form as a cross-check.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.scoring import SUCCESS_HIGH, SUCCESS_LOW, YEAR_BANDS, success
from marquee.functions.text import description_tokens
from marquee.operators.score import join_on_keys, score_titles
from marquee.plans.materialize import materialize
from marquee.sources.catalog import SEGMENT_KEYS, TEXT_COLUMNS


def prepare_candidates(candidates: DataFrame, stop_words: Iterable[str] | None = None) -> DataFrame:
    """Candidates plus their cleaned description tokens."""
    stops = None if stop_words is None else list(stop_words)
    return candidates.withColumn("desc_tokens", description_tokens("description", stops))


def catalog_with_candidates(prepared: DataFrame, prepared_candidates: DataFrame) -> DataFrame:
    """Bag union of catalogue titles and candidates on the six common columns.

    ``is_candidate`` tells them apart and ``row_id`` is ``title_id`` or ``cand_id``.
    """
    cols = [*TEXT_COLUMNS, "description_scraped"]

    def side(df: DataFrame, id_col: str, flag: bool) -> DataFrame:
        return df.select(
            "platform", "type", F.lit(flag).alias("is_candidate"),
            F.col(id_col).cast("bigint").alias("row_id"),
            *TEXT_COLUMNS,
            F.array_join("desc_tokens", " ").alias("description_scraped"),
        ).select("platform", "type", "is_candidate", "row_id", *cols)

    return side(prepared, "title_id", False).unionByName(side(prepared_candidates, "cand_id", True))


def _widened(joined: DataFrame, target: tuple[float, float]) -> DataFrame:
    """``(cand_id, title, sucesso)``: scaled over the segment's range widened by the candidate's points."""
    total = F.col("total_points")
    lo, hi = F.least("min_points", total), F.greatest("max_points", total)
    return joined.select("cand_id", "title", success(total, lo, hi, target).alias("sucesso"))


def candidate_success(prepared_candidates: DataFrame, maps: DataFrame, stats: DataFrame,
                      keys: Sequence[str] = SEGMENT_KEYS, stop_words: Iterable[str] | None = None,
                      year_bands: Sequence[tuple[int, int, int]] = YEAR_BANDS,
                      target: tuple[float, float] = (SUCCESS_LOW, SUCCESS_HIGH)) -> DataFrame:
    """``(cand_id, title, sucesso)`` for every candidate, in one pass.

    ``maps`` are the segment's weight maps and ``stats`` its min/max points,
    both computed from the catalogue without candidates. A candidate whose
    segment has no titles scores on the year alone and gets the middle of the target.
    """
    scored = score_titles(prepared_candidates, maps, keys, stop_words, year_bands)
    return _widened(join_on_keys(scored, stats, keys, "left"), target)


def candidate_success_union(prepared: DataFrame, prepared_candidates: DataFrame,
                            maps: DataFrame, keys: Sequence[str] = SEGMENT_KEYS,
                            stop_words: Iterable[str] | None = None,
                            year_bands: Sequence[tuple[int, int, int]] = YEAR_BANDS,
                            target: tuple[float, float] = (SUCCESS_LOW, SUCCESS_HIGH),
                            tables: list[str] | None = None) -> DataFrame:
    """The literal form, for every candidate.

    Candidates are united with their segment and scored in one pass with the
    lists of the segment without them. The ranges come from the same scored
    rows, over titles only; each candidate then widens its segment's range by its own
    points, as if it alone had been added.
    """
    titles = prepared.drop("description").withColumn("cand_id", F.lit(None).cast("bigint"))
    union = titles.unionByName(prepared_candidates.drop("description").withColumn(
        "title_id", F.lit(None).cast("bigint")), allowMissingColumns=True)
    scored = score_titles(union, maps, keys, stop_words, year_bands)
    # A candidate's title goes on; the titles' own text is not needed again.
    scored = materialize(scored.select(*keys, "cand_id", F.when(F.col("cand_id").isNotNull(), F.col("title")).alias(
        "title"), "total_points"), "union_scored", tables)
    of_titles = F.when(F.col("cand_id").isNull(), F.col("total_points"))
    stats = scored.groupBy(*keys).agg(F.min(of_titles).alias("min_points"), F.max(of_titles).alias("max_points"))
    return _widened(join_on_keys(scored.filter(F.col("cand_id").isNotNull()), stats, keys, "left"), target)
