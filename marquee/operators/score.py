"""Segments, scoring, scaling and the best titles.

Scoring never explodes the catalogue: each title keeps its token arrays and
looks its terms up in its segment's weight maps (one small row per segment,
joined on the segment keys), so scoring is a map-only stage over the titles.
Only the per-segment statistics aggregate, with partial aggregation before
their (tiny) shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.scoring import (SUCCESS_HIGH, SUCCESS_LOW, YEAR_BANDS, success, weighted_sum,
                                       year_points)
from marquee.functions.text import description_tokens, genre_score_terms, title_score_tokens
from marquee.sources.catalog import (CATALOG_COLUMNS, SEGMENT_KEYS, SEGMENT_TYPES, TEXT_COLUMNS,
                                     segment_filter)

# Number of best titles kept per segment.
TOP_TITLES = 15

# The criteria's columns, in order.
POINT_COLUMNS: tuple[str, ...] = (
    "points_criterion_1", "points_criterion_2", "points_criterion_3", "points_criterion_4",
)
OUTPUT_COLUMNS: tuple[str, ...] = TEXT_COLUMNS + POINT_COLUMNS + ("total_points", "sucesso")


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 how: str = "left") -> DataFrame:
    """Equi-join on the segment keys, null-safe, keeping the left side's key columns.

    The right side is expected to be one small row per segment (a written
    table): the planner broadcasts it when its real size allows.
    """
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    joined = left.join(r, cond, how)
    return joined.drop(*[f"__r_{k}" for k in keys])


def prepare(catalog: DataFrame, stop_words: Iterable[str] | None = None,
            types: Sequence[str] = SEGMENT_TYPES) -> DataFrame:
    """Segment filter plus the cleaned description tokens (``desc_tokens``).

    Unused columns are pruned by Catalyst wherever this frame is read.
    """
    stops = None if stop_words is None else list(stop_words)
    return segment_filter(catalog, types).select(
        *CATALOG_COLUMNS, description_tokens("description", stops).alias("desc_tokens"))


def segment_sizes(catalog: DataFrame, keys: Sequence[str] = SEGMENT_KEYS,
                  types: Sequence[str] = SEGMENT_TYPES) -> DataFrame:
    """``(keys..., n)``: titles per segment after the type filter."""
    return segment_filter(catalog, types).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def desc_clean(prepared: DataFrame) -> DataFrame:
    """``(title_id, description_scraped)``: the cleaned description text."""
    return prepared.select("title_id", F.array_join("desc_tokens", " ").alias("description_scraped"))


def criteria(stop_words: Iterable[str] | None = None,
             year_bands: Sequence[tuple[int, int, int]] = YEAR_BANDS) -> dict[str, Column]:
    """The four criteria as columns over a prepared frame joined to its segment's maps.

    1. description: sum of the description-word weights over every cleaned word;
    2. genres: sum of genre weights over the stripped, comma-split genres (case-sensitive);
    3. release year: the year band's points (no list needed);
    4. title: sum of the title-word weights over the title's scoring tokens.
    """
    stops = None if stop_words is None else list(stop_words)
    return {
        "points_criterion_1": weighted_sum(F.col("desc_tokens"), F.col("desc_weights")),
        "points_criterion_2": weighted_sum(genre_score_terms(F.col("listed_in")),
                                           F.col("genre_weights")),
        "points_criterion_3": year_points(F.col("release_year"), year_bands),
        "points_criterion_4": weighted_sum(title_score_tokens("title", stops),
                                           F.col("title_weights")),
    }


def score_titles(prepared: DataFrame, maps: DataFrame, keys: Sequence[str] = SEGMENT_KEYS,
                 stop_words: Iterable[str] | None = None,
                 year_bands: Sequence[tuple[int, int, int]] = YEAR_BANDS) -> DataFrame:
    """Add the four criteria (see :func:`criteria`) and their sum ``total_points``."""
    joined = join_on_keys(prepared, maps, keys, "left")
    scored = joined.withColumns(criteria(stop_words, year_bands))
    total = sum((F.col(c) for c in POINT_COLUMNS[1:]), F.col(POINT_COLUMNS[0]))
    return scored.withColumn("total_points", total.cast("int")).drop(
        "desc_weights", "genre_weights", "title_weights")


def score_one(prepared: DataFrame, name: str, maps: DataFrame | None = None,
              keys: Sequence[str] = SEGMENT_KEYS,
              stop_words: Iterable[str] | None = None,
              year_bands: Sequence[tuple[int, int, int]] = YEAR_BANDS) -> DataFrame:
    """``(title_id, <name>)``: one criterion alone, joined only to the maps it reads."""
    rule = criteria(stop_words, year_bands)[name]
    df = prepared if maps is None else join_on_keys(prepared, maps, keys, "left")
    return df.select("title_id", rule.alias(name))


def segment_stats(scored: DataFrame, keys: Sequence[str] = SEGMENT_KEYS) -> DataFrame:
    """``(keys..., min_points, max_points)`` of ``total_points`` per segment."""
    return scored.groupBy(*keys).agg(F.min("total_points").alias("min_points"),
                                     F.max("total_points").alias("max_points"))


def scale_success(scored: DataFrame, stats: DataFrame, keys: Sequence[str] = SEGMENT_KEYS,
                  target: tuple[float, float] = (SUCCESS_LOW, SUCCESS_HIGH)) -> DataFrame:
    """Add ``sucesso``: ``total_points`` min-max scaled into the target range within the segment."""
    joined = join_on_keys(scored, stats, keys, "left")
    return joined.withColumn(
        "sucesso", success(F.col("total_points"), F.col("min_points"), F.col("max_points"), target)
    ).drop("min_points", "max_points")


def top_titles(scored: DataFrame, n: int = TOP_TITLES,
               keys: Sequence[str] = SEGMENT_KEYS) -> DataFrame:
    """The ``n`` best titles per segment, by ``total_points DESC, title, title_id, description``.

    ``row_number() <= n`` is planned as a ``WindowGroupLimit`` before and after
    the shuffle, so at most ``n`` rows per segment and task are shuffled, with
    their descriptions.
    """
    order = [F.col("total_points").desc(), *[F.col(c).asc() for c in ("title", "title_id", "description")]]
    window = Window.partitionBy(*keys).orderBy(*order)
    return (scored.withColumn("__rank", F.row_number().over(window))
            .filter(F.col("__rank") <= n).drop("__rank"))
