"""Rank weights and per-segment weight maps.

A ranked list becomes ``term -> weight`` with ``weight = (base + 1 - rank) * step``.
The defaults reproduce the job's weights: description words 10, 9, ... ;
genres 25, 20, 15, 10, 5; title words 10, 9, ... . ``base`` is the size asked
of the list, not the number of terms found, so three words of a top 10 still
weigh 10, 9, 8, and the last rank of any size weighs one step.

The three lists of a segment are folded into one row holding three
``map<string,int>`` columns. That table has one row per segment and at most
``n`` entries per map, so a scoring join against it is a broadcast join when
its size allows (see :mod:`marquee.plans.materialize`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.topk import TOP_DESCRIPTION_WORDS, TOP_GENRES, TOP_TITLE_WORDS
from marquee.sources.catalog import SEGMENT_KEYS

Spec = tuple[str, str, int, int]

# Steps between ranks of the three lists (description words, genres, title words).
STEPS: tuple[int, int, int] = (1, 5, 1)


def specs_of(sizes: Sequence[int], steps: Sequence[int] = STEPS) -> tuple[Spec, Spec, Spec]:
    """``(list name, term column, base, step)`` of the three lists, given their sizes and steps."""
    names = (("description", "word"), ("genre", "genre"), ("title", "word"))
    return tuple((*name, n, step) for name, n, step in zip(names, sizes, steps))


DESCRIPTION, GENRE, TITLE = specs_of((TOP_DESCRIPTION_WORDS, TOP_GENRES, TOP_TITLE_WORDS))

MAP_COLUMNS = {"description": "desc_weights", "genre": "genre_weights", "title": "title_weights"}


def list_weights(ranked: DataFrame, spec: tuple[str, str, int, int],
                 keys: Sequence[str] = SEGMENT_KEYS) -> DataFrame:
    """``(keys..., list, term, weight)`` for one ranked list."""
    name, term_col, base, step = spec
    weight = ((F.lit(base + 1) - F.col("rank")) * F.lit(step)).cast("int")
    return ranked.select(*keys, F.lit(name).alias("list"),
                         F.col(term_col).alias("term"), weight.alias("weight"))


def weights_from_lists(lists: DataFrame, keys: Sequence[str] = SEGMENT_KEYS,
                       specs: tuple = (DESCRIPTION, GENRE, TITLE)) -> DataFrame:
    """``(keys..., list, term, weight)`` from the fused lists of ``segment_lists``."""
    lists = lists.filter(F.col("list").isin([name for name, *_ in specs]))
    weight = None
    for name, _, base, step in specs:
        w = (F.lit(base + 1) - F.col("rank")) * F.lit(step)
        weight = F.when(F.col("list") == name, w) if weight is None else weight.when(F.col("list") == name, w)
    return lists.select(*keys, "list", "term", weight.cast("int").alias("weight"))


def weight_maps(weights: DataFrame, keys: Sequence[str] = SEGMENT_KEYS) -> DataFrame:
    """One row per segment: ``desc_weights``, ``genre_weights``, ``title_weights`` maps.

    A segment without entries for a list gets an empty map.
    """
    def one(list_name: str):
        entry = F.when(F.col("list") == list_name, F.struct("term", "weight"))
        # collect_list skips the nulls of the other lists.
        return F.map_from_entries(F.collect_list(entry)).alias(MAP_COLUMNS[list_name])

    return weights.groupBy(*keys).agg(one("description"), one("genre"), one("title"))
