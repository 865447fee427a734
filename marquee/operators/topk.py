"""Most frequent terms per segment.

A term list is counted by exploding a token array, counting occurrences with a
partial (map-side) then final aggregation on ``(segment, term)``, and ranking
per segment with ``row_number``. The ``rank <= n`` filter lets Spark plan a
``WindowGroupLimit`` on both sides of the shuffle, so at most ``n`` rows per
segment leave each task: a segment holding a third of all titles does not
become one huge window task.

Ties are broken by the term (code-point order), which makes the lists a total
order: ``count DESC, term ASC``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.text import genre_terms, title_vocabulary_tokens
from marquee.operators.stops import without_stops
from marquee.sources.catalog import SEGMENT_KEYS

# List sizes of the three rankings.
TOP_DESCRIPTION_WORDS = 10
TOP_GENRES = 5
TOP_TITLE_WORDS = 10

# The list name of a segment's own row among its ranked lists.
SEGMENT = "segment"


def term_counts(df: DataFrame, terms: Column, term_name: str,
                keys: Sequence[str] = SEGMENT_KEYS) -> DataFrame:
    """``(keys..., term, count)``: occurrences of each term (not distinct titles) per segment.

    ``explode_outer`` plus a null filter equals ``explode`` here (token arrays
    hold no nulls), but stops Catalyst from inferring a ``size(tokens) > 0``
    filter that would tokenise every text a second time below the shuffle.
    """
    exploded = (df.select(*keys, F.explode_outer(terms).alias(term_name))
                .filter(F.col(term_name).isNotNull()))
    return exploded.groupBy(*keys, term_name).agg(F.count(F.lit(1)).alias("count"))


def rank_terms(counts: DataFrame, term_name: str, n: int,
               keys: Sequence[str] = SEGMENT_KEYS) -> DataFrame:
    """Keep the ``n`` most frequent terms per segment, numbered from 1.

    With no keys the ranking is global and planned as a top-k sort
    (``TakeOrderedAndProject``), never as an unpartitioned window.
    """
    order = [F.col("count").desc(), F.col(term_name).asc()]
    if not keys:
        return counts.orderBy(*order).limit(n).select(term_name, "count")
    window = Window.partitionBy(*keys).orderBy(*order)
    return (counts.withColumn("rank", F.row_number().over(window))
            .filter(F.col("rank") <= n)
            .select(*keys, "rank", term_name, "count"))


def top_terms(df: DataFrame, terms: Column, term_name: str, n: int,
              keys: Sequence[str] = SEGMENT_KEYS, stops: DataFrame | None = None) -> DataFrame:
    counts = term_counts(df, terms, term_name, keys)
    if stops is not None:
        counts = without_stops(counts, term_name, stops)
    return rank_terms(counts, term_name, n, keys)


def top_description_words(prepared: DataFrame, n: int = TOP_DESCRIPTION_WORDS,
                          keys: Sequence[str] = SEGMENT_KEYS, stops: DataFrame | None = None) -> DataFrame:
    """``(keys..., rank, word, count)`` over the cleaned descriptions (``desc_tokens``)."""
    return top_terms(prepared, F.col("desc_tokens"), "word", n, keys, stops)


def top_genres(catalog: DataFrame, n: int = TOP_GENRES,
               keys: Sequence[str] = SEGMENT_KEYS) -> DataFrame:
    """``(keys..., rank, genre, count)``: genres split on ',' and trimmed."""
    return top_terms(catalog, genre_terms(F.col("listed_in")), "genre", n, keys)


def top_title_words(catalog: DataFrame, n: int = TOP_TITLE_WORDS,
                    keys: Sequence[str] = SEGMENT_KEYS,
                    stop_words: Iterable[str] | None = None, stops: DataFrame | None = None) -> DataFrame:
    """``(keys..., rank, word, count)`` over the title vocabulary tokens."""
    return top_terms(catalog, title_vocabulary_tokens("title", stop_words), "word", n, keys, stops)


def segment_lists(prepared: DataFrame,
                  sizes: tuple[int, int, int] = (TOP_DESCRIPTION_WORDS, TOP_GENRES, TOP_TITLE_WORDS),
                  keys: Sequence[str] = SEGMENT_KEYS,
                  stop_words: Iterable[str] | None = None, stops: DataFrame | None = None) -> DataFrame:
    """All three ranked lists in one scan and one aggregation: ``(keys..., list, rank, term, count)``.

    The ranks of :func:`list_counts`. ``stops`` is a table of further stop words
    (:mod:`marquee.operators.stops`), taken out of the counted words.
    """
    counts = list_counts(prepared, keys, stop_words)
    if stops is not None:
        counts = without_stops(counts, "term", stops, F.col("list").isin("description", "title"))
    return rank_lists(counts, sizes, keys)


def list_counts(prepared: DataFrame, keys: Sequence[str] = SEGMENT_KEYS,
                stop_words: Iterable[str] | None = None, weight: Column | None = None) -> DataFrame:
    """Counts of all terms of the three lists in one scan and one aggregation: ``(keys..., list, term, count)``.

    ``list`` is ``description``, ``genre`` or ``title``, and ``SEGMENT`` for one
    more row per segment whose count is the number of its titles. Each title
    first becomes four ``(list, terms)`` rows (``inline``), then each row's
    array is exploded: the catalogue is read, and its text tokenised, once,
    with no per-token tagging. ``weight`` is what an occurrence counts (1; -1 for rows that are taken away).
    """
    def part(name: str, terms: Column) -> Column:
        return F.struct(F.lit(name).alias("list"), terms.alias("terms"))

    parts = F.array(
        part("description", F.col("desc_tokens")),
        part("genre", genre_terms(F.col("listed_in"))),
        part("title", title_vocabulary_tokens("title", stop_words)),
        part(SEGMENT, F.array(F.lit(""))),
    )
    tag = [] if weight is None else [weight.alias("__weight")]
    exploded = (prepared.select(*keys, *tag, F.inline(parts))
                .select(*keys, *[F.col("__weight") for _ in tag], "list", F.explode_outer("terms").alias("term"))
                .filter(F.col("term").isNotNull()))
    counted = F.count(F.lit(1)) if weight is None else F.sum("__weight")
    return exploded.groupBy(*keys, "list", "term").agg(counted.alias("count"))


def rank_lists(counts: DataFrame, sizes: tuple[int, int, int] = (TOP_DESCRIPTION_WORDS, TOP_GENRES, TOP_TITLE_WORDS),
               keys: Sequence[str] = SEGMENT_KEYS) -> DataFrame:
    """``(keys..., list, rank, term, count)``: the most frequent terms of each list, from :func:`list_counts`."""
    n_desc, n_genre, n_title = sizes
    limit = (F.when(F.col("list") == "description", n_desc)
             .when(F.col("list") == "genre", n_genre).when(F.col("list") == "title", n_title).otherwise(1))
    window = Window.partitionBy(*keys, "list").orderBy(F.col("count").desc(), F.col("term").asc())
    # The literal bound lets Spark plan a WindowGroupLimit around the shuffle.
    return (counts.withColumn("rank", F.row_number().over(window))
            .filter(F.col("rank") <= max(*sizes, 1))
            .filter(F.col("rank") <= limit)
            .select(*keys, "list", "rank", "term", "count"))
