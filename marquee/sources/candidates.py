"""Candidate titles: new titles to evaluate against their segment.

Columns: ``cand_id bigint, platform, type, title, listed_in, release_year,
rating, description`` (all strings after the id). Any number of candidates,
in any number of segments, are evaluated in one pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sources.catalog import TEXT_COLUMNS, _read

CANDIDATE_COLUMNS: tuple[str, ...] = ("cand_id", "platform", "type") + TEXT_COLUMNS

CANDIDATE_SCHEMA = T.StructType(
    [T.StructField("cand_id", T.LongType(), False)]
    + [T.StructField(n, T.StringType(), True) for n in CANDIDATE_COLUMNS[1:]]
)


def candidates_from_rows(spark: SparkSession, rows: Iterable[Mapping[str, object]]) -> DataFrame:
    """Candidates typed by hand (a few dicts) as a frame with a declared schema.

    Missing fields are null, columns come out in a fixed order whatever the
    dict order, and a row without ``cand_id`` is numbered by position.
    """
    data = []
    for i, row in enumerate(rows):
        cand_id = row.get("cand_id", i)
        values = [None if row.get(n) is None else str(row.get(n)) for n in CANDIDATE_COLUMNS[1:]]
        data.append((int(cand_id), *values))
    return spark.createDataFrame(data, CANDIDATE_SCHEMA)


def candidates_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test candidates: one per ``benchmark`` row, spread over the segments (FIXTURES.md §3)."""
    item = F.col("item_id")
    platform = (F.when(item % 4 == 0, "de").when(item % 4 == 1, "en")
                .when(item % 4 == 2, "es").otherwise("fr"))
    genres = (F.when(item % 3 == 0, F.lit("red rod, small anvil"))
              .when(item % 3 == 1, F.lit("Red Rod")))
    return _read(spark, sf_dir, "benchmark").select(
        item.alias("cand_id"),
        platform.alias("platform"),
        F.when(item % 8 < 4, "Movie").otherwise("TV Show").alias("type"),
        F.substring_index("text", ".", 1).alias("title"),
        genres.alias("listed_in"),
        (F.lit(2014) + item % 12).cast("string").alias("release_year"),
        F.lit("src0").alias("rating"),
        F.col("text").alias("description"),
    )
