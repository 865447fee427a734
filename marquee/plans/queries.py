"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query builds the test catalogue (FIXTURES.md §2) and, where needed, the
test candidates (§3) from the tables in ``sf_dir``, over whole tables.
Column names match :mod:`marquee.plans.oracle` one to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.score import OUTPUT_COLUMNS, POINT_COLUMNS
from marquee.plans.incremental import IncrementalCatalog
from marquee.plans.job import CatalogJob
from marquee.plans.materialize import materialize, remove_tables, scratch_path
from marquee.sources.candidates import CANDIDATE_COLUMNS, candidates_from_tables
from marquee.sources.catalog import (CATALOG_COLUMNS, CSV_READ_OPTIONS, SEGMENT_KEYS, catalog_from_tables,
                                     read_catalog_csv, read_typed_csv)
from marquee.sources.headers import header_classes
from marquee.sources.infer import column_types
from marquee.sources.sinks import (CSV_WRITE_OPTIONS, publish_top_titles_csv, read_published_csv, read_top_titles_csv,
                                   write_top_titles_csv)

Query = Callable[[SparkSession, str], DataFrame]

TOP_TITLE_COLUMNS = [*SEGMENT_KEYS, "title_id", *OUTPUT_COLUMNS]


def job(spark: SparkSession, sf_dir: str, with_candidates: bool = False) -> CatalogJob:
    cands = candidates_from_tables(spark, sf_dir) if with_candidates else None
    return CatalogJob(catalog_from_tables(spark, sf_dir), cands)


def q_catalog(spark, sf_dir):
    return catalog_from_tables(spark, sf_dir).select(*CATALOG_COLUMNS)


def q_segment_sizes(spark, sf_dir):
    return job(spark, sf_dir).segment_sizes()


def q_desc_clean(spark, sf_dir):
    return job(spark, sf_dir).desc_clean()


def q_top_desc_words(spark, sf_dir):
    return job(spark, sf_dir).top_desc_words()


def q_top_desc_words_global(spark, sf_dir):
    return job(spark, sf_dir).top_desc_words(keys=())


def q_top_genres(spark, sf_dir):
    return job(spark, sf_dir).top_genres()


def q_top_title_words(spark, sf_dir):
    return job(spark, sf_dir).top_title_words()


def q_rank_weights(spark, sf_dir):
    return job(spark, sf_dir).rank_weights()


def _points(name: str) -> Query:
    def q(spark, sf_dir):
        return job(spark, sf_dir).criterion(name)
    q.__name__ = f"q_{name}"
    return q


def q_total_points(spark, sf_dir):
    return job(spark, sf_dir).scored.select(
        "title_id", "points_criterion_1", "points_criterion_2", "points_criterion_3",
        "points_criterion_4", "total_points")


def q_segment_stats(spark, sf_dir):
    return job(spark, sf_dir).segment_stats()


def q_success_scaled(spark, sf_dir):
    return job(spark, sf_dir).scaled.select("title_id", "total_points", "sucesso")


def q_top15_titles(spark, sf_dir):
    return job(spark, sf_dir).top_titles().select(*TOP_TITLE_COLUMNS)


def q_candidates(spark, sf_dir):
    return candidates_from_tables(spark, sf_dir).select(*CANDIDATE_COLUMNS)


def q_catalog_with_candidates(spark, sf_dir):
    return job(spark, sf_dir, with_candidates=True).catalog_with_candidates()


def q_candidate_success(spark, sf_dir):
    return job(spark, sf_dir, with_candidates=True).candidate_success()


def q_candidate_success_union(spark, sf_dir):
    return job(spark, sf_dir, with_candidates=True).candidate_success_union()


def q_report_lines(spark, sf_dir):
    return job(spark, sf_dir).report_lines()


def q_csv_round_trip(spark, sf_dir):
    """``top15_titles`` written as per-segment CSV into the shared folder and read back."""
    path = scratch_path(spark, "top15_csv")
    write_top_titles_csv(job(spark, sf_dir).top_titles(), path)
    return read_top_titles_csv(spark, path).select(*TOP_TITLE_COLUMNS)


def _as_csv(spark: SparkSession, sf_dir: str) -> dict[str, list[str]]:
    """The catalogue view written as CSV, per platform in files of two column orders; their paths."""
    path = scratch_path(spark, "catalog_csv")
    catalog = catalog_from_tables(spark, sf_dir)
    names = [c for c in CATALOG_COLUMNS if c != "platform"]
    for part, columns in enumerate((names, names[::-1])):
        half = catalog.filter(F.col("title_id") % 2 == part).select(*columns, "platform")
        # Each task writes its own file a platform: no platform is gathered in one task.
        half.write.partitionBy("platform").options(**CSV_WRITE_OPTIONS).csv(f"{path}/{part}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    platform = F.regexp_extract("path", "/platform=([^/]+)/", 1).alias("platform")
    found: dict[str, list[str]] = {}
    for r in files.select(platform, "path").collect():
        found.setdefault(r.platform, []).append(r.path)
    return found


def q_catalog_csv(spark, sf_dir):
    return read_catalog_csv(spark, _as_csv(spark, sf_dir), "title_id").select(*CATALOG_COLUMNS)


def q_top15_from_csv(spark, sf_dir):
    catalog = read_catalog_csv(spark, _as_csv(spark, sf_dir), "title_id")
    return CatalogJob(catalog).top_titles().select(*TOP_TITLE_COLUMNS)


def q_catalog_inferred(spark, sf_dir):
    """The types of the catalogue's columns, from its CSV files, per platform."""
    names = [c for c in CATALOG_COLUMNS if c != "platform"]
    raw = None
    for platform, _, files in header_classes(spark, _as_csv(spark, sf_dir), CSV_READ_OPTIONS):
        part = spark.read.options(**CSV_READ_OPTIONS).csv(files).select(*names, F.lit(platform).alias("platform"))
        raw = part if raw is None else raw.unionByName(part)
    return column_types(raw, names, ["platform"])


def _orders_as_csv(spark, sf_dir):
    path = scratch_path(spark, "orders_csv")
    spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").write.options(**CSV_WRITE_OPTIONS).csv(path)
    return path


def q_orders_inferred(spark, sf_dir):
    """The types of the orders' columns, from CSV files of them."""
    (_, _, files), = header_classes(spark, {"orders": [_orders_as_csv(spark, sf_dir)]}, CSV_READ_OPTIONS)
    return column_types(spark.read.options(**CSV_READ_OPTIONS).csv(files))


def q_orders_typed(spark, sf_dir):
    """Orders per priority from typed CSV files: keys, dates and prices need no casts."""
    orders = read_typed_csv(spark, _orders_as_csv(spark, sf_dir))
    return orders.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderkey").cast("bigint").alias("last_key"),
        F.min("o_orderdate").cast("date").alias("first_date"), F.max("o_totalprice").alias("largest"))


def _stop_list(spark, sf_dir):
    """A stop list that grows with the tables: every word of ASCII letters of the benchmark texts."""
    texts = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet").select("text")
    words = texts.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word"))
    return words.filter("word != ''")


def _with_stop_table(spark, sf_dir):
    return CatalogJob(catalog_from_tables(spark, sf_dir), stop_words=_stop_list(spark, sf_dir))


def q_top_desc_words_stop_table(spark, sf_dir):
    return _with_stop_table(spark, sf_dir).top_desc_words()


def q_top_title_words_stop_table(spark, sf_dir):
    return _with_stop_table(spark, sf_dir).top_title_words()


def q_desc_clean_stop_table(spark, sf_dir):
    return _with_stop_table(spark, sf_dir).desc_clean()


def q_total_points_stop_table(spark, sf_dir):
    return _with_stop_table(spark, sf_dir).scored.select("title_id", *POINT_COLUMNS, "total_points")


def q_top_desc_words_two_pass(spark, sf_dir):
    return job(spark, sf_dir).top_desc_words_two_pass()


def q_title_ranks(spark, sf_dir):
    return job(spark, sf_dir).title_ranks()


def q_report_lines_global(spark, sf_dir):
    return CatalogJob(catalog_from_tables(spark, sf_dir), keys=()).report_lines()


def q_csv_round_trip_global(spark, sf_dir):
    """``top15_titles_global`` written as one CSV file into the shared folder and read back."""
    path = scratch_path(spark, "top15_csv")
    write_top_titles_csv(CatalogJob(catalog_from_tables(spark, sf_dir), keys=()).top_titles(), path, ())
    return read_top_titles_csv(spark, path, ()).select("title_id", *OUTPUT_COLUMNS)


def q_success_scaled_global(spark, sf_dir):
    return CatalogJob(catalog_from_tables(spark, sf_dir), keys=()).scaled.select(
        "title_id", "total_points", "sucesso")


def q_top15_titles_global(spark, sf_dir):
    return CatalogJob(catalog_from_tables(spark, sf_dir), keys=()).top_titles()


def q_csv_published(spark, sf_dir):
    """``top15_titles`` published twice under fixed names, the second time in place of the first, and read back."""
    path, best = scratch_path(spark, "published"), job(spark, sf_dir).top_titles()
    publish_top_titles_csv(best.filter("total_points > 0"), path)
    publish_top_titles_csv(best, path)
    return read_published_csv(spark, path).select(*TOP_TITLE_COLUMNS)


def _incremental(spark, sf_dir) -> IncrementalCatalog:
    """The catalogue as three batches that cover it and one that repeats some titles and is removed again.

    The batches are read from one written catalogue: the tables are joined once, not for each batch.
    """
    tables: list[str] = []
    catalog = materialize(catalog_from_tables(spark, sf_dir), "catalog", tables)
    part = F.pmod(F.xxhash64("title_id"), F.lit(3))
    state = IncrementalCatalog(spark, scratch_path(spark, "incremental"))
    state.update(add={"part0": catalog.filter(part == 0), "part1": catalog.filter(part == 1),
                      "again": catalog.filter(F.pmod(F.xxhash64("title"), F.lit(5)) == 0)})
    state.update(add={"part2": catalog.filter(part == 2)}, remove=["again"])
    remove_tables(spark, tables)
    return state


def q_top15_incremental(spark, sf_dir):
    return _incremental(spark, sf_dir).top_titles().select(*TOP_TITLE_COLUMNS)


def q_segment_stats_incremental(spark, sf_dir):
    return _incremental(spark, sf_dir).segment_stats()


QUERIES: dict[str, Query] = {
    "catalog": q_catalog,
    "segment_sizes": q_segment_sizes,
    "desc_clean": q_desc_clean,
    "top_desc_words": q_top_desc_words,
    "top_desc_words_global": q_top_desc_words_global,
    "top_genres": q_top_genres,
    "top_title_words": q_top_title_words,
    "rank_weights": q_rank_weights,
    "score_description": _points("points_criterion_1"),
    "score_genres": _points("points_criterion_2"),
    "score_year": _points("points_criterion_3"),
    "score_title": _points("points_criterion_4"),
    "total_points": q_total_points,
    "segment_stats": q_segment_stats,
    "success_scaled": q_success_scaled,
    "top15_titles": q_top15_titles,
    "candidates": q_candidates,
    "catalog_with_candidates": q_catalog_with_candidates,
    "candidate_success": q_candidate_success,
    "candidate_success_union": q_candidate_success_union,
    "report_lines": q_report_lines,
    "csv_round_trip": q_csv_round_trip,
    "catalog_csv": q_catalog_csv,
    "top15_from_csv": q_top15_from_csv,
    "success_scaled_global": q_success_scaled_global,
    "top15_titles_global": q_top15_titles_global,
    "catalog_inferred": q_catalog_inferred,
    "orders_inferred": q_orders_inferred,
    "orders_typed": q_orders_typed,
    "top_desc_words_stop_table": q_top_desc_words_stop_table,
    "top_title_words_stop_table": q_top_title_words_stop_table,
    "desc_clean_stop_table": q_desc_clean_stop_table,
    "total_points_stop_table": q_total_points_stop_table,
    "top_desc_words_two_pass": q_top_desc_words_two_pass,
    "title_ranks": q_title_ranks,
    "csv_published": q_csv_published,
    "top15_incremental": q_top15_incremental,
    "segment_stats_incremental": q_segment_stats_incremental,
    "report_lines_global": q_report_lines_global,
    "csv_round_trip_global": q_csv_round_trip_global,
}

__all__ = ["QUERIES", "Query", "job"]
