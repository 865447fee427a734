"""The whole job as one call: read the catalogues, write every output.

Outputs under ``out``::

    top_titles/platform=.../type=.../part-*.csv     best titles per segment (H1)
    reports/platform=.../type=.../report=.../part-*  ranked text reports (H2)
        (a job without keys: top_titles/part-*.csv and reports/report=.../part-*)
    candidates/part-*.csv                           candidate success, when candidates are given

Published (``published=True``), the best titles are files of fixed names instead, which change all at
once when the job is through (:func:`marquee.sources.sinks.publish_top_titles_csv`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from marquee.plans.job import CatalogJob
from marquee.plans.materialize import remove_tables
from marquee.sources.candidates import CANDIDATE_COLUMNS
from marquee.sources.catalog import CSV_READ_OPTIONS, read_catalog_csv, read_catalog_parquet
from marquee.sources.sinks import CSV_WRITE_OPTIONS, publish_top_titles_csv, write_reports, write_top_titles_csv

READERS = {"csv": read_catalog_csv, "parquet": read_catalog_parquet}


def read_candidates_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Candidate titles from CSV with a header (``cand_id`` and the catalogue columns)."""
    raw = spark.read.options(**CSV_READ_OPTIONS).csv(path)
    return raw.select(raw["cand_id"].cast("bigint").alias("cand_id"),
                      *[raw[c].cast("string").alias(c) for c in CANDIDATE_COLUMNS[1:]])


def run_job(job: CatalogJob, out: str, mode: str = "overwrite", published: bool = False) -> None:
    """Write the best titles, the reports and (if any) the candidates' success under ``out``."""
    if not published:
        write_top_titles_csv(job.top_titles(), f"{out}/top_titles", job.keys, mode)
    write_reports(job.report_lines(), f"{out}/reports", job.keys, mode)
    if job.candidates is not None:
        (job.candidate_success().write.mode(mode).options(**CSV_WRITE_OPTIONS)
         .csv(f"{out}/candidates"))
    if published:  # last: nothing changes if another output failed
        publish_top_titles_csv(job.top_titles(), f"{out}/top_titles", job.keys)


def run_from_files(spark: SparkSession, catalogs: Mapping[str, str | Sequence[str]], out: str,
                   candidates: str | None = None, fmt: str = "csv", id_column: str | None = None,
                   reader: Mapping[str, object] | None = None, published: bool = False, **job_options) -> None:
    """Read per-platform catalogues (and a candidate CSV), write every output, delete the job's tables.

    ``fmt`` is a key of ``READERS``, ``reader`` holds further options of that
    reader, and ``job_options`` go to :class:`CatalogJob`.
    """
    tables: list[str] = []
    try:
        catalog = READERS[fmt](spark, catalogs, id_column, tables=tables, **(reader or {}))
        cands = read_candidates_csv(spark, candidates) if candidates else None
        with CatalogJob(catalog, cands, **job_options) as job:
            run_job(job, out, published=published)
    finally:
        remove_tables(spark, tables)


def run_from_csv(spark: SparkSession, catalogs: Mapping[str, str | Sequence[str]], out: str,
                 candidates: str | None = None, **options) -> None:
    """:func:`run_from_files` over CSV catalogues."""
    run_from_files(spark, catalogs, out, candidates, "csv", **options)
