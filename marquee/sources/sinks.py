"""Sinks: ranked titles as CSV, reports as text, and CSV files published under fixed names.

All are Spark writers partitioned by segment, so every segment's file is
written by the task holding that segment's rows; no row passes through the
driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators.score import OUTPUT_COLUMNS, POINT_COLUMNS
from marquee.sources.catalog import CSV_READ_OPTIONS, SEGMENT_KEYS, TEXT_COLUMNS
from marquee.sources.manifests import Folder, latest, publish

# The CSV writer trims values by default; keep them whole so they read back unchanged.
CSV_WRITE_OPTIONS: dict[str, str] = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

TOP_TITLES_SCHEMA = T.StructType(
    [T.StructField("title_id", T.LongType(), True)]
    + [T.StructField(c, T.StringType(), True) for c in TEXT_COLUMNS]
    + [T.StructField(c, T.IntegerType(), True) for c in POINT_COLUMNS]
    + [T.StructField("total_points", T.IntegerType(), True),
       T.StructField("sucesso", T.DoubleType(), True)]
    + [T.StructField(k, T.StringType(), True) for k in SEGMENT_KEYS]
)


def write_top_titles_csv(top: DataFrame, path: str,
                         keys: Sequence[str] = SEGMENT_KEYS, mode: str = "overwrite") -> None:
    """One CSV file with a header per segment, under ``path/platform=.../type=...``.

    The rows (at most ``n`` per segment) are gathered by segment into one task
    and written best first. Without keys there is one segment, hence one file in ``path``.
    """
    order = [F.col("total_points").desc(), F.col("title"), F.col("title_id")]
    if not keys:
        (top.select("title_id", *OUTPUT_COLUMNS).coalesce(1).sortWithinPartitions(*order)
            .write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path))
        return
    (top.select("title_id", *OUTPUT_COLUMNS, *keys)
        .repartition(*[F.col(k) for k in keys])
        .sortWithinPartitions(*[F.col(k) for k in keys], *order)
        .write.mode(mode).partitionBy(*keys).options(**CSV_WRITE_OPTIONS).csv(path))


def publish_top_titles_csv(top: DataFrame, path: str, keys: Sequence[str] = SEGMENT_KEYS,
                           name: str = "top_titles", keep: int = 2) -> dict[str, str]:
    """Publish one named CSV file per segment, all at once; returns the files' paths by name.

    A segment's file is ``name__platform=<value>__type=<value>.csv``
    (``name.csv`` without keys; values escaped as Spark escapes partition values, so names differ).
    The files are written and renamed in a folder of the run's own, then one
    manifest makes them current: readers (:func:`published_files`) see the last publication
    until then, and go on seeing it if the run fails. The newest ``keep`` publications
    stay, so that a reader can finish; the folders of older and of failed runs are deleted.
    """
    folder = Folder(top.sparkSession, path)
    number, current = latest(folder)
    run, files = f"run-{uuid.uuid4().hex}", {}
    try:
        write_top_titles_csv(top, f"{folder.path}/{run}", keys, "errorifexists")
        for file in folder.files(run):
            *segment, leaf = file.split("/")
            if leaf.endswith(".csv"):
                final = "__".join([name, *segment]) + ".csv"
                files[final] = "/".join([run, *segment, final])
                folder.rename(f"{run}/{file}", files[final])
        publish(folder, number + 1, {"run": run, "keys": list(keys), "files": files,
                                     "runs": [*(current or {}).get("runs", []), run][-max(keep, 1):]})
    except Exception:
        folder.delete(run)
        raise
    kept = latest(folder)[1]["runs"]
    for other in folder.names():
        if other.startswith("run-") and other not in kept:
            folder.delete(other)
    return {k: f"{folder.path}/{v}" for k, v in files.items()}


def published_files(spark: SparkSession, path: str) -> dict[str, str]:
    """Paths, by name, of the current publication; empty if there is none."""
    folder = Folder(spark, path)
    content = latest(folder)[1]
    return {} if content is None else {k: f"{folder.path}/{v}" for k, v in content["files"].items()}


def read_published_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the current publication (``FileNotFoundError`` if there is none)."""
    folder = Folder(spark, path)
    content = latest(folder)[1]
    if content is None:
        raise FileNotFoundError(f"nothing is published in {path}")
    return read_top_titles_csv(spark, f"{folder.path}/{content['run']}", content["keys"])


def read_top_titles_csv(spark: SparkSession, path: str, keys: Sequence[str] = SEGMENT_KEYS) -> DataFrame:
    """Read back :func:`write_top_titles_csv` output with its declared schema."""
    schema = T.StructType([f for f in TOP_TITLES_SCHEMA if f.name in keys or f.name not in SEGMENT_KEYS])
    return (spark.read.schema(schema).options(**CSV_READ_OPTIONS)
            .option("basePath", path).csv(path))


def write_reports(lines: DataFrame, path: str, keys: Sequence[str] = SEGMENT_KEYS,
                  mode: str = "overwrite") -> None:
    """One text file per report, lines in order, under ``path/platform=/type=/report=``.

    A report is a dozen lines: each is gathered into one task by its
    partition values and sorted by line number within it.
    """
    parts = [*keys, "report"]
    (lines.repartition(*[F.col(c) for c in parts])
          .sortWithinPartitions(*parts, "line_no")
          .select(*parts, "line")
          .write.mode(mode).partitionBy(*parts).text(path))
