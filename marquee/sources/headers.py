"""Header classes of many CSV files, in one distributed pass over their first lines.

Spark applies one header to all files of a read, so files must be read by
header. Looking at each file from the driver is a job per file; here one job
opens every file, takes its first line that is not blank and stops, and the executors
group the files by that line. The driver gets one row per different line, and lets the CSV reader parse
one file of each class. Planning takes a constant number of jobs and one more for each class.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# More than any file: one file is one partition of the first-line scan, so that reading stops in each.
_WHOLE_FILE = str(1 << 50)
# Files whose first lines one task reads, at least.
FILES_A_TASK = 64


def first_lines(spark: SparkSession, paths: Mapping[str, list[str]]) -> DataFrame:
    """``(source, path, line)``: the first line that is not blank of each file of each source; files without one are left out.

    A file is opened and read only as far as that line.
    """
    side = spark.newSession()  # its own settings of file partitions, the same cluster
    side.conf.set("spark.sql.files.maxPartitionBytes", _WHOLE_FILE)
    side.conf.set("spark.sql.files.openCostInBytes", _WHOLE_FILE)
    scans = []
    for source, files in paths.items():
        lines = side.read.option("recursiveFileLookup", "true").text(files)
        scans.append(lines.select(F.lit(source).alias("source"), F.col("_metadata.file_path").alias("path"),
                                  F.col("value").alias("line")).rdd)
    lines = spark.sparkContext.union(scans)

    def first(rows):  # imperative on purpose: no DataFrame operation stops reading a partition
        from urllib.parse import unquote
        for row in rows:
            if row.line.strip():
                yield row.source, unquote(row.path), row.line
                return

    files = lines.getNumPartitions()
    tasks = max(spark.sparkContext.defaultParallelism, -(-files // FILES_A_TASK))
    heads = lines.mapPartitions(first)
    if files > tasks:
        heads = heads.coalesce(tasks)
    return spark.createDataFrame(heads, "source string, path string, line string", verifySchema=False)


def header_classes(spark: SparkSession, paths: Mapping[str, list[str]],
                   options: Mapping[str, str]) -> list[tuple[str, tuple[str, ...], list[str]]]:
    """``(source, column names, files)`` of each different header among the files of each source.

    Files with equal first lines have one header, parsed once; a line that leaves a quote open goes on
    in the next ones, so such files are parsed each. File names are all that reaches the driver.
    """
    if not paths:
        return []
    quotes = F.char_length("line") - F.char_length(F.replace("line", F.lit('"'), F.lit("")))
    own = F.when(quotes % 2 == 1, F.col("path"))
    found = (first_lines(spark, paths).groupBy("source", "line", own.alias("own"))
             .agg(F.array_sort(F.collect_list("path")).alias("files")))
    parsed: dict[tuple, tuple[str, ...]] = {}
    groups: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for row in sorted(found.collect(), key=lambda r: (r.source, r.files[0])):
        if (row.line, row.own) not in parsed:
            parsed[row.line, row.own] = tuple(spark.read.options(**options).csv(row.files[0]).columns)
        groups.setdefault((row.source, parsed[row.line, row.own]), []).extend(row.files)
    return [(source, header, sorted(files)) for (source, header), files in groups.items() if header]
