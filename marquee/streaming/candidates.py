"""Candidates arriving as files, evaluated as they come.

Each micro-batch of new candidate titles is scored against the lists and
statistics the batch job wrote for the catalogue (a stream-static join
against two small tables: weight maps and segment statistics), with the same
closed form as :func:`marquee.operators.candidates.candidate_success`. The
stream keeps no state: every candidate is independent of the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from marquee.plans.job import CatalogJob
from marquee.sources.candidates import CANDIDATE_SCHEMA


def read_candidate_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming frame of candidate files (declared schema, no inference).

    File streams need their schema up front, and Spark applies it to CSV
    columns by position: CSV files must hold ``CANDIDATE_COLUMNS`` in that
    order, with a header line.
    """
    reader = spark.readStream.schema(CANDIDATE_SCHEMA).format(fmt)
    if fmt == "csv":
        reader = reader.options(header="true", multiLine="true", escape='"')
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def candidate_success_stream(job: CatalogJob, candidates: DataFrame) -> DataFrame:
    """``(cand_id, title, sucesso)`` for a streaming frame of candidates.

    ``job`` supplies the catalogue's weight maps and segment statistics; they
    are written (and broadcast by size) before the stream starts.
    """
    return job.success_of(candidates)


def start_candidate_scoring(job: CatalogJob, source: str, sink: str, checkpoint: str,
                            fmt: str = "parquet", available_now: bool = False) -> StreamingQuery:
    """Score candidate files from ``source`` into Parquet files under ``sink``.

    ``checkpoint`` is a folder on shared storage that belongs to this pair of
    source and sink: a restart with the same folder goes on after the last
    committed batch, whatever the job object.
    """
    spark = job.catalog.sparkSession
    stream = candidate_success_stream(job, read_candidate_stream(spark, source, fmt))
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(sink)
