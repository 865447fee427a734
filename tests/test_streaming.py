"""Candidates scored from a file stream equal the batch result."""

from pyspark.sql import functions as F

from conftest import SMOKE
from marquee.plans.job import CatalogJob
from marquee.plans.materialize import scratch_path
from marquee.sources.candidates import candidates_from_tables
from marquee.sources.catalog import catalog_from_tables
from marquee.streaming.candidates import start_candidate_scoring


def test_stream_equals_batch(spark):
    cands = candidates_from_tables(spark, SMOKE)
    job = CatalogJob(catalog_from_tables(spark, SMOKE), cands)
    source = scratch_path(spark, "cand_source")
    cands.filter(F.col("cand_id") % 2 == 0).write.parquet(source + "/batch=0")
    cands.filter(F.col("cand_id") % 2 == 1).write.parquet(source + "/batch=1")
    sink = scratch_path(spark, "cand_sink")
    query = start_candidate_scoring(job, source + "/*", sink, scratch_path(spark, "ckpt"), available_now=True)
    query.awaitTermination(300)
    streamed = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    batch = sorted(tuple(r) for r in job.candidate_success().collect())
    assert streamed == batch and len(batch) == cands.count()


def test_csv_candidate_stream(spark):
    from marquee.sources.sinks import CSV_WRITE_OPTIONS
    cands = candidates_from_tables(spark, SMOKE)
    job = CatalogJob(catalog_from_tables(spark, SMOKE), cands)
    source = scratch_path(spark, "cand_csv_source")
    cands.write.options(**CSV_WRITE_OPTIONS).csv(source)
    sink = scratch_path(spark, "cand_csv_sink")
    query = start_candidate_scoring(job, source, sink, scratch_path(spark, "ckpt"), fmt="csv", available_now=True)
    query.awaitTermination(300)
    streamed = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    batch = sorted(tuple(r) for r in job.candidate_success().collect())
    assert streamed == batch


def test_restarted_stream_finds_new_candidates(spark):
    cands = candidates_from_tables(spark, SMOKE)
    job = CatalogJob(catalog_from_tables(spark, SMOKE), cands)
    source, sink, ckpt = (scratch_path(spark, f"restart_{x}") for x in ("source", "sink", "ckpt"))
    for part in (0, 1):
        cands.filter(F.col("cand_id") % 2 == part).write.parquet(f"{source}/batch={part}")
        query = start_candidate_scoring(job, source + "/*", sink, ckpt, available_now=True)
        query.awaitTermination(300)
    streamed = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    assert streamed == sorted(tuple(r) for r in job.candidate_success().collect())


def test_stream_takes_every_parameter_of_the_job(spark):
    cands = candidates_from_tables(spark, SMOKE)
    source = scratch_path(spark, "cand_params")
    cands.write.parquet(source)
    for options in ({"target": (0.0, 10.0), "year_bands": [(1990, 2030, 7)]}, {"keys": ()}, {"keys": ("type",)},
                    {"stop_words": ["the"], "top_n": (3, 2, 1), "weight_steps": (4, 3, 2)},
                    {"stop_words": spark.createDataFrame([("the",)], "w string")}):
        with CatalogJob(catalog_from_tables(spark, SMOKE), cands, **options) as job:
            sink = scratch_path(spark, "cand_params_sink")
            query = start_candidate_scoring(job, source, sink, scratch_path(spark, "ckpt"), available_now=True)
            query.awaitTermination(300)
            streamed = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
            assert streamed == sorted(tuple(r) for r in job.candidate_success().collect()), options
