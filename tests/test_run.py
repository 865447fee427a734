"""The whole job from CSV catalogues to written outputs."""

import os

from pyspark.sql import functions as F

from conftest import SMOKE
from marquee.plans.job import CatalogJob
from marquee.plans.materialize import scratch_path
from marquee.__main__ import job_options, parser
from marquee.plans.run import run_from_csv, run_from_files
from marquee.sources.candidates import candidates_from_tables
from marquee.sources.catalog import catalog_from_tables
from marquee.sources.sinks import CSV_WRITE_OPTIONS, read_top_titles_csv


def test_run_from_csv_equals_the_job_on_tables(spark):
    cat = catalog_from_tables(spark, SMOKE)
    src = scratch_path(spark, "run_src")
    catalogs = {}
    for platform in [r.platform for r in cat.select("platform").distinct().collect()]:
        path = f"{src}/{platform}"
        (cat.filter(F.col("platform") == platform)
         .select(F.col("title_id").alias("show_id"), "type", "title", "listed_in",
                 "release_year", "rating", "description")
         .write.options(**CSV_WRITE_OPTIONS).csv(path))
        catalogs[platform] = path
    cands = candidates_from_tables(spark, SMOKE)
    cands.write.options(**CSV_WRITE_OPTIONS).csv(f"{src}/candidates")
    out = scratch_path(spark, "run_out")
    run_from_csv(spark, catalogs, out, f"{src}/candidates")

    reference = CatalogJob(cat, cands)
    got = read_top_titles_csv(spark, f"{out}/top_titles")
    key = ("platform", "type", "title", "total_points", "sucesso")
    assert sorted(got.select(*key).collect()) == sorted(reference.top_titles().select(*key).collect())
    got_c = spark.read.option("header", True).csv(f"{out}/candidates")
    assert sorted((int(r.cand_id), float(r.sucesso)) for r in got_c.collect()) == \
        sorted((r.cand_id, r.sucesso) for r in reference.candidate_success().collect())
    assert os.path.isdir(f"{out}/reports".replace("file:", ""))


def test_run_from_parquet_with_parameters(spark):
    src, out = scratch_path(spark, "run_pq"), scratch_path(spark, "run_pq_out")
    cat = catalog_from_tables(spark, SMOKE).filter("platform = 'en'")
    cat.drop("platform").write.parquet(src)
    run_from_files(spark, {"en": src}, out, fmt="parquet", id_column="title_id", top_titles_n=2, top_n=(3, 2, 1),
                   types=("Movie",))
    got = read_top_titles_csv(spark, f"{out}/top_titles")
    expected = CatalogJob(cat, top_titles_n=2, top_n=(3, 2, 1), types=("Movie",)).top_titles()
    assert sorted(got.select(*expected.columns).collect()) == sorted(expected.collect())


def test_command_line_options_reach_the_job(spark):
    path = scratch_path(spark, "stops")
    spark.createDataFrame([("foo",), ("bar",)], "value string").coalesce(1).write.text(path)
    args = parser().parse_args(["--catalog", "p=/x", "--out", "/y", "--stop-words", path, "--types", "Movie",
                                "--top-n", "12,6,3", "--weight-steps", "2,5,1", "--year-bands", "[[1990, 1999, 7]]",
                                "--target", "[0, 1]", "--top-titles", "4"])
    options = job_options(spark, args)
    assert sorted(options.pop("stop_words")) == ["bar", "foo"]
    assert options == {"types": ["Movie"], "top_n": (12, 6, 3), "weight_steps": (2, 5, 1),
                       "year_bands": [(1990, 1999, 7)], "target": (0, 1), "top_titles_n": 4}
    assert job_options(spark, parser().parse_args(["--catalog", "p=/x", "--out", "/y"])) == {}


def test_ungrouped_run_from_files(spark):
    """The whole job over one segment, from files to every written output."""
    src, out = scratch_path(spark, "run_whole"), scratch_path(spark, "run_whole_out")
    cat, cands = catalog_from_tables(spark, SMOKE), candidates_from_tables(spark, SMOKE)
    catalogs = {}
    for platform in ("en", "de"):
        catalogs[platform] = f"{src}/{platform}"
        cat.filter(F.col("platform") == platform).drop("platform").write.options(**CSV_WRITE_OPTIONS).csv(catalogs[platform])
    cands.write.options(**CSV_WRITE_OPTIONS).csv(f"{src}/candidates")
    run_from_files(spark, catalogs, out, f"{src}/candidates", id_column="title_id", keys=())
    with CatalogJob(cat.filter("platform in ('en', 'de')"), cands, keys=()) as job:
        want = job.top_titles()
        got = read_top_titles_csv(spark, f"{out}/top_titles", ())
        assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
        lines = spark.read.text(f"{out}/reports/report=top_genres").collect()
        wanted = job.report_lines().filter("report = 'top_genres'").orderBy("line_no").collect()
        assert [r.value for r in lines] == [r.line for r in wanted] and lines[0].value.startswith("Catálogo - Top 5")
        scored = spark.read.option("header", True).csv(f"{out}/candidates")
        assert sorted((int(r.cand_id), float(r.sucesso)) for r in scored.collect()) == \
            sorted((r.cand_id, r.sucesso) for r in job.candidate_success().collect())
