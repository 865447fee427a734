"""Sinks and the CSV source: write, read back, compare."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE
from marquee.operators.reports import RULE
from marquee.plans.job import CatalogJob
from marquee.plans.materialize import is_local, scratch_path, shared_dir
from marquee.sources.catalog import catalog_from_tables, read_catalog_csv, read_catalog_parquet
from marquee.sources.sinks import read_top_titles_csv, write_reports, write_top_titles_csv

TRICKY = ['He said "hi", left', "line one\nline two", "  padded  ", "a,b,,c", "plain", "é ñ 日本"]


def test_shared_dir_comes_from_the_session(spark):
    d = shared_dir(spark)
    assert d == spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(d.rstrip("/") + "/marquee/x-")


def test_cluster_without_shared_folder_is_refused(spark, monkeypatch):
    from types import SimpleNamespace
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session)
    assert is_local("local[8]") and not is_local("local-cluster[3,2,1024]")


def test_top_titles_csv_round_trip(spark):
    job = CatalogJob(catalog_from_tables(spark, SMOKE))
    top = job.top_titles()
    top = top.withColumn("description", F.when(F.col("title_id") % 7 == 0, F.lit(TRICKY[0]))
                         .when(F.col("title_id") % 7 == 1, F.lit(TRICKY[1]))
                         .when(F.col("title_id") % 7 == 2, F.lit(TRICKY[2]))
                         .otherwise(F.col("description")))
    path = scratch_path(spark, "csv_test")
    write_top_titles_csv(top, path)
    back = read_top_titles_csv(spark, path).select(*top.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, top.collect()))
    # one file per segment
    seg_dirs = [p for p, _, files in os.walk(path.replace("file:", ""))
                if any(f.endswith(".csv") for f in files)]
    assert all(len([f for f in os.listdir(p) if f.endswith(".csv")]) == 1 for p in seg_dirs)


def test_catalog_csv_source_parses_quotes_and_newlines(spark):
    d = tempfile.mkdtemp(prefix="marquee-csv-")
    rows = [(f"s{i}", "Movie", t, "someone", "Drama, Comedy", "2020", "PG", desc)
            for i, (t, desc) in enumerate(zip(TRICKY, TRICKY))]
    df = spark.createDataFrame(rows, "show_id string, type string, title string, director string, "
                                     "listed_in string, release_year string, rating string, "
                                     "description string")

    def write(frame, path):
        (frame.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(path))

    write(df, f"{d}/a")
    # another platform: other column order, an extra column, no id column
    write(df.select("description", "rating", "release_year", "listed_in", "title", "type",
                    F.lit("x").alias("country")), f"{d}/b")
    cat = read_catalog_csv(spark, {"a": f"{d}/a", "b": f"{d}/b"})
    got = cat.collect()
    assert len(got) == 2 * len(TRICKY)
    for platform in ("a", "b"):
        mine = [r for r in got if r.platform == platform]
        assert sorted(r.description for r in mine) == sorted(TRICKY)
        assert all(r.title == r.description and r.type == "Movie" and r.rating == "PG"
                   and r.listed_in == "Drama, Comedy" for r in mine)
    assert len({r.title_id for r in got}) == len(got)


def _csv(df, path):
    df.coalesce(1).write.option("header", True).csv(path)


def test_platforms_without_ids_get_one_row_per_title(spark):
    d = tempfile.mkdtemp(prefix="marquee-csv-")
    paths = {}
    for p in "abc":
        rows = [("Movie", f"{p}{k}", f"text of {p}{k}") for k in range(3)]
        _csv(spark.createDataFrame(rows, "type string, title string, description string"), f"{d}/{p}")
        paths[p] = f"{d}/{p}"
    catalog = read_catalog_csv(spark, paths)
    assert len({r.title_id for r in catalog.collect()}) == 9
    top = CatalogJob(catalog).top_titles().collect()
    assert len(top) == 9 and all(r.description == f"text of {r.title}" and r.title[0] == r.platform for r in top)


def test_columns_go_by_name_in_every_file_of_a_platform(spark):
    d = tempfile.mkdtemp(prefix="marquee-csv-")
    _csv(spark.createDataFrame([("s1", "Movie", "one")], "show_id string, type string, title string"), f"{d}/1")
    _csv(spark.createDataFrame([("two", "s2", "Movie")], "title string, show_id string, type string"), f"{d}/2")
    got = read_catalog_csv(spark, {"p": [f"{d}/1", f"{d}/2"]})
    assert sorted((r.type, r.title) for r in got.collect()) == [("Movie", "one"), ("Movie", "two")]
    with pytest.raises(Exception, match="(?i)header"):
        read_catalog_csv(spark, {"p": [f"{d}/1", f"{d}/2"]}, one_header=True).collect()


def test_records_on_one_line_can_be_split(spark):
    d = tempfile.mkdtemp(prefix="marquee-csv-")
    rows = [(k, "Movie", f"title {k}") for k in range(2000)]
    _csv(spark.createDataFrame(rows, "show_id long, type string, title string"), f"{d}/1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = read_catalog_csv(spark, {"p": f"{d}/1"}, "show_id", multiline=False)
        assert got.rdd.getNumPartitions() > 1 and got.agg(F.count_distinct("title_id")).first()[0] == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_parquet_catalogues(spark):
    d = tempfile.mkdtemp(prefix="marquee-pq-")
    spark.createDataFrame([("Movie", "a", 2012.0)], "type string, title string, release_year double").write.parquet(f"{d}/a")
    spark.createDataFrame([("b", "TV Show", 1)], "title string, type string, extra int").write.parquet(f"{d}/b")
    got = {r.platform: r for r in read_catalog_parquet(spark, {"a": f"{d}/a", "b": f"{d}/b"}).collect()}
    assert got["a"].release_year == "2012" and got["b"].type == "TV Show"
    assert got["a"].title_id != got["b"].title_id


def test_reports_written_in_order(spark):
    job = CatalogJob(catalog_from_tables(spark, SMOKE))
    lines = job.report_lines()
    path = scratch_path(spark, "reports_test")
    write_reports(lines, path)
    local = path.replace("file:", "")
    seg = os.path.join(local, "platform=en", "type=Movie", "report=top_desc_words")
    files = [f for f in os.listdir(seg) if f.startswith("part-")]
    assert len(files) == 1
    with open(os.path.join(seg, files[0]), encoding="utf-8") as fh:
        content = fh.read().splitlines()
    assert content[0] == "en Filmes - Top 10 Palavras das Descrições" and content[1] == RULE
    assert content[2].startswith("1. ") and content[2].endswith(" ocorrências")
    assert [int(x.split(".")[0]) for x in content[2:]] == list(range(1, len(content) - 1))


def test_csv_sink_null_and_empty_text(spark):
    """Spark's CSV defaults: null and '' both read back as null; other text is unchanged."""
    top = CatalogJob(catalog_from_tables(spark, SMOKE)).top_titles()
    first = top.orderBy("title_id").limit(3).withColumn(
        "description", F.when(F.col("title_id") == F.lit(top.agg(F.min("title_id")).first()[0]),
                              F.lit(None).cast("string")).otherwise(F.lit("")))
    path = scratch_path(spark, "csv_null_test")
    write_top_titles_csv(first, path)
    back = read_top_titles_csv(spark, path)
    assert [r.description for r in back.collect()] == [None, None, None]
    assert sorted(r.title for r in back.collect()) == sorted(r.title for r in first.collect())
