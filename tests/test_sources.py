"""CSV headers in one pass, and inferred column types."""

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from marquee.plans.materialize import scratch_path
from marquee.sources.catalog import CSV_READ_OPTIONS, read_catalog_csv, read_typed_csv
from marquee.sources.headers import first_lines, header_classes
from marquee.sources.infer import column_types, typed


def _write(folder, n, columns):
    os.makedirs(folder, exist_ok=True)
    for k in range(n):
        order = columns if k % 2 else columns[::-1]
        row = {"show_id": k, "type": "Movie", "title": f"t {k}", "description": 'a "quoted"\nline'}
        with open(f"{folder}/f {k:04d}+%.csv", "w") as out:  # names that need escaping
            out.write("\n" * (k % 3) + ",".join(order) + "\n")
            out.write(",".join('"' + str(row[c]).replace('"', '""') + '"' for c in order) + "\n")


def _jobs(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_number_of_jobs_does_not_grow_with_files(spark, tmp_path):
    columns = ["show_id", "type", "title", "description"]
    jobs, frames = [], []
    for n in (100, 500):
        _write(f"{tmp_path}/{n}", n, columns)
        jobs.append(_jobs(spark, f"headers-{n}", lambda: frames.append(
            read_catalog_csv(spark, {"p": f"{tmp_path}/{n}"}, "show_id"))))
    assert jobs[0] == jobs[1] <= 8
    got = frames[1].select("title_id", "title", "description").collect()
    assert sorted(tuple(r) for r in got) == [(k, f"t {k}", 'a "quoted"\nline') for k in range(500)]


def test_header_classes(spark, tmp_path):
    files = {"a": "x,y\n1,2\n", "b": "y,x\n1,2\n", "c": "x,y\n", "empty": "", "blank": "\n \n", "open": '"x\n1",y\n3,4\n'}
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    found = header_classes(spark, {"s": [str(tmp_path)], "t": [f"{tmp_path}/a.csv"]}, CSV_READ_OPTIONS)
    named = {(s, h): [os.path.basename(f) for f in files] for s, h, files in found}
    assert named == {("s", ("x", "y")): ["a.csv", "c.csv"], ("s", ("y", "x")): ["b.csv"],
                     ("s", ("x\n1", "y")): ["open.csv"], ("t", ("x", "y")): ["a.csv"]}
    assert header_classes(spark, {}, CSV_READ_OPTIONS) == []


def test_first_lines_stop_reading(spark, tmp_path):
    """One row a file leaves the scan, however long the file is."""
    (tmp_path / "long.csv").write_text("h1,h2\n" + "1,2\n" * 200_000)
    (tmp_path / "short.csv").write_text("h2\n")
    rows = first_lines(spark, {"s": [str(tmp_path)]}).collect()
    assert sorted(r.line for r in rows) == ["h1,h2", "h2"]


LATTICE = [
    (["1", "-2", "+3", None, ""], "int"), (["1", "3000000000"], "bigint"), (["1", "99999999999999999999"], "double"),
    (["1", "2.5"], "double"), (["1e3", ".5", "5."], "double"), (["true", "False"], "boolean"), (["true", "1"], "string"),
    (["2020-02-29"], "date"), (["2021-02-29"], "string"), (["2020-01-01", "2020-01-01 10:00:00"], "timestamp"),
    (["2020-01-01T10:00:00.5"], "timestamp"), (["2020-01-01", "7"], "string"), ([None, ""], "string"), ([], "string"),
    (["1", "n/a"], "string"), ([" 1"], "string"), (["1\n"], "string"), (["NaN"], "string")]


def test_inferred_types(spark):
    width = max(len(v) for v, _ in LATTICE)
    rows = list(itertools.zip_longest(*[v + [None] * (width - len(v)) for v, _ in LATTICE]))
    frame = spark.createDataFrame(rows, ", ".join(f"c{k} string" for k in range(len(LATTICE))))
    for seed in range(2):  # any order, any partitions
        random.Random(seed).shuffle(rows)
        got = column_types(spark.createDataFrame(rows, frame.schema).repartition(seed + 1)).collect()
        assert [r.column_type for r in sorted(got, key=lambda r: r.position)] == [t for _, t in LATTICE]
    assert column_types(frame.limit(0)).first().column_type == "string"
    out = typed(frame)
    assert dict(out.dtypes)["c0"] == "int" and dict(out.dtypes)["c14"] == "string"
    assert sorted(r.c0 for r in out.select("c0").collect() if r.c0 is not None) == [-2, 1, 3]


def test_types_per_key_and_one_pass(spark):
    frame = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "x"), (None, None)], "k string, v string")
    found = column_types(frame, keys=["k"])
    got = {(r.k, r.column_type, r.n_values, r.n_nulls) for r in found.collect()}
    assert got == {("a", "int", 2, 0), ("b", "string", 1, 0), (None, "string", 0, 1)}
    plan = column_types(frame, keys=["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_and" in plan and plan.count("Exchange hashpartitioning") == 1


def test_typed_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,day,x\n1,2020-01-01,5\n")
    (tmp_path / "b.csv").write_text("day,n\n2021-05-05,2.5\n")
    got = read_typed_csv(spark, str(tmp_path))
    assert dict(got.dtypes) == {"n": "double", "day": "date", "x": "int"}
    assert sorted((r.n, str(r.day), r.x) for r in got.collect()) == [(1.0, "2020-01-01", 5), (2.5, "2021-05-05", None)]
    with pytest.raises(ValueError):
        (tmp_path / "none").mkdir()
        (tmp_path / "none" / "e.csv").write_text("")
        read_typed_csv(spark, f"{tmp_path}/none")
