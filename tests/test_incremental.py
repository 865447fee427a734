"""Batches added and removed: every output equals a full run over the batches that are left."""

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE
from marquee.plans import incremental, queries
from marquee.plans.incremental import IncrementalCatalog
from marquee.plans.job import CatalogJob
from marquee.plans.materialize import scratch_path
from marquee.sources.catalog import catalog_from_tables
from marquee.sources.manifests import Folder


@pytest.fixture(scope="module")
def parts(spark):
    """Four batches; the last repeats titles of the others and has a segment of its own, a null platform."""
    path = scratch_path(spark, "parts")
    catalog_from_tables(spark, SMOKE).write.parquet(path)
    cat = spark.read.parquet(path)
    extra = cat.filter("title_id % 9 = 0").withColumn(
        "platform", F.when(F.col("title_id") % 2 == 0, F.col("platform")))
    return {**{f"b{k}": cat.filter(F.col("title_id") % 3 == k) for k in range(3)}, "extra": extra}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def assert_equals_full_run(state, frames, **options):
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    with CatalogJob(whole, **options) as job:
        want = job.top_titles()
        assert state.top_titles().columns == want.columns
        assert rows_of(state.top_titles()) == rows_of(want)
        assert rows_of(state.segment_stats()) == rows_of(job.segment_stats())
        lists = job.lists.filter("list != 'segment'").drop("__whole")
        assert rows_of(state.lists().select(*lists.columns)) == rows_of(lists)
        if job.keys:
            sizes = job.segment_sizes()
            assert rows_of(state.segment_sizes().toDF(*sizes.columns)) == rows_of(sizes)


def test_after_every_update_outputs_equal_a_full_run(spark, parts):
    path = scratch_path(spark, "inc")
    state = IncrementalCatalog(spark, path)
    state.update(add={"b0": parts["b0"]})
    assert_equals_full_run(state, [parts["b0"]])
    state.update(add={"b1": parts["b1"], "extra": parts["extra"]})
    assert_equals_full_run(state, [parts["b0"], parts["b1"], parts["extra"]])
    # Opened again; one goes and one comes in a step; the segment of its own vanishes.
    state = IncrementalCatalog(spark, path)
    state.update(add={"b2": parts["b2"]}, remove=["extra"])
    assert_equals_full_run(state, [parts["b0"], parts["b1"], parts["b2"]])
    state.update(add={"b0": parts["extra"]}, remove=["b0"])
    assert_equals_full_run(state, [parts["extra"], parts["b1"], parts["b2"]])
    state.update(remove=["b0", "b1", "b2"])
    assert state.top_titles().collect() == state.lists().collect() == state.segment_stats().collect() == []
    assert sum(n.startswith("batch-") for n in Folder(spark, path).names()) == 3  # those of the version before
    state.update(add={"b1": parts["b1"]})
    assert_equals_full_run(state, [parts["b1"]])


def test_ungrouped_and_with_parameters(spark, parts):
    options = dict(keys=(), top_n=(4, 3, 2), top_titles_n=3, stop_words=["the"], weight_steps=(2, 5, 3))
    state = IncrementalCatalog(spark, scratch_path(spark, "inc"), **options)
    state.update(add={"a": parts["b0"], "b": parts["b1"]})
    state.update(add={"c": parts["extra"]}, remove=["a"])
    assert_equals_full_run(state, [parts["b1"], parts["extra"]], **options)


def test_clean_segments_are_not_scored_again(spark, parts):
    path = scratch_path(spark, "inc")
    state = IncrementalCatalog(spark, path)
    state.update(add={"all": parts["b0"].unionByName(parts["b1"])})
    one = parts["b2"].filter("platform = 'en' and type = 'Movie'").limit(1)
    plain = one.withColumns({"title": F.lit("zz"), "description": F.lit("zz"), "listed_in": F.lit("zz")})
    state.update(add={"plain": plain})
    dirty = state.table("dirty")
    assert dirty.collect() == []  # one rare word more changes no list
    assert_equals_full_run(state, [parts["b0"], parts["b1"], plain])
    state.update(remove=["plain"])
    assert state.table("dirty").collect() == []
    assert_equals_full_run(state, [parts["b0"], parts["b1"]])


def test_a_failed_update_leaves_the_last_version(spark, parts, monkeypatch):
    path = scratch_path(spark, "inc")
    state = IncrementalCatalog(spark, path)
    state.update(add={"b0": parts["b0"]})
    before = Folder(spark, path).names()

    def broken(*_):
        raise OSError("lost")

    monkeypatch.setattr(incremental, "publish", broken)
    with pytest.raises(OSError):
        state.update(add={"b1": parts["b1"]}, remove=["b0"])
    monkeypatch.undo()
    assert Folder(spark, path).names() == before and list(state.batches) == ["b0"]
    assert_equals_full_run(IncrementalCatalog(spark, path), [parts["b0"]])


def test_wrong_use_is_told(spark, parts):
    path = scratch_path(spark, "inc")
    state = IncrementalCatalog(spark, path)
    with pytest.raises(ValueError):
        state.top_titles()
    with pytest.raises(KeyError):
        state.update(remove=["none"])
    state.update(add={"b0": parts["b0"].limit(0)})
    assert state.top_titles().collect() == []
    with pytest.raises(ValueError):
        state.update(add={"b0": parts["b0"]})
    with pytest.raises(ValueError):
        IncrementalCatalog(spark, path, top_n=(1, 1, 1))


def counting(spark, df):
    """The frame, and how often any of its rows was computed."""
    seen = spark.sparkContext.accumulator(0)

    def see(_):
        seen.add(1)
        return True

    return df.filter(F.udf(see, "boolean").asNondeterministic()("title_id")), seen


def test_an_update_scores_a_title_once(spark, parts, monkeypatch):
    seen, score = [], incremental.score_ops.score_titles

    def counted(*args):
        df, n = counting(spark, score(*args))
        seen.append(n)
        return df

    monkeypatch.setattr(incremental.score_ops, "score_titles", counted)
    state = IncrementalCatalog(spark, scratch_path(spark, "inc"))
    state.update(add={"b0": parts["b0"], "b1": parts["b1"]})
    monkeypatch.undo()
    titles = sum(r.n for r in state.segment_sizes().collect())
    assert [n.value for n in seen] == [titles] and titles > 0
    assert not state.folder.names(f"{state._state['version']}/scored")  # needed while the version is written only
    assert_equals_full_run(state, [parts["b0"], parts["b1"]])


def test_the_queries_join_the_tables_once(spark, parts, monkeypatch):
    whole = parts["b0"].unionByName(parts["b1"]).unionByName(parts["b2"])
    df, seen = counting(spark, whole)
    monkeypatch.setattr(queries, "catalog_from_tables", lambda *_: df)
    state = queries._incremental(spark, SMOKE)
    assert seen.value == whole.count()
    assert_equals_full_run(state, [whole])
