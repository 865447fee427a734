"""Operators on hand-made catalogues (FIXTURES.md §4) and properties on the test tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from marquee.operators import topk
from marquee.plans.job import CatalogJob
from marquee.sources.candidates import candidates_from_rows, candidates_from_tables
from marquee.sources.catalog import catalog_from_tables, conform

COLS = "title_id long, platform string, type string, title string, listed_in string, " \
       "release_year string, rating string, description string"


def catalog(spark, rows):
    return conform(spark.createDataFrame(rows, COLS))


def row(i, title="t", genres=None, year="1990", desc="", platform="p", kind="Movie"):
    return (i, platform, kind, title, genres, year, "r", desc)


def collect_map(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_type_filter_drops_other_types_and_nulls(spark):
    cat = catalog(spark, [row(1), row(2, kind="TV Show"), row(3, kind="Special"), row(4, kind=None)])
    sizes = {(r.platform, r.type): r.n for r in CatalogJob(cat).segment_sizes().collect()}
    assert sizes == {("p", "Movie"): 1, ("p", "TV Show"): 1}


def test_genre_counts_and_scores(spark):
    rows = [row(1, genres="Drama, Comedy,,Drama "), row(2, genres="Drama, Action"),
            row(3, genres="Action, Drama"), row(4, genres="TV Dramas"), row(5, genres="TV dramas"),
            row(6, genres=None)]
    job = CatalogJob(catalog(spark, rows))
    counts = collect_map(job.top_genres(), "genre", "count")
    assert counts == {"Drama": 4, "Action": 2, "Comedy": 1, "TV Dramas": 1, "TV dramas": 1}
    ranks = collect_map(job.top_genres(), "genre", "rank")
    assert ranks["Drama"] == 1 and ranks["Action"] == 2 and ranks["Comedy"] == 3  # ties: term order
    points = collect_map(job.scored, "title_id", "points_criterion_2")
    # Drama 25, Comedy 15, '' 0, Drama 25
    assert points[1] == 65
    assert points[4] == 10 and points[5] == 5 and points[6] == 0


def test_description_score_counts_every_occurrence(spark):
    rows = [row(1, desc="love war love"), row(2, desc="love war"), row(3, desc="love")]
    job = CatalogJob(catalog(spark, rows))
    weights = {(r.list, r.term): r.weight for r in job.rank_weights().collect()}
    assert weights[("description", "love")] == 10 and weights[("description", "war")] == 9
    points = collect_map(job.scored, "title_id", "points_criterion_1")
    assert points == {1: 29, 2: 19, 3: 10}


def test_weights_start_from_the_constant(spark):
    rows = [row(1, desc="alpha alpha alpha beta beta gamma", title="Alpha")]
    job = CatalogJob(catalog(spark, rows))
    desc = sorted((r.weight, r.term) for r in job.rank_weights().collect() if r.list == "description")
    assert desc == [(8, "gamma"), (9, "beta"), (10, "alpha")]


def test_title_score_uses_scoring_tokens(spark):
    rows = [row(1, title="Spider-Man Home"), row(2, title="Home Spider-Man"), row(3, title="Café")]
    job = CatalogJob(catalog(spark, rows))
    vocab = collect_map(job.top_title_words(), "word", "count")
    assert vocab == {"spiderman": 2, "home": 2, "caf": 1}
    points = collect_map(job.scored, "title_id", "points_criterion_4")
    # home is 1st (tie with spiderman, term order), spider-man never scores, café is not caf
    assert points == {1: 10, 2: 10, 3: 0}


def test_success_range_and_constant_segments(spark):
    rows = [row(1, desc="love love", platform="a"), row(2, desc="love", platform="a"),
            row(3, desc="nothing here", platform="a"),
            row(4, desc="same", platform="b"), row(5, desc="same", platform="b")]
    job = CatalogJob(catalog(spark, rows))
    got = collect_map(job.scaled, "title_id", "sucesso")
    assert got[1] == 95.0 and got[3] == 60.0 and 60 < got[2] < 95
    assert got[4] == got[5] == 77.5


def test_candidates_above_below_and_empty_segment(spark):
    rows = [row(1, desc="love love war", year="2001"), row(2, desc="war", year="1990")]
    job = CatalogJob(catalog(spark, rows), candidates_from_rows(spark, [
        {"cand_id": 10, "platform": "p", "type": "Movie", "title": "x",
         "description": "love love love war unknown", "release_year": "2020"},
        {"cand_id": 11, "platform": "p", "type": "Movie", "title": "y", "description": "",
         "release_year": "1990"},
        {"cand_id": 12, "platform": "q", "type": "Movie", "title": "z", "description": "love",
         "release_year": "2012"},
    ]))
    got = collect_map(job.candidate_success(), "cand_id", "sucesso")
    assert got == {10: 95.0, 11: 60.0, 12: 77.5}
    # the candidate's words do not change the lists
    assert {r.term for r in job.rank_weights().collect()} == {"love", "war"}


def test_candidates_from_rows_is_order_independent(spark):
    a = candidates_from_rows(spark, [{"title": "t", "type": "Movie", "platform": "p"}])
    b = candidates_from_rows(spark, [{"platform": "p", "title": "t", "type": "Movie"}])
    assert a.collect() == b.collect() and a.columns[0] == "cand_id"


@pytest.fixture(scope="module")
def small_job(spark):
    return CatalogJob(catalog_from_tables(spark, SMALL), candidates_from_tables(spark, SMALL))


def test_properties_on_test_tables(small_job):
    scaled = small_job.scaled
    assert {r.p for r in scaled.select(F.col("points_criterion_3").alias("p")).distinct().collect()} \
        <= {0, 5, 10, 15, 20}
    bounds = scaled.groupBy("platform", "type").agg(
        F.min("sucesso").alias("lo"), F.max("sucesso").alias("hi"),
        F.min("total_points").alias("tlo"), F.max("total_points").alias("thi")).collect()
    for b in bounds:
        if b.tlo == b.thi:
            assert b.lo == b.hi == 77.5
        else:
            assert b.lo == 60.0 and b.hi == 95.0


def test_closed_form_equals_union_form(small_job):
    union = {r.cand_id: (r.title, r.sucesso) for r in small_job.candidate_success_union().collect()}
    closed = {r.cand_id: (r.title, r.sucesso) for r in small_job.candidate_success().collect()}
    assert len(union) == 40 and union == closed


def test_fused_lists_equal_separate_lists(small_job):
    fused = sorted(tuple(r) for r in small_job.lists.filter("list != 'segment'").collect())
    separate = []
    for name, df in (("description", small_job.top_desc_words()), ("genre", small_job.top_genres()),
                     ("title", small_job.top_title_words())):
        separate += [(r[0], r[1], name, *r[2:]) for r in df.collect()]
    assert fused == sorted(separate)
    own = {(r.platform, r.type): r["count"] for r in small_job.lists.filter("list = 'segment'").collect()}
    assert own == {(r.platform, r.type): r.n for r in small_job.segment_sizes().collect()}


def test_segmented_equals_one_segment_alone(spark, small_job):
    seg = ("en", "TV Show")
    alone = CatalogJob(catalog_from_tables(spark, SMALL)
                       .filter((F.col("platform") == seg[0]) & (F.col("type") == seg[1])))
    mine = small_job.scaled.filter((F.col("platform") == seg[0]) & (F.col("type") == seg[1]))
    a = sorted((r.title_id, r.total_points, r.sucesso) for r in alone.scaled.collect())
    b = sorted((r.title_id, r.total_points, r.sucesso) for r in mine.collect())
    assert a == b and len(a) > 10


def test_invariant_under_repartitioning(spark, small_job):
    shuffled = catalog_from_tables(spark, SMALL).repartition(5, F.rand(3))
    again = CatalogJob(shuffled)
    a = sorted(tuple(r) for r in again.top_titles().collect())
    b = sorted(tuple(r) for r in small_job.top_titles().collect())
    assert a == b


def test_global_top_words_is_a_top_k_sort(spark, small_job):
    glob = topk.top_description_words(small_job.prepared, 10, keys=())
    plan = glob._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and glob.count() == 10


def test_shuffle_joins_give_the_same_result(spark, small_job):
    """Per-segment tables over the broadcast threshold are joined with a shuffle."""
    expected_top = sorted(tuple(r) for r in small_job.top_titles().collect())
    expected_cands = sorted(tuple(r) for r in small_job.candidate_success().collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        job = CatalogJob(catalog_from_tables(spark, SMALL), candidates_from_tables(spark, SMALL))
        top = job.top_titles()
        cands = job.candidate_success()
        assert sorted(tuple(r) for r in top.collect()) == expected_top
        assert sorted(tuple(r) for r in cands.collect()) == expected_cands
        plan = cands._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("mode", ["cache", "none"])
def test_token_modes_give_the_same_result(spark, small_job, mode):
    job = CatalogJob(catalog_from_tables(spark, SMALL), candidates_from_tables(spark, SMALL),
                     tokens=mode)
    try:
        scaled = job.scaled
        if mode == "cache":
            lists_plan = job.lists  # written table: read the plan of the scores instead
            plan = job.scored._jdf.queryExecution().executedPlan().toString()
            assert "InMemoryTableScan" in plan and lists_plan is not None
        a = sorted(tuple(r) for r in scaled.collect())
        b = sorted(tuple(r) for r in small_job.scaled.collect())
        assert a == b
    finally:
        job.close()


def test_genre_score_is_case_sensitive(spark):
    rows = [row(1, genres="TV Dramas"), row(2, genres="TV Dramas, Comedy")]
    job = CatalogJob(catalog(spark, rows), candidates_from_rows(spark, [
        {"cand_id": 1, "platform": "p", "type": "Movie", "title": "c", "listed_in": "TV dramas"},
        {"cand_id": 2, "platform": "p", "type": "Movie", "title": "d", "listed_in": " TV Dramas\t"},
    ]))
    scored = job.scored.select("title_id", "points_criterion_2").collect()
    assert {r.title_id: r.points_criterion_2 for r in scored} == {1: 25, 2: 45}
    from marquee.operators.score import score_titles
    cands = score_titles(job.prepared_candidates, job.maps).collect()
    assert {r.cand_id: r.points_criterion_2 for r in cands} == {1: 0, 2: 25}


def test_conform_fills_missing_columns_with_null(spark):
    df = spark.createDataFrame([(1, "p", "Movie", "Some Title", 2012.0)],
                               "title_id long, platform string, type string, title string, "
                               "release_year double")
    cat = conform(df)
    r = cat.first()
    assert r.release_year == "2012" and r.listed_in is None and r.description is None
    points = CatalogJob(cat).scored.select("points_criterion_1", "points_criterion_3").first()
    assert tuple(points) == (0, 15)


# --- parameters --------------------------------------------------------------------

def test_weights_follow_the_list_sizes_and_steps(spark):
    rows = [row(1, desc=" ".join(f"w{c}x " * (20 - k) for k, c in enumerate("abcdefghijkl")))]
    job = CatalogJob(catalog(spark, rows), top_n=(12, 3, 2), weight_steps=(2, 5, 1))
    weights = [r.weight for r in job.rank_weights().orderBy(F.desc("weight")).collect() if r.list == "description"]
    assert weights == list(range(24, 0, -2))


def test_year_bands_and_target_are_parameters(spark):
    rows = [row(1, year="1950"), row(2, year="1990"), row(3, year="2020")]
    job = CatalogJob(catalog(spark, rows), year_bands=[(1940, 1959, 30), (1980, 1999, 15)], target=(0.0, 10.0))
    assert collect_map(job.scaled, "title_id", "sucesso") == {1: 10.0, 2: 5.0, 3: 0.0}
    assert collect_map(job.criterion("points_criterion_3"), "title_id", "points_criterion_3") == {1: 30, 2: 15, 3: 0}


def test_types_and_stop_list_are_parameters(spark):
    rows = [row(1, kind="Special", desc="alpha beta"), row(2, kind="Movie", desc="alpha")]
    job = CatalogJob(catalog(spark, rows), types=("Special",), stop_words=["beta"])
    assert [(r.type, r.n) for r in job.segment_sizes().collect()] == [("Special", 1)]
    assert [r.word for r in job.top_desc_words().collect()] == ["alpha"]


def test_other_keys_and_no_keys(spark):
    rows = [row(1, desc="love love"), row(2, desc="love"), row(3, desc="war", kind="TV Show")]
    by_rating = CatalogJob(catalog(spark, rows), keys=("platform", "rating"))
    top = by_rating.top_titles()
    assert top.columns.count("rating") == 1 and [r.title_id for r in top.orderBy(F.desc("total_points")).collect()][0] == 1
    whole = CatalogJob(catalog(spark, rows), candidates_from_rows(spark, [
        {"cand_id": 1, "platform": "q", "type": "Movie", "description": "love love"}]), keys=())
    # love is ranked first (10) and war second (9): 20, 10 and 9 points
    assert collect_map(whole.scaled, "title_id", "sucesso") == {1: 95.0, 2: 63.18, 3: 60.0}
    assert [tuple(r) for r in whole.segment_stats().collect()] == [(9, 20)]
    assert collect_map(whole.candidate_success(), "cand_id", "sucesso") == {1: 95.0}
    assert whole.top_titles().columns[0] == "title_id"


# --- best titles carry their own text ------------------------------------------------

def test_repeated_ids_keep_their_own_descriptions(spark):
    rows = [row(7, title=f"t{k}", desc=f"text number {k}") for k in range(4)] + [row(None, title="n", desc="none")]
    top = CatalogJob(catalog(spark, rows)).top_titles().collect()
    assert sorted((r.title, r.description) for r in top) == sorted(
        [(f"t{k}", f"text number {k}") for k in range(4)] + [("n", "none")])


def test_closed_job_deletes_its_tables(spark):
    import os
    with CatalogJob(catalog(spark, [row(1, desc="love")])) as job:
        assert job.scaled.count() == 1
        folders = [p.replace("file:", "") for p in job.tables]
        assert folders and all(os.path.isdir(p) for p in folders)
    assert not any(os.path.exists(p) for p in folders)
