"""Stop lists as tables, top terms in two passes, and ranks of all rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SMOKE
from marquee.operators.heavy import candidates, summaries, top_terms_two_pass
from marquee.operators.rank import ranked
from marquee.operators.topk import top_terms
from marquee.plans.job import CatalogJob
from marquee.sources.candidates import candidates_from_tables
from marquee.sources.catalog import catalog_from_tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def many_stops(spark):
    """100,005 stop words as a table, with a null and a repeated one; and those that texts hold, as a list.

    The others are made up. (A literal list of them all takes minutes to plan: that is what the table is for.)
    """
    words = ["the", "and", "ing", "thand", "les"]
    made_up = spark.range(100_000).select(F.concat(F.lit("zz9"), F.col("id")).alias("anything"))
    return words, made_up.union(spark.createDataFrame([(w,) for w in words + [None, "the"]], "anything string"))


def test_stop_table_equals_the_literal_list(spark, many_stops):
    words, table = many_stops
    cat, cands = catalog_from_tables(spark, SMOKE), candidates_from_tables(spark, SMOKE)
    with CatalogJob(cat, cands, stop_words=table) as by_table, CatalogJob(cat, cands, stop_words=words) as by_list:
        for name in ("top_desc_words", "desc_clean", "report_lines", "candidate_success", "catalog_with_candidates",
                     "top_desc_words_two_pass"):
            assert _rows(getattr(by_table, name)()) == _rows(getattr(by_list, name)()), name
        assert _rows(by_table.top_titles()) == _rows(by_list.top_titles())


def test_no_literal_list_in_the_plan(spark, many_stops):
    with CatalogJob(catalog_from_tables(spark, SMOKE), stop_words=many_stops[1]) as job:
        plan = _plan(job.top_desc_words())
        assert "INSET" not in plan.upper() and "zz9" not in plan.replace("zz9,", "") and "LeftOuter" in plan
        # The join stands above both aggregations: it sees counted terms, not tokens.
        assert plan.index("LeftOuter") < plan.index("HashAggregate")


def test_stop_table_beyond_a_broadcast(spark, many_stops):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with CatalogJob(catalog_from_tables(spark, SMOKE), stop_words=many_stops[1]) as job:
            shuffled = _rows(job.top_title_words())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    with CatalogJob(catalog_from_tables(spark, SMOKE), stop_words=many_stops[0]) as job:
        assert shuffled == _rows(job.top_title_words())


def _tokens(spark, seed, n=3000):
    """Segments of a skewed, a flat and a tiny vocabulary, with ties, and a null segment."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        skewed = [f"w{int(rng.paretovariate(0.9))}" for _ in range(10)]
        rows.append(("skewed", "a", skewed))
        rows.append(("flat", "a", [f"f{rng.randrange(5000)}" for _ in range(10)]))
        if k % 100 == 0:
            rows.append((None, "b", ["x", "y", "y", "z", "t"]))
    rows += [("tied", None, [f"t{i}" for i in range(40)])] * 30 + [("empty", "a", [])]
    return spark.createDataFrame(rows, "platform string, type string, terms array<string>").repartition(8)


@pytest.mark.parametrize("tracked", [64, 1000])
def test_two_passes_equal_one(spark, tracked):
    frame = _tokens(spark, tracked).cache()
    want = _rows(top_terms(frame, F.col("terms"), "word", 10))
    assert _rows(top_terms_two_pass(frame, F.col("terms"), "word", 10, tracked)) == want


def test_summaries_leave_out_no_frequent_term(spark):
    """Whatever is not a candidate has fewer occurrences than the last of the best, or the list is not proven."""
    frame = _tokens(spark, 5).cache()
    found = candidates(summaries(frame, F.col("terms"), 1024), 10, 1024)
    skewed = found.filter("platform = 'skewed'").collect()
    assert len(skewed) < 1024
    exact = dict(frame.filter("platform = 'skewed'").select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    listed = {r.term for r in skewed}
    last = sorted(exact.values(), reverse=True)[9]
    assert last > skewed[0].unseen and all(n < last for t, n in exact.items() if t not in listed)


def test_all_ranks_equal_row_number(spark):
    rng = random.Random(3)
    rows = [("hot" if k % 3 else rng.choice(["a", None, "b"]), "m", k, rng.randrange(20)) for k in range(5000)]
    frame = spark.createDataFrame(rows, "platform string, type string, id long, points int").repartition(7)
    order = [F.col("points").desc(), F.col("id").asc()]
    want = frame.withColumn("rank", F.row_number().over(Window.partitionBy("platform", "type").orderBy(*order)))
    got = ranked(frame, order)
    assert _rows(got) == _rows(want.withColumn("rank", F.col("rank").cast("bigint")))
    assert "Window" not in _plan(got)  # only the written shares of tasks were windowed
    assert ranked(frame.limit(0), order).collect() == []


def test_title_ranks_agree_with_the_best_titles(spark):
    with CatalogJob(catalog_from_tables(spark, SMOKE)) as job:
        best = _rows(job.top_titles().select("platform", "type", "title_id"))
        ranks = job.title_ranks()
        assert _rows(ranks.filter("rank <= 15").select("platform", "type", "title_id")) == best
        assert ranks.count() == job.scored_table.count()
