"""Plan checks: no Python in the plans, no product joins, broadcasts for the per-segment
tables, grouped top-k limited on both sides of its shuffle, pruned and pushed-down scans."""

import pytest

from conftest import SMOKE
import __spark_entry__ as entry
from marquee.plans.queries import QUERIES

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "FlatMapGroupsInPandas", "MapInPandas")


def executed_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_product_join(spark, name):
    plan = executed_plan(QUERIES[name](spark, SMOKE))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"


@pytest.mark.parametrize("name", ["score_description", "success_scaled", "candidate_success"])
def test_per_segment_tables_are_broadcast(spark, name):
    plan = executed_plan(QUERIES[name](spark, SMOKE))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("name", ["top_desc_words", "top_genres", "top_title_words", "rank_weights",
                                  "report_lines"])
def test_grouped_top_k_limits_before_the_shuffle(spark, name):
    df = QUERIES[name](spark, SMOKE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "Partial" in text and "Final" in text


def test_scan_reads_only_needed_columns(spark):
    df = QUERIES["top_genres"](spark, SMOKE)
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    scans = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    # documents are read without their text: genres need ids and keys only
    assert any("lang" in s and "text" not in s for s in scans), scans


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns[:3] == ["platform", "type", "title_id"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_text_is_tokenised_once_per_source(spark, name):
    """A plan that re-derives a shared subplan (e.g. one filter per list) would scan and
    tokenise the same text again; every text source is tokenised at most once."""
    plan = executed_plan(QUERIES[name](spark, SMOKE))
    sources = 2 if name == "catalog_with_candidates" else 1
    # description words are letter runs of at least 3 (titles use the same rule with 1)
    assert plan.count(r"\p{L}{3,}") <= sources, name


@pytest.mark.parametrize("name", ["top15_titles", "report_lines"])
def test_documents_are_scanned_once(spark, name, monkeypatch):
    """The tokens table (or the one lazy pass) is the only reader of the catalogue's texts."""
    from marquee.plans import job as job_module
    plans = []

    def write(df, table, paths=None):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, table, paths)

    from marquee.plans.materialize import materialize
    monkeypatch.setattr(job_module, "materialize", write)
    plans.append(executed_plan(QUERIES[name](spark, SMOKE)))
    # AQE prints a plan twice (initial and final): count the scans that read texts in the final one.
    scans = [p.split("== Initial Plan ==")[0].count("documents.parquet") for p in plans]
    assert sum(scans) == 1, scans
