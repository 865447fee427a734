"""Line dedup: against SQL, odd rows, and no Python in the plan."""

import re

from llm.conftest import SMALL, collected, empty_of
from marquee.llm.line_dedup import line_dedup
from marquee.llm.oracle import ORACLE_SQL
from marquee.llm.queries import QUERIES
from oracle_compare import compare, duck

COLUMNS = ("id", "host", "text", "n_lines", "n_dropped")


def brute(rows, share, least):
    pages, seen = {}, {}
    for _, host, text in rows:
        pages[host] = pages.get(host, 0) + 1
        for line in {x for x in (text or "").split("\n") if x.strip(" \t\x0b\x0c\r")}:
            seen[host, line] = seen.get((host, line), 0) + 1
    out = []
    for i, host, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if not (seen.get((host, x), 0) >= least and seen[host, x] > share * pages[host])]
        out.append((i, host, "\n".join(kept), len(own), len(own) - len(kept)))
    return sorted(out, key=repr)


def test_query_equals_sql(spark):
    r = compare(spark, SMALL, "op8", QUERIES["op8_line_dedup"], ORACLE_SQL["op8_line_dedup"], duck(SMALL))
    assert r["values_match"], r


def test_sites_are_judged_alone(spark):
    rows = [(k, "a", f"MENU\nown {k}\n\nFOOT") for k in range(6)] + [(10 + k, "b", f"MENU\nb {k}") for k in range(40)]
    rows += [(60, "b", "FOOT\nFOOT"), (61, None, "MENU"), (62, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = line_dedup(df, share=0.5, least_pages=3)
    assert collected(got, *COLUMNS) == brute(rows, 0.5, 3)
    assert {r.text for r in got.collect() if r.id == 60} == {"FOOT\nFOOT"}


def test_odd_rows_and_empty_table(odd_rows):
    rows = [(r.doc_id, r.source, r.text) for r in odd_rows.collect()]
    assert collected(line_dedup(odd_rows, share=0.1, least_pages=2), *COLUMNS) == brute(rows, 0.1, 2)
    assert line_dedup(empty_of(odd_rows)).collect() == []


def test_plan_holds_no_python(odd_rows):
    plan = line_dedup(odd_rows)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
