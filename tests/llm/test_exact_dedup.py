"""Exact dedup: against SQL, odd rows, struck identifiers, and no Python in the plans."""

import hashlib
import re

from pyspark.sql import functions as F

from llm.conftest import SMOKE, collected, empty_of
from marquee.llm import exact_dedup as module
from marquee.llm.exact_dedup import ambiguous, chunks, exact_dedup, recipes
from marquee.llm.oracle import ORACLE_SQL
from marquee.llm.queries import QUERIES
from oracle_compare import compare, duck


def brute(rows):
    groups = {}
    norm = [(i, re.sub(r"[ \t-\r]+", " ", t or "")) for i, t in rows]
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    out = []
    for i, t in norm:
        known = [x for x in groups[t] if x is not None]
        keep = min(known) if known else None
        out.append((i, keep, len(groups[t]), i is not None and i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_query_equals_sql(spark):
    r = compare(spark, SMOKE, "op6", QUERIES["op6_exact_dedup"], ORACLE_SQL["op6_exact_dedup"], duck(SMOKE))
    assert r["values_match"], r


def test_odd_rows(odd_rows):
    got = exact_dedup(odd_rows)
    assert got.columns == list(COLUMNS)
    assert collected(got, *COLUMNS) == brute([(r.doc_id, r.text) for r in odd_rows.collect()])


def test_empty_table(odd_rows):
    assert exact_dedup(empty_of(odd_rows)).collect() == []


def test_chunks_cover_the_text_and_follow_its_content(spark):
    shared = "".join(f"Sentence number {k} says something of its own. " for k in range(200))
    texts = [shared, "x" * 700 + ". " + shared, "y" * 5000, ""]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    cut = {r.k: r.c for r in df.select("k", chunks(F.col("t")).alias("c")).collect()}
    assert all("".join(cut[k]) == t for k, t in enumerate(texts))
    assert all(len(c) <= module.CHUNK_MOST for row in cut.values() for c in row)
    assert len(set(cut[0]) & set(cut[1])) >= len(cut[0]) - 2


def test_identifiers_of_different_chunks_are_struck_out(spark, monkeypatch):
    """With identifiers of one bit nearly all collide, and the recipes' SHA-256s decide."""
    real = module.F.xxhash64
    monkeypatch.setattr(module.F, "xxhash64", lambda *c: real(*c) % 2)
    rows = [(k, f"text number {k % 7}. " * 40) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ambiguous(recipes(df)).count() > 0
    assert collected(exact_dedup(df), *COLUMNS) == brute(rows)


def test_plans_hold_no_python(spark, odd_rows):
    plan = exact_dedup(odd_rows)._jdf.queryExecution().executedPlan().toString()
    plan += ambiguous(recipes(odd_rows))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
