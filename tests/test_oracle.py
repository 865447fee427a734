"""Every registered query against its DuckDB SQL (the driver's correctness gate, run locally).

At sf0.001 by default; set MARQUEE_ORACLE_SF=/root/testdata/sf0.01 for the gate's scale.
"""

import os

import pytest

from conftest import SMOKE
from marquee.plans.oracle import oracle_sql
from marquee.plans.queries import QUERIES
from oracle_compare import compare, duck

SF = os.environ.get("MARQUEE_ORACLE_SF", SMOKE)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF, name, QUERIES[name], oracle_sql()[name], con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["values_match"], r
