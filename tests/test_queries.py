"""Every registered query against its DuckDB oracle (sf0.001), and the
entry point's smoke check."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from cellhouse.plans.registry import load_all  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

# the training-data queries have tests of their own
QUERIES = {n: q for n, q in E.queries().items() if n in load_all()[0]}
ORACLES = {n: q for n, q in E.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert len(QUERIES) >= 50


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLES[name])
    cols = [c[0] for c in cur.description]
    exp = rows_of(cols, cur.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == exp


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["row", "family", "qualifier", "ts", "value"]
