"""Every registered query against its DuckDB twin (the driver's check)."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import TABLES, digest  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from conftest import SF01  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF01)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(exp)
    assert digest(df.columns, got)[0] == digest(cols, exp)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_date", "region", "total_revenue", "order_count", "avg_order_cents"]


def test_every_query_has_a_callable(spark):
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
