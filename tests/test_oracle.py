"""Every registered query with SQL matches its DuckDB restatement (small scale factor).

The driver runs the same comparison at sf0.01; this keeps it green while
iterating.  Columns are compared by name, rows order-insensitively.
"""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

from conftest import SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

SQLS = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_oracle_key_is_a_query():
    assert set(SQLS) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(SQLS))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"))
    got = df.toPandas()
    want = duck.execute(SQLS[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    _, rg = rows_of(got)
    _, rw = rows_of(want)
    assert rg == rw


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[0] == "sales_date"
