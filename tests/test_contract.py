"""All contract queries against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from linewright.plans.contract import ORACLES, QUERIES

SF = Path(contract.SMOKE_DIR)
TABLES = ["nation", "customer", "part", "orders", "lineitem", "events", "documents", "pages"]

pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, str(SF))
    columns = sorted(df.columns)
    got = sorted(tuple(repr(row[c]) for c in columns) for row in df.collect())
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    want = sorted(tuple(repr(row[names.index(c)]) for c in columns) for row in result.fetchall())
    assert sorted(names) == columns and got == want
