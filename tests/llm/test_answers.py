"""Queries that have an SQL answer, against DuckDB."""

import duckdb
import pytest

from linewright.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_answer(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages", "labels", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = c.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == sorted(map(str, cursor.fetchall()))
