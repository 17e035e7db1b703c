"""Queries that SQL can express, against DuckDB on the smallest given tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from legtrail.llm.queries import ORACLES, QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="given tables not there")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS FROM '{path}'")
    result = con.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    df = QUERIES[name](spark, str(SF_DIR))
    assert sorted(df.columns) == sorted(columns)
    assert Counter(map(tuple, df.select(*columns).collect())) == Counter(map(tuple, result.fetchall()))
