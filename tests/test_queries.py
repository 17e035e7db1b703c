"""Every query against DuckDB on the smallest given tables, and the shape of its plan."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as repo
from catalog import ORACLES, QUERIES
from tests import skewed

SF_DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="given tables not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS FROM '{path}'")
    return con


def by_name(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    plain = lambda v: f"{v:.9g}" if isinstance(v, float) else v
    return [names[i] for i in order], Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(repo.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, plan, name):
    df = QUERIES[name](spark, str(SF_DIR))
    text = plan(df)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in text
    result = duck.execute(ORACLES[name])
    expected = by_name([column[0] for column in result.description], result.fetchall())
    assert by_name(df.columns, df.collect()) == expected
    assert sum(expected[1].values())


def test_entry(spark):
    df = repo.entry(spark)
    assert df.columns[:5] == ["ICAO24", "requested_time", "velocity", "geo_altitude", "id"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["ingest_movements", "flight_ordinal", "trajectory_grid_asof"])
def test_skewed_events(spark, tmp_path, name):
    """A third of the rows from one user, a sixth in one minute."""
    skewed.events(spark, 6000).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS FROM '{tmp_path}/events.parquet/*.parquet'")
    result = con.execute(ORACLES[name])
    expected = by_name([column[0] for column in result.description], result.fetchall())
    df = QUERIES[name](spark, str(tmp_path))
    assert by_name(df.columns, df.collect()) == expected
