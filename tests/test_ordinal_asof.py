"""Numbering and as-of search against brute force, with a third of the rows in one group."""

import random
from bisect import bisect_left, bisect_right
from datetime import datetime, timedelta
from itertools import groupby

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from legtrail.functions import times
from legtrail.operators import ordinal, trajectory
from legtrail.operators.asof import asof
from legtrail.session import folder_names, scratch


@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 rows: a third on one day, of which half are copies of one row; some null days."""
    random = np.random.default_rng(1)
    data = []
    for n in range(20_000):
        kind = random.integers(0, 6)
        if kind == 0:
            data.append(("hot", 500, "copy"))
        elif kind == 1:
            data.append(("hot", int(random.integers(0, 1000)), f"r{n}"))
        elif kind == 2:
            data.append((None, int(random.integers(0, 1000)), f"r{n}"))
        else:
            late = None if n % 50 == 0 else int(random.integers(0, 1000))
            data.append((f"d{n % 40}", late, f"r{n}"))
    return data


def test_ordinal_equals_brute_force(spark, skewed):
    df = spark.createDataFrame(skewed, "day string, t int, k string").repartition(6)
    got = ordinal.with_ordinal(df, ["day"], ["t", "k"]).collect()
    order = lambda row: (row[1] is None, row[1] or 0, row[2])
    expected = []
    by_day = sorted(skewed, key=lambda row: (row[0] is not None, row[0] or "", *order(row)))
    for _, group in groupby(by_day, key=lambda row: row[0]):
        expected += [(*row, n) for n, row in enumerate(group, 1)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_ordinal_spreads_a_hot_group(spark, skewed):
    """Half of the hot day is copies of one row; its rows still lie in many partitions."""
    df = spark.createDataFrame(skewed, "day string, t int, k string")
    seen = []

    def staged(rows, purpose):
        kept = rows.cache()
        sizes = kept.filter("day = 'hot'").groupBy(F.shiftright("_at", 33)).count().collect()
        seen.extend(row["count"] for row in sizes)
        return kept

    kept, ordinal.staged = ordinal.staged, staged
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        ordinal.with_ordinal(df, ["day"], ["t", "k"]).count()
    finally:
        ordinal.staged = kept
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(seen) > 8 and max(seen) < sum(seen) / 6


def brute_asof(probes, states, later):
    by_key = {}
    for key, t, tie, v in states:
        kept = by_key.setdefault(key, {})
        if t not in kept or tie > kept[t][0]:
            kept[t] = (tie, v)
    found = []
    for key, t, n in probes:
        times_of = sorted(by_key.get(key, {}))
        at = bisect_left(times_of, t) if later else bisect_right(times_of, t) - 1
        hit = times_of[at] if 0 <= at < len(times_of) else None
        found.append((key, t, n, hit, by_key[key][hit][1] if hit is not None else None))
    return found


def run_asof(spark, probes, states, later):
    p = spark.createDataFrame(probes, "key string, t long, n int")
    s = spark.createDataFrame(states, "key string, t long, tie long, v double")
    got = asof(p, s, ["key"], "t", "t", ["v"], tie="tie", later=later)
    return [tuple(row) for row in got.select("key", "t", "n", "found_time", "v").collect()]


@pytest.mark.parametrize("later", [False, True])
def test_asof_with_a_hot_key(spark, later):
    random = np.random.default_rng(2)
    key = lambda: "hot" if random.random() < 0.4 else f"k{random.integers(0, 30)}"
    states = [
        (key(), int(random.integers(-500, 5000)), n, None if n % 9 == 0 else float(n)) for n in range(4000)
    ]
    states += [("hot", 777, 1, 1.0)] * 2000  # copies of one state
    probes = [(key(), int(random.integers(-800, 6000)), n) for n in range(4000)]
    probes.append(("unknown", 3, 9999))
    got = run_asof(spark, probes, states, later)
    assert sorted(got, key=str) == sorted(brute_asof(probes, states, later), key=str)


small = st.integers(-6, 6)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    probes=st.lists(st.tuples(st.sampled_from("ab"), small), min_size=1, max_size=8),
    states=st.lists(st.tuples(st.sampled_from("ab"), small, st.booleans()), min_size=1, max_size=8),
    later=st.booleans(),
)
def test_asof_at_any_edge(spark, probes, states, later):
    probes = [(k, t, n) for n, (k, t) in enumerate(probes)]
    states = [(k, t, n, None if null else float(n)) for n, (k, t, null) in enumerate(states)]
    got = run_asof(spark, probes, states, later)
    assert sorted(got, key=str) == sorted(brute_asof(probes, states, later), key=str)


def test_asof_spreads_a_hot_minute(spark, monkeypatch):
    """All states of one key, most in one instant; no partition of the sort has more than its share."""
    import legtrail.operators.asof as module

    sizes, staged = [], module.staged

    def watched(rows, purpose):
        kept = staged(rows, purpose)
        sizes.extend(r["count"] for r in kept.groupBy(F.shiftright("_at", 33)).count().collect())
        return kept

    monkeypatch.setattr(module, "staged", watched)
    states = [("hot", 777 if n % 4 else n, n, float(n)) for n in range(6000)]
    probes = [("hot", n, n) for n in range(0, 6000, 3)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        got = run_asof(spark, probes, states, False)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(got, key=str) == sorted(brute_asof(probes, states, False), key=str)
    assert len(sizes) >= 18 and max(sizes) < 2 * sum(sizes) / len(sizes)


START = datetime(2022, 12, 3, 19, 0)


def flight(aircraft, seconds, offset=0):
    start = START + timedelta(seconds=offset)
    end = None if seconds is None else start + timedelta(seconds=seconds)
    return (aircraft, f"{aircraft}-{offset}", start, end)


def flights_of(spark, *rows):
    return spark.createDataFrame(
        list(rows), "ICAO24 string, id string, departure_time timestamp_ntz, arrival_time timestamp_ntz"
    )


@pytest.mark.parametrize("seconds, n", [(0, 1), (179, 1), (180, 2), (181, 2), (3600, 21), (-1, 0), (None, 0)])
def test_grid_has_both_ends(spark, seconds, n):
    got = trajectory.grid(flights_of(spark, flight("a", seconds)), 180).collect()
    assert sorted(row.grid_step for row in got) == list(range(n))


def test_long_grid_is_whole_over_several_blocks(spark):
    got = trajectory.grid(flights_of(spark, flight("a", 10_000)), 1)
    assert got.count() == 10_001
    assert got.select("grid_micros").distinct().count() == 10_001
    last = got.agg(F.max(times.from_micros("grid_micros"))).first()[0]
    assert last == START + timedelta(seconds=10_000)


def test_exact_sampling_has_no_row_for_a_gap(spark, rows):
    # On the grid at 0, 180 and 540; 200 is off it; 360 is missing; 720 is after arrival.
    telemetry = spark.createDataFrame(
        [("a", START + timedelta(seconds=s), float(s) if s else None) for s in (0, 180, 200, 540, 720)]
        + [("b", START, 5.0)] + [("a", START + timedelta(seconds=180), 180.0)] * 50,  # copies
        "ICAO24 string, time timestamp_ntz, longitude double",
    )
    flights = flights_of(spark, flight("a", 600), flight("a", 400, 180), flight("c", 600))
    got = trajectory.sample_exact(flights, telemetry, 180, ["longitude"])
    assert rows(got, "id", "grid_step", "longitude") == [
        ("a-0", 0, None), ("a-0", 1, 180.0), ("a-0", 3, 540.0), ("a-180", 0, 180.0), ("a-180", 2, 540.0)
    ]


def test_exact_sampling_is_an_equality_join(spark, plan):
    telemetry = spark.createDataFrame([("a", START, 1.0)], "ICAO24 string, time timestamp_ntz, v double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(trajectory.sample_exact(flights_of(spark, flight("a", 600)), telemetry, 180, ["v"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_asof_sampling_takes_the_last_state_of_the_same_aircraft(spark, rows):
    telemetry = spark.createDataFrame(
        [("a", START + timedelta(seconds=s), float(s), s) for s in (-90_000, 170, 180, 190)],
        "ICAO24 string, time timestamp_ntz, velocity double, tie long",
    )
    flights = flights_of(spark, flight("a", 400), flight("b", 400))
    got = trajectory.sample_asof(flights, telemetry, 180, ["velocity"], "tie")
    assert rows(got, "id", "grid_step", "velocity") == [
        ("a-0", 0, -90_000.0), ("a-0", 1, 180.0), ("a-0", 2, 190.0)
    ]


def test_a_state_stays_whole_with_null_and_equal_ties(spark, rows):
    states = spark.createDataFrame(
        [("a", 1, None, 1.0, "x"), ("a", 1, None, 2.0, None), ("b", 1, 5, None, "p"), ("b", 1, 5, 3.0, None), (None, 1, 9, 9.0, "q")],
        "k string, t long, tie int, v double, w string",
    )
    probes = spark.createDataFrame([("a", 2), ("b", 2), (None, 2)], "k string, at long")
    got = asof(probes, states, ["k"], "at", "t", ["v", "w"], "tie")
    assert rows(got, "k", "found_time", "v", "w") == [(None, None, None, None), ("a", 1, 2.0, None), ("b", 1, 3.0, None)]


def _brute_force(flights, states, step, exact):
    found = []
    for aircraft, name, start, end in flights:
        for at in range(start, end + 1, step) if end is not None else ():
            own = [(t, v) for a, t, v in states if a == aircraft is not None and t is not None and (t == at if exact else t <= at)]
            found += [(name, (at - start) // step, max(own)[1])] if own else []
    return sorted(found)


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("n_states", [40, 4000])  # fewer, then more than grid points
def test_sampling_by_states_or_by_points_is_whole(spark, rows, exact, n_states):
    draw = random.Random(n_states)
    aircraft = ["a"] * 8 + ["b", "c", None]
    flights = [(draw.choice(aircraft), f"f{i}", s := draw.randrange(2000), s + draw.randrange(900)) for i in range(30)]
    flights += [("a", "never", 50, None), ("z", "stateless", 0, 100), ("a", "backwards", 90, 20), ("a", "short", 7, 7)]
    times_ = draw.sample([(a, t) for a in (*"abc", None) for t in range(3000)], n_states)
    states = [(a, t, float(t)) for a, t in times_] + [("a", None, 1.0)]
    at = lambda s: None if s is None else START + timedelta(seconds=s)
    table = spark.createDataFrame(
        [(a, n, at(s), at(e)) for a, n, s, e in flights],
        "ICAO24 string, id string, departure_time timestamp_ntz, arrival_time timestamp_ntz",
    )
    telemetry = spark.createDataFrame([(a, at(t), v) for a, t, v in states], "ICAO24 string, time timestamp_ntz, v double")
    sample = trajectory.sample_exact if exact else trajectory.sample_asof
    for tasks in (1, 3):
        got = sample(table, telemetry, 60, ["v"], tasks=tasks)
        assert rows(got, "id", "grid_step", "v") == _brute_force(flights, states, 60, exact)


@pytest.mark.parametrize("exact", [True, False])
def test_a_long_grid_with_few_states_is_not_sorted(spark, exact):
    telemetry = spark.createDataFrame(
        [("a", START + timedelta(seconds=s), float(s)) for s in (0, 5000, 9000)], "ICAO24 string, time timestamp_ntz, v double"
    )
    with scratch(spark) as kept:
        sample = trajectory.sample_exact if exact else trajectory.sample_asof
        got = sample(flights_of(spark, flight("a", 10_000)), telemetry, 1, ["v"], kept=kept)
        assert got.agg(F.count("*"), F.sum("v")).first() == ((3, 14_000) if exact else (10_001, 4000 * 5000 + 1001 * 9000))
        tables = [f"{kept.folder}/{name}" for name in folder_names(spark, kept.folder)]
        assert sum(spark.read.parquet(table).count() for table in tables) < 30
