import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from legtrail import schemas
from legtrail.operators import nested, select

ZONE = "Europe/Zurich"


def records(spark, *rows):
    """(aircraft, departure, arrival, origin, destination)"""
    return spark.createDataFrame(
        [(a, "CALL", d, r, o, to, None) for a, d, r, o, to in rows], schemas.RAW_FLIGHT
    )


def at(text):
    return datetime.fromisoformat(text)


def test_departure_range_is_closed_and_local(spark, rows):
    df = records(
        spark,
        ("a", at("2022-09-09 22:00:00"), None, "HOME", None),
        ("b", at("2022-09-09 21:59:59"), None, "HOME", None),
        ("c", at("2022-09-10 21:59:59"), None, "HOME", None),
        ("d", at("2022-09-10 22:00:00"), None, "HOME", None),
        ("e", at("2022-09-10 10:00:00"), None, "AWAY", None),
        ("f", at("2022-09-10 10:00:00"), None, None, None),
    )
    got = select.airport_departures(df, "HOME", "2022-09-10 00:00:00", "2022-09-10 23:59:59", ZONE)
    assert rows(got, "ICAO24") == [("a",), ("c",)]


def test_arrivals_use_the_arrival_time(spark, rows):
    df = records(
        spark,
        ("a", at("2022-10-12 20:00:00"), at("2022-10-12 23:00:00"), "AWAY", "HOME"),
        ("b", at("2022-10-13 20:00:00"), at("2022-10-13 23:00:00"), "AWAY", "HOME"),
        ("c", at("2022-10-13 10:00:00"), None, "AWAY", "HOME"),
    )
    got = select.airport_arrivals(df, "HOME", "2022-10-13 00:00:00", "2022-10-13 23:59:59", ZONE)
    assert rows(got, "ICAO24") == [("a",)]


def test_one_flight_in_both_selections(spark):
    df = records(spark, ("a", at("2022-09-10 08:00:00"), at("2022-09-10 09:00:00"), "HOME", "HOME"))
    span = ("2022-09-10 00:00:00", "2022-09-10 23:59:59", ZONE)
    assert select.airport_departures(df, "HOME", *span).count() == 1
    assert select.airport_arrivals(df, "HOME", *span).count() == 1


def test_range_reaches_the_scan(spark, tmp_path, plan):
    records(spark, ("a", at("2022-09-10 08:00:00"), None, "HOME", None)).write.parquet(str(tmp_path / "r"))
    df = spark.read.parquet(str(tmp_path / "r"))
    text = plan(select.airport_departures(df, "HOME", "2022-09-10 00:00:00", "2022-09-10 23:59:59", ZONE))
    assert "GreaterThanOrEqual(departure_time,2022-09-09T22:00)" in text
    assert "EqualTo(origin_airport,HOME)" in text


def test_on_days_stops_at_the_last_full_second(spark, rows):
    df = records(
        spark,
        ("a", at("2022-09-09 22:00:00"), None, "HOME", None),
        ("b", at("2022-09-10 21:59:59"), None, "HOME", None),
        ("c", at("2022-09-10 21:59:59.500000"), None, "HOME", None),
        ("d", at("2022-09-11 12:00:00"), None, "HOME", None),
        ("e", None, None, "HOME", None),
    )
    days = spark.createDataFrame([(date(2022, 9, 10),), (date(2022, 9, 10),)], "day date")
    assert rows(select.on_days(df, days, "departure_time", ZONE), "ICAO24") == [("a",), ("b",)]


def test_rolling_months_take_whole_months(spark, rows):
    df = spark.createDataFrame(
        [(date(2022, 11, 30),), (date(2022, 12, 1),), (date(2023, 4, 30),), (date(2023, 5, 1),), (None,)], "d date"
    )
    got = select.rolling_months(df, "d", F.lit(date(2023, 4, 26)))  # 120 days back: 2022-12-27
    assert rows(got) == [(date(2022, 12, 1),), (date(2023, 4, 30),)]


def test_latest_skips_nulls_and_takes_another_table(spark, rows):
    df = spark.createDataFrame([(1, "a"), (3, "b"), (3, "c"), (None, "d")], "n int, k string")
    other = spark.createDataFrame([(1,), (None,)], "m int")
    assert rows(select.latest(df, "n"), "k") == [("b",), ("c",)]
    assert rows(select.latest(df, "n", other, "m"), "k") == [("a",)]


def test_flatten_keeps_the_contract_whatever_is_null(spark):
    df = records(spark, ("abc123", at("2021-11-20 22:30:10"), at("2021-11-20 23:45:20"), "HOME", None))
    flat = nested.flatten_flights(df, "CET")
    assert flat.columns == schemas.FLIGHTS.names
    row = flat.first()
    assert (row.departure_date, row.arrival_date) == (date(2021, 11, 20), date(2021, 11, 21))
    assert row.id == "abc123_2021-11-20 23:30:10" and row.destination_airport_ICAO is None


def test_flatten_lists_skips_empty_and_null(spark, rows):
    record = records(spark, ("a", at("2022-09-10 08:00:00"), None, "HOME", None)).first().asDict()
    lists = spark.createDataFrame(
        [(1, [record, record]), (2, []), (3, None)], f"n int, l array<{schemas.RAW_FLIGHT.simpleString()}>"
    )
    assert rows(nested.flatten_lists(lists, "l", "CET", keep=["n"]), "n", "ICAO24") == [(1, "a"), (1, "a")]


@pytest.fixture
def nested_flights(spark):
    flights = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), ("z", 4)], "id string, copy int")
    points = spark.createDataFrame(
        [("x", 2, 20.0), ("x", 0, None), ("x", 1, 10.0), ("y", 5, 50.0)], "id string, step long, v double"
    )
    return nested.nest_trajectories(
        flights, points, ["id"], order=["step"], fields=["v"], block=F.floor(F.col("step") / 2)
    )


def test_nesting_sorts_and_goes_on_in_further_blocks(nested_flights, rows):
    got = [
        (row.id, row.copy, row.block, row.state_vectors and [tuple(p) for p in row.state_vectors])
        for row in nested_flights.collect()
    ]
    assert sorted(got, key=str) == sorted(
        [
            ("x", 1, 0, [(0, None), (1, 10.0)]),
            ("x", 1, 1, [(2, 20.0)]),
            ("x", 2, 0, [(0, None), (1, 10.0)]),
            ("x", 2, 1, [(2, 20.0)]),
            ("y", 3, 2, [(5, 50.0)]),
            ("z", 4, None, None),
        ],
        key=str,
    )


def test_explode_numbers_points_and_skips_null_series(nested_flights, rows):
    got = nested.explode_trajectory(nested_flights, "state_vectors", ["id", "copy", "block"], ["step"])
    assert rows(got.filter("copy <> 2")) == [("x", 1, 0, 1, 0), ("x", 1, 0, 2, 1), ("x", 1, 1, 1, 2), ("y", 3, 2, 1, 5)]


def test_only_trajectories(nested_flights):
    assert nested.trajectories(nested_flights, ["id"]).columns == ["id", "block", "state_vectors"]


@pytest.mark.parametrize("size", [1, 7, 1024])
def test_a_key_with_a_third_of_all_points_is_cut_in_blocks(spark, size):
    """Arrays are bounded, the place goes on from block to block; nulls last, copies count each."""
    draw = random.Random(size)
    data = [("hot" if draw.random() < 0.33 else f"k{draw.randrange(60)}", draw.choice([None, *range(50)]), draw.random() < 0.5)
            for _ in range(1500)]
    points = spark.createDataFrame(data + [(None, 1, True)], "id string, step int, up boolean").repartition(5)
    flights = spark.createDataFrame([("hot",), ("k1",), ("none",)], "id string")
    got = nested.nest_trajectories(flights, points, ["id"], order=["step", "up"], fields=["up"], block_size=size)
    assert got.selectExpr("max(size(state_vectors)) as n").first().n <= size
    last = lambda row: (row[0] is None, row[0] or 0, row[1])
    expected = [
        (key, n, *row)
        for key in ("hot", "k1")
        for n, row in enumerate(sorted([row[1:] for row in data if row[0] == key], key=last), 1)
    ]
    flat = nested.explode_trajectory(got, "state_vectors", ["id"], ["step", "up"], block_size=size)
    assert sorted(map(tuple, flat.collect()), key=lambda row: row[:2]) == expected
    assert [row.state_vectors for row in got.filter("id = 'none'").collect()] == [None]
