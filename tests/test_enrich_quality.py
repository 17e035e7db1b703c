from datetime import date

from pyspark.sql import functions as F

from legtrail.functions import times
from legtrail.operators import enrich, quality

D1, D2, D3 = date(2022, 11, 1), date(2022, 11, 2), date(2022, 11, 3)


def test_dates_fan_out_and_unknown_points_stay(spark, rows):
    points = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), (None, 4)], "id string, n int")
    flights = spark.createDataFrame(
        [("x", D1, D1), ("x", D1, D2), (None, D3, D3), ("z", D3, D3)],
        "id string, departure_date date, arrival_date date",
    )
    got = enrich.attach_dates(points, flights)
    assert rows(got, "n", "departure_date", "arrival_date") == [
        (1, D1, D1), (1, D1, D2), (2, D1, D1), (2, D1, D2), (3, None, None), (4, None, None)
    ]


def test_flight_id_by_day_and_number(spark, rows):
    flights = spark.createDataFrame([(D1, 1, "x"), (D1, 2, "y"), (D2, 1, "z")], "day date, idx int, id string")
    points = spark.createDataFrame([(D1, 2, "p"), (D2, 1, "q"), (D2, 2, "r")], "day date, idx int, v string")
    got = enrich.attach_flight_id(points, flights, by=["day"])
    assert got.columns == ["day", "v", "id"]
    assert rows(got, "v", "id") == [("p", "y"), ("q", "z"), ("r", None)]


def test_airport_details_for_both_ends(spark, rows):
    airports = spark.createDataFrame([("H", "Home"), ("A", "Away")], "code string, name string")
    flights = spark.createDataFrame([(1, "H", "A"), (2, "A", None), (3, "H", "?")], "n int, o string, d string")
    got = enrich.airport_metadata(flights, airports, "code", ["name"], {"o": "o_", "d": "d_"})
    assert rows(got, "n", "o_name", "d_name") == [(1, "Home", "Away"), (2, "Away", None), (3, "Home", None)]


def test_orphans_count_points_and_null_is_an_id(spark, rows):
    points = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "id string")
    flights = spark.createDataFrame([("x",), ("x",)], "id string")
    assert rows(quality.orphans(points, flights)) == [(None, 1), ("y", 2)]
    with_null = flights.unionByName(spark.createDataFrame([(None,)], "id string"))
    assert rows(quality.orphans(points, with_null)) == [("y", 2)]


def days(spark):
    return quality.spine(spark.range(1), times.date_sequence(F.lit(D1), F.lit(D3)))


def test_a_day_is_missing_if_any_family_is(spark, rows):
    data = spark.createDataFrame(
        [(D1, "a"), (D1, "b"), (D2, "a"), (D2, "a"), (date(2022, 12, 1), "b")], "d date, f string"
    )
    counts = quality.family_counts(data, "d", "f")
    assert rows(quality.missing_dates(days(spark), counts, ["a", "b"])) == [(D2,), (D3,)]
    assert rows(quality.missing_dates(days(spark), counts, ["a"])) == [(D3,)]
    assert rows(quality.missing_dates(days(spark), counts, ["a"], threshold=1)) == [(D1,), (D3,)]


def test_no_counts_means_all_missing(spark):
    empty = spark.createDataFrame([], "day date, family string, n long")
    assert quality.missing_dates(days(spark), empty, ["a"]).count() == 3


def test_day_sizes_use_a_strict_threshold(spark, rows):
    counts = spark.createDataFrame([(D1, 5), (D2, 6)], "day date, n long")
    assert rows(quality.day_sizes(days(spark), counts, 5)) == [(D1, 5, False), (D2, 6, True), (D3, 0, False)]


def test_chunks_over_several_dates(spark, rows):
    data = spark.createDataFrame([(D2, D1), (D2, D2), (D2, D2), (D3, D3)], "a date, d date")
    assert rows(quality.multi_date_chunks(data, "a", "d")) == [(D2, 2)]


def test_latest_days_compared(spark, rows):
    departures = spark.createDataFrame([(D1,), (D3,)], "arrival_date date")
    arrivals = spark.createDataFrame([(D2,)], "departure_date date")
    assert rows(quality.latest_day_agreement(departures, arrivals)) == [(D2, D3, False)]
    nothing = arrivals.limit(0)
    assert rows(quality.latest_day_agreement(departures.limit(0), nothing)) == [(None, None, True)]


def test_report_of_empty_inputs(spark, rows):
    empty = spark.createDataFrame([], "id string")
    assert rows(quality.integrity_report(empty, empty)) == [
        ("flights_not_empty", 0, False), ("orphan_trajectories", 0, True), ("points_not_empty", 0, False)
    ]
