from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from legtrail.functions import names, times

ZONE = "Europe/Zurich"


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def test_local_time_follows_summer_time(spark):
    got = one(
        spark,
        times.local_time(ntz("2021-07-04 05:30:15"), "CET"),
        times.local_time(ntz("2021-12-05 18:40:00"), "CET"),
        times.local_date(ntz("2021-11-20 23:30:05"), ZONE),
    )
    assert got == (datetime(2021, 7, 4, 7, 30, 15), datetime(2021, 12, 5, 19, 40), date(2021, 11, 21))


@pytest.mark.parametrize(
    "day, start, end, hours",
    [
        ("2023-03-25", "2023-03-24 23:00:00", "2023-03-25 22:59:59", 24),
        ("2023-03-26", "2023-03-25 23:00:00", "2023-03-26 21:59:59", 23),
        ("2022-10-30", "2022-10-29 22:00:00", "2022-10-30 22:59:59", 25),
    ],
)
def test_day_bounds(spark, day, start, end, hours):
    first, last = times.day_start(F.lit(day).cast("date"), ZONE), times.day_end(F.lit(day).cast("date"), ZONE)
    length = times.epoch_micros(last) - times.epoch_micros(first)
    got = one(spark, first.cast("string"), last.cast("string"), length)
    assert got == (start, end, (hours * 3600 - 1) * 1_000_000)


@pytest.mark.parametrize("text, micros", [
    ("1970-01-01 00:00:00", 0),
    ("2021-05-06 07:08:09", 1_620_284_889_000_000),
    ("2024-01-01 00:00:11.172425", 1_704_067_211_172_425),
    ("1969-12-31 23:59:59.999999", -1),
])
def test_micros_both_ways(spark, text, micros):
    got = one(spark, times.epoch_micros(ntz(text)), times.from_micros(F.lit(micros)).cast("string"))
    assert got == (micros, text)


def test_times_do_not_depend_on_the_session_zone(spark):
    instant = F.expr("timestamp_micros(1679790600123456)")  # inside a spring gap of some zones
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("America/New_York", "Europe/Zurich", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            clock = times.utc_clock(instant)
            key = names.flight_key(F.lit("abc456"), ntz("2023-03-26 02:30:00"), ZONE)
            got = one(spark, clock.cast("string"), times.epoch_micros(clock), key)
            assert got == (
                "2023-03-26 00:30:00.123456", 1_679_790_600_123_456, "abc456_2023-03-26 04:30:00"
            )
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_slices_below_and_above_zero(spark):
    got = one(spark, *[times.whole_slices(F.lit(n), 10) for n in (-11, -10, -1, 0, 9, 10)])
    assert got == (-2, -1, -1, 0, 0, 1)


def test_floor_to_hour(spark):
    got = one(spark, times.floor_to(ntz("2024-01-01 05:59:59.999999"), 3600).cast("string"))
    assert got == ("2024-01-01 05:00:00",)


def test_key_needs_both_parts(spark):
    null = F.lit(None)
    got = one(
        spark,
        names.flight_key(F.lit("77abcd"), ntz("2031-07-04 06:05:04"), "CET"),
        names.flight_key(null.cast("string"), ntz("2031-07-04 06:05:04"), "CET"),
        names.flight_key(F.lit("77abcd"), null.cast("timestamp_ntz"), "CET"),
        names.flight_key(F.lit("77abcd"), ntz("2031-07-03 22:00:00"), "CET"),
    )
    assert got == ("77abcd_2031-07-04 08:05:04", None, None, "77abcd_2031-07-04 00:00:00")


def test_names(spark):
    day = F.lit("2022-09-10").cast("date")
    got = one(
        spark,
        names.partition_name("data", F.lit("bl_dep"), day),
        names.alternatives(names.months_back(day, 120)),
    )
    assert got == ("data/bl_dep_2022_09_10.csv", "2022_05|2022_06|2022_07|2022_08|2022_09")
    assert names.name_pattern("bl_dep") == r"^bl_dep_\d+"
    assert names.name_pattern("bl_dep_SV", ["2022_08", "2022_09"]) == "^bl_dep_SV_(2022_08|2022_09)"


def test_look_back_ends_yesterday(spark):
    days = one(spark, times.look_back(F.lit(date(2023, 4, 26)), 30))[0]
    assert (days[0], days[-1], len(days)) == (date(2023, 3, 27), date(2023, 4, 25), 30)
