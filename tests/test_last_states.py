"""Last states carried from day to day, against brute force and against reading all history."""

import random
import shutil
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from legtrail import schemas
from legtrail.plans import ingest
from legtrail.sources import last_states, store
from tests.test_plans import ZONE, sizes

START = datetime(2024, 1, 1)
KIND = "ICAO24 string, time timestamp_ntz, velocity double, geo_altitude double, tie long"


def drawn(seed, days=12, n=600):
    """States of few aircraft with ties, nulls, copies; some aircraft are silent for most of the time."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        aircraft = draw.choice(["a", "a", "a", "b", "c", None])
        time = START + timedelta(days=draw.randrange(days), minutes=draw.randrange(0, 1440, 90))
        rows.append((aircraft, time, draw.choice([None, 1.0, 2.0]), draw.choice([None, 3.0]), draw.choice([None, i % 3])))
    rows += [("silent", START + timedelta(minutes=7), 4.0, None, 1), ("silent", START + timedelta(minutes=7), 5.0, None, None)]
    rows += [("late", START + timedelta(days=days - 1, hours=23, minutes=59, seconds=59), 6.0, 1.0, 1), ("b", None, 1.0, 1.0, 1)]
    return rows + rows[:50]


@pytest.fixture
def stored(spark, tmp_path):
    def make(rows, name="telemetry"):
        states = spark.createDataFrame(rows, KIND)
        dated = states.withColumn("utc_day", F.col("time").cast("date"))
        dated.repartition(1).write.partitionBy("utc_day").parquet(str(tmp_path / name))
        return read(spark, tmp_path / name)

    return make


def read(spark, path):
    return spark.read.schema(f"{KIND}, utc_day date").parquet(str(path))


def plain(rows, day):
    """Last whole state of each aircraft up to the end of a day; nulls lowest."""
    low = lambda value: (value is not None, value or 0)
    best = {}
    for aircraft, time, velocity, altitude, tie in rows:
        if aircraft is not None and time is not None and time.date() <= day:
            rank = (time, low(tie), low(velocity), low(altitude))
            if aircraft not in best or rank > best[aircraft][0]:
                best[aircraft] = rank, (aircraft, time, velocity, altitude, tie)
    return sorted((row for _, row in best.values()), key=str)


def kept(spark, path, telemetry, day):
    rows = last_states.at_end_of(telemetry, str(path), [day], "utc_day")
    return sorted(map(tuple, rows.select("ICAO24", "time", "velocity", "geo_altitude", "tie").collect()), key=str)


@pytest.mark.parametrize("steps", [[[11]], [[0], [1], [5], [11]], [[3, 4, 9]], [[9], [2], [2, 6, 11]]])
def test_tables_equal_brute_force_whatever_they_were_made_from(spark, stored, tmp_path, steps):
    rows = drawn(len(steps))
    telemetry = stored(rows)
    asked = set()
    for step in steps:
        days = [START.date() + timedelta(days=d) for d in step]
        last_states.keep_up(telemetry, str(tmp_path / "last"), days, "utc_day")
        asked |= set(days)
    assert last_states.days_kept(spark, str(tmp_path / "last")) == sorted(asked)
    for day in asked:
        assert kept(spark, tmp_path / "last", telemetry, day) == plain(rows, day)


def test_a_day_follows_from_the_day_before(spark, stored, tmp_path):
    """Once the eve's table is there, older telemetry may be gone."""
    rows = drawn(8)
    telemetry = stored(rows)
    fifth, sixth = date(2024, 1, 5), date(2024, 1, 6)
    last_states.keep_up(telemetry, str(tmp_path / "last"), [fifth], "utc_day")
    for d in range(1, 6):
        shutil.rmtree(tmp_path / "telemetry" / f"utc_day=2024-01-0{d}")
    assert kept(spark, tmp_path / "last", read(spark, tmp_path / "telemetry"), sixth) == plain(rows, sixth)


def test_changed_telemetry_is_forgotten_and_made_anew(spark, stored, tmp_path):
    rows = drawn(9)
    days = [START.date() + timedelta(days=d) for d in (2, 4, 6)]
    path = str(tmp_path / "last")
    last_states.keep_up(stored(rows), path, days, "utc_day")
    late = rows + [("new", START + timedelta(days=4), 9.0, 9.0, 1)]
    telemetry = stored(late, "changed")
    last_states.forget(spark, path, days[1])
    assert last_states.days_kept(spark, path) == days[:1]
    assert kept(spark, path, telemetry, days[2]) == plain(late, days[2])


def test_other_columns_are_refused_and_no_telemetry_gives_no_rows(spark, stored, tmp_path):
    day, path = START.date(), str(tmp_path / "last")
    nothing = stored(drawn(1)).filter("false")
    assert last_states.at_end_of(nothing, path, [day], "utc_day").collect() == []
    telemetry = read(spark, tmp_path / "telemetry")
    last_states.keep_up(telemetry, path, [day], "utc_day")
    with pytest.raises(ValueError, match="columns"):
        last_states.at_end_of(telemetry.drop("velocity"), path, [day], "utc_day")


def test_stretches_of_days():
    day = lambda n: date(2024, 2, 27) + timedelta(days=n)
    assert last_states.runs([day(3), day(0), day(1), day(1), day(7)]) == [(day(0), day(1)), (day(3), day(3)), (day(7), day(7))]
    assert last_states.runs([]) == []


def leg(aircraft, day, hour, hours, origin="HOME", destination="AWAY"):
    start = START + timedelta(days=day, hours=hour)
    return (aircraft, "C", start, start + timedelta(hours=hours), origin, destination, None)


LEGS = [leg("a", 2, 8, 3), leg("silent", 2, 9, 2), leg("b", 2, 23, 4), leg("c", 2, 5, 1, "AWAY", "HOME"), leg("late", 2, 7, 1),
        leg("silent", 9, 6, 30), leg("a", 9, 1, 1, "AWAY", "HOME"), leg(None, 9, 1, 1)]


def points(spark, folder):
    rows = store.read_partitions(spark, ingest.points_path(str(folder)), schemas.STORED_POINTS, ingest.PARTITIONS)
    return sorted(map(str, map(tuple, rows.select("family", "day", *schemas.STORED_POINTS.names).collect())))


@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_an_ingest_reads_its_days_and_their_eves(spark, stored, tmp_path, monkeypatch, broadcast):
    """All but the days that flights touch is unreadable; the result is that of all history."""
    monkeypatch.setattr(ingest, "MAX_BROADCAST_AIRCRAFT", broadcast)
    rows = drawn(5)
    telemetry = stored(rows)
    records = spark.createDataFrame(LEGS, schemas.RAW_FLIGHT)
    span = ("HOME", "2024-01-01 00:00:00", "2024-01-31 00:00:00", ZONE)
    options = dict(step=1800, exact=False, has_tie=True, telemetry_day="utc_day")
    ingest.ingest_movements(records, telemetry, str(tmp_path / "all"), *span, **options)

    path = str(tmp_path / "last")
    eves = [date(2024, 1, 2), date(2024, 1, 9)]
    last_states.keep_up(telemetry, path, eves, "utc_day")
    read_days = {"2024-01-03", "2024-01-04", "2024-01-10", "2024-01-11"}
    for folder in (tmp_path / "telemetry").glob("utc_day=*"):
        if folder.name.removeprefix("utc_day=") not in read_days:
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"no Parquet")
            for file in folder.glob(".*.crc"):
                file.unlink()
    telemetry = read(spark, tmp_path / "telemetry")
    ingest.ingest_movements(records, telemetry, str(tmp_path / "eves"), *span, **options, carried=path)
    assert sizes(spark, tmp_path / "eves") == sizes(spark, tmp_path / "all")
    assert points(spark, tmp_path / "eves") == points(spark, tmp_path / "all") and len(points(spark, tmp_path / "all")) > 60
    assert last_states.days_kept(spark, path) == eves


def test_rows_scanned(spark, stored, tmp_path):
    """Thirty days of telemetry: what a day's flights get is that day's rows and one per aircraft."""
    rows = [(f"p{i % 20}", START + timedelta(days=d, minutes=i), 1.0, 2.0, i) for d in range(30) for i in range(200)]
    telemetry = stored(rows + [("silent", START, 1.0, 1.0, 1)])
    path = str(tmp_path / "last")
    day = START.date() + timedelta(days=29)
    last_states.keep_up(telemetry, path, [day - timedelta(days=1)], "utc_day")
    assert last_states.telemetry_on(telemetry, path, [day], "utc_day").count() == 200 + 21


def test_carried_states_need_a_day(spark, stored, tmp_path):
    records = spark.createDataFrame(LEGS, schemas.RAW_FLIGHT)
    with pytest.raises(ValueError, match="partition column"):
        ingest.ingest_movements(
            records, stored(drawn(1)).drop("utc_day"), str(tmp_path / "out"), "HOME", "2024-01-01 00:00:00",
            "2024-01-31 00:00:00", ZONE, exact=False, carried=str(tmp_path / "last"),
        )
