"""Whole runs on a small airfield."""

from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from legtrail import schemas
from legtrail.plans import consolidate, explore, ingest
from legtrail.sources import csv_files, store

ZONE = "Europe/Zurich"
DAY = datetime(2022, 11, 12)


def leg(aircraft, hour, minutes, origin, destination, day=0):
    start = DAY + timedelta(days=day, hours=hour)
    return (aircraft, "C", start, start + timedelta(minutes=minutes), origin, destination, None)


LEGS = [
    leg("a", 8, 12, "HOME", "AWAY"),
    leg("a", 8, 12, "HOME", "AWAY"),  # an exact copy
    leg("b", 9, 9, "HOME", "HOME"),  # in both families
    leg("c", 22.9, 30, "AWAY", "HOME"),  # arrives on the next local day
    leg("d", 10, 6, "HOME", None),
    leg("e", 10, 6, "HOME", "AWAY", day=1),
    leg("f", 11, 6, "AWAY", "HOME", day=1),
    leg("g", 11, 6, "AWAY", "ELSEWHERE"),
    leg("h", 12, 6, "HOME", "AWAY", day=2),  # no telemetry
]


@pytest.fixture
def records(spark):
    return spark.createDataFrame(LEGS, schemas.RAW_FLIGHT)


@pytest.fixture
def telemetry(spark):
    """One state a minute, on every grid of 180 s."""
    rows = [
        (a, start + timedelta(minutes=m), float(m), None if m == 0 else 6.5, m)
        for a, _, start, end, *_ in set(leg[:6] for leg in LEGS)
        if a != "h"
        for m in range(int((end - start).total_seconds() // 60) + 1)
    ]
    return spark.createDataFrame(
        rows, "ICAO24 string, time timestamp_ntz, velocity double, longitude double, tie long"
    )


def stored(spark, folder, family, fmt="parquet"):
    where = ingest.points_path if family.endswith("SV") else ingest.flights_path
    rows = store.read_partitions(
        spark, where(str(folder)), schemas.stored_schema(family), ingest.PARTITIONS, fmt
    )
    return rows.filter(F.col("family") == family)


def sizes(spark, folder, fmt="parquet"):
    """Rows per family and day, points as often as they have copies."""
    found = {family: Counter() for family in schemas.FAMILIES}
    for family, days in found.items():
        for row in stored(spark, folder, family, fmt).collect():
            days[str(row.day)] += row.copies if family.endswith("SV") else 1
    return found


FIRST_DAY = {
    "bl_dep": {"2022-11-12": 4},
    "bl_arr": {"2022-11-12": 1, "2022-11-13": 1},
    # 5 points for each of two copies, each repeated by the two date rows of the id; 4 for b, 3 for d
    "bl_dep_SV": {"2022-11-12": 2 * 2 * 5 + 4 + 3},
    "bl_arr_SV": {"2022-11-12": 4, "2022-11-13": 11},
}


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_ingest(spark, records, telemetry, tmp_path, exact, fmt):
    run = lambda: ingest.ingest_movements(
        records, telemetry, str(tmp_path), "HOME", "2022-11-12 00:00:00", "2022-11-13 02:00:00",
        ZONE, exact=exact, has_tie=not exact, fmt=fmt,
    )
    decisions = run()
    assert sizes(spark, tmp_path, fmt) == FIRST_DAY
    assert decisions.filter("replaced").count() == 6
    assert run().filter("replaced").count() == 0
    assert sizes(spark, tmp_path, fmt) == FIRST_DAY

    points = stored(spark, tmp_path, "bl_arr_SV", fmt)
    overnight = points.filter("ICAO24 = 'c'").orderBy("requested_time").collect()
    assert overnight[0].departure_date == date(2022, 11, 12) and overnight[0].day == date(2022, 11, 13)
    assert overnight[0].longitude is None and overnight[0].velocity == 0.0
    assert {b.requested_time - a.requested_time for a, b in zip(overnight, overnight[1:])} == {180.0}
    assert overnight[0].id == "c_2022-11-12 23:54:00"
    assert points.columns == [*schemas.STORED_POINTS.names, "family", "day"]


def test_all_telemetry_beyond_the_broadcast_limit(spark, records, telemetry, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "MAX_BROADCAST_AIRCRAFT", 0)
    ingest.ingest_movements(
        records, telemetry, str(tmp_path), "HOME", "2022-11-12 00:00:00", "2022-11-13 02:00:00", ZONE
    )
    assert sizes(spark, tmp_path) == FIRST_DAY


def test_grid_spread_over_tasks_and_old_states(spark, records, telemetry, tmp_path, monkeypatch):
    """Small tasks, and aircraft whose only state lies before the first departure."""
    monkeypatch.setattr(ingest, "GRID_POINTS_PER_TASK", 2)
    old = spark.createDataFrame(
        [("h", DAY - timedelta(days=d), float(d), None, d) for d in (9, 40)], telemetry.schema
    )
    ingest.ingest_movements(
        records, telemetry.unionByName(old), str(tmp_path), "HOME",
        "2022-11-12 00:00:00", "2022-11-15 00:00:00", ZONE, exact=False, has_tie=True,
    )
    points = stored(spark, tmp_path, "bl_dep_SV").filter("ICAO24 = 'h'").collect()
    assert [p.velocity for p in points] == [9.0, 9.0, 9.0]
    assert sizes(spark, tmp_path)["bl_dep_SV"].total() == 27 + 3 + 3


def test_no_flights_at_all(spark, records, telemetry, tmp_path):
    decisions = ingest.ingest_movements(
        records, telemetry, str(tmp_path), "NOWHERE", "2022-11-12 00:00:00", "2022-11-15 00:00:00", ZONE
    )
    assert decisions.isEmpty()
    assert all(stored(spark, tmp_path, family).isEmpty() for family in schemas.FAMILIES)


def test_counts_read_only_the_wanted_days(spark, records, telemetry, tmp_path, plan):
    ingest.ingest_movements(
        records, telemetry, str(tmp_path), "HOME", "2022-11-12 00:00:00", "2022-11-15 00:00:00", ZONE
    )
    text = plan(ingest.stored_counts(spark, str(tmp_path), date(2022, 11, 13), date(2022, 11, 14)))
    assert text.count("(day#") >= 2 and "2022-11-13" in text
    assert text.count("PushedAggregation: [COUNT(*)]") == 2, "no column is read, only footers"


def test_backfill_takes_missing_days_only(spark, records, telemetry, tmp_path):
    args = (records, telemetry, str(tmp_path), "HOME")
    ingest.ingest_movements(*args, "2022-11-12 00:00:00", "2022-11-13 02:00:00", ZONE)
    # The 12th has all four families; the 13th has no departures; nothing on the 14th has points.
    decisions = ingest.backfill_missing_days(*args, date(2022, 11, 15), ZONE, days=5)
    assert {(str(r.day), r.family) for r in decisions.filter("replaced").collect()} == {
        ("2022-11-13", "bl_dep"), ("2022-11-13", "bl_dep_SV"), ("2022-11-14", "bl_dep"),
        ("2022-11-13", "bl_arr"), ("2022-11-13", "bl_arr_SV"),
    }
    got = sizes(spark, tmp_path)
    assert got["bl_dep"] == {"2022-11-12": 4, "2022-11-13": 1, "2022-11-14": 1}
    assert got["bl_arr"] == {"2022-11-12": 1, "2022-11-13": 2}
    assert got["bl_dep_SV"] == {"2022-11-12": 27, "2022-11-13": 3}
    again = ingest.backfill_missing_days(*args, date(2022, 11, 15), ZONE, days=5)
    assert again.filter("replaced").isEmpty() and sizes(spark, tmp_path) == got


def test_consolidate_store_and_files(spark, records, telemetry, tmp_path):
    folder, out = str(tmp_path / "days"), str(tmp_path / "out")
    ingest.ingest_movements(
        records, telemetry, folder, "HOME", "2022-11-12 00:00:00", "2022-11-15 00:00:00", ZONE
    )
    as_of = date(2022, 12, 1)
    daily = {f: consolidate.daily_store(spark, folder, f, as_of, days=10) for f in schemas.FAMILIES}
    paths = consolidate.consolidate_datasets(daily, out)
    departures = store.with_position(spark, paths["bl_dep"]).orderBy("position").collect()
    assert [row.ICAO24 for row in departures] == ["a", "a", "b", "d", "e", "h"]
    assert spark.read.parquet(paths["bl_dep_SV"]).agg(F.sum("copies")).first()[0] == 30
    later = consolidate.daily_store(spark, folder, "bl_dep_SV", date(2023, 1, 31), days=20)
    assert later.isEmpty()

    files = str(tmp_path / "files")
    daily = {family: rows.drop("copies") for family, rows in daily.items()}
    for family, rows in daily.items():
        csv_files.write_csv(rows, files, F.lit(f"{family}_2022_11_12"))
    for family, rows in daily.items():
        back = consolidate.daily_files(spark, files, family, as_of, part="folder")
        assert Counter(map(tuple, back.collect())) == Counter(map(tuple, rows.collect()))


def test_recent_months():
    assert consolidate.recent_months(date(2023, 4, 26), 120) == [
        "2022_12", "2023_01", "2023_02", "2023_03", "2023_04"
    ]


def test_explore_latest_day(spark, records, telemetry):
    airports = spark.createDataFrame([("HOME", 46.5), ("AWAY", 47.0)], "code string, latitude double")
    now = F.lit(DAY + timedelta(days=2)).cast("timestamp_ntz")
    found = explore.explore_latest_day(
        records, telemetry, "HOME", now, ZONE, airports=airports, details=("latitude",), guard=False
    )
    # Arrivals left on the 12th and 13th, so the latest day is the 13th.
    assert [row.ICAO24 for row in found.departures.collect()] == ["e"]
    assert sorted(row.ICAO24 for row in found.arrivals.collect()) == ["c", "f"]
    row = found.nested.filter("direction = 'departure'").first()
    assert (row.ICAO24, row.origin_latitude, row.destination_latitude) == ("e", 46.5, 47.0)
    assert [p.grid_step for p in row.state_vectors] == [0, 1, 2, 3, 4, 5, 6]
    assert {
        r.ICAO24: len(r.state_vectors)
        for r in found.nested.filter("direction = 'arrival'").collect()
    } == {"c": 31, "f": 7}
    assert not found.agreement.first().agree


def test_explore_keeps_flights_without_points_and_copies(spark, records, telemetry):
    flights = spark.createDataFrame(LEGS, schemas.RAW_FLIGHT)
    from legtrail.operators import nested

    flat = nested.flatten_flights(flights, ZONE)
    got = explore.with_trajectories(flat, telemetry, step=60)
    assert got.count() == len(LEGS)
    series = {r.ICAO24: r.state_vectors for r in got.collect()}
    assert series["h"] is None and len(series["a"]) == 13


def test_explore_stops_on_disagreement_and_on_nothing(spark, records, telemetry):
    now = F.lit(DAY + timedelta(days=2)).cast("timestamp_ntz")
    with pytest.raises(explore.NotReady, match="differ"):
        explore.explore_latest_day(records, telemetry, "HOME", now, ZONE)
    with pytest.raises(explore.NotReady, match="no recent"):
        explore.explore_latest_day(records, telemetry, "NOWHERE", now, ZONE)


@pytest.mark.parametrize("block_steps, rows", [(None, 1), (1024, 2)])
def test_a_long_flight_is_one_row_unless_blocks_are_asked_for(spark, block_steps, rows):
    flight = spark.createDataFrame([leg("z", 0, 18 * 60, "HOME", "AWAY")], schemas.RAW_FLIGHT)
    states = spark.createDataFrame([("z", DAY, 1.0, 1)], "ICAO24 string, time timestamp_ntz, velocity double, tie long")
    from legtrail.operators import nested

    flat = nested.flatten_flights(flight, ZONE)
    got = explore.with_trajectories(flat, states, block_steps, step=60, exact=False, has_tie=True).collect()
    assert len(got) == rows and sum(len(r.state_vectors) for r in got) == 18 * 60 + 1


@pytest.mark.parametrize("exact", [True, False])
def test_unknown_aircraft_match_nothing_at_any_limit(spark, records, telemetry, tmp_path, monkeypatch, exact):
    unknown = spark.createDataFrame([leg(None, 8, 12, "HOME", "AWAY")] * 3, schemas.RAW_FLIGHT)
    states = spark.createDataFrame([(None, DAY + timedelta(hours=8), 1.0, None, 1)] * 4, telemetry.schema)
    found = []
    for limit in (0, 500_000):
        monkeypatch.setattr(ingest, "MAX_BROADCAST_AIRCRAFT", limit)
        folder = tmp_path / str(limit)
        ingest.ingest_movements(
            records.unionByName(unknown), telemetry.unionByName(states), str(folder), "HOME",
            "2022-11-12 00:00:00", "2022-11-13 02:00:00", ZONE, exact=exact, has_tie=True,
        )
        found.append(sizes(spark, folder))
    assert found[0] == found[1]
    assert found[0] == {**FIRST_DAY, "bl_dep": {"2022-11-12": 4 + 3}}


def test_copies_are_counted_not_written(spark, telemetry, tmp_path):
    many = spark.createDataFrame([leg("a", 8, 12, "HOME", "AWAY")] * 50, schemas.RAW_FLIGHT)
    ingest.ingest_movements(many, telemetry, str(tmp_path), "HOME", "2022-11-12 00:00:00", "2022-11-13 02:00:00", ZONE)
    rows = stored(spark, tmp_path, "bl_dep_SV").collect()
    assert [r.copies for r in rows] == [2500] * 5


@pytest.mark.parametrize("exact", [True, False])
def test_nothing_is_left_of_a_run(spark, records, telemetry, tmp_path, monkeypatch, exact):
    from legtrail import session

    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path / "shared"))
    ingest.ingest_movements(
        records, telemetry, str(tmp_path / "out"), "HOME", "2022-11-12 00:00:00", "2022-11-13 02:00:00", ZONE,
        exact=exact, has_tie=True,
    )
    left = sorted(p.name.rsplit("-", 1)[0] for p in (tmp_path / "shared").iterdir())
    assert left == ["legtrail-decision", "legtrail-decision"]  # the result


def test_days_are_read_by_folder(spark, records, telemetry, tmp_path, plan):
    """Partition columns with the UTC date bound what is read; results are the same."""
    for name, rows, time in (("records", records, "departure_time"), ("telemetry", telemetry, "time")):
        rows.withColumn("utc_day", F.col(time).cast("date")).write.partitionBy("utc_day").parquet(str(tmp_path / name))
    stored_records, states = (spark.read.parquet(str(tmp_path / n)) for n in ("records", "telemetry"))
    from legtrail.operators import select

    chosen = stored_records.filter(
        select.departs("HOME", "2022-11-12 00:00:00", "2022-11-12 23:59:59", ZONE, day="utc_day")
    )
    scan = plan(chosen)
    assert "2022-11-11" in scan.split("PartitionFilters: ")[1].split("\n")[0]
    folder = tmp_path / "out"
    ingest.ingest_movements(
        stored_records, states, str(folder), "HOME", "2022-11-12 00:00:00", "2022-11-13 02:00:00", ZONE,
        departure_day="utc_day", telemetry_day="utc_day",
    )
    assert sizes(spark, folder)["bl_dep_SV"] == FIRST_DAY["bl_dep_SV"]
    needs = ingest.Extent(1, 1, 1_668_210_000_000_000, 1_668_210_900_000_000)
    some = spark.createDataFrame([leg("a", 8, 12, "HOME", "AWAY")], schemas.RAW_FLIGHT)
    assert "PartitionFilters: [isnotnull(utc_day" in plan(ingest.telemetry_for(some, states, needs, True, "utc_day"))


@pytest.mark.parametrize("exact", [True, False])
def test_the_latest_day_reads_recent_folders(spark, records, telemetry, tmp_path, exact):
    """Records by UTC day of departure: all other folders are unreadable; the result is that of the whole table."""
    far = spark.createDataFrame([leg("z", 8, 12, "HOME", "AWAY", day=d) for d in (-40, -20, 30)], schemas.RAW_FLIGHT)
    agreeing = [leg("a", 8, 12, "HOME", "AWAY"), leg("c", 9, 30, "AWAY", "HOME"), leg("b", 7, 9, "HOME", "HOME", day=-1)]
    recent = spark.createDataFrame(agreeing, schemas.RAW_FLIGHT)
    dated = recent.unionByName(far).withColumn("utc_day", F.col("departure_time").cast("date"))
    dated.write.partitionBy("utc_day").parquet(str(tmp_path / "records"))
    for folder in (tmp_path / "records").glob("utc_day=*"):
        if folder.name[8:] not in ("2022-11-11", "2022-11-12"):
            for file in folder.iterdir():
                file.unlink() if file.name.startswith(".") else file.write_bytes(b"no Parquet")
    stored_records = spark.read.schema(dated.schema).parquet(str(tmp_path / "records"))
    now = F.lit(DAY + timedelta(hours=20)).cast("timestamp_ntz")
    results = []
    for rows, day in ((recent, None), (stored_records, "utc_day")):
        # No flight here is over midnight, so the day of departure bounds arrivals too.
        found = explore.explore_latest_day(
            rows, telemetry, "HOME", now, ZONE, exact=exact, has_tie=True, departure_day=day, arrival_day=day
        )
        results.append([sorted(map(str, df.collect())) for df in (found.departures, found.arrivals, found.nested)])
    assert results[0] == results[1] and len(results[0][2]) == 2


def test_what_a_run_needs_comes_from_the_passes_that_write(spark, records, telemetry, tmp_path, monkeypatch):
    """No job looks for the extent of the flights or for the days; the numbers are those of a job of their own."""
    from legtrail import session
    from legtrail.operators import nested

    flights = nested.flatten_flights(records, ZONE)
    with session.scratch(spark) as kept:
        staged, seen = kept.measured(flights, "flights", **ingest.extent_metrics(180))
        assert ingest.Extent(**seen) == ingest.extent(staged, 180) and seen["aircraft"] == 8
        nothing, seen = kept.measured(flights.filter("false"), "none", **ingest.extent_metrics(180))
        assert ingest.Extent(**seen) == (0, 0, None, None) and nothing.isEmpty()

    def jobs(group, **more):
        spark.sparkContext.setJobGroup(group, group)
        flights = nested.flatten_flights(
            records.withColumn("family", F.lit("bl_dep")).filter("origin_airport = 'HOME'"), ZONE, keep=["family"]
        )
        ingest.save(flights, telemetry, str(tmp_path / group), step=180, has_tie=True).collect()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few = jobs("measured")
    upsert, points_of = ingest.store.upsert_larger, ingest.points_of
    monkeypatch.setattr(ingest.store, "upsert_larger", lambda *args: upsert(*args[:-1]))
    monkeypatch.setattr(ingest, "points_of", lambda *args, needs, **more: points_of(*args, **more))
    assert few < jobs("asked")
    assert sizes(spark, tmp_path / "measured") == sizes(spark, tmp_path / "asked")
