"""Whole runs: ingest, backfill, consolidate, explore.

Results are summed up per family and day, with a digest that every column of every row goes into.
"""

from datetime import date

from pyspark.sql import Column, functions as F

from catalog import adapters
from catalog.adapters import HOME, ZONE
from catalog.files import union, write_daily_files
from catalog.registry import query, table
from legtrail import schemas
from legtrail.functions import times
from legtrail.operators import nested
from legtrail.plans import consolidate, explore, ingest
from legtrail.session import new_folder
from legtrail.sources import store

HOUR = 3600

_LOCAL = "AT TIME ZONE 'Europe/Zurich' AT TIME ZONE 'UTC'"

#: ``points``: every flight's grid points with the last state before each.
_POINTS = """grid AS (
  SELECT id, ICAO24, departure_airport_ICAO, destination_airport_ICAO, departure_time, arrival_time,
         departure_date, arrival_date,
         unnest(generate_series(departure_time, arrival_time, INTERVAL {step})) AS grid_time
  FROM flights WHERE arrival_time IS NOT NULL),
points AS (
  SELECT grid.*, velocity, geo_altitude FROM grid ASOF JOIN telemetry
    ON grid.ICAO24 = telemetry.ICAO24 AND grid_time >= time)"""

_DEP = "departure_airport_ICAO = 'signup'"
_ARR = "destination_airport_ICAO = 'signup'"


# Text of a row and sum of a number made from it, the same in both languages; nulls are left out of the text.
_FLIGHT_TEXT = """concat_ws('|', ICAO24, call_sign, epoch_us(departure_time), departure_date, epoch_us(arrival_time),
  arrival_date, departure_airport_ICAO, destination_airport_ICAO, id)"""
_POINT_TEXT = """concat_ws('|', ICAO24, epoch_us(grid_time), round(geo_altitude * 100)::BIGINT,
  round(velocity * 100)::BIGINT, id, arrival_date, departure_date)"""
_DIGEST = "sum(('0x' || substr(md5({}), 1, 8))::BIGINT)::BIGINT"


def _row_number(*columns) -> Column:
    """The number that goes into a digest for a row of these columns."""
    text = F.concat_ws("|", *[column.cast("string") for column in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _four_families(dep: str, arr: str, of_days: str = "true") -> str:
    """SQL of ``(family, day, n, n_ids, digest)`` for the movements that meet two conditions."""
    flights = f"""SELECT '{{family}}' AS family, {{day}} AS day, count(*) AS n,
         count(DISTINCT id) AS n_ids, {_DIGEST.format(_FLIGHT_TEXT)} AS digest
       FROM flights WHERE {{where}} GROUP BY {{day}}"""
    # A point repeats once per flight row of its id, in its family.
    points = f"""SELECT '{{family}}' AS family, day, count(*) AS n,
         count(DISTINCT id) AS n_ids, {_DIGEST.format(_POINT_TEXT)} AS digest
       FROM (SELECT p.* EXCLUDE (arrival_date, departure_date), f.arrival_date, f.departure_date, f.{{day}} AS day
             FROM (SELECT * FROM points WHERE {{where}}) p
             JOIN (SELECT id, arrival_date, departure_date FROM flights WHERE {{where}}) f USING (id))
       GROUP BY day"""
    return " UNION ALL ".join(
        template.format(family=family, day=day, where=where)
        for template, family, day, where in (
            (flights, "bl_dep", "departure_date", dep),
            (flights, "bl_arr", "arrival_date", arr),
            (points, "bl_dep_SV", "departure_date", dep),
            (points, "bl_arr_SV", "arrival_date", arr),
        )
    )


def _between(column: str, start: str, end: str) -> str:
    return f"{column} BETWEEN TIMESTAMP '{start}' {_LOCAL} AND TIMESTAMP '{end}' {_LOCAL}"


def _stored_days(spark, folder):
    flights = store.read_partitions(
        spark, ingest.flights_path(folder), schemas.FLIGHTS, ingest.PARTITIONS
    )
    points = store.read_partitions(
        spark, ingest.points_path(folder), schemas.STORED_POINTS, ingest.PARTITIONS
    )
    c = F.col
    hundredths = lambda name: F.round(c(name) * 100).cast("bigint")
    of_flight = _row_number(
        c("ICAO24"), c("call_sign"), times.epoch_micros("departure_time"), c("departure_date"),
        times.epoch_micros("arrival_time"), c("arrival_date"), c("departure_airport_ICAO"),
        c("destination_airport_ICAO"), c("id"),
    )
    of_point = _row_number(
        c("ICAO24"), F.round(c("requested_time") * 1_000_000).cast("bigint"), hundredths("geo_altitude"),
        hundredths("velocity"), c("id"), c("arrival_date"), c("departure_date"),
    )
    return union(
        rows.groupBy("family", "day").agg(
            n.alias("n"),
            F.count_distinct("id").alias("n_ids"),
            total.alias("digest"),
        )
        for rows, n, total in (
            (flights, F.count("*"), F.sum(of_flight)),
            (points, F.sum("copies"), F.sum(of_point * c("copies"))),
        )
    )


_PLACED_FLIGHT = _FLIGHT_TEXT.replace("destination_airport_ICAO", "destination")
_PLACED_POINT = """concat_ws('|', ICAO24, round(longitude * 1000000)::BIGINT, round(latitude * 1000000)::BIGINT,
  round(requested_time * 1000000)::BIGINT, round(geo_altitude * 100)::BIGINT, round(velocity * 100)::BIGINT,
  special_purpose_indicator, origin_country, id, arrival_date, departure_date)"""

#: Consolidated sets from ``flights``, ``point_rows`` and ``recent`` (first and last day of points), summed up by day.
_POSITIONS = f"""positions AS (
  SELECT 'bl_dep' AS family, departure_date AS day,
         row_number() OVER (ORDER BY departure_time, id) AS position, {_PLACED_FLIGHT} AS line
  FROM (SELECT *, {{destination}} AS destination FROM flights)
  UNION ALL
  SELECT 'bl_arr', {{arrival_day}}, row_number() OVER (ORDER BY departure_time, id), {_PLACED_FLIGHT}
  FROM (SELECT *, destination_airport_ICAO AS destination FROM flights) WHERE destination IS NOT NULL
  UNION ALL
  SELECT 'bl_dep_SV', departure_date, row_number() OVER (ORDER BY departure_date, id, requested_time), {_PLACED_POINT}
  FROM point_rows, recent WHERE departure_date BETWEEN first AND last
  UNION ALL
  SELECT 'bl_arr_SV', arrival_date, row_number() OVER (ORDER BY arrival_date, id, requested_time), {_PLACED_POINT}
  FROM point_rows, recent WHERE arrival_date BETWEEN first AND last)
SELECT family, day, count(*) AS n, min(position) AS first_position, max(position) AS last_position,
       {_DIGEST.format("concat_ws('|', position, line)")} AS digest
FROM positions GROUP BY family, day"""


def _placed(spark, paths: dict[str, str], days: dict[str, str]):
    """Consolidated sets summed up by day, with a digest of every column and the position of every row."""
    c = F.col
    parts = lambda name, n: F.round(c(name) * n).cast("bigint")
    of_flight = [
        c("ICAO24"), c("call_sign"), times.epoch_micros("departure_time"), c("departure_date"),
        times.epoch_micros("arrival_time"), c("arrival_date"), c("departure_airport_ICAO"),
        c("destination_airport_ICAO"), c("id"),
    ]
    of_point = [
        c("ICAO24"), parts("longitude", 1_000_000), parts("latitude", 1_000_000), parts("requested_time", 1_000_000),
        parts("geo_altitude", 100), parts("velocity", 100), c("special_purpose_indicator"), c("origin_country"),
        c("id"), c("arrival_date"), c("departure_date"),
    ]
    return union(
        store.with_position(spark, path)
        .groupBy(c(days[family]).alias("day"))
        .agg(
            F.count("*").alias("n"),
            F.min("position").alias("first_position"),
            F.max("position").alias("last_position"),
            F.sum(_row_number(c("position"), *(of_point if family.endswith("SV") else of_flight))).alias("digest"),
        )
        .withColumn("family", F.lit(family))
        for family, path in paths.items()
    )


_ALL_TIME = ("2023-12-01 00:00:00", "2024-02-29 23:59:59")
_FIRST_DAYS = ("2024-01-01 00:00:00", "2024-01-12 23:59:59")
_AS_OF = date(2024, 1, 31)


@query(f"""
WITH {adapters.FLIGHTS}, {adapters.TELEMETRY}, {_POINTS.format(step="1 HOUR")}
{_four_families(f"{_DEP} AND {_between('departure_time', *_ALL_TIME)}",
                f"{_ARR} AND {_between('arrival_time', *_ALL_TIME)}")}""")
def ingest_movements(spark, sf_dir):
    folder = new_folder(spark, "movements")
    ingest.ingest_movements(
        adapters.legs(spark, sf_dir),
        adapters.telemetry(spark, sf_dir),
        folder,
        HOME,
        *_ALL_TIME,
        ZONE,
        step=HOUR,
        exact=False,
        has_tie=True,
    )
    return _stored_days(spark, folder)


_HOURLY_LEGS = """SELECT * REPLACE (date_trunc('hour', departure_time) AS departure_time,
                                    date_trunc('hour', arrival_time) AS arrival_time) FROM legs"""


@query(f"""
WITH {adapters.FLIGHTS.replace("FROM legs)", f"FROM ({_HOURLY_LEGS}))")}, {adapters.TELEMETRY},
hourly AS (SELECT ICAO24, date_trunc('hour', time) AS grid_time, arg_max(velocity, tie) AS velocity,
                  arg_max(geo_altitude, tie) AS geo_altitude FROM telemetry GROUP BY ALL),
points AS (
  SELECT f.*, grid_time, velocity, geo_altitude
  FROM (SELECT DISTINCT id, ICAO24, departure_airport_ICAO, destination_airport_ICAO, departure_time, arrival_time,
                        departure_date, arrival_date, leg_id FROM flights) f
  JOIN hourly h ON f.ICAO24 = h.ICAO24 AND grid_time BETWEEN departure_time AND arrival_time)
{_four_families(f"{_DEP} AND {_between('departure_time', *_ALL_TIME)}",
                f"{_ARR} AND {_between('arrival_time', *_ALL_TIME)}")}""")
def ingest_exact(spark, sf_dir):
    # Legs and states on whole hours, so that the grid of every flight has states; the last of an hour counts.
    folder = new_folder(spark, "movements")
    hour = lambda time: times.floor_to(time, HOUR)
    legs = adapters.legs(spark, sf_dir)
    legs = legs.withColumns({t: hour(t) for t in ("departure_time", "arrival_time")})
    ingest.ingest_movements(
        legs,
        adapters.telemetry(spark, sf_dir).withColumn("time", hour("time")),
        folder,
        HOME,
        *_ALL_TIME,
        ZONE,
        step=HOUR,
        has_tie=True,
    )
    return _stored_days(spark, folder)


_TWO_DAYS = [(f"2024-01-{day} 00:00:00", f"2024-01-{day} 23:59:59") for day in (10, 13)]


@query(f"""
WITH {adapters.FLIGHTS}, {adapters.TELEMETRY}, {_POINTS.format(step="1 HOUR")}
{_four_families(*(f"{side} AND ({' OR '.join(_between(time, *day) for day in _TWO_DAYS)})"
                  for side, time in ((_DEP, 'departure_time'), (_ARR, 'arrival_time'))))}""")
def ingest_from_eves(spark, sf_dir):
    # Two days are ingested one after the other; the second starts from the states that were kept for the first.
    folder, path, last = (new_folder(spark, name) for name in ("movements", "telemetry", "last-states"))
    states = adapters.telemetry(spark, sf_dir).withColumn("utc_day", F.col("time").cast("date"))
    store.write_partitions(states, path, ("utc_day",))
    stored = spark.read.schema(states.schema).parquet(path)
    for day in _TWO_DAYS:
        ingest.ingest_movements(
            adapters.legs(spark, sf_dir), stored, folder, HOME, *day, ZONE,
            step=HOUR, exact=False, has_tie=True, telemetry_day="utc_day", carried=last,
        )
    return _stored_days(spark, folder)


_ON_MISSING = (
    "EXISTS (FROM missing WHERE {time} BETWEEN day::TIMESTAMP "
    + _LOCAL
    + " AND (day::TIMESTAMP + INTERVAL '86399 seconds') "
    + _LOCAL
    + ")"
)


@query(f"""
WITH {adapters.FLIGHTS}, {adapters.TELEMETRY}, {_POINTS.format(step="1 HOUR")},
first_run AS ({_four_families(f"{_DEP} AND {_between('departure_time', *_FIRST_DAYS)}",
                              f"{_ARR} AND {_between('arrival_time', *_FIRST_DAYS)}")}),
missing AS (
  SELECT day FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30',
                                                 INTERVAL 1 DAY))::DATE AS day)
  LEFT JOIN first_run USING (day) GROUP BY day HAVING count(family) < 4),
second_run AS ({_four_families(f"{_DEP} AND {_ON_MISSING.format(time='departure_time')}",
                               f"{_ARR} AND {_ON_MISSING.format(time='arrival_time')}")})
SELECT family, day,
       CASE WHEN b.n > coalesce(a.n, 0) THEN b.n ELSE a.n END AS n,
       CASE WHEN b.n > coalesce(a.n, 0) THEN b.n_ids ELSE a.n_ids END AS n_ids,
       CASE WHEN b.n > coalesce(a.n, 0) THEN b.digest ELSE a.digest END AS digest
FROM first_run a FULL JOIN second_run b USING (family, day)""")
def backfill_missing_days(spark, sf_dir):
    folder = new_folder(spark, "movements")
    legs, telemetry = adapters.legs(spark, sf_dir), adapters.telemetry(spark, sf_dir)
    sampling = dict(step=HOUR, exact=False, has_tie=True)
    ingest.ingest_movements(legs, telemetry, folder, HOME, *_FIRST_DAYS, ZONE, **sampling)
    ingest.backfill_missing_days(legs, telemetry, folder, HOME, _AS_OF, ZONE, **sampling)
    return _stored_days(spark, folder)


@query(f"""
WITH {adapters.FLIGHTS}, {adapters.POINT_ROWS.replace("point_rows AS", "all_points AS")},
point_rows AS (SELECT * FROM (
  SELECT * REPLACE (
    (departure_date + INTERVAL (ICAO24::BIGINT % 4) MONTH)::DATE AS departure_date,
    (arrival_date + INTERVAL (ICAO24::BIGINT % 4) MONTH)::DATE AS arrival_date) FROM all_points)),
recent AS (SELECT DATE '2024-03-01' AS first, DATE '2024-07-31' AS last),
{_POSITIONS.format(destination="CASE WHEN day(departure_date) <= 20 THEN destination_airport_ICAO END",
                   arrival_day="departure_date")}""")
def consolidate_datasets(spark, sf_dir):
    # Points lie in January to April; of the 120 days up to July, the months from March on count.
    raw, out = new_folder(spark, "daily"), new_folder(spark, "consolidated")
    write_daily_files(spark, sf_dir, raw, months=F.col("ICAO24").cast("int") % 4)
    daily = {
        family: consolidate.daily_files(spark, raw, family, date(2024, 7, 5), part="folder")
        for family in schemas.FAMILIES
    }
    days = consolidate.STORED_DAY | {schemas.ARRIVALS: "departure_date"}
    return _placed(spark, consolidate.consolidate_datasets(daily, out), days)


@query(f"""
WITH {adapters.FLIGHTS}, {adapters.POINT_ROWS},
recent AS (SELECT DATE '2024-01-01' AS first, DATE '2024-05-31' AS last),
{_POSITIONS.format(destination="destination_airport_ICAO", arrival_day="arrival_date")}""")
def consolidate_changes(spark, sf_dir):
    # The first run has two thirds of the days, and half of the last of them; the second brings the rest.
    folder, out = new_folder(spark, "movements"), new_folder(spark, "consolidated")
    cut = F.lit(date(2024, 1, 20))
    flights = nested.flatten_flights(adapters.legs(spark, sf_dir), ZONE)
    reached = flights.filter(F.col("destination_airport_ICAO").isNotNull())
    points = adapters.point_rows(spark, sf_dir).withColumn("copies", F.lit(1).cast("bigint"))
    parts = [
        (flights, schemas.DEPARTURES, "departure_date", "call_sign"),
        (reached, schemas.ARRIVALS, "arrival_date", "call_sign"),
        (points, schemas.DEPARTURE_POINTS, "departure_date", "ICAO24"),
        (points.filter("arrival_date is not null"), schemas.ARRIVAL_POINTS, "arrival_date", "ICAO24"),
    ]
    stored = [
        union(
            rows.withColumns({"family": F.lit(family), "day": F.col(day), "half": F.crc32(F.col(half).cast("binary")) % 2})
            for rows, family, day, half in some
        )
        for some in (parts[:2], parts[2:])
    ]
    paths = ingest.flights_path(folder), ingest.points_path(folder)

    def put(rows, path):
        return store.upsert_larger(rows.drop("half"), path, ingest.PARTITIONS, weight=None)

    early = (F.col("day") < cut) | ((F.col("day") == cut) & (F.col("half") == 0))
    for rows, path in zip(stored, paths):
        put(rows.filter(early), path)
    as_of = date(2024, 5, 1)
    daily = {f: consolidate.daily_store(spark, folder, f, as_of) for f in schemas.FAMILIES}
    consolidate.consolidate_ranges(daily, out)
    decisions = [put(rows.filter(F.col("day") >= cut), path) for rows, path in zip(stored, paths)]
    consolidate.consolidate_changes(spark, folder, out, union(decisions), as_of)
    return _placed(spark, {f: f"{out}/{f}_all" for f in schemas.FAMILIES}, consolidate.STORED_DAY)


_LATEST = f"""latest AS (
  SELECT max(departure_date) AS day FROM flights
  WHERE {_ARR} AND arrival_time BETWEEN (SELECT max(ts) - INTERVAL 3 DAY FROM events)
                                    AND (SELECT max(ts) + INTERVAL 1 DAY FROM events)),
bounds AS (SELECT day::TIMESTAMP {_LOCAL} AS first,
                  (day::TIMESTAMP + INTERVAL '86399 seconds') {_LOCAL} AS last FROM latest),
chosen AS (
  SELECT 'departure' AS direction, flights.* FROM flights, bounds
  WHERE {_DEP} AND departure_time BETWEEN first AND last
  UNION ALL
  SELECT 'arrival', flights.* FROM flights, bounds
  WHERE {_ARR} AND arrival_time BETWEEN first AND last)"""


@query(f"""
WITH {adapters.FLIGHTS}, {adapters.TELEMETRY}, {_LATEST},
airports AS (SELECT event_type AS code, count(*) AS n_events FROM events GROUP BY 1),
grid AS (SELECT DISTINCT direction, id, ICAO24, departure_time, arrival_time,
                unnest(generate_series(departure_time, arrival_time, INTERVAL 1 MINUTE)) AS grid_time
         FROM chosen WHERE arrival_time IS NOT NULL),
points AS (SELECT grid.*, velocity, 0 AS block
           FROM grid ASOF JOIN telemetry
             ON grid.ICAO24 = telemetry.ICAO24 AND grid_time >= time),
blocks AS (SELECT direction, id, departure_time, arrival_time, block::BIGINT AS block,
                  count(*) AS n_points, epoch_us(min(grid_time)) AS first_micros,
                  sum(round(velocity * 100)::BIGINT)::BIGINT AS cents
           FROM points GROUP BY ALL)
SELECT direction, id, c.departure_time, c.arrival_time, block, coalesce(n_points, 0) AS n_points,
       first_micros, coalesce(cents, 0) AS cents,
       o.n_events AS origin_n_events, d.n_events AS destination_n_events
FROM chosen c LEFT JOIN blocks b USING (direction, id, departure_time, arrival_time)
LEFT JOIN airports o ON o.code = c.departure_airport_ICAO
LEFT JOIN airports d ON d.code = c.destination_airport_ICAO""")
def explore_latest_day(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    airports = events.groupBy(F.col("event_type").alias("code")).agg(F.count("*").alias("n_events"))
    found = explore.explore_latest_day(
        adapters.legs(spark, sf_dir),
        adapters.telemetry(spark, sf_dir),
        HOME,
        events.agg(F.max("ts")).scalar(),
        ZONE,
        airports=airports,
        details=("n_events",),
        guard=False,  # these airports are never in step
        exact=False,
        has_tie=True,
    )
    cents = F.aggregate(
        "state_vectors",
        F.lit(0).cast("bigint"),
        lambda total, point: total + F.round(point.velocity * 100).cast("bigint"),
    )
    first = F.round(F.col("state_vectors")[0].requested_time * 1_000_000).cast("bigint")
    return found.nested.select(
        "direction",
        "id",
        "departure_time",
        "arrival_time",
        "block",
        F.coalesce(F.size("state_vectors"), F.lit(0)).cast("bigint").alias("n_points"),
        first.alias("first_micros"),
        F.coalesce(cents, F.lit(0)).alias("cents"),
        "origin_n_events",
        "destination_n_events",
    )
