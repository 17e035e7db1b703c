"""CSV scans, day-partitioned stores, upsert and compaction, each through a fresh folder."""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from catalog import adapters
from catalog.adapters import ZONE
from catalog.registry import query, table
from legtrail import schemas
from legtrail.functions import names, times
from legtrail.operators import nested
from legtrail.session import new_folder, staged
from legtrail.sources import csv_files, store


@query(f"WITH {adapters.FLIGHTS} SELECT * EXCLUDE leg_id FROM flights")
def scan_flights_csv(spark, sf_dir):
    path = new_folder(spark, "flights")
    csv_files.write_csv(nested.flatten_flights(adapters.legs(spark, sf_dir), ZONE), path)
    return csv_files.scan_same_header(spark, path, schemas.FLIGHTS)


@query(f"WITH {adapters.POINT_ROWS} SELECT * FROM point_rows")
def scan_points_csv(spark, sf_dir):
    path = new_folder(spark, "points")
    csv_files.write_csv(adapters.point_rows(spark, sf_dir), path)
    return csv_files.scan_same_header(spark, path, schemas.STATE_VECTORS)


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')")
def scan_name_regex(spark, sf_dir):
    path = new_folder(spark, "named")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    csv_files.write_csv(events, path, folder=F.concat(F.lit("ev_"), "event_type"))
    return csv_files.scan(spark, path, events.schema, "^ev_(click|view)", part="folder")


@query("""
SELECT event_id, ts, user_id, event_type, value,
       CASE WHEN event_type <> 'error' THEN props END AS props FROM events""")
def scan_schema_drift(spark, sf_dir):
    path = new_folder(spark, "drift")
    events = table(spark, sf_dir, "events")
    reordered = ["event_id", "props", "value", "event_type", "user_id", "ts"]
    kind = F.col("event_type")
    variants = [
        (kind.isin("signup", "purchase"), reordered),
        (kind == "error", [c for c in events.columns if c != "props"]),
        (~kind.isin("signup", "purchase", "error"), events.columns),
    ]
    for rows, columns in variants:
        csv_files.write_csv(events.filter(rows).select(columns), path)
    return csv_files.scan(spark, path, events.schema)


@query("SELECT event_id, event_type FROM events WHERE event_type LIKE '%i%'")
def scan_file_regex(spark, sf_dir):
    # The files themselves are chosen: one is written for each pattern of type.
    path = new_folder(spark, "named-files")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    holds = F.col("event_type").contains("i")
    csv_files.write_csv(events.filter(~holds), path)
    others = {row.file for row in csv_files.file_headers(spark, path, "event_id").select("file").collect()}
    csv_files.write_csv(events.filter(holds), path)
    names_ = "|".join(sorted(re.escape(name.rsplit("/", 1)[-1]) for name in others)) or "-"
    return csv_files.scan(spark, path, events.schema, f"^(?!({names_})$)")


@query("""
SELECT event_id, ts, value, value > 50 AS large,
       CASE WHEN event_type <> 'error' THEN event_type END AS kind,
       CASE WHEN event_type <> 'view' THEN ts::DATE END AS day, props,
       'event_id,ts' || chr(10) || '"' || event_type || '", ' || event_id AS note
FROM events""")
def csv_value_roundtrip(spark, sf_dir):
    path = new_folder(spark, "values")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "value",
        (F.col("value") > 50).alias("large"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"),
        F.when(F.col("event_type") != "view", F.col("ts").cast("date")).alias("day"),
        "props",
        F.concat(F.lit('event_id,ts\n"'), "event_type", F.lit('", '), "event_id").alias("note"),
    )
    csv_files.write_csv(rows, path)
    return csv_files.scan(spark, path, rows.schema)


@query("""
SELECT event_id, ts, value, event_type || chr(10) || chr(10) || '"' || event_id || '",' AS note FROM events""")
def scan_ranges_csv(spark, sf_dir):
    # Files are cut in sixteenths of the largest one, so that most ranges begin inside some record or other.
    path = new_folder(spark, "ranges")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "value",
        F.concat("event_type", F.lit('\n\n"'), "event_id", F.lit('",')).alias("note"),
    )
    csv_files.write_csv(rows, path)
    size = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 1
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.maxPartitionBytes", size // 16 + 1)
    apart.conf.set("spark.sql.files.openCostInBytes", size // 16 + 1)
    return csv_files.scan_same_header(apart, path, rows.schema)


_EVENT_DAYS = """
SELECT event_id, ts, user_id, event_type, value,
       (ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich')::DATE AS event_date
FROM events"""


def _event_days(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        times.local_date("ts", ZONE).alias("event_date"),
    )


@query(f"SELECT *, event_date AS day FROM ({_EVENT_DAYS})")
def sink_by_day_roundtrip(spark, sf_dir):
    path = new_folder(spark, "by-day")
    events = _event_days(spark, sf_dir)
    store.write_partitions(events.withColumn("day", F.col("event_date")), path)
    return store.read_partitions(spark, path, events.schema)


@query(f"""
WITH e AS ({_EVENT_DAYS}),
old AS (SELECT * FROM e WHERE value < 34.65),
new AS (SELECT * FROM e WHERE value >= 34.65),
winners AS (SELECT event_date FROM (SELECT event_date, count(*) AS n FROM new GROUP BY 1) a
            LEFT JOIN (SELECT event_date, count(*) AS n FROM old GROUP BY 1) b USING (event_date)
            WHERE a.n > coalesce(b.n, 0))
SELECT *, event_date AS day FROM new WHERE event_date IN (FROM winners)
UNION ALL
SELECT *, event_date AS day FROM old WHERE event_date NOT IN (FROM winners)""")
def upsert_keep_larger(spark, sf_dir):
    # Two fetches of the same days: the low readings are stored, the high ones come in.
    path = new_folder(spark, "upsert")
    events = _event_days(spark, sf_dir)
    dated = events.withColumn("day", F.col("event_date"))
    stored = F.col("value") < 34.65
    store.write_partitions(dated.filter(stored), path)
    store.upsert_larger(dated.filter(~stored), path)
    return store.read_partitions(spark, path, events.schema)


@query("""
SELECT event_id, ts, user_id, event_type, value, event_date, event_date AS day FROM ("""
       + _EVENT_DAYS + """) WHERE day(event_date) % 2 = 0 OR value < 34.65
UNION ALL
SELECT event_id, ts, user_id, event_type, value, event_date, event_date FROM ("""
       + _EVENT_DAYS + """) WHERE day(event_date) % 2 = 1 AND value >= 34.65
  AND event_date NOT IN (SELECT event_date FROM (""" + _EVENT_DAYS + """) WHERE value < 34.65)""")
def csv_store_roundtrip(spark, sf_dir):
    # Days come with different column orders; odd days are stored in part, and offered again in a smaller part.
    path = new_folder(spark, "csv-store")
    events = _event_days(spark, sf_dir).withColumn("day", F.col("event_date"))
    low, even = F.col("value") < 34.65, F.dayofmonth("event_date") % 2 == 0
    mixed_up = ["value", "event_type", "day", "user_id", "event_date", "ts", "event_id"]
    store.write_partitions(events.filter(low & ~even), path, fmt="csv")
    store.upsert_larger(events.filter(even).select(mixed_up), path, fmt="csv")
    none_stored = events.filter(~low & ~even).join(events.filter(low).select("day").distinct(), "day", "left_anti")
    store.upsert_larger(none_stored.select(mixed_up), path, fmt="csv")
    return store.read_partitions(spark, path, events.drop("day").schema, fmt="csv")


@query("""
SELECT o_orderkey, o_orderdate, o_totalprice,
       row_number() OVER (ORDER BY o_orderdate NULLS LAST, o_orderkey) AS position
FROM orders""")
def compact_sorted(spark, sf_dir):
    path = new_folder(spark, "compact")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    store.compact(orders, path, ["o_orderdate", "o_orderkey"])
    return store.with_position(spark, path)


def write_daily_files(spark, sf_dir, path: str, months: Column) -> None:
    """Legs and events as daily CSV of the four families, with the header drift of such files.

    The days of points are moved on by ``months``.

    Departures up to the 10th of a month have the full header, up to the 20th another order, and
    later ones no destination column; arrivals up to the 15th have the origin last.
    """
    flights = staged(nested.flatten_flights(adapters.legs(spark, sf_dir), ZONE), "flights")
    reached = flights.filter(F.col("destination_airport_ICAO").isNotNull())
    points = adapters.point_rows(spark, sf_dir)
    moved = {day: F.add_months(day, months) for day in ("departure_date", "arrival_date")}
    points = points.withColumns(moved)
    full = schemas.FLIGHTS.names
    swapped = [*full[:7], full[8], full[7]]
    no_destination = [*full[:7], full[8]]
    origin_last = [*full[:6], full[7], full[8], full[6]]
    dom = F.dayofmonth
    variants: list[tuple[DataFrame, str, str, list[str]]] = [
        (flights.filter(dom("departure_date") <= 10), schemas.DEPARTURES, "departure_date", full),
        (
            flights.filter(dom("departure_date").between(11, 20)),
            schemas.DEPARTURES, "departure_date", swapped,
        ),
        (
            flights.filter(dom("departure_date") > 20),
            schemas.DEPARTURES, "departure_date", no_destination,
        ),
        (reached.filter(dom("arrival_date") > 15), schemas.ARRIVALS, "arrival_date", full),
        (reached.filter(dom("arrival_date") <= 15), schemas.ARRIVALS, "arrival_date", origin_last),
        (points, schemas.DEPARTURE_POINTS, "departure_date", points.columns),
        (
            points.filter(F.col("arrival_date").isNotNull()),
            schemas.ARRIVAL_POINTS, "arrival_date", points.columns,
        ),
    ]
    for rows, family, day, columns in variants:
        folder = F.concat(F.lit(family + "_"), names.day_text(day))
        csv_files.write_csv(rows.select(columns), path, folder)


def union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)

