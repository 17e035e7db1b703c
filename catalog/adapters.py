"""The given tables seen as movements.

legs: every ``signup`` or ``purchase`` event is a departure from the airport of that name; the
aircraft is the user; it arrives at the other airport with its first event there at or after the
departure. telemetry: every event is a state of its user.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.registry import table
from legtrail.functions import names, times
from legtrail.operators.asof import asof

ZONE = "Europe/Zurich"
HOME = "signup"
AWAY = "purchase"


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flight records with a ``leg_id``."""
    stops = table(spark, sf_dir, "events").filter(F.col("event_type").isin(HOME, AWAY))
    aircraft = F.col("user_id").cast("string").alias("ICAO24")
    departures = stops.select(
        F.col("event_id").alias("leg_id"),
        aircraft,
        F.concat(F.lit("LEG"), F.col("event_id")).alias("call_sign"),
        F.col("ts").alias("departure_time"),
        F.col("event_type").alias("origin_airport"),
        F.when(F.col("event_type") == HOME, AWAY).otherwise(HOME).alias("toward"),
    )
    arrivals = stops.select(
        aircraft, F.col("event_type").alias("toward"), times.epoch_micros("ts").alias("micros")
    )
    flown = asof(
        departures.withColumn("micros", times.epoch_micros("departure_time")),
        arrivals,
        key=["ICAO24", "toward"],
        time="micros",
        state_time="micros",
        later=True,
        found_time="landed",
    )
    return flown.withColumn("arrival_time", times.from_micros("landed")).select(
        *[c for c in departures.columns if c != "toward"],
        "arrival_time",
        F.when(F.col("landed").isNotNull(), F.col("toward")).alias("destination_airport"),
    )


LEGS = """legs AS (
  SELECT event_id AS leg_id, user_id::VARCHAR AS ICAO24, 'LEG' || event_id AS call_sign,
         ts AS departure_time, event_type AS origin_airport,
         CASE WHEN event_type = 'signup' THEN next_purchase ELSE next_signup END AS arrival_time,
         CASE WHEN event_type = 'signup' AND next_purchase IS NOT NULL THEN 'purchase'
              WHEN event_type = 'purchase' AND next_signup IS NOT NULL THEN 'signup'
         END AS destination_airport
  FROM (SELECT *,
          min(ts) FILTER (event_type = 'purchase') OVER onward AS next_purchase,
          min(ts) FILTER (event_type = 'signup') OVER onward AS next_signup
        FROM events
        WINDOW onward AS (PARTITION BY user_id ORDER BY ts
                          RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
  WHERE event_type IN ('signup', 'purchase'))"""

#: ``flights``: the legs as flight rows.
FLIGHTS = (
    LEGS
    + """, flights AS (
  SELECT leg_id, ICAO24, call_sign, departure_time,
         (departure_time AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich')::DATE AS departure_date,
         arrival_time,
         (arrival_time AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich')::DATE AS arrival_date,
         origin_airport AS departure_airport_ICAO,
         destination_airport AS destination_airport_ICAO,
         ICAO24 || '_' || strftime(departure_time AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich',
                                   '%Y-%m-%d %H:%M:%S') AS id
  FROM legs)"""
)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States: ICAO24, time, velocity, geo_altitude and the event's id as ``tie``."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("ICAO24"),
        F.col("ts").alias("time"),
        F.col("value").alias("velocity"),
        F.get_json_object("props", "$.k").cast("double").alias("geo_altitude"),
        F.col("event_id").alias("tie"),
    )


TELEMETRY = """telemetry AS (
  SELECT user_id::VARCHAR AS ICAO24, ts AS time, value AS velocity,
         (props->>'$.k')::DOUBLE AS geo_altitude, event_id AS tie
  FROM events)"""


def point_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a state-vector row; errors have no position, logins of no airport no dates."""
    local_day = times.local_date("time", ZONE)
    no_position = F.col("event_type") == "error"
    return (
        table(spark, sf_dir, "events")
        .withColumn("ICAO24", F.col("user_id").cast("string"))
        .withColumn("time", F.col("ts"))
        .select(
            "ICAO24",
            F.when(~no_position, F.col("value") / 64).alias("longitude"),
            F.when(~no_position, F.col("value") / 128).alias("latitude"),
            times.epoch_seconds("time").alias("requested_time"),
            F.get_json_object("props", "$.k").cast("double").alias("geo_altitude"),
            F.col("value").alias("velocity"),
            no_position.alias("special_purpose_indicator"),
            F.lit(None).cast("string").alias("origin_country"),
            names.flight_key("ICAO24", "time", ZONE).alias("id"),
            F.when(F.col("event_type").isin(HOME, AWAY), local_day).alias("arrival_date"),
            local_day.alias("departure_date"),
        )
    )


POINT_ROWS = """point_rows AS (
  SELECT user_id::VARCHAR AS ICAO24,
         CASE WHEN event_type <> 'error' THEN value / 64 END AS longitude,
         CASE WHEN event_type <> 'error' THEN value / 128 END AS latitude,
         epoch_us(ts) / 1000000.0::DOUBLE AS requested_time,
         (props->>'$.k')::DOUBLE AS geo_altitude, value AS velocity,
         event_type = 'error' AS special_purpose_indicator,
         NULL::VARCHAR AS origin_country,
         user_id || '_' || strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich',
                                    '%Y-%m-%d %H:%M:%S') AS id,
         CASE WHEN event_type IN ('signup', 'purchase')
              THEN (ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich')::DATE END AS arrival_date,
         (ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich')::DATE AS departure_date
  FROM events)"""


def flight_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as flights: id, aircraft, day and family (order status)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("aircraft"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderstatus").alias("family"),
        F.col("o_totalprice").alias("price"),
    )


def point_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems as points of the flight with the same order key."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        F.col("l_extendedprice").alias("price"),
    )


FLIGHT_ORDERS = """flight_orders AS (
  SELECT o_orderkey AS id, o_custkey AS aircraft, o_orderdate::DATE AS day,
         o_orderstatus AS family, o_totalprice AS price
  FROM orders)"""
POINT_LINES = """point_lines AS (
  SELECT l_orderkey AS id, l_linenumber AS line, l_partkey AS part, l_extendedprice AS price
  FROM lineitem)"""
