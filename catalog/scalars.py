"""Time, key and name functions over whole tables."""

from pyspark.sql import functions as F

from catalog.adapters import ZONE
from catalog.registry import query, table
from legtrail import schemas
from legtrail.functions import names, times
from legtrail.operators import quality, select


@query("""
SELECT event_id, ts,
       ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich' AS local_ts,
       (ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich')::DATE AS local_day
FROM events""")
def local_dates(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        times.local_time("ts", ZONE).alias("local_ts"),
        times.local_date("ts", ZONE).alias("local_day"),
    )


@query("""
SELECT event_id,
       user_id || '_' || strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Zurich',
                                  '%Y-%m-%d %H:%M:%S') AS id
FROM events""")
def flight_key(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", names.flight_key("user_id", "ts", ZONE).alias("id")
    )


@query("""
SELECT o_orderkey, 'data/bl_dep_' || strftime(o_orderdate, '%Y_%m_%d') || '.csv' AS name,
       strftime(o_orderdate, '%Y_%m') AS month
FROM orders""")
def partition_names(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        names.partition_name("data", F.lit(schemas.DEPARTURES), day).alias("name"),
        names.month_text(day).alias("month"),
    )


@query("""
WITH newest AS (SELECT max(o_orderdate)::DATE AS as_of FROM orders),
spine AS (SELECT unnest(generate_series(as_of - 30, as_of - 1, INTERVAL 1 DAY))::DATE AS day
          FROM newest)
SELECT day, count(o_orderkey) AS n
FROM spine LEFT JOIN orders ON o_orderdate::DATE = day GROUP BY day""")
def date_spine(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    newest = orders.agg(F.max("day").alias("as_of"))
    days = quality.spine(newest, times.look_back("as_of", 30))
    counts = orders.groupBy("day").agg(F.count("*").alias("n"))
    return quality.day_sizes(days, counts).select("day", "n")


@query("""
SELECT o_orderkey,
       o_orderdate::DATE::TIMESTAMP AT TIME ZONE 'Europe/Zurich' AT TIME ZONE 'UTC' AS day_start,
       (o_orderdate::DATE::TIMESTAMP + INTERVAL '86399 seconds')
         AT TIME ZONE 'Europe/Zurich' AT TIME ZONE 'UTC' AS day_end,
       (epoch((o_orderdate::DATE::TIMESTAMP + INTERVAL '86399 seconds') AT TIME ZONE 'Europe/Zurich')
        - epoch(o_orderdate::DATE::TIMESTAMP AT TIME ZONE 'Europe/Zurich') + 1)::BIGINT AS seconds
FROM orders""")
def day_bounds(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    start, end = times.day_start(day, ZONE), times.day_end(day, ZONE)
    length = times.epoch_micros(end) - times.epoch_micros(start)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        start.alias("day_start"),
        end.alias("day_end"),
        (times.whole_slices(length, times.MICROS_PER_SECOND) + 1).alias("seconds"),
    )


@query("""
SELECT event_id, ts FROM events
WHERE ts BETWEEN (SELECT max(ts) FROM events) - INTERVAL 3 DAY
             AND (SELECT max(ts) FROM events) + INTERVAL 1 DAY""")
def recent_window(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    now = events.agg(F.max("ts")).scalar()
    return select.around_now(events, "ts", now, back=3 * 86_400, ahead=86_400)


@query("""
WITH newest AS (SELECT max(o_orderdate)::DATE AS as_of FROM orders),
months AS (SELECT DISTINCT strftime(unnest(generate_series(as_of - 120, as_of, INTERVAL 1 DAY)),
                                    '%Y_%m') AS month FROM newest)
SELECT o_orderkey, strftime(o_orderdate, '%Y_%m') AS month,
       (SELECT string_agg(month, '|' ORDER BY month) FROM months) AS months
FROM orders WHERE strftime(o_orderdate, '%Y_%m') IN (SELECT month FROM months)""")
def rolling_months(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    newest = orders.agg(F.max("day").alias("as_of"))
    months = newest.select(names.alternatives(names.months_back(F.col("as_of"), 120))).scalar()
    return select.rolling_months(orders, "day", newest.scalar()).select(
        "o_orderkey", names.month_text("day").alias("month"), months.alias("months")
    )
