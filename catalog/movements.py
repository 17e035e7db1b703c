"""Selection, flattening, numbering and completeness."""

from pyspark.sql import functions as F

from catalog import adapters
from catalog.adapters import HOME, ZONE
from catalog.registry import query, table
from legtrail.functions import times
from legtrail.operators import nested, ordinal, quality, select

# The range covers the middle of the events; its ends are local times.
START, END = "2024-01-05 06:00:00", "2024-01-24 21:59:59"

_RANGE = """BETWEEN TIMESTAMP '2024-01-05 06:00:00' AT TIME ZONE 'Europe/Zurich' AT TIME ZONE 'UTC'
             AND TIMESTAMP '2024-01-24 21:59:59' AT TIME ZONE 'Europe/Zurich' AT TIME ZONE 'UTC'"""


@query(f"""
WITH {adapters.LEGS}
SELECT * FROM legs WHERE origin_airport = 'signup' AND departure_time {_RANGE}""")
def airport_departures(spark, sf_dir):
    return select.airport_departures(adapters.legs(spark, sf_dir), HOME, START, END, ZONE)


@query(f"""
WITH {adapters.LEGS}
SELECT * FROM legs WHERE destination_airport = 'signup' AND arrival_time {_RANGE}""")
def airport_arrivals(spark, sf_dir):
    return select.airport_arrivals(adapters.legs(spark, sf_dir), HOME, START, END, ZONE)


@query(f"WITH {adapters.FLIGHTS} SELECT * FROM flights")
def flatten_flights(spark, sf_dir):
    # A response is a list of records: one for a departure, an empty one for any other event.
    legs = adapters.legs(spark, sf_dir)
    record = F.struct(*[c for c in legs.columns if c != "leg_id"])
    responses = legs.select("leg_id", F.array(record).alias("flights"))
    others = table(spark, sf_dir, "events").filter(~F.col("event_type").isin(HOME, adapters.AWAY))
    empty = others.select(
        F.col("event_id").alias("leg_id"),
        F.array().cast(responses.schema["flights"].dataType).alias("flights"),
    )
    return nested.flatten_lists(responses.unionByName(empty), "flights", ZONE, keep=["leg_id"])


@query(f"""
WITH {adapters.FLIGHTS}
SELECT leg_id, departure_date, departure_time,
       row_number() OVER (PARTITION BY departure_date ORDER BY departure_time, leg_id) AS idx
FROM flights""")
def flight_ordinal(spark, sf_dir):
    flights = nested.flatten_flights(adapters.legs(spark, sf_dir), ZONE, keep=["leg_id"])
    return ordinal.with_ordinal(
        flights.select("leg_id", "departure_date", "departure_time"),
        by=["departure_date"],
        order=["departure_time", "leg_id"],
    )


@query("SELECT * FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def latest_day_movements(spark, sf_dir):
    return select.latest(table(spark, sf_dir, "orders"), "o_orderdate")


@query(f"""
WITH {adapters.FLIGHTS},
arrivals AS (SELECT max(departure_date) AS d FROM flights WHERE destination_airport_ICAO = 'signup'),
departures AS (SELECT max(arrival_date) AS d FROM flights WHERE departure_airport_ICAO = 'signup')
SELECT a.d AS arrivals_latest, d.d AS departures_latest, a.d IS NOT DISTINCT FROM d.d AS agree
FROM arrivals a, departures d""")
def latest_day_agreement(spark, sf_dir):
    flights = nested.flatten_flights(adapters.legs(spark, sf_dir), ZONE)
    return quality.latest_day_agreement(
        flights.filter(F.col("departure_airport_ICAO") == HOME),
        flights.filter(F.col("destination_airport_ICAO") == HOME),
    )


@query(f"""
WITH {adapters.FLIGHTS}
SELECT arrival_date AS chunk, count(DISTINCT departure_date) AS n_dates
FROM flights GROUP BY arrival_date HAVING count(DISTINCT departure_date) > 1""")
def multi_date_chunks(spark, sf_dir):
    flights = nested.flatten_flights(adapters.legs(spark, sf_dir), ZONE)
    return quality.multi_date_chunks(flights, "arrival_date", "departure_date")


# The event types, standing for four families and one more.
EVENT_FAMILIES = ("click", "error", "purchase", "signup", "view")


@query("""
WITH spine AS (SELECT unnest(generate_series(DATE '2023-12-25', DATE '2024-02-05',
                                             INTERVAL 1 DAY))::DATE AS day),
families AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS family),
counts AS (SELECT ts::DATE AS day, event_type AS family, count(*) AS n FROM events GROUP BY ALL)
SELECT day FROM spine CROSS JOIN families LEFT JOIN counts USING (day, family)
GROUP BY day HAVING NOT bool_and(coalesce(n, 0) > 60)""")
def missing_dates(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    first, last = (F.lit(text).cast("date") for text in ("2023-12-25", "2024-02-05"))
    days = quality.spine(spark.range(1), times.date_sequence(first, last))
    counts = quality.family_counts(events, "day", "event_type")
    return quality.missing_dates(days, counts, EVENT_FAMILIES, threshold=60)


@query("SELECT o_orderdate::DATE AS day, count(*) AS n FROM orders GROUP BY 1")
def partition_counts(spark, sf_dir):
    return adapters.flight_orders(spark, sf_dir).groupBy("day").agg(F.count("*").alias("n"))


@query("""
WITH spine AS (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE,
                                             INTERVAL 1 DAY))::DATE AS day FROM orders),
counts AS (SELECT o_orderdate::DATE AS day, count(*) AS n FROM orders GROUP BY 1)
SELECT day, coalesce(n, 0) AS n, coalesce(n, 0) > 5 AS ok FROM spine LEFT JOIN counts USING (day)""")
def partition_nonempty(spark, sf_dir):
    orders = adapters.flight_orders(spark, sf_dir)
    counts = orders.groupBy("day").agg(F.count("*").alias("n"))
    ends = counts.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    days = quality.spine(ends, times.date_sequence("first", "last"))
    return quality.day_sizes(days, counts, threshold=5)
