"""Trajectories, keys, dates, nesting and integrity."""

from pyspark.sql import functions as F

from catalog import adapters
from catalog.registry import query, table
from legtrail import schemas
from legtrail.functions import times
from legtrail.operators import enrich, nested, ordinal, quality, trajectory

HOUR = 3600
#: Records of an aircraft that one list holds at most; few, so that aircraft of the given tables have several.
BLOCK = 16


#: Fields of a line, in the order in which the points of a flight are sorted; ties are whole lines that are equal.
_LINE = ["line", "part", "price"]
#: Lines of an order in one array; few, so that orders of the given tables have several.
LINES = 4


def _nested_orders(spark, sf_dir):
    """Orders with their lines inside, a row for each block of lines."""
    return nested.nest_trajectories(
        adapters.flight_orders(spark, sf_dir).select("id", "day"),
        adapters.point_lines(spark, sf_dir),
        ["id"],
        block_size=LINES,
        order=_LINE,
        fields=[],
    )


@query(f"""
WITH {adapters.FLIGHT_ORDERS}, {adapters.POINT_LINES},
blocks AS (SELECT *, (row_number() OVER (PARTITION BY id ORDER BY line, part, price) - 1) // {LINES} AS block
           FROM point_lines)
SELECT o.id, block, any_value(o.day) AS day, count(line) AS n_points,
       string_agg(line || ':' || part || ':' || round(p.price * 100)::BIGINT, ',' ORDER BY line, part, p.price) AS points
FROM flight_orders o LEFT JOIN blocks p ON o.id = p.id GROUP BY o.id, block""")
def nested_trajectories(spark, sf_dir):
    cents = lambda p: F.round(p.price * 100).cast("bigint")
    text = F.transform("state_vectors", lambda p: F.concat_ws(":", p.line, p.part, cents(p)))
    return _nested_orders(spark, sf_dir).select(
        "id",
        "block",
        "day",
        F.coalesce(F.size("state_vectors"), F.lit(0)).cast("bigint").alias("n_points"),
        F.array_join(text, ",").alias("points"),
    )


@query(f"""
WITH {adapters.FLIGHT_ORDERS}, {adapters.POINT_LINES}
SELECT id, row_number() OVER (PARTITION BY id ORDER BY line, part, price) AS idx, line, part, price
FROM point_lines WHERE id IN (SELECT o_orderkey FROM orders)""")
def explode_trajectory(spark, sf_dir):
    orders = _nested_orders(spark, sf_dir)
    return nested.explode_trajectory(orders, "state_vectors", ["id"], _LINE, block_size=LINES)


@query(f"""
WITH {adapters.LEGS}
SELECT ICAO24, row_number() OVER (PARTITION BY ICAO24 ORDER BY leg_id)::INTEGER AS idx, call_sign, departure_time
FROM legs""")
def fetch_ordinal(spark, sf_dir):
    # Lists of records per aircraft, in the order of fetching (leg_id); each flight keeps its place in it. A list
    # goes on in further blocks, so that none grows with the flights of an aircraft.
    legs = adapters.legs(spark, sf_dir).withColumn("aircraft", F.col("ICAO24"))
    fields = [name for name in schemas.RAW_FLIGHT.names if name != "state_vectors"]
    lists = nested.nest_numbered(legs, ["aircraft"], ["leg_id"], fields, BLOCK, series="records")
    flights = nested.flatten_lists(lists, "records", adapters.ZONE, keep=["block"], idx="idx", block_size=BLOCK)
    return flights.select("ICAO24", F.col("idx").cast("int").alias("idx"), "call_sign", "departure_time")


def _numbered_orders(spark, sf_dir):
    flights = adapters.flight_orders(spark, sf_dir).select("day", "id")
    return ordinal.with_ordinal(flights, by=["day"], order=["id"])


@query(f"""
WITH {adapters.FLIGHT_ORDERS}, {adapters.POINT_LINES},
numbered AS (SELECT day, id, row_number() OVER (PARTITION BY day ORDER BY id) AS idx
             FROM flight_orders),
series AS (SELECT day, idx, line, part, price FROM point_lines JOIN numbered USING (id))
SELECT day, id, line, part, price FROM series LEFT JOIN numbered USING (day, idx)""")
def attach_flight_id(spark, sf_dir):
    numbered = _numbered_orders(spark, sf_dir)
    series = adapters.point_lines(spark, sf_dir).join(numbered, "id").drop("id")
    return enrich.attach_flight_id(series, numbered, by=["day"])


@query(f"""
WITH {adapters.FLIGHT_ORDERS}, {adapters.POINT_LINES},
dated AS (SELECT id, day FROM flight_orders WHERE family IN ('F', 'P')
          UNION ALL SELECT id, (day + INTERVAL 1 DAY)::DATE FROM flight_orders WHERE family = 'P')
SELECT id, line, part, price, day FROM point_lines LEFT JOIN dated USING (id)""")
def attach_dates(spark, sf_dir):
    # Family P has two rows per id, family O none: points repeat or stay without a date.
    flights = adapters.flight_orders(spark, sf_dir).select("id", "day", "family")
    revised = flights.filter("family = 'P'").withColumn("day", F.date_add("day", 1))
    dated = flights.filter(F.col("family").isin("F", "P")).unionByName(revised)
    return enrich.attach_dates(adapters.point_lines(spark, sf_dir), dated, columns=["day"])


@query(f"""
WITH {adapters.FLIGHT_ORDERS}, {adapters.POINT_LINES}
SELECT id, count(*) AS n_points FROM point_lines
WHERE id NOT IN (SELECT id FROM flight_orders WHERE family <> 'P') GROUP BY id""")
def orphan_points(spark, sf_dir):
    flights = adapters.flight_orders(spark, sf_dir).filter("family <> 'P'")
    return quality.orphans(adapters.point_lines(spark, sf_dir), flights)


@query(f"""
WITH {adapters.FLIGHT_ORDERS}, {adapters.POINT_LINES},
flights AS (SELECT * FROM flight_orders WHERE family <> 'P'),
orphans AS (SELECT DISTINCT id FROM point_lines WHERE id NOT IN (SELECT id FROM flights)),
counts AS (SELECT (SELECT count(*) FROM flights) AS f, (SELECT count(*) FROM point_lines) AS p,
                  (SELECT count(*) FROM orphans) AS o)
SELECT 'flights_not_empty' AS "check", f AS n, f > 0 AS pass FROM counts
UNION ALL SELECT 'points_not_empty', p, p > 0 FROM counts
UNION ALL SELECT 'orphan_trajectories', o, o = 0 FROM counts""")
def integrity_report(spark, sf_dir):
    flights = adapters.flight_orders(spark, sf_dir).filter("family <> 'P'")
    return quality.integrity_report(flights, adapters.point_lines(spark, sf_dir))


@query(f"""
WITH {adapters.LEGS}, {adapters.TELEMETRY}
SELECT leg_id, time AS grid_time, tie AS event_id, velocity
FROM (SELECT leg_id, ICAO24, date_trunc('hour', departure_time) AS dep,
             date_trunc('hour', arrival_time) AS arr FROM legs) l
JOIN (SELECT ICAO24, date_trunc('hour', time) AS time, max(tie) AS tie,
             arg_max(velocity, tie) AS velocity FROM telemetry GROUP BY ALL) t
  ON l.ICAO24 = t.ICAO24 AND t.time BETWEEN l.dep AND l.arr""")
def trajectory_grid_exact(spark, sf_dir):
    legs = adapters.legs(spark, sf_dir).select(
        "leg_id",
        "ICAO24",
        times.floor_to("departure_time", HOUR).alias("departure_time"),
        times.floor_to("arrival_time", HOUR).alias("arrival_time"),
    )
    states = adapters.telemetry(spark, sf_dir).select(
        "ICAO24",
        times.floor_to("time", HOUR).alias("time"),
        F.col("tie").alias("event_id"),
        "velocity",
    )
    points = trajectory.sample_exact(legs, states, HOUR, ["event_id", "velocity"], "event_id")
    return points.select(
        "leg_id", times.from_micros("grid_micros").alias("grid_time"), "event_id", "velocity"
    )


@query(f"""
WITH {adapters.LEGS}, {adapters.TELEMETRY},
grid AS (SELECT leg_id, ICAO24, departure_time,
                unnest(generate_series(departure_time, arrival_time, INTERVAL 6 HOUR)) AS grid_time
         FROM legs WHERE arrival_time IS NOT NULL)
SELECT leg_id, (date_diff('microsecond', departure_time, grid_time) // 21600000000)::BIGINT
         AS grid_step,
       grid_time, time AS state_time, tie AS event_id, velocity, geo_altitude
FROM grid ASOF JOIN telemetry ON grid.ICAO24 = telemetry.ICAO24 AND grid_time >= time""")
def trajectory_grid_asof(spark, sf_dir):
    legs = adapters.legs(spark, sf_dir).select(
        "leg_id", "ICAO24", "departure_time", "arrival_time"
    )
    points = trajectory.sample_asof(
        legs,
        adapters.telemetry(spark, sf_dir).withColumn("event_id", F.col("tie")),
        step=6 * HOUR,
        values=["event_id", "velocity", "geo_altitude"],
        tie="event_id",
    )
    return points.select(
        "leg_id",
        "grid_step",
        times.from_micros("grid_micros").alias("grid_time"),
        times.from_micros("state_micros").alias("state_time"),
        "event_id",
        "velocity",
        "geo_altitude",
    )


@query("""
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
       s_nationkey AS origin, c_nationkey AS destination,
       o.n_name AS origin_name, o_r.r_name AS origin_region,
       d.n_name AS destination_name, d_r.r_name AS destination_region
FROM lineitem
LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation o ON s_nationkey = o.n_nationkey
LEFT JOIN region o_r ON o.n_regionkey = o_r.r_regionkey
LEFT JOIN nation d ON c_nationkey = d.n_nationkey
LEFT JOIN region d_r ON d.n_regionkey = d_r.r_regionkey""")
def airport_metadata(spark, sf_dir):
    # A shipment is a flight from the supplier's nation to the customer's.
    lines = table(spark, sf_dir, "lineitem")
    suppliers, orders, customers = (table(spark, sf_dir, t) for t in ("supplier", "orders", "customer"))
    flights = (
        lines.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
        .join(suppliers.select("s_suppkey", F.col("s_nationkey").alias("origin")),
              F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(orders.select("o_orderkey", "o_custkey"),
              F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(customers.select("c_custkey", F.col("c_nationkey").alias("destination")),
              F.col("o_custkey") == F.col("c_custkey"), "left")
        .drop("s_suppkey", "o_orderkey", "o_custkey", "c_custkey")
    )
    airports = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("n_nationkey", F.col("n_name").alias("name"), F.col("r_name").alias("region"))
    )
    ends = {"origin": "origin_", "destination": "destination_"}
    return enrich.airport_metadata(flights, airports, "n_nationkey", ["name", "region"], ends)
