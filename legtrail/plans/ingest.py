"""Movements of an airport and their trajectories into a store partitioned by family and day.

Both directions go through together: one pass over the flight records, one over the telemetry, one
write per store. A flight that is in both families is sampled once.
"""

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from legtrail import schemas
from legtrail.functions import times
from legtrail.operators import enrich, nested, quality, select, trajectory
from legtrail.session import Scratch, scratch
from legtrail.sources import last_states, store

#: Grid points one task lays out, and most tasks that do; beyond them a task has more points.
GRID_POINTS_PER_TASK = 500_000
MAX_GRID_TASKS = 10_000
#: Most aircraft that are broadcast to thin out telemetry before it is shuffled (under 50 MB). Beyond it the
#: join that samples does the same work later; results do not depend on it.
MAX_BROADCAST_AIRCRAFT = 500_000

PARTITIONS = (store.FAMILY, store.DAY)

_POINT_KEYS = ("ICAO24", "departure_time", "arrival_time", "id")


def flights_path(folder: str) -> str:
    return f"{folder}/flights"


def points_path(folder: str) -> str:
    return f"{folder}/points"


def _day() -> Column:
    """Departure date of departures, arrival date of arrivals."""
    is_departure = F.col(store.FAMILY) == schemas.DEPARTURES
    return F.when(is_departure, F.col("departure_date")).otherwise(F.col("arrival_date"))


class Extent(NamedTuple):
    """What flights will need: about how many aircraft, number of grid points, first and last microsecond."""

    aircraft: int
    points: int
    first: int | None
    last: int | None


def flown(flights: DataFrame) -> DataFrame:
    """Flights that have a grid: a known aircraft and both ends in order."""
    return flights.filter(_has_grid())


def _has_grid() -> Column:
    return F.col("ICAO24").isNotNull() & (F.col("arrival_time") >= F.col("departure_time"))


def extent_metrics(step: int) -> dict[str, Column]:
    """The fields of :class:`Extent` as aggregates over flights."""
    departure, arrival = times.epoch_micros("departure_time"), times.epoch_micros("arrival_time")
    steps = times.whole_slices(arrival - departure, step * times.MICROS_PER_SECOND) + 1
    return {
        "aircraft": F.approx_count_distinct(F.when(_has_grid(), F.col("ICAO24")), 0.01),
        "points": F.coalesce(F.sum(F.when(_has_grid(), steps)), F.lit(0)),
        "first": F.min(F.when(_has_grid(), departure)),
        "last": F.max(F.when(_has_grid(), arrival)),
    }


def extent(flights: DataFrame, step: int) -> Extent:
    return Extent(*flights.agg(*[metric.alias(name) for name, metric in extent_metrics(step).items()]).first())


def flight_days(flights: DataFrame) -> list[date]:
    """The UTC days that flights touch: one value per day comes to the driver."""
    ends = flown(flights).select(
        F.col("departure_time").cast("date").alias("first"), F.col("arrival_time").cast("date").alias("last")
    )
    touched = ends.distinct().select(F.explode(times.date_sequence("first", "last")).alias("day")).distinct()
    return [row.day for row in touched.collect()]


def telemetry_for(
    flights: DataFrame,
    telemetry: DataFrame,
    needs: Extent,
    exact: bool,
    day: str | None = None,
    carried: str | None = None,
) -> DataFrame:
    """The telemetry that can matter to flights, thinned out before anything is shuffled.

    A state without aircraft matters to none. ``day`` names a partition column with the UTC date of
    ``time``; bounds on it are constants, so other folders are not read. What lies before the first
    departure is reduced to the last state of each aircraft, within each task first; with ``carried``, the path of a
    table of last states (:mod:`legtrail.sources.last_states`), it is not read at all: only the days that flights
    touch are, and the last states on the eve of each stretch of them.
    """
    if carried and not day:
        raise ValueError("carried states need a partition column with the day of the telemetry")
    if needs.aircraft == 0:
        return (telemetry.drop(day) if day else telemetry).filter(F.lit(False))
    first, last = times.from_micros(F.lit(needs.first)), times.from_micros(F.lit(needs.last))
    by_day = bool(carried) and not exact
    if by_day:
        telemetry = last_states.telemetry_on(telemetry, carried, flight_days(flights), day)
    telemetry = telemetry.filter((F.col("time") <= last) & F.col("ICAO24").isNotNull())
    if day and not by_day:
        telemetry = telemetry.filter(F.col(day) <= last.cast("date"))
        telemetry = telemetry.filter(F.col(day) >= first.cast("date")) if exact else telemetry
        telemetry = telemetry.drop(day)
    if needs.aircraft <= MAX_BROADCAST_AIRCRAFT:
        aircraft = flown(flights).select("ICAO24").distinct()
        telemetry = telemetry.join(F.broadcast(aircraft), "ICAO24", "left_semi")
    if by_day:
        return telemetry
    during = telemetry.filter(F.col("time") >= first)
    if exact:
        return during
    return during.unionByName(last_states.last_of(telemetry.filter(F.col("time") < first)))


def sampled(
    flights: DataFrame,
    telemetry: DataFrame,
    step: int,
    exact: bool = True,
    has_tie: bool = False,
    telemetry_day: str | None = None,
    carried: str | None = None,
    kept: Scratch | None = None,
    needs: Extent | None = None,
) -> DataFrame:
    """Grid points of flights with the flight's columns and ``grid_step``.

    ``exact``: telemetry lies on the grid; otherwise the last state before each grid time counts.
    ``telemetry`` has ICAO24, time and state columns, those it lacks become null; with ``has_tie``
    also a number ``tie``, the greatest of which decides between states of one aircraft and time.
    ``telemetry_day`` names its partition column with the UTC date of ``time``, if there is one; then ``carried`` may
    name a table of last states that is read, and kept up, in place of all history (as-of only). Intermediate tables
    go to ``kept``, which is to be removed after the result was read, or else to folders of their own. ``needs`` is the
    :func:`extent` of the flights, if it is known.
    """
    needs = needs or extent(flights, step)
    tie = "tie" if has_tie else None
    present = [name for name in schemas.STATE_FIELDS if name in telemetry.columns]
    extra = [name for name in (tie, telemetry_day) if name]
    telemetry = telemetry.select("ICAO24", "time", *present, *extra)
    telemetry = telemetry_for(flights, telemetry, needs, exact, telemetry_day, carried)
    # Tasks lay out grids: as many as what their rows grow to asks for, not their size.
    tasks = min(MAX_GRID_TASKS, ceil(needs.points / GRID_POINTS_PER_TASK))
    sample = trajectory.sample_exact if exact else trajectory.sample_asof
    points = sample(flights, telemetry, step, present, tie, kept=kept, tasks=tasks)
    absent = {
        name: F.lit(None).cast(schemas.STATE_VECTORS[name].dataType)
        for name in schemas.STATE_FIELDS
        if name not in present
    }
    return points.withColumns(
        {**absent, "requested_time": times.micros_to_seconds("grid_micros")}
    )


def flown_once(flights: DataFrame) -> DataFrame:
    """Each flight that has an id once, with ``_rows``: family, dates and number of copies of its points.

    Every flight row gets its series, and every point counts once per flight row of its family and id, with that
    row's dates. Both are settled among the flights as counts: copies of a flight, in one family or both, are
    sampled once and never written out. A flight without id has no aircraft or no departure, so no points.
    """
    known = flights.filter(F.col("id").isNotNull())
    members = known.groupBy(*_POINT_KEYS, store.FAMILY).agg(F.count("*").alias("_n"))
    dates = known.groupBy("id", store.FAMILY, "arrival_date", "departure_date").agg(
        F.count("*").alias("_m")
    )
    dated = enrich.attach_dates(
        members, dates, columns=["arrival_date", "departure_date", "_m"], by=[store.FAMILY]
    )
    copies = (F.col("_n") * F.col("_m")).alias("copies")
    row = F.struct(store.FAMILY, "arrival_date", "departure_date", copies)
    return dated.groupBy(*_POINT_KEYS).agg(F.collect_list(row).alias("_rows"))


def points_of(once: DataFrame, telemetry: DataFrame, **sampling) -> DataFrame:
    """State-vector rows of :func:`flown_once` flights for each family, with their number of ``copies``."""
    points = sampled(once, telemetry, **sampling).withColumn("_row", F.explode("_rows"))
    columns = [name for name in schemas.STATE_VECTORS.names if not name.endswith("_date")]
    return points.select(*columns, "_row.*").select(*schemas.STORED_POINTS.names, store.FAMILY)


def save(
    flights: DataFrame, telemetry: DataFrame, folder: str, fmt: str = "parquet", **sampling
) -> DataFrame:
    """Upsert flight rows with their family, and the points of these flights.

    Gives the decision per family and day. Points are replaced first: after a failure in between, the flights
    of the day still count as the smaller ones, so the next run replaces them.
    """
    days = {"first": F.min(store.DAY), "last": F.max(store.DAY)}
    with scratch(flights.sparkSession) as kept:
        flights, flight_span = kept.measured(flights.withColumn(store.DAY, _day()), "flights", **days)
        once, needs = kept.measured(flown_once(flights), "flown", **extent_metrics(sampling["step"]))
        ids = once.select("id", F.explode("_rows").alias("_row")).select("id", "_row.family")
        if not quality.orphans(ids, flights, by=[store.FAMILY]).isEmpty():
            raise ValueError("points of unknown flights")
        points = points_of(once, telemetry, kept=kept, needs=Extent(**needs), **sampling)
        family = F.concat(store.FAMILY, F.lit("_SV"))
        points = points.withColumn(store.DAY, _day()).withColumn(store.FAMILY, family)
        points, point_span = kept.measured(points, "points", **days)
        of_points = store.upsert_larger(
            points, points_path(folder), PARTITIONS, fmt, True, "copies", tuple(point_span.values())
        )
        of_flights = store.upsert_larger(
            flights, flights_path(folder), PARTITIONS, fmt, True, None, tuple(flight_span.values())
        )
        return of_flights.unionByName(of_points)


def ingest_movements(
    records: DataFrame,
    telemetry: DataFrame,
    folder: str,
    airport: str,
    start: str,
    end: str,
    zone: str,
    step: int = 180,
    departure_day: str | None = None,
    arrival_day: str | None = None,
    **options,
) -> DataFrame:
    """Departures and arrivals of ``airport`` between two local times, with trajectories.

    ``departure_day``, ``arrival_day`` and ``telemetry_day`` name partition columns with the UTC date of the time, if
    there are such: then only folders of the range are read.
    """
    chosen = select.movements(
        records,
        {
            schemas.DEPARTURES: select.departs(airport, start, end, zone, day=departure_day),
            schemas.ARRIVALS: select.arrives(airport, start, end, zone, day=arrival_day),
        },
    )
    flights = nested.flatten_flights(chosen, zone, keep=[store.FAMILY])
    return save(flights, telemetry, folder, step=step, **options)


def stored_counts(
    spark, folder: str, first: date, last: date, fmt: str = "parquet"
) -> DataFrame:
    """``(day, family, n)`` of a store from ``first`` to ``last``; of other days, and of Parquet columns, nothing is read."""
    within = F.col(store.DAY).between(F.lit(first), F.lit(last))
    counts = [
        store.stored_counts(spark, path, schema, PARTITIONS, fmt, within).select(store.DAY, store.FAMILY, "n")
        for path, schema in (
            (flights_path(folder), schemas.FLIGHTS),
            (points_path(folder), schemas.STORED_POINTS),
        )
    ]
    return reduce(DataFrame.unionByName, counts)


def backfill_missing_days(
    records: DataFrame,
    telemetry: DataFrame,
    folder: str,
    airport: str,
    as_of: date,
    zone: str,
    days: int = 30,
    step: int = 180,
    fmt: str = "parquet",
    families: Sequence[str] = schemas.FAMILIES,
    departure_day: str | None = None,
    arrival_day: str | None = None,
    **options,
) -> DataFrame:
    """Ingest those of the last ``days`` days before ``as_of`` for which any family has no rows.

    Gives the decision per family and day; no rows if nothing was missing.
    """
    spark = records.sparkSession
    wanted = quality.spine(spark.range(1), times.look_back(F.lit(as_of), days))
    first, last = as_of - timedelta(days=days), as_of - timedelta(days=1)
    counts = stored_counts(spark, folder, first, last, fmt)
    span = (f"{first} 00:00:00", f"{last} 23:59:59", zone)
    either = select.movements(
        records,
        {
            schemas.DEPARTURES: select.departs(airport, *span, day=departure_day),
            schemas.ARRIVALS: select.arrives(airport, *span, day=arrival_day),
        },
    )
    is_departure = F.col(store.FAMILY) == schemas.DEPARTURES
    moved = F.when(is_departure, F.col("departure_time")).otherwise(F.col("arrival_time"))
    with scratch(spark) as kept:
        missing = kept.staged(quality.missing_dates(wanted, counts, families), "missing")
        chosen = select.on_days(either.withColumn("moved", moved), missing, "moved", zone)
        flights = nested.flatten_flights(chosen, zone, keep=[store.FAMILY])
        return save(flights, telemetry, folder, fmt, step=step, **options)
