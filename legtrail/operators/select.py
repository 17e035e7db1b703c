"""Which movements: by airport and time range, latest day, rolling months."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from legtrail.functions import times


def in_local_range(time: str, start: str, end: str, zone: str, day: str | None = None) -> Column:
    """Closed interval between two clock readings in ``zone``.

    A bound on a time prunes no file by itself. ``day`` names a partition column with the UTC date of
    ``time``: its bounds are constants, so only folders of those days are read.
    """
    first, last = times.local_bound(start, zone), times.local_bound(end, zone)
    inside = F.col(time).between(first, last)
    return inside & F.col(day).between(first.cast("date"), last.cast("date")) if day else inside


def departs(
    airport: str,
    start: str,
    end: str,
    zone: str,
    origin: str = "origin_airport",
    time: str = "departure_time",
    day: str | None = None,
) -> Column:
    """Condition: left ``airport`` between ``start`` and ``end``, local time, both included."""
    return (F.col(origin) == airport) & in_local_range(time, start, end, zone, day)


def arrives(
    airport: str,
    start: str,
    end: str,
    zone: str,
    destination: str = "destination_airport",
    time: str = "arrival_time",
    day: str | None = None,
) -> Column:
    """Condition: reached ``airport`` between ``start`` and ``end``, local time, both included."""
    return (F.col(destination) == airport) & in_local_range(time, start, end, zone, day)


def airport_departures(flights: DataFrame, *range_, **columns) -> DataFrame:
    """Flights that meet :func:`departs`."""
    return flights.filter(departs(*range_, **columns))


def airport_arrivals(flights: DataFrame, *range_, **columns) -> DataFrame:
    """Flights that meet :func:`arrives`."""
    return flights.filter(arrives(*range_, **columns))


def movements(records: DataFrame, families: dict[str, Column], family: str = "family") -> DataFrame:
    """Several selections in one pass: a row comes once per family whose condition it meets."""
    met = [F.when(condition, F.lit(name)) for name, condition in families.items()]
    return records.filter(reduce(Column.__or__, families.values())).withColumn(
        family, F.explode(F.array_compact(F.array(*met)))
    )


def on_days(rows: DataFrame, days: DataFrame, time: str, zone: str, day: str = "day") -> DataFrame:
    """Rows whose ``time`` lies on one of ``days``, from 00:00:00 to 23:59:59 local."""
    wanted = days.select(F.col(day).alias("_wanted")).distinct()
    same_day = times.local_date(time, zone) == F.col("_wanted")
    return rows.join(
        wanted, same_day & (F.col(time) <= times.day_end("_wanted", zone)), "left_semi"
    )


def latest(rows: DataFrame, column: str, of: DataFrame | None = None, of_column: str | None = None):
    """Rows on the latest value of a column, taken from ``rows`` or from another table."""
    newest = (of if of is not None else rows).agg(F.max(of_column or column)).scalar()
    return rows.filter(F.col(column) == newest)


def around_now(
    rows: DataFrame, time: str, now: Column, back: int, ahead: int, day: str | None = None
) -> DataFrame:
    """Rows from ``back`` seconds before ``now`` to ``ahead`` seconds after it; ``day`` as in :func:`in_local_range`."""
    first, last = times.plus_seconds(now, -back), times.plus_seconds(now, ahead)
    inside = rows.filter(F.col(time).between(first, last))
    return inside.filter(F.col(day).between(first.cast("date"), last.cast("date"))) if day else inside


def rolling_months(rows: DataFrame, day: str, as_of: Column, days: int = 120) -> DataFrame:
    """Rows in the calendar months touched by the ``days`` days before ``as_of`` and by it.

    A plain range on the date, so a store partitioned by day reads those folders only.
    """
    first = F.trunc(times.days_before(as_of, days), "MM")
    return rows.filter(F.col(day).between(first, F.last_day(as_of)))
