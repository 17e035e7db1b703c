"""Nested flight records to rows and back."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from legtrail.functions import names, times
from legtrail.operators import ordinal
from legtrail.session import Scratch

#: Points that one array holds at most, where blocks are cut by number.
POINTS_PER_BLOCK = 1024


def flight_columns(record: str | None, zone: str) -> list[Column]:
    """The columns of a flight row, from a record struct or from top-level record columns."""
    field = (lambda name: F.col(f"{record}.{name}")) if record else F.col
    departure, arrival = field("departure_time"), field("arrival_time")
    return [
        field("ICAO24").alias("ICAO24"),
        field("call_sign").alias("call_sign"),
        departure.alias("departure_time"),
        times.local_date(departure, zone).alias("departure_date"),
        arrival.alias("arrival_time"),
        times.local_date(arrival, zone).alias("arrival_date"),
        field("origin_airport").alias("departure_airport_ICAO"),
        field("destination_airport").alias("destination_airport_ICAO"),
        names.flight_key(field("ICAO24"), departure, zone).alias("id"),
    ]


def flatten_flights(records: DataFrame, zone: str, keep: Sequence[str] = ()) -> DataFrame:
    """Flight rows of a table with one raw flight record per row; ``keep`` passes columns on."""
    return records.select(*keep, *flight_columns(None, zone))


def flatten_lists(
    lists: DataFrame,
    column: str,
    zone: str,
    keep: Sequence[str] = (),
    idx: str | None = None,
    block_size: int | None = None,
) -> DataFrame:
    """Flight rows of a table with a list of raw flight records per row; empty lists give none.

    All columns of the contract are always there, whatever fields are null in a record. ``idx``
    names a column for the place of the flight in its list, from 1: the order of fetching. With ``block_size`` a
    list is cut in rows of so many records, numbered by ``block`` from 0, and the place goes on from row to row.
    """
    before = F.col("block") * block_size if block_size else F.lit(0)
    records = lists.select(*keep, before.alias("_before"), F.posexplode(column).alias("_at", "record"))
    number = [(F.col("_before") + F.col("_at") + 1).alias(idx)] if idx else []
    return records.select(*keep, *number, *flight_columns("record", zone))


def explode_trajectory(
    flights: DataFrame,
    series: str,
    keep: Sequence[str],
    fields: Sequence[str] | None = None,
    idx: str = "idx",
    block_size: int | None = None,
) -> DataFrame:
    """One row per point, numbered from 1 in the order of the series; null series give none.

    With ``block_size``, the size that :func:`nest_numbered` cut blocks by, the number goes on from block to block.
    """
    before = F.col("block") * block_size if block_size else F.lit(0)
    points = flights.select(*keep, before.alias("_before"), F.posexplode(series).alias("_at", "_point"))
    inside = [F.col(f"_point.{name}") for name in fields] if fields else [F.col("_point.*")]
    number = F.col("_before") + F.col("_at") + 1
    return points.select(*keep, number.alias(idx), *inside)


def nest_points(
    points: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    fields: Sequence[str],
    block: Column | None = None,
    series: str = "state_vectors",
) -> DataFrame:
    """Points gathered into one sorted array per key and block.

    Without ``block`` a key has one array, as long as its span and step make it. ``block`` numbers
    stretches of a trajectory, such as 1024 grid steps each; an array then holds at most a block's
    points, and a key has a row for each block. Nothing is cut off.
    """
    block = F.lit(0).cast("bigint") if block is None else block
    point = F.struct(*order, *[name for name in fields if name not in order])
    return points.groupBy(*key, block.alias("block")).agg(
        F.array_sort(F.collect_list(point)).alias(series)
    )


def nest_numbered(
    points: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    fields: Sequence[str],
    size: int = POINTS_PER_BLOCK,
    series: str = "state_vectors",
    kept: Scratch | None = None,
) -> DataFrame:
    """Points gathered into sorted arrays of ``size`` points, ``block`` numbering those of a key from 0.

    A point's place among those of its key (nulls last) says which block it goes to. The places come from one sort
    over all keys by ranges (:func:`legtrail.operators.ordinal.with_ordinal`, also for ``kept``), so neither an array nor a
    task grows with a key, whatever its points are like.
    """
    names_ = [*order, *[name for name in fields if name not in order]]
    placed = ordinal.with_ordinal(points.select(*key, *[n for n in names_ if n not in key]), key, order, "_place", kept)
    block = times.whole_slices(F.col("_place") - 1, size).alias("block")
    in_order = F.array_sort(F.collect_list(F.struct("_place", F.struct(*names_).alias("point"))))
    return placed.groupBy(*key, block).agg(F.transform(in_order, lambda one: one["point"]).alias(series))


def nest_trajectories(
    flights: DataFrame,
    points: DataFrame,
    key: Sequence[str],
    series: str = "state_vectors",
    block_size: int | None = None,
    **nest,
) -> DataFrame:
    """Flights with their trajectory inside; flights without points stay, with a null series.

    A flight has a row for each block: those of :func:`nest_points`, or with ``block_size`` of :func:`nest_numbered`.
    """
    if block_size:
        nested = nest_numbered(points, key, size=block_size, series=series, **nest)
    else:
        nested = nest_points(points, key, series=series, **nest)
    return flights.join(nested, list(key), "left")


def trajectories(flights: DataFrame, key: Sequence[str], series: str = "state_vectors") -> DataFrame:
    """Only key, block and series of nested flights."""
    return flights.select(*key, "block", series)
