"""Keys, dates and airport details attached by joins.

None of these broadcasts by hand: Catalyst does so where it knows a side to be small, and AQE
splits a key that holds most rows of the left side.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def left_join_null_safe(
    left: DataFrame, right: DataFrame, key: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Left join in which null keys match null keys; repeated right keys repeat the left row."""
    right = right.select(*[F.col(k).alias(f"_r_{k}") for k in key], *columns)
    condition = None
    for k in key:
        same = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        condition = same if condition is None else condition & same
    return left.join(right, condition, "left").drop(*[f"_r_{k}" for k in key])


def attach_flight_id(
    points: DataFrame, flights: DataFrame, by: Sequence[str], idx: str = "idx", id: str = "id"
) -> DataFrame:
    """Points numbered by flight get the flight's id in place of the number."""
    return left_join_null_safe(points, flights, [*by, idx], [id]).drop(idx)


def attach_dates(
    points: DataFrame,
    flights: DataFrame,
    id: str = "id",
    columns: Sequence[str] = ("arrival_date", "departure_date"),
    by: Sequence[str] = (),
) -> DataFrame:
    """Points with the dates of their flight (of the same ``by``). Points of unknown flights stay; a point whose id
    stands for several flight rows comes once per row. A null id names no flight: such points stay without dates."""
    return left_join_null_safe(points, flights.filter(F.col(id).isNotNull()), [*by, id], columns)


def airport_metadata(
    flights: DataFrame,
    airports: DataFrame,
    code: str,
    details: Sequence[str],
    ends: dict[str, str],
) -> DataFrame:
    """Flights with airport details; ``ends`` maps a code column to the prefix of its details."""
    for column, prefix in ends.items():
        renamed = airports.select(
            F.col(code).alias(column), *[F.col(d).alias(f"{prefix}{d}") for d in details]
        )
        flights = flights.join(renamed, column, "left")
    return flights
