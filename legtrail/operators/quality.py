"""Completeness and integrity checks."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def spine(one_row: DataFrame, dates: Column, name: str = "day") -> DataFrame:
    """One row per date of an array column of a one-row table."""
    return one_row.select(F.explode(dates).alias(name))


def family_counts(rows: DataFrame, day: str, family: str | Column) -> DataFrame:
    """``(day, family, n)``."""
    family = F.col(family) if isinstance(family, str) else family
    return rows.groupBy(F.col(day).alias("day"), family.alias("family")).agg(
        F.count("*").alias("n")
    )


def day_sizes(days: DataFrame, counts: DataFrame, threshold: int = 0) -> DataFrame:
    """Every wanted day with its row count and whether it has more than ``threshold`` rows."""
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    return days.join(counts, "day", "left").select("day", n.alias("n"), (n > threshold).alias("ok"))


def missing_dates(
    days: DataFrame, counts: DataFrame, families: Sequence[str], threshold: int = 0
) -> DataFrame:
    """Wanted days on which any family has ``threshold`` rows or fewer; absent counts as 0."""
    wanted = days.select("day", F.explode(F.array(*map(F.lit, families))).alias("family"))
    enough = F.coalesce("n", F.lit(0)) > threshold
    return (
        wanted.join(counts, ["day", "family"], "left")
        .groupBy("day")
        .agg(F.coalesce(F.bool_and(enough), F.lit(True)).alias("complete"))
        .filter(~F.col("complete"))
        .select("day")
    )


def orphans(
    points: DataFrame,
    flights: DataFrame,
    id: str = "id",
    flight_id: str = "id",
    by: Sequence[str] = (),
) -> DataFrame:
    """Ids of points that no flight (of the same ``by``) has, with their number of points.

    Null counts as an id. Points are counted per id before the join, so long trajectories do not
    move.
    """
    counted = points.groupBy(*by, F.col(id).alias("id")).agg(F.count("*").alias("n_points"))
    known = flights.select(
        *[F.col(c).alias(f"_{c}") for c in by], F.col(flight_id).alias("_id")
    ).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*by, "id")]
    return counted.join(known, reduce(Column.__and__, same), "left_anti")


def multi_date_chunks(rows: DataFrame, chunk: str, date: str) -> DataFrame:
    """Chunks whose rows fall on more than one date."""
    return (
        rows.groupBy(F.col(chunk).alias("chunk"))
        .agg(F.count_distinct(date).alias("n_dates"))
        .filter("n_dates > 1")
    )


def latest_day_agreement(departures: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Latest departure date among arrivals, latest arrival date among departures, and if equal."""
    of_arrivals = arrivals.agg(F.max("departure_date")).scalar()
    return departures.agg(F.max("arrival_date").alias("departures_latest")).select(
        of_arrivals.alias("arrivals_latest"),
        "departures_latest",
        of_arrivals.eqNullSafe(F.col("departures_latest")).alias("agree"),
    )


def check(name: str, counted: DataFrame, passes: Column) -> DataFrame:
    """One row ``(check, n, pass)`` from the row count ``n`` of a table."""
    return counted.agg(F.count("*").alias("n")).select(
        F.lit(name).alias("check"), "n", passes.alias("pass")
    )


def integrity_report(
    flights: DataFrame, points: DataFrame, id: str = "id", flight_id: str = "id"
) -> DataFrame:
    """One row per check: neither side empty, every trajectory belongs to a flight."""
    n = F.col("n")
    return (
        check("flights_not_empty", flights, n > 0)
        .unionByName(check("points_not_empty", points, n > 0))
        .unionByName(check("orphan_trajectories", orphans(points, flights, id, flight_id), n == 0))
    )
