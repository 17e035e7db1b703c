"""Four consolidated sorted datasets from the daily ones."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from legtrail import schemas
from legtrail.functions import names
from legtrail.operators import select
from legtrail.plans import ingest
from legtrail.sources import csv_files, store

#: Sort of each dataset; the columns after the first only make the order total.
ORDER = {
    schemas.DEPARTURES: ("departure_time", "id", "destination_airport_ICAO"),
    schemas.ARRIVALS: ("departure_time", "id", "departure_airport_ICAO"),
    schemas.DEPARTURE_POINTS: ("departure_date", "id", "requested_time"),
    schemas.ARRIVAL_POINTS: ("arrival_date", "id", "requested_time"),
}

_POINT_DAY = {
    schemas.DEPARTURE_POINTS: "departure_date",
    schemas.ARRIVAL_POINTS: "arrival_date",
}

#: The column from which a row's day in the store was taken.
STORED_DAY = {schemas.DEPARTURES: "departure_date", schemas.ARRIVALS: "arrival_date", **_POINT_DAY}


def recent_months(as_of: date, days: int) -> list[str]:
    """Month texts touched by the last ``days`` days up to ``as_of``."""
    span = (as_of - timedelta(days=n) for n in range(days + 1))
    return sorted({day.strftime("%Y_%m") for day in span})


def daily_files(
    spark: SparkSession, path, family: str, as_of: date, days: int = 120, part: str = "file"
) -> DataFrame:
    """All daily CSV files of one family; of point families those of the recent months."""
    months = recent_months(as_of, days) if family in _POINT_DAY else None
    pattern = names.name_pattern(family, months)
    return csv_files.scan(spark, path, schemas.family_schema(family), pattern, part)


def daily_store(
    spark: SparkSession, folder: str, family: str, as_of: date, days: int = 120, fmt: str = "parquet"
) -> DataFrame:
    """One family of an ingest store; of point families only the folders of recent months."""
    return daily_rows(spark, folder, family, as_of, days, fmt).drop(*ingest.PARTITIONS)


def daily_rows(
    spark: SparkSession, folder: str, family: str, as_of: date, days: int = 120, fmt: str = "parquet"
) -> DataFrame:
    """As :func:`daily_store`, with the columns that name the folders."""
    is_points = family in _POINT_DAY
    path = ingest.points_path(folder) if is_points else ingest.flights_path(folder)
    rows = store.read_partitions(
        spark, path, schemas.stored_schema(family), ingest.PARTITIONS, fmt
    ).filter(F.col(store.FAMILY) == family)
    if is_points:
        rows = select.rolling_months(rows, store.DAY, F.lit(as_of), days)
    return rows


def consolidate_datasets(daily: dict[str, DataFrame], out: str, fmt: str = "parquet") -> dict[str, str]:
    """Write ``<out>/<family>_all`` for each family; gives the paths."""
    paths = {}
    for family, rows in daily.items():
        paths[family] = f"{out}/{family}_all"
        store.compact(rows, paths[family], ORDER[family], fmt)
    return paths


def _path(out: str, family: str) -> str:
    return f"{out}/{family}_all"


def consolidate_ranges(daily: dict[str, DataFrame], out: str) -> dict[str, str]:
    """As :func:`consolidate_datasets`, in folders that :func:`consolidate_changes` can change one by one (Parquet)."""
    for family, rows in daily.items():
        store.compact_ranges(rows, _path(out, family), ORDER[family])
    return {family: _path(out, family) for family in daily}


def consolidate_changes(
    spark: SparkSession, folder: str, out: str, decision: DataFrame, as_of: date, days: int = 120, fmt: str = "parquet"
) -> dict[str, list]:
    """Bring the datasets of :func:`consolidate_ranges` up to an ingest store of which some days have changed.

    ``decision`` is what an ingest gives: family, day and whether the day was ``replaced``. From the store only
    the replaced days are read; of the datasets only folders are written that hold rows of these days, before or after.
    Point families lose the folders of months that are no longer recent. The datasets are then what a full
    run would have made. Gives the dates of the folders written or removed, by family.
    """
    changed = {family: [] for family in schemas.FAMILIES}
    for row in decision.filter("replaced").select(store.FAMILY, store.DAY).distinct().collect():
        changed[row[store.FAMILY]].append(row[store.DAY])
    months = set(recent_months(as_of, days))
    written = {}
    for family, dates in changed.items():
        on = lambda column: _one_of(column, dates)
        path = _path(out, family)
        rows = daily_rows(spark, folder, family, as_of, days, fmt).filter(on(store.DAY)).drop(*ingest.PARTITIONS)
        written[family] = store.merge_ranges(rows, path, ORDER[family], on(STORED_DAY[family])) if dates else []
        if family in _POINT_DAY:
            old = store.drop_ranges(spark, path, lambda day: day is not None and day[:7].replace("-", "_") in months)
            written[family] += [date.fromisoformat(name.split("=")[1]) for name in old]
    return written


def _one_of(column: str, dates: list) -> Column:
    """True for one of the dates, among which may be null."""
    known = [day for day in dates if day is not None]
    found = F.col(column).isin(known) if known else F.lit(False)
    return found | F.col(column).isNull() if len(known) < len(dates) else found
