"""Last states carried from day to day: all that as-of search needs of the time before a day.

A table with a folder per UTC day holds the last state of every aircraft seen up to the end of that day. A day's table
follows from an earlier one and the telemetry of the days between, so older telemetry is read once and never again.

Telemetry is a table with ICAO24, time, state columns and a partition column with the UTC date of ``time``; of states
of one aircraft and time that with the greatest ``tie`` counts (if there is such a column, nulls lowest), then that with the
greatest values.
"""

from collections.abc import Sequence
from datetime import date, timedelta
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from legtrail import session
from legtrail.sources import store

KEY = "ICAO24"
TIME = "time"
TIE = "tie"
_ONE_DAY = timedelta(days=1)


def days_kept(spark: SparkSession, path: str) -> list[date]:
    """The days whose tables are there, from the names of the folders."""
    mark = f"{store.DAY}="
    found = (name.removeprefix(mark) for name in session.folder_names(spark, path) if name.startswith(mark))
    return sorted(date.fromisoformat(text) for text in found)


def forget(spark: SparkSession, path: str, since: date) -> None:
    """Remove the tables from ``since`` on: to be called when telemetry of that day has changed or come late."""
    for day in days_kept(spark, path):
        if day >= since:
            session.remove(spark, f"{path}/{store.DAY}={day}")


def last_of(states: DataFrame, by: Sequence[str] = (KEY,)) -> DataFrame:
    """One whole state per ``by``: the last one. Reduced within each task first; states without aircraft are left out."""
    tied = [name for name in states.columns if name == TIE]
    others = [name for name in states.columns if name not in (*by, TIME, TIE)]
    latest = F.max(F.struct(TIME, *tied, *others)).alias("_latest")
    return states.dropna(subset=[KEY, TIME]).groupBy(*by).agg(latest).select(*by, "_latest.*")


def read(spark: SparkSession, path: str, telemetry: DataFrame, day: str) -> DataFrame:
    """The table with the columns of ``telemetry`` (without its ``day``) and the partition column ``day``."""
    plain = telemetry.drop(day)
    kept = store.read_partitions(spark, path, plain.schema, (store.DAY,))
    if days_kept(spark, path):
        stored = set(spark.read.parquet(path).columns) - {store.DAY}
        if stored != set(plain.columns):
            raise ValueError(f"last states were kept with the columns {sorted(stored)}; forget them to start anew")
    return kept


def keep_up(telemetry: DataFrame, path: str, days: Sequence[date], day: str) -> None:
    """Make sure that the table has the last states at the end of each of ``days``.

    What is missing is made from the latest table before it and the telemetry since then, in one pass for all days that
    have the same table before them; without any, from all telemetry up to the day. ``day`` names the partition column
    of ``telemetry``. Every table is written once and whole: a failed run leaves the others as they are.
    """
    spark = telemetry.sparkSession
    kept = days_kept(spark, path)
    before = lambda wanted: max((d for d in kept if d < wanted), default=None)
    table = read(spark, path, telemetry, day)
    for base, missing in groupby(sorted(set(days) - set(kept)), key=before):
        store.write_partitions(_made(telemetry, table, base, list(missing), day), path, (store.DAY,))


def _made(telemetry: DataFrame, table: DataFrame, base: date | None, missing: list[date], day: str) -> DataFrame:
    """The tables of the days ``missing`` from that of ``base``."""
    news = telemetry.filter(F.col(day) <= F.lit(missing[-1]))
    news = news.filter(F.col(day) > F.lit(base)) if base else news
    # Each state belongs to the first missing day that ends after it.
    ends = F.array(*[F.lit(d) for d in missing])
    first_end = F.element_at(F.filter(ends, lambda end: end >= F.col(day)), 1)
    news = last_of(news.select(*table.drop(store.DAY).columns, first_end.alias("_end")), [KEY, "_end"])
    if base:
        old = table.filter(F.col(store.DAY) == F.lit(base)).drop(store.DAY).withColumn("_end", F.lit(missing[0]))
        news = last_of(news.unionByName(old), [KEY, "_end"])
    # An aircraft that is silent keeps its state until it is seen again; a row per aircraft and day it is seen on.
    onward = W.partitionBy(KEY).orderBy("_end")
    lasting = F.filter(
        ends, lambda end: (end >= F.col("_end")) & (F.col("_next").isNull() | (end < F.col("_next")))
    )
    filled = news.withColumn("_next", F.lead("_end").over(onward)).withColumn(store.DAY, F.explode(lasting))
    return filled.drop("_end", "_next")


def at_end_of(telemetry: DataFrame, path: str, days: Sequence[date], day: str) -> DataFrame:
    """The last states at the end of each of ``days``, in the columns of ``telemetry`` without ``day``; made if not there."""
    spark = telemetry.sparkSession
    keep_up(telemetry, path, days, day)
    table = read(spark, path, telemetry, day)
    return table.filter(F.col(store.DAY).isin(list(days))).drop(store.DAY)


def runs(days: Sequence[date]) -> list[tuple[date, date]]:
    """First and last day of each stretch of days without a gap."""
    found: list[tuple[date, date]] = []
    for d in sorted(set(days)):
        if found and found[-1][1] + _ONE_DAY == d:
            found[-1] = (found[-1][0], d)
        else:
            found.append((d, d))
    return found


def within(column: str, spans: Sequence[tuple[date, date]]) -> Column:
    """True for dates in one of the stretches."""
    found = F.lit(False)
    for first, last in spans:
        found = found | F.col(column).between(F.lit(first), F.lit(last))
    return found


def telemetry_on(telemetry: DataFrame, path: str, days: Sequence[date], day: str) -> DataFrame:
    """All states that as-of search on ``days`` can find: the telemetry of these days, and the last states on the eve of each
    stretch of them. No other folder of ``telemetry`` is read, but for eves that nobody has kept up yet."""
    spans = runs(days)
    eves = at_end_of(telemetry, path, [first - _ONE_DAY for first, _ in spans], day)
    return telemetry.filter(within(day, spans)).drop(day).unionByName(eves)
