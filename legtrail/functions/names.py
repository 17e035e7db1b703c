"""Flight keys and names of daily datasets."""

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from legtrail.functions.times import _col, date_sequence, days_before, local_time

# Separators and extension of dataset names.
EXTENSION = ".csv"
SEPARATOR = "_"


def flight_key(aircraft, departure, zone: str) -> Column:
    """``<aircraft>_<local departure, to the second>``; null if either part is null."""
    clock = F.substring(local_time(departure, zone).cast("string"), 1, 19)
    return F.concat(_col(aircraft).cast("string"), F.lit(SEPARATOR), clock)


def day_text(day) -> Column:
    """Date as ``yyyy_MM_dd``."""
    return F.translate(_col(day).cast("string"), "-", SEPARATOR)


def month_text(day) -> Column:
    """Month of a date as ``yyyy_MM``."""
    return F.substring(day_text(day), 1, 7)


def partition_name(folder: str, family, day) -> Column:
    """``<folder>/<family>_<yyyy_MM_dd>.csv``."""
    return F.concat(
        F.lit(folder + "/"), _col(family), F.lit(SEPARATOR), day_text(day), F.lit(EXTENSION)
    )


def months_back(as_of, days: int) -> Column:
    """Sorted array of the month texts touched by the ``days`` days before ``as_of`` and by it."""
    span = date_sequence(days_before(as_of, days), as_of)
    return F.array_sort(F.array_distinct(F.transform(span, month_text)))


def alternatives(texts) -> Column:
    """Texts joined with ``|``, for use inside a regular expression."""
    return F.array_join(_col(texts), "|")


def name_pattern(family: str, months: Iterable[str] | None = None) -> str:
    """Pattern of the daily names of one family, of all days or of some months only."""
    if months is None:
        return rf"^{family}_\d+"
    return rf"^{family}_({'|'.join(months)})"
