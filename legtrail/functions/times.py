"""Time-zone, calendar and grid arithmetic.

Every function takes and gives columns (or names) and stays inside generated code. ``zone`` is a
region name such as ``Europe/Zurich``; summer time follows its rules.
"""

from pyspark.sql import Column, functions as F

UTC = "UTC"
MICROS_PER_SECOND = 1_000_000


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def utc_clock(instant) -> Column:
    """UTC clock reading (TIMESTAMP_NTZ) of a TIMESTAMP, in any session zone."""
    return from_micros(F.unix_micros(_col(instant)))


def local_time(utc, zone: str) -> Column:
    """Clock reading in ``zone`` of a UTC instant."""
    return F.convert_timezone(F.lit(UTC), F.lit(zone), _col(utc))


def local_date(utc, zone: str) -> Column:
    """Calendar date in ``zone`` of a UTC instant."""
    return local_time(utc, zone).cast("date")


def to_utc(local, zone: str) -> Column:
    """UTC instant of a clock reading in ``zone``."""
    return F.convert_timezone(F.lit(zone), F.lit(UTC), _col(local))


def local_bound(text: str, zone: str) -> Column:
    """UTC instant of a literal such as ``2024-01-10 23:59:59`` in ``zone``."""
    return to_utc(F.lit(text).cast("timestamp_ntz"), zone)


def day_start(day, zone: str) -> Column:
    """UTC instant of 00:00:00 on a date in ``zone``."""
    return to_utc(_col(day).cast("timestamp_ntz"), zone)


def day_end(day, zone: str) -> Column:
    """UTC instant of 23:59:59 on a date in ``zone``."""
    return to_utc(plus_seconds(_col(day).cast("timestamp_ntz"), 24 * 3600 - 1), zone)


def plus_seconds(time, seconds) -> Column:
    """Time shifted by a whole number of seconds, negative to go back."""
    count = F.lit(seconds) if isinstance(seconds, int) else seconds
    return _col(time) + F.expr("INTERVAL '1' SECOND") * count


def epoch_micros(utc) -> Column:
    """Microseconds since 1970 of a UTC instant held as TIMESTAMP_NTZ; whole-number arithmetic from its parts."""
    utc = _col(utc)
    days = F.date_diff(utc.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(utc)) * 60 + F.minute(utc)
    second = (F.extract(F.lit("SECOND"), utc) * MICROS_PER_SECOND).cast("bigint")
    return minutes * (60 * MICROS_PER_SECOND) + second


def from_micros(micros) -> Column:
    """UTC instant of a number of microseconds since 1970."""
    return _epoch() + F.expr("INTERVAL '0.000001' SECOND") * _col(micros)


def micros_to_seconds(micros) -> Column:
    """Seconds since 1970 as double, the unit of ``requested_time``."""
    return _col(micros) / F.lit(float(MICROS_PER_SECOND))


def epoch_seconds(utc) -> Column:
    return micros_to_seconds(epoch_micros(utc))


def whole_slices(number, width: int) -> Column:
    """Number of the ``width``-wide slice a whole number lies in, also below zero."""
    number = _col(number)
    return F.call_function("div", number - F.pmod(number, F.lit(width)), F.lit(width))


def time_slice(utc, seconds: int) -> Column:
    """Number of the ``seconds``-wide slice of time an instant lies in; grows with time."""
    return whole_slices(epoch_micros(utc), seconds * MICROS_PER_SECOND)


def floor_to(utc, seconds: int) -> Column:
    """Start of the ``seconds``-wide slice of time an instant lies in."""
    return plus_seconds(_epoch(), time_slice(utc, seconds) * seconds)


def days_before(day, days: int) -> Column:
    return F.date_sub(_col(day), days)


def date_sequence(first, last) -> Column:
    """Array of all dates from ``first`` to ``last``, both included."""
    return F.sequence(_col(first), _col(last), F.expr("interval 1 day"))


def look_back(as_of, days: int) -> Column:
    """Array of the ``days`` dates that end the day before ``as_of``."""
    return date_sequence(days_before(as_of, days), days_before(as_of, 1))
