"""The latest day of an airport: movements with their trajectories inside."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from legtrail.functions import times
from legtrail.operators import enrich, nested, quality, select
from legtrail.plans.ingest import sampled
from legtrail.session import staged

DAY_SECONDS = 86_400

FLIGHT_KEY = ("id", "departure_time", "arrival_time")


class LatestDay(NamedTuple):
    agreement: DataFrame
    departures: DataFrame
    arrivals: DataFrame
    nested: DataFrame


class NotReady(ValueError):
    """The latest day is not known: nothing recent, or departures and arrivals disagree."""


def with_trajectories(
    flights: DataFrame, telemetry: DataFrame, block_steps: int | None = None, **sampling
) -> DataFrame:
    """Flights with their sampled trajectory inside: one row per flight, or with ``block_steps`` one
    for each stretch of so many grid steps."""
    flights = staged(flights, "flights")
    once = flights.select("ICAO24", *FLIGHT_KEY).distinct()
    points = sampled(once, telemetry, **sampling)
    return nested.nest_trajectories(
        flights,
        points,
        FLIGHT_KEY,
        order=["grid_step"],
        fields=["requested_time", "longitude", "latitude", "geo_altitude", "velocity"],
        block=times.whole_slices("grid_step", block_steps) if block_steps else None,
    )


def explore_latest_day(
    records: DataFrame,
    telemetry: DataFrame,
    airport: str,
    now: Column,
    zone: str,
    step: int = 60,
    back: int = 3 * DAY_SECONDS,
    ahead: int = DAY_SECONDS,
    airports: DataFrame | None = None,
    code: str = "code",
    details: tuple[str, ...] = (),
    guard: bool = True,
    departure_day: str | None = None,
    arrival_day: str | None = None,
    **sampling,
) -> LatestDay:
    """Movements of the latest day, plain and with trajectories inside (column ``direction``).

    The latest day is the last departure date among recent arrivals. It is fetched, one value, so that
    the scan of that day has constant bounds. ``guard``: raises :class:`NotReady` if there are no recent
    departures or arrivals, or if the last arrival date among departures is another day; without it
    the result may be empty. ``departure_day`` and ``arrival_day`` name partition columns of ``records`` with the UTC date
    of the time, if there are such: then only folders of the recent days, and of the latest day, are read.
    """
    leaving = records.filter(F.col("origin_airport") == airport)
    reaching = records.filter(F.col("destination_airport") == airport)
    recent_departures = nested.flatten_flights(
        select.around_now(leaving, "departure_time", now, back, ahead, departure_day), zone
    )
    recent_arrivals = nested.flatten_flights(
        select.around_now(reaching, "arrival_time", now, back, ahead, arrival_day), zone
    )
    agreement = quality.latest_day_agreement(recent_departures, recent_arrivals)
    found = agreement.first()
    if guard and (found.arrivals_latest is None or found.departures_latest is None):
        raise NotReady("no recent arrivals, or no recent departures that have arrived")
    if guard and not found.agree:
        raise NotReady(f"latest days differ: {found.arrivals_latest}, {found.departures_latest}")
    day = F.lit(found.arrivals_latest).cast("date")

    def that_day(time, utc_day):
        first, last = times.day_start(day, zone), times.day_end(day, zone)
        inside = F.col(time).between(first, last)
        return inside & F.col(utc_day).between(first.cast("date"), last.cast("date")) if utc_day else inside

    chosen = select.movements(
        records,
        {
            "departure": (F.col("origin_airport") == airport) & that_day("departure_time", departure_day),
            "arrival": (F.col("destination_airport") == airport) & that_day("arrival_time", arrival_day),
        },
        "direction",
    )
    flights = nested.flatten_flights(chosen, zone, keep=["direction"])
    if airports is not None:
        ends = {"departure_airport_ICAO": "origin_", "destination_airport_ICAO": "destination_"}
        flights = enrich.airport_metadata(flights, airports, code, details, ends)
    return LatestDay(
        agreement=agreement,
        departures=recent_departures.filter(F.col("departure_date") == day),
        arrivals=recent_arrivals.filter(F.col("arrival_date") == day),
        nested=with_trajectories(flights, telemetry, step=step, **sampling),
    )
