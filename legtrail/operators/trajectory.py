"""States of an aircraft at departure, departure + step, ... up to arrival."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from legtrail.functions import times
from legtrail.functions.rows import repeat
from legtrail.operators.asof import asof, one_state_per_time
from legtrail.operators.ordinal import with_ordinal
from legtrail.session import Scratch

# Columns that only this module sees.
_FROM, _SPAN, _N, _FIRST, _LAST, _TIME, _NEXT = "_from", "_span", "_n", "_first", "_last", "_state_time", "_next_time"


def grid(
    flights: DataFrame,
    step: int,
    departure: str = "departure_time",
    arrival: str = "arrival_time",
) -> DataFrame:
    """Flights with one row per grid time: ``grid_step`` from 0 and ``grid_micros`` since 1970.

    Flights without both ends in order give none. Only whole-number arithmetic per grid row.
    """
    micros = step * times.MICROS_PER_SECOND
    start, span = F.col("_from"), times.epoch_micros(arrival) - F.col("_from")
    flown = flights.filter(F.col(arrival) >= F.col(departure)).withColumn(
        "_from", times.epoch_micros(departure)
    )
    return (
        repeat(flown, times.whole_slices(span, micros) + 1, "grid_step")
        .withColumn("grid_micros", start + F.col("grid_step") * micros)
        .drop("_from")
    )


def _states(telemetry, aircraft, time, values, tie):
    tied = [tie] if tie and tie not in values else []
    return telemetry.select(aircraft, times.epoch_micros(time).alias("grid_micros"), *values, *tied)


def _numbered(states: DataFrame, aircraft: str, kept: Scratch) -> DataFrame:
    """States that can be found, one per time, with the number of each among those of its aircraft, from 1."""
    known = states.dropna(subset=[aircraft, "grid_micros"])
    return kept.staged(with_ordinal(known, [aircraft], ["grid_micros"], _N, kept), "numbered")


def _met(
    flights: DataFrame, states: DataFrame, step: int, aircraft: str, departure: str, arrival: str, exact: bool, kept: Scratch
) -> tuple[DataFrame, bool]:
    """Flights in order with the numbers of the first and last state that their grid can meet, and whether there are no
    more such states over all flights than grid points."""
    ends = flights.filter(F.col(arrival) >= F.col(departure)).withColumn(_FROM, times.epoch_micros(departure))
    ends = ends.withColumn(_SPAN, times.epoch_micros(arrival) - F.col(_FROM))
    places = states.select(aircraft, "grid_micros", _N)

    def placed(rows: DataFrame, at, name: str) -> DataFrame:
        probes = rows.withColumn("_probe", at)
        found = asof(probes, places, [aircraft], "_probe", "grid_micros", [_N], found_time="_found", kept=kept)
        return found.withColumn(name, F.coalesce(_N, F.lit(0))).drop("_probe", "_found", _N)

    # exact: from the first state at or after departure; else from the last one at or before it
    ends = placed(ends, F.col(_FROM) - 1, _FIRST) if exact else placed(ends, F.col(_FROM), _FIRST)
    ends = ends.withColumn(_FIRST, F.col(_FIRST) + 1 if exact else F.greatest(_FIRST, F.lit(1)))
    ends = placed(ends, F.col(_FROM) + F.col(_SPAN), _LAST).filter(F.col(_LAST) >= F.col(_FIRST))
    steps = times.whole_slices(_SPAN, step * times.MICROS_PER_SECOND) + 1
    sums = {"met": F.sum(F.col(_LAST) - F.col(_FIRST) + 1), "points": F.sum(steps)}
    ends, counts = kept.measured(ends, "met", **sums)
    return ends, (counts["met"] or 0) <= (counts["points"] or 0)


def _with_states(ends: DataFrame, states: DataFrame, aircraft: str, tasks: int) -> DataFrame:
    """A row for each flight and state that it can meet: an equality join on the state's number, no range condition."""
    states = states.withColumnRenamed("grid_micros", _TIME)
    rows = repeat(ends, F.col(_LAST) - F.col(_FIRST) + 1, _N).withColumn(_N, F.col(_N) + F.col(_FIRST))
    if tasks > 1:
        rows, states = (side.repartition(tasks, aircraft, _N) for side in (rows, states))
    return rows.join(states, [aircraft, _N])


def _spread(flights: DataFrame, tasks: int) -> DataFrame:
    return flights.repartition(tasks, *flights.columns) if tasks > 1 else flights


def sample_exact(
    flights: DataFrame,
    telemetry: DataFrame,
    step: int,
    values: Sequence[str],
    tie: str | None = None,
    aircraft: str = "ICAO24",
    time: str = "time",
    departure: str = "departure_time",
    arrival: str = "arrival_time",
    kept: Scratch | None = None,
    tasks: int = 1,
) -> DataFrame:
    """The state at each grid time, for telemetry that lies on the grid.

    Each flight meets the states between its ends, by their numbers, and those on its grid are kept. If that made more
    rows than there are grid points, the grid is laid out in full. Either way there is an equality join with
    a key so fine that no aircraft is a hot key. A grid time without telemetry gives no row. ``kept`` as in
    :func:`legtrail.operators.asof.asof`; more than one of ``tasks`` lay out the grid, whatever the sizes of their input.
    """
    kept = kept or Scratch(flights.sparkSession)
    states = one_state_per_time(
        _states(telemetry, aircraft, time, values, tie), [aircraft], "grid_micros", values, tie
    )
    states = _numbered(states, aircraft, kept)
    ends, by_states = _met(flights, states, step, aircraft, departure, arrival, True, kept)
    columns = [aircraft, "grid_micros", *[c for c in flights.columns if c != aircraft], "grid_step", *values]
    if not by_states:
        laid_out = grid(_spread(ends.select(flights.columns), tasks), step, departure, arrival)
        return laid_out.join(states.drop(_N), [aircraft, "grid_micros"]).select(columns)
    micros = step * times.MICROS_PER_SECOND
    since = F.col(_TIME) - F.col(_FROM)
    met = _with_states(ends, states, aircraft, tasks).filter(since % micros == 0)
    return met.withColumns({"grid_step": times.whole_slices(since, micros), "grid_micros": F.col(_TIME)}).select(columns)


def sample_asof(
    flights: DataFrame,
    telemetry: DataFrame,
    step: int,
    values: Sequence[str],
    tie: str | None = None,
    aircraft: str = "ICAO24",
    time: str = "time",
    departure: str = "departure_time",
    arrival: str = "arrival_time",
    kept: Scratch | None = None,
    tasks: int = 1,
) -> DataFrame:
    """The last state at or before each grid time, with its ``state_micros``, for telemetry that is
    not on the grid.

    A grid time before the aircraft's first state gives no row. Each flight meets the states from the last one before
    its departure to its arrival, by their numbers, and the grid is laid out from each state to the next: grid points
    are not sorted or shuffled. If that made more rows than there are grid points, each point is searched for instead.
    ``kept`` and ``tasks`` as in :func:`sample_exact`.
    """
    kept = kept or Scratch(flights.sparkSession)
    states = one_state_per_time(
        _states(telemetry, aircraft, time, values, tie), [aircraft], "grid_micros", values, tie
    )
    states = _numbered(states, aircraft, kept)
    ends, by_states = _met(flights, states, step, aircraft, departure, arrival, False, kept)
    columns = [*flights.columns, "grid_step", "grid_micros", "state_micros", *values]
    if not by_states:
        found = asof(
            grid(_spread(ends.select(flights.columns), tasks), step, departure, arrival),
            states.drop(_N),
            key=[aircraft],
            time="grid_micros",
            state_time="grid_micros",
            values=values,
            found_time="state_micros",
            kept=kept,
        )
        return found.filter(F.col("state_micros").isNotNull()).select(columns)
    micros = step * times.MICROS_PER_SECOND
    following = states.select(aircraft, (F.col(_N) - 1).alias(_N), F.col("grid_micros").alias(_NEXT))
    met = _with_states(ends, states.join(following, [aircraft, _N], "left"), aircraft, tasks)
    since = F.greatest(F.col(_TIME) - F.col(_FROM), F.lit(0).cast("bigint"))
    until = F.least(F.coalesce(F.col(_NEXT) - F.col(_FROM) - 1, F.col(_SPAN)), F.col(_SPAN))
    begin, end = times.whole_slices(since + (micros - 1), micros), times.whole_slices(until, micros)
    laid_out = repeat(met.withColumn("_begin", begin), end - F.col("_begin") + 1, "grid_step")
    laid_out = laid_out.withColumn("grid_step", F.col("grid_step") + F.col("_begin"))
    return laid_out.withColumns(
        {"grid_micros": F.col(_FROM) + F.col("grid_step") * micros, "state_micros": F.col(_TIME)}
    ).select(columns)
