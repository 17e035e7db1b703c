"""Nearest earlier or later state of a key at given times.

Times are whole numbers of any unit, such as :func:`legtrail.functions.times.epoch_micros`.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from legtrail.session import Scratch, staged

_STATE = "_state"
#: Bits of an increasing id below those of its partition.
PLACE_BITS = 33


def one_state_per_time(
    states: DataFrame,
    key: Sequence[str],
    time: str,
    values: Sequence[str],
    tie: str | None = None,
) -> DataFrame:
    """States reduced to one per key and time: the one with the greatest ``tie`` (nulls lowest), of equal ones the one
    with the greatest values. A state stays whole, nulls included. Reduced before the shuffle."""
    if not values:
        return states.select(*key, time).distinct()
    whole = F.struct(*([F.col(tie).alias("_tie")] if tie else []), *values)
    one = states.groupBy(*key, time).agg(F.max(whole).alias("_v"))
    return one.select(*key, time, *[F.col(f"_v.{value}").alias(value) for value in values])


def asof(
    probes: DataFrame,
    states: DataFrame,
    key: Sequence[str],
    time: str,
    state_time: str,
    values: Sequence[str] = (),
    tie: str | None = None,
    later: bool = False,
    found_time: str = "found_time",
    kept: Scratch | None = None,
) -> DataFrame:
    """Each probe row with the last state of its key at or before its time (``later``: the first
    at or after). Adds ``found_time`` and ``values``, null if there is no such state. A null key is
    no key: such states match nothing, and such probes find nothing. Of states of one time that with the
    greatest ``tie`` counts (nulls lowest), then that with the greatest values; a state stays whole.

    States and probes are sorted together by ranges of key and time, so that a hot key, day or minute
    lies in many partitions, copies too. The sorted rows are written down with their place; each
    partition starts from the last state of the partitions before it, for which one row per key and
    partition is looked at. They go to ``kept``, which is to be removed after the result was read, or else to a
    folder of their own.
    """
    toward = F.desc if later else F.asc
    state = F.struct(F.col(state_time).alias(found_time), *values)
    rank = F.struct(*([F.col(tie).alias("_tie")] if tie else []), *values, F.lit(0).alias("_same"))
    known = states.dropna(subset=list(key)).select(
        *key, F.col(state_time).alias("_time"), state.alias(_STATE), rank.alias("_rank"), F.lit(1).alias("_kind")
    )
    together = probes.withColumns({"_time": F.col(time), "_kind": F.lit(2)}).unionByName(
        known, allowMissingColumns=True
    )
    order = [*key, toward("_time"), "_kind", F.asc_nulls_first("_rank")]
    ranged = together.withColumn("_salt", F.rand(7)).repartitionByRange(*order, "_salt")
    placed = ranged.sortWithinPartitions(*order).drop("_rank", "_time", "_salt")
    write = kept.staged if kept else staged
    placed = write(placed.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("_part", F.shiftright("_at", PLACE_BITS))

    earlier = W.partitionBy(*key).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    last_of_part = F.max_by(_STATE, F.when(F.col("_kind") == 1, F.col("_at")))
    carried = (
        placed.groupBy(*key, "_part")
        .agg(last_of_part.alias(_STATE))
        .withColumn(_STATE, F.last(_STATE, ignorenulls=True).over(earlier))
        .filter(F.col(_STATE).isNotNull())
        .withColumns({"_kind": F.lit(0), "_at": F.lit(-1).cast("bigint")})
    )
    so_far = W.partitionBy(*key, "_part").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    return (
        placed.unionByName(carried, allowMissingColumns=True)
        .withColumn("_found", F.last(_STATE, ignorenulls=True).over(so_far))
        .filter("_kind = 2")
        .select(*probes.columns, *[F.col(f"_found.{name}").alias(name) for name in (found_time, *values)])
    )
