"""Row numbers within a group that may hold most of the table."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from legtrail.operators.asof import PLACE_BITS
from legtrail.session import Scratch, staged


def with_ordinal(
    rows: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    name: str = "idx",
    kept: Scratch | None = None,
) -> DataFrame:
    """Number rows from 1 within ``by`` in the order of ``order``, nulls last.

    One sort over all groups by ranges, so a large group lies in as many partitions as its rows need,
    copies of one row included. The sorted rows are written down with their place; a row's number is its
    place within its partition's part of the group, plus the lengths of the parts before. Only one row per group
    and partition goes through a running sum. The written rows go to ``kept``, which is to be removed after the result
    was read, or else to a folder of their own.
    """
    columns = rows.columns
    keys = [F.asc_nulls_last(column) for column in (*by, *order)]
    salted = rows.withColumn("_salt", F.rand(7))
    ranged = salted.repartitionByRange(*keys, "_salt").sortWithinPartitions(*keys)
    write = kept.staged if kept else staged
    placed = write(ranged.select(*columns, F.monotonically_increasing_id().alias("_at")), "ordered")
    part = F.shiftright("_at", PLACE_BITS).alias("_part")
    earlier = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = (
        placed.groupBy(*by, part)
        .agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
        .select(
            *[F.col(column).alias(f"_by_{column}") for column in by],
            "_part",
            (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        )
    )
    same = [F.col(column).eqNullSafe(F.col(f"_by_{column}")) for column in by]
    here = F.shiftright("_at", PLACE_BITS) == F.col("_part")
    return placed.join(parts, reduce(Column.__and__, same, here)).select(
        *columns, (F.col("_at") + F.col("_shift")).alias(name)
    )
