"""Rows made from rows."""

from pyspark.sql import Column, DataFrame, functions as F

from legtrail.functions.times import whole_slices

#: Most rows made from one array.
BLOCK = 1024


def repeat(df: DataFrame, times: Column, name: str) -> DataFrame:
    """Each row ``times`` times, numbered from 0 in ``name``; not at all if zero or null.

    Laid out in blocks, so that no array grows with the number of repeats.
    """
    first = F.col("_block") * BLOCK
    return (
        df.withColumn("_times", times.cast("bigint"))
        .filter("_times > 0")
        .withColumn(
            "_block",
            F.explode(F.sequence(F.lit(0).cast("bigint"), whole_slices(F.col("_times") - 1, BLOCK))),
        )
        .withColumn(
            name, F.explode(F.sequence(first, F.least(F.col("_times"), first + BLOCK) - 1))
        )
        .drop("_times", "_block")
    )
