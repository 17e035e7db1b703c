from legtrail.functions.rows import BLOCK, repeat
from pyspark.sql import functions as F


def test_repeat_over_block_edges(spark, rows):
    df = spark.createDataFrame([(n,) for n in (0, 1, BLOCK, BLOCK + 1, 3 * BLOCK - 1)] + [(None,)], "n int")
    got = repeat(df, F.col("n"), "at").groupBy("n").agg(F.count("*"), F.min("at"), F.max("at"), F.count_distinct("at"))
    assert rows(got) == [(n, n, 0, n - 1, n) for n in (1, BLOCK, BLOCK + 1, 3 * BLOCK - 1)]
