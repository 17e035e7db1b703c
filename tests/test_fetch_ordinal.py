from collections import Counter

from pyspark.sql import functions as F

from catalog import joins


def test_lists_of_a_hot_aircraft_are_cut_into_blocks(spark, monkeypatch):
    legs = spark.range(25).select(
        F.col("id").alias("leg_id"),
        F.when(F.col("id") < 20, F.lit("hot")).when(F.col("id") < 23, F.lit("cold")).alias("ICAO24"),
        F.col("id").cast("string").alias("call_sign"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("departure_time"),
        F.lit(None).cast("timestamp_ntz").alias("arrival_time"),
        F.lit("A").alias("origin_airport"),
        F.lit("B").alias("destination_airport"),
    )
    lengths = []
    flatten = joins.nested.flatten_lists

    def watched(lists, column, *args, **more):
        lengths.extend(row[0] for row in lists.select(F.size(column)).collect())
        return flatten(lists, column, *args, **more)

    monkeypatch.setattr(joins, "BLOCK", 8, raising=False)
    monkeypatch.setattr(joins.nested, "flatten_lists", watched)
    monkeypatch.setattr(joins.adapters, "legs", lambda spark, sf_dir: legs)
    rows = joins.fetch_ordinal(spark, "").collect()
    assert Counter(lengths) == Counter([8, 8, 4, 3, 2])
    first = {"hot": 0, "cold": 20, None: 23}
    assert len(rows) == 25 and all(row.idx == int(row.call_sign) - first[row.ICAO24] + 1 for row in rows)
