from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from legtrail.sources import store

SCHEMA = "d date, k string, v int"
FIELDS = StructType(
    [StructField("d", DateType()), StructField("k", StringType()), StructField("v", IntegerType())]
)
D1, D2, D3 = date(2022, 11, 1), date(2022, 11, 2), date(2022, 11, 3)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA).withColumn("day", F.col("d"))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_keep_larger_day_by_day(spark, tmp_path, rows, fmt):
    path = str(tmp_path / "s")
    old = frame(spark, (D1, "old", 1), (D1, "old", 2), (D2, "old", 1), (D2, "old", 2))
    store.write_partitions(old, path, fmt=fmt)
    # D1: a tie keeps the old rows; D2: more rows win; D3: nothing stored yet.
    new = frame(
        spark, (D1, "new", 1), (D1, "new", 2), (D2, "new", 1), (D2, "new", 2), (D2, "new", 3), (D3, "new", 1)
    )
    decision = store.upsert_larger(new, path, fmt=fmt)
    assert rows(decision, "day", "n_new", "n_old", "replaced") == [
        (D1, 2, 2, False), (D2, 3, 2, True), (D3, 1, 0, True)
    ]
    once = rows(store.read_partitions(spark, path, FIELDS, fmt=fmt))
    assert Counter((d, k) for d, k, _, day in once) == {(D1, "old"): 2, (D2, "new"): 3, (D3, "new"): 1}
    assert all(d == day for d, _, _, day in once)

    again = store.upsert_larger(new, path, fmt=fmt)
    assert not again.filter("replaced").count()
    assert rows(store.read_partitions(spark, path, FIELDS, fmt=fmt)) == once


def test_first_write_and_null_day(spark, tmp_path, rows):
    path = str(tmp_path / "s")
    new = frame(spark, (D1, "a", 1), (None, "b", 2))
    assert store.read_partitions(spark, path, FIELDS).isEmpty()
    store.upsert_larger(new, path)
    assert rows(store.read_partitions(spark, path, FIELDS), "day", "k") == [(None, "b"), (D1, "a")]
    decision = store.upsert_larger(frame(spark, (None, "c", 1), (None, "c", 2)), path)
    assert rows(decision, "day", "n_new", "n_old", "replaced") == [(None, 2, 1, True)]
    assert rows(store.read_partitions(spark, path, FIELDS), "day", "k") == [
        (None, "c"), (None, "c"), (D1, "a")
    ]


def test_empty_incoming_changes_nothing(spark, tmp_path, rows):
    path = str(tmp_path / "s")
    store.write_partitions(frame(spark, (D1, "a", 1)), path)
    assert store.upsert_larger(frame(spark), path).isEmpty()
    assert rows(store.read_partitions(spark, path, FIELDS), "k") == [("a",)]


def test_day_filter_prunes_folders(spark, tmp_path, plan):
    path = str(tmp_path / "s")
    store.write_partitions(frame(spark, (D1, "a", 1), (D2, "b", 2)), path)
    text = plan(store.read_partitions(spark, path, FIELDS).filter(F.col("day") >= D2).select("k"))
    assert "PartitionFilters: [isnotnull(day" in text and "ReadSchema: struct<k:string>" in text


def test_a_day_with_most_rows_is_split_over_files(spark, tmp_path):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200kb")
    try:
        hot = spark.range(400_000).select(
            F.when(F.col("id") % 3 < 2, F.lit(D1)).otherwise(F.date_add(F.lit(D1), (F.col("id") % 50).cast("int"))).alias("d"),
            F.sha2(F.col("id").cast("string"), 256).alias("k"),
            F.col("id").cast("int").alias("v"),
        ).repartition(8)
        store.write_partitions(hot.withColumn("day", F.col("d")), str(tmp_path / "s"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = list((tmp_path / "s" / "day=2022-11-01").glob("*.parquet"))
    assert len(files) > 3
    assert spark.read.parquet(str(tmp_path / "s")).count() == 400_000


def test_compaction_keeps_rows_and_order(spark, tmp_path, rows):
    df = spark.range(5000).select(
        F.when(F.col("id") % 7 > 0, F.date_add(F.lit(D1), (F.col("id") % 3).cast("int"))).alias("d"),
        F.format_string("%05d", (F.col("id") * 7919) % 5000).alias("k"),
        F.lit(1).alias("v"),
    )
    path = str(tmp_path / "all")
    store.compact(df, path, ["d", "k"])
    got = store.with_position(spark, path)
    by_position = sorted(got.collect(), key=lambda row: row.position)
    assert [row.position for row in by_position] == list(range(1, 5001))
    expected = sorted(df.collect(), key=lambda row: (row.d is None, row.d or D1, row.k))
    assert [(row.d, row.k) for row in by_position] == [(row.d, row.k) for row in expected]


def test_compaction_of_repeated_rows_to_csv(spark, tmp_path):
    df = frame(spark, (D1, "a", 1), (D1, "a", 1), (None, "b", 2)).drop("day")
    store.compact(df, str(tmp_path / "all"), ["d", "k"], fmt="csv")
    lines = [
        line
        for part in sorted((tmp_path / "all").glob("part-*.csv"))
        for line in part.read_text().splitlines()[1:]
    ]
    assert lines == ["2022-11-01,a,1", "2022-11-01,a,1", "NA,b,2"]


def test_family_and_day(spark, tmp_path, rows):
    path, by = str(tmp_path / "s"), ["family", "day"]
    old = frame(spark, (D1, "old", 1), (D1, "old", 2)).withColumn("family", F.lit("a"))
    store.write_partitions(old, path, by)
    new = frame(spark, (D1, "new", 1)).withColumn("family", F.explode(F.array(F.lit("a"), F.lit("b"))))
    store.upsert_larger(new, path, by)
    got = store.read_partitions(spark, path, FIELDS, by)
    assert rows(got, "family", "k") == [("a", "old"), ("a", "old"), ("b", "new")]


def test_csv_store_is_read_by_name(spark, tmp_path, rows):
    path = str(tmp_path / "s")
    first = spark.createDataFrame([("a", "1", date(2024, 1, 1))], "k string, v string, day date")
    second = spark.createDataFrame([("2", "b", date(2024, 1, 2))], "v string, k string, day date")
    store.upsert_larger(first, path, fmt="csv")
    store.upsert_larger(second, path, fmt="csv")
    back = store.read_partitions(spark, path, first.drop("day").schema, fmt="csv")
    assert rows(back, "k", "v") == [("a", "1"), ("b", "2")]
    other = spark.createDataFrame([], "v string, z string").schema
    with pytest.raises(Exception, match="(?i)header"):
        store.read_partitions(spark, path, other, fmt="csv").collect()


def test_upsert_counts_only_incoming_days(spark, tmp_path):
    path = str(tmp_path / "s")
    days = spark.createDataFrame([(i, date(2024, 1, i)) for i in range(1, 9)], "n int, day date")
    store.write_partitions(days, path)
    for folder in (tmp_path / "s").glob("day=2024-01-0[1-4]"):
        for file in folder.glob("*.parquet"):
            file.write_bytes(b"unreadable")
    found = store.upsert_larger(days.filter("n = 6").unionByName(days.filter("n = 6")), path).collect()
    assert [(r.n_new, r.n_old, r.replaced) for r in found] == [(2, 1, True)]


def blanked(folder):
    """Zeroes in place of all column chunks of the Parquet files in a folder; their footers stay."""
    for file in folder.rglob("*.parquet"):
        data = file.read_bytes()
        footer = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
        file.write_bytes(data[:4] + bytes(footer - 4) + data[footer:])
    for file in folder.rglob(".*.crc"):
        file.unlink()


def counted(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("weight", [None, "copies"])
def test_counts_come_from_footers(spark, tmp_path, plan, weight):
    rows = spark.range(3000).selectExpr(
        "id", "1L as copies", "if(id % 7 = 0, null, date'2024-01-01' + cast(id % 5 as int)) as day", "concat('f', id % 2) as family"
    )
    path, by = str(tmp_path / "out"), ["family", "day"]
    store.write_partitions(rows, path, by)
    expected = counted(store.row_counts(rows, by, weight))
    schema = rows.drop(*by).schema
    got = store.stored_counts(spark, path, schema, by, weight=weight)
    assert "PushedAggregation: [COUNT(*)" in plan(got) and counted(got) == expected
    blanked(tmp_path / "out")
    with pytest.raises(Exception):
        store.read_partitions(spark, path, schema, by).agg({"id": "sum"}).collect()
    assert counted(store.stored_counts(spark, path, schema, by, weight=weight)) == expected
    some = store.stored_counts(spark, path, schema, by, where=store.F.col("day") == store.F.lit("2024-01-02").cast("date"))
    assert "PartitionFilters: [isnotnull(day" in plan(some) and len(counted(some)) == 2


def test_only_folders_with_copies_are_read(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "if(id % 10 = 3, id, 1) as copies", "date'2024-01-01' + cast(id % 10 as int) as day")
    path = str(tmp_path / "out")
    store.write_partitions(rows, path)
    expected = counted(store.row_counts(rows, ["day"], "copies"))
    for folder in (tmp_path / "out").glob("day=*"):
        if folder.name != "day=2024-01-04":
            blanked(folder)
    assert counted(store.stored_counts(spark, path, rows.drop("day").schema, weight="copies")) == expected
    nothing = store.stored_counts(spark, str(tmp_path / "none"), rows.drop("day").schema, weight="copies")
    assert nothing.collect() == [] and nothing.columns == ["day", "n"]


def ranged(spark, n, shift=0):
    """Rows with a total order that begins with a time, and the day they are stored by (a day after for some)."""
    return spark.range(n).selectExpr(
        f"if(id % 11 = 0, null, timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id % 97 as int))) as t",
        f"id + {shift} as k", "date'2024-01-01' + cast(id % 97 div 24 + id % 2 as int) as stored_day",
    )


def test_changed_days_are_merged_into_the_ranges_they_touch(spark, tmp_path, rows):
    """Positions are those of a full run; files of other ranges are not touched; emptied ranges are gone."""
    F = store.F
    path, order = str(tmp_path / "merged"), ["t", "k"]
    old = ranged(spark, 800)
    store.compact_ranges(old, path, order)
    assert rows(store.with_position(spark, path)) == rows(with_plain_position(spark, old))
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "merged").rglob("*.parquet")}
    day = F.lit("2024-01-02").cast("date")
    new = ranged(spark, 300, 10_000).filter(F.col("stored_day") == day)
    touched = store.merge_ranges(new, path, order, F.col("stored_day") == day)
    assert [str(d) for d in touched] == ["2024-01-01", "2024-01-02", "None"]
    now = old.filter(F.col("stored_day") != day).unionByName(new)
    assert rows(store.with_position(spark, path)) == rows(with_plain_position(spark, now))
    kept = {f for f in files if f.exists() and f.stat().st_mtime_ns == files[f]}
    assert {f.parent.name for f in files} - {f.parent.name for f in kept} == {"range=2024-01-01", "range=2024-01-02", "range=__HIVE_DEFAULT_PARTITION__"}
    last = F.col("t") >= F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    assert [str(d) for d in store.merge_ranges(new.limit(0), path, order, last)] == ["2024-01-05"]
    assert not (tmp_path / "merged" / "range=2024-01-05").exists()
    assert rows(store.with_position(spark, path)) == rows(with_plain_position(spark, now.filter(F.coalesce(~last, F.lit(True)))))
    assert store.merge_ranges(new.limit(0), path, order, F.lit(False)) == []
    assert store.drop_ranges(spark, path, lambda date: date is None or date > "2024-01-03") == [f"range=2024-01-0{i}" for i in (1, 2, 3)]


def with_plain_position(spark, df):
    order = store.W.orderBy(store.F.asc_nulls_last("t"), store.F.asc_nulls_last("k"))
    return df.withColumn("position", store.F.row_number().over(order).cast("bigint"))
