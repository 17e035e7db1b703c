"""Partitioned stores and consolidated sorted datasets.

A store has one folder per day, or per family and day. Its partition columns are not in the files;
the date a day was taken from stays in them.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from legtrail.session import empty, folder_names, remove, scratch, staged
from legtrail.sources import csv_files

# Partition columns.
DAY = "day"
FAMILY = "family"
RANGE = "range"
#: Most files whose row counts are broadcast, about 100 bytes each.
MAX_BROADCAST_FILES = 200_000
_PARTITION_TYPES = {DAY: DateType(), FAMILY: StringType(), RANGE: DateType()}


def write_partitions(
    df: DataFrame, path: str, by: Sequence[str] = (DAY,), fmt: str = "parquet"
) -> None:
    """Write one folder per value of the columns ``by``, replacing only folders present in ``df``.

    CSV files have their columns in order of name, whatever the order of ``df``, so that all files of a
    store have one header. The rebalance lets AQE split a day that holds most rows over several tasks and files, and put
    small days together. A null day gets a folder of its own.
    """
    if fmt == "csv":
        columns = [*sorted(c for c in df.columns if c not in by), *by]
        writer = csv_files.csv_writer(csv_files.csv_text(df.select(columns)).hint("rebalance", *by))
    else:
        writer = df.hint("rebalance", *by).write.format(fmt)
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).save(path)


def read_partitions(
    spark: SparkSession,
    path: str,
    schema: StructType,
    by: Sequence[str] = (DAY,),
    fmt: str = "parquet",
) -> DataFrame:
    """Rows of a store, empty but typed if nothing was written yet; ``schema`` is without ``by``.

    Filters on the partition columns prune folders. A CSV file with another header than that of
    ``schema`` in order of name fails the read, it is never taken by position.
    """
    full = StructType([*schema.fields, *[StructField(c, _PARTITION_TYPES[c]) for c in by]])
    fields = sorted(schema.fields, key=lambda field: field.name) if fmt == "csv" else schema.fields
    reader = spark.read.schema(StructType([*fields, *full.fields[len(schema.fields):]]))
    if fmt == "csv":
        reader = reader.options(**csv_files.READ_OPTIONS, enforceSchema=False)
    try:
        return reader.format(fmt).load(path).select(full.names)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, full)


def row_counts(df: DataFrame, by: Sequence[str] = (DAY,), weight: str | None = None) -> DataFrame:
    """Number of rows ``n`` per partition; with ``weight``, the sum of that column."""
    return df.groupBy(*by).agg((F.sum(weight) if weight else F.count("*")).alias("n"))


def _from_footers(spark: SparkSession) -> SparkSession:
    """A session whose counts per folder come from the footers of Parquet files, without reading a column."""
    apart = spark.newSession()
    apart.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    apart.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return apart


def stored_counts(
    spark: SparkSession,
    path: str,
    schema: StructType,
    by: Sequence[str] = (DAY,),
    fmt: str = "parquet",
    where: Column | None = None,
    weight: str | None = None,
) -> DataFrame:
    """As :func:`row_counts`, of a store's folders for which ``where`` (over ``by``) holds.

    In a Parquet store the numbers of rows come from the files' footers. With ``weight``, of whole numbers from 1 up,
    so does its greatest value; only folders where that is above 1 are read, that column alone.
    """
    footers = fmt == "parquet"
    rows = read_partitions(_from_footers(spark) if footers else spark, path, schema, by, fmt)
    rows = rows if where is None else rows.filter(where)
    if not weight or not footers:
        return row_counts(rows, by, weight)
    counted = rows.groupBy(*by).agg(F.count("*").alias("n"), F.max(weight).alias("_most"))
    several = counted.filter("_most > 1").select(*by).collect()  # a row per folder
    single = counted.filter("_most = 1").select(*by, "n")
    if not several:
        return single
    heavy = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(row[c])) for c in by]) for row in several]
    read = read_partitions(spark, path, schema, by, fmt).filter(reduce(Column.__or__, heavy))
    return row_counts(read, by, weight).unionByName(single)


def keep_larger(n_new, n_old) -> Column:
    """True if new rows replace old ones: strictly more of them; nothing there counts as 0."""
    return F.coalesce(n_new, F.lit(0)) > F.coalesce(n_old, F.lit(0))


def _same(by: Sequence[str], prefix: str) -> Column:
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in by])


def upsert_larger(
    incoming: DataFrame,
    path: str,
    by: Sequence[str] = (DAY,),
    fmt: str = "parquet",
    is_staged: bool = False,
    weight: str | None = None,
    span: tuple | None = None,
) -> DataFrame:
    """Replace each partition of a store for which ``incoming`` has more rows than the store holds.

    Incoming rows are written to the shared folder once (``is_staged``: they already are); from the
    store only counts are read (:func:`stored_counts`), of the days between the first and the last incoming one. ``weight``
    names a column that says how many rows a row stands for; ``span`` is the first and the last incoming day, if they
    are known. The winning partitions are fixed before any is overwritten, so a
    repeated task cannot change its mind, and the store is never source and target of rows at once.
    Gives ``by, n_new, n_old, replaced``, one row per incoming partition.
    """
    spark = incoming.sparkSession
    incoming = incoming if is_staged else staged(incoming, "incoming")
    schema = StructType([field for field in incoming.schema if field.name not in by])
    within = None
    if DAY in by:
        first, last = span or incoming.agg(F.min(DAY), F.max(DAY)).first()
        within = F.col(DAY).between(F.lit(first), F.lit(last)) | F.col(DAY).isNull()
    old = stored_counts(spark, path, schema, by, fmt, within, weight).withColumnsRenamed(
        {"n": "n_old", **{c: f"old_{c}" for c in by}}
    )
    new = row_counts(incoming, by, weight).withColumnRenamed("n", "n_new")
    decision = staged(
        new.join(old, _same(by, "old_"), "left").select(
            *by,
            "n_new",
            F.coalesce("n_old", F.lit(0)).alias("n_old"),
            keep_larger(F.col("n_new"), F.col("n_old")).alias("replaced"),
        ),
        "decision",
    )
    winners = decision.filter("replaced").select(*[F.col(c).alias(f"won_{c}") for c in by])
    write_partitions(incoming.join(winners, _same(by, "won_"), "left_semi"), path, by, fmt)
    return decision


def compact(df: DataFrame, path: str, order: Sequence[str], fmt: str = "parquet") -> None:
    """Write one dataset sorted by ``order``, nulls last, within and across files.

    The sort is a range shuffle: its cost per task does not depend on how many rows share a day,
    as long as ``order`` ends in a column that tells rows apart.
    """
    keys = [F.asc_nulls_last(name) for name in order]
    if fmt == "csv":
        types = {field.name: field for field in df.schema}
        ordered = df.sort(*keys).select(*[csv_files.text_column(types[name]) for name in df.columns])
        csv_files.csv_writer(ordered).mode("overwrite").save(path)
    else:
        df.sort(*keys).write.format(fmt).mode("overwrite").save(path)


def _write_ranges(rows: DataFrame, path: str, order: Sequence[str], mode: str) -> None:
    """Sorted rows in a folder for each date of the first column of ``order``; null dates come last."""
    dated = rows.withColumn(RANGE, F.col(order[0]).cast("date"))
    keys = [F.asc_nulls_last(name) for name in (RANGE, *order)]
    writer = dated.sort(*keys).write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(RANGE).parquet(path)


def compact_ranges(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Write one dataset sorted by ``order``, nulls last, in folders by the date of its first column.

    As :func:`compact`, but :func:`merge_ranges` can later change some of it and leave the rest as it is.
    """
    _write_ranges(df, path, order, "static")


def merge_ranges(new: DataFrame, path: str, order: Sequence[str], superseded: Column) -> list:
    """Put rows into a dataset of :func:`compact_ranges`, in place of its ``superseded`` rows.

    Only the folders that hold a superseded row, or get a new one, are read in full and written again; of the
    others the columns that ``superseded`` needs are read, as far as the files' statistics do not rule them out. What
    folders will hold is written down before any is replaced. Gives the dates of the folders written or removed.
    """
    spark = new.sparkSession
    old = read_partitions(spark, path, new.schema, (RANGE,))
    gone = F.coalesce(superseded, F.lit(False))
    dated = new.withColumn(RANGE, F.col(order[0]).cast("date"))
    touched = [row[RANGE] for row in old.filter(gone).select(RANGE).unionAll(dated.select(RANGE)).distinct().collect()]
    if not touched:
        return []
    dates = [date for date in touched if date is not None]
    in_touched = F.col(RANGE).isin(dates) if dates else F.lit(False)
    in_touched = in_touched | F.col(RANGE).isNull() if len(dates) < len(touched) else in_touched
    with scratch(spark) as kept:
        rows = kept.staged(old.filter(in_touched & ~gone).unionByName(dated), "merged")
        filled = {row[RANGE] for row in rows.select(RANGE).distinct().collect()}
        _write_ranges(rows.drop(RANGE), path, order, "dynamic")
    for date in set(touched) - filled:
        remove(spark, f"{path}/{RANGE}={date or '__HIVE_DEFAULT_PARTITION__'}")
    return sorted(touched, key=lambda date: (date is None, date or 0))


def drop_ranges(spark: SparkSession, path: str, keep) -> list[str]:
    """Remove the folders for whose date (ISO text, ``None`` for null) ``keep`` is false; gives their names."""
    mark = f"{RANGE}="
    dropped = []
    for name in folder_names(spark, path):
        text = name.removeprefix(mark)
        if name.startswith(mark) and not keep(None if text == "__HIVE_DEFAULT_PARTITION__" else text):
            remove(spark, f"{path}/{name}")
            dropped.append(name)
    return dropped


def with_position(spark: SparkSession, path: str, name: str = "position") -> DataFrame:
    """Rows of a compacted Parquet dataset with their 1-based position in it, of :func:`compact` or :func:`compact_ranges`.

    The position is the row's place in its file plus the lengths of the files before it; only one
    row per file goes through the running sum, and is broadcast if the files are not too many.
    """
    dataset = spark.read.parquet(path)
    ranged = [F.asc_nulls_last(RANGE)] if RANGE in dataset.columns else []
    rows = dataset.select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    number = lambda pattern: F.regexp_extract("_file", pattern, 1).cast("int")
    in_order = W.orderBy(*ranged, number(r"^part-(\d+)"), number(r"[-.]c(\d+)")).rowsBetween(
        W.unboundedPreceding, -1
    )
    parts = [RANGE, "_file"] if ranged else ["_file"]
    before = (
        rows.groupBy(*parts)
        .agg(F.count("*").alias("_n"))
        .select(
            *[F.col(part).alias(f"_of{part}") for part in parts],
            F.coalesce(F.sum("_n").over(in_order), F.lit(0)).alias("_before"),
        )
    )
    if len(dataset.inputFiles()) <= MAX_BROADCAST_FILES:
        before = F.broadcast(before)
    # One write may name its files alike in several folders.
    same = [F.col(part).eqNullSafe(F.col(f"_of{part}")) for part in parts]
    return rows.join(before, reduce(Column.__and__, same)).select(
        *[c for c in rows.columns if c not in ("_file", "_row", RANGE)],
        (F.col("_before") + F.col("_row") + 1).alias(name),
    )
