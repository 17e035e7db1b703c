"""Typed CSV whose header order and column set differ from file to file."""

import re
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    FloatType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from legtrail.session import empty
from legtrail.sources import csv_ranges

# Null text and instant format of the CSV files.
NULL_TEXT = "NA"
INSTANT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]'Z'"
DATE_FORMAT = "yyyy-MM-dd"

READ_OPTIONS = {
    "header": True,
    "nullValue": NULL_TEXT,
    "escape": '"',
    "multiLine": True,  # a quoted text may hold line breaks; files too large for one task go to csv_ranges
    "timestampNTZFormat": INSTANT_FORMAT,
    "dateFormat": DATE_FORMAT,
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
}

FILE_PATH = "_metadata.file_path"
FILE_SIZE = "_metadata.file_size"

#: Files up to this size are read whole for their first line, many of them by one task.
SMALL_FILE = 256 << 10
#: Larger files whose first lines one job reads.
FILES_AT_ONCE = 200
_UNITS = {"": 0, "b": 0, "k": 10, "kb": 10, "m": 20, "mb": 20, "g": 30, "gb": 30}


def split_size(spark: SparkSession) -> int:
    """Bytes of a file that Spark gives to one task."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]*)", text).groups()
    return int(number) << _UNITS[unit]


def _named(df: DataFrame, name_regex: str | None, part: str) -> DataFrame:
    """Keep rows of files whose name (or whose folder's name) matches; prunes the file list."""
    if name_regex is None:
        return df
    if part == "file":
        return df.filter(F.col("_metadata.file_name").rlike(name_regex))
    folder = F.substring_index(F.substring_index(FILE_PATH, "/", -2), "/", 1)
    return df.filter(F.substring_index(folder, "=", -1).rlike(name_regex))


def scan_same_header(
    spark: SparkSession,
    path,
    schema: StructType,
    name_regex: str | None = None,
    part: str = "file",
    split_over: int | None = None,
) -> DataFrame:
    """Typed scan of files that all have the header of ``schema``, in its order.

    A file with another header fails the scan instead of being read by position. Files of more than
    ``split_over`` bytes (what Spark gives to one task, if not given) are read by ranges in parallel.
    """
    limit = split_size(spark) if split_over is None else split_over
    large = _first_lines(spark, _larger(spark, path, limit, name_regex, part))
    for row in large:
        if (row.header or []) != schema.names:
            raise ValueError(f"another header in {row.file}: {row.header}")
    return _typed(spark, path, [row.file for row in large], schema, name_regex, part, limit)


def _typed(spark, path, large, schema, name_regex=None, part="file", limit=None) -> DataFrame:
    """Rows of the files at ``path`` up to ``limit`` bytes, and of the ``large`` ones."""
    reader = spark.read.schema(schema).options(**READ_OPTIONS, enforceSchema=False)
    rows = _named(reader.option("recursiveFileLookup", True).csv(path), name_regex, part) if path else None
    if not large:
        return rows
    of_large = csv_ranges.scan_ranges(spark, sorted(large), schema, READ_OPTIONS)
    if rows is None:
        return of_large
    small = rows if limit is None else rows.filter(F.col(FILE_SIZE) <= limit)
    return small.unionAll(of_large)


def _cells(line: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(line, '["\r\ufeff]', ""), ","), lambda cell: F.trim(cell))


def _larger(spark: SparkSession, path, over: int, name_regex: str | None, part: str) -> list:
    """(file, size) of the files of more than ``over`` bytes; none of them is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    large = _named(files.filter(F.col(FILE_SIZE) > over), name_regex, part)
    return sorted(large.select(F.col(FILE_PATH).alias("file"), F.col(FILE_SIZE).alias("size")).collect())


def _first_lines(spark: SparkSession, files: list) -> list:
    """(file, size, header) of files, of each of which only the beginning is read.

    A limit over a file that is one task ends its read after one line; so many files are one job.
    """
    # A session of its own, as how files are cut is a setting of the session.
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.maxPartitionBytes", max([1, *(row["size"] for row in files)]))
    apart.conf.set("spark.sql.files.openCostInBytes", max([1, *(row["size"] for row in files)]))
    found = []
    for start in range(0, len(files), FILES_AT_ONCE):
        lines = [
            apart.read.text(row.file).limit(1).select(F.lit(row.file).alias("file"), F.lit(row["size"]).alias("size"), "value")
            for row in files[start : start + FILES_AT_ONCE]
        ]
        rows = reduce(DataFrame.unionAll, lines)
        found += rows.select("file", "size", _cells(F.col("value")).alias("header")).collect()
    return found


def file_headers(
    spark: SparkSession,
    path,
    anchor: str,
    name_regex: str | None = None,
    part: str = "file",
) -> DataFrame:
    """``(file, size, header)``, one row per non-empty file; header is null if the first line lacks ``anchor``.

    The header is the first line of the file, so whatever the rows hold cannot be taken for one. Small files are
    read whole, many by one task, and one row per file is left within each; of larger ones only the beginning is read
    (at once, their names and headers come to the driver).
    """
    text = spark.read.option("recursiveFileLookup", True).text(path)
    text = _named(text.filter(F.col(FILE_SIZE) <= SMALL_FILE), name_regex, part)
    small = (
        text.select(
            F.col(FILE_PATH).alias("file"),
            F.col(FILE_SIZE).alias("size"),
            F.struct(
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("at"),
                F.col("value").alias("line"),
            ).alias("one"),
        )
        .groupBy("file", "size")
        .agg(F.min("one").alias("one"))
        .select("file", "size", _cells(F.col("one.line")).alias("header"))
    )
    large = _first_lines(spark, _larger(spark, path, SMALL_FILE, name_regex, part))
    found = small.unionAll(spark.createDataFrame([tuple(row) for row in large], small.schema)) if large else small
    return found.select("file", "size", F.when(F.array_contains("header", anchor), F.col("header")).alias("header"))


def scan(
    spark: SparkSession,
    path,
    schema: StructType,
    name_regex: str | None = None,
    part: str = "file",
    anchor: str | None = None,
    split_over: int | None = None,
) -> DataFrame:
    """Union of all files by column name.

    One typed scan per distinct header, not per file. A column a file lacks is null; a column
    beyond ``schema`` comes last, as text. The driver holds the file names, as Spark's own file
    index does, and no rows. Files of more than ``split_over`` bytes (what Spark gives to one task, if not given)
    are read by ranges in parallel.
    """
    limit = split_size(spark) if split_over is None else split_over
    by_header = defaultdict(lambda: ([], []))
    anchor = anchor or schema.names[0]
    for row in file_headers(spark, path, anchor, name_regex, part).collect():
        if row.header is None:
            raise ValueError(f"no header with a column {anchor!r} in {row.file}")
        by_header[tuple(row.header)][row.size > limit].append(row.file)

    known = {field.name: field for field in schema}
    parts = []
    for header, (small, large) in sorted(by_header.items()):
        fields = [known.get(name, StructField(name, StringType())) for name in header]
        part_scan = _typed(spark, sorted(small), large, StructType(fields))
        parts.append(
            part_scan.select(
                *[
                    F.col(name) if name in header else F.lit(None).cast(field.dataType).alias(name)
                    for name, field in known.items()
                ],
                *[name for name in header if name not in known],
            )
        )
    if not parts:
        return empty(spark, schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def text_column(field: StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, TimestampNTZType):
        text = F.concat(F.translate(value.cast("string"), " ", "T"), F.lit("Z"))
    elif isinstance(field.dataType, BooleanType):
        text = F.upper(value.cast("string"))
    elif isinstance(field.dataType, (DoubleType, FloatType)):
        whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
        text = F.when(whole, F.floor(value).cast("string")).otherwise(value.cast("string"))
    else:
        text = value.cast("string")
    return text.alias(field.name)


def csv_text(df: DataFrame) -> DataFrame:
    """Every column as the text it has in the CSV files: UTC ISO instants, TRUE/FALSE, plain numbers."""
    return df.select(*[text_column(field) for field in df.schema])


def csv_writer(df: DataFrame):
    """Writer with the options that go with :func:`csv_text`."""
    return df.write.format("csv").options(
        header=True,
        nullValue=NULL_TEXT,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_csv(df: DataFrame, path: str, folder: Column | None = None) -> None:
    """Add CSV files to ``path``; with ``folder``, into ``folder=<value>`` below it per value.

    All columns stay in the files. The rebalance splits a folder that holds most rows.
    """
    if folder is None:
        csv_writer(csv_text(df)).mode("append").save(path)
        return
    rows = df.withColumn("folder", folder)
    text = csv_text(rows).hint("rebalance", "folder")
    csv_writer(text).mode("append").partitionBy("folder").save(path)
