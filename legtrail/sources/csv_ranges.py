"""Large CSV files, quoted line breaks included, read by ranges of bytes in parallel.

Whether a line break ends a record depends on all quotes before it. Spark cuts a file in blocks at line breaks; each
block is cut in parts of a bounded number of lines, the lines of a part with an odd number of quotes are counted, and a
running sum over parts, one row each, tells how many such lines lie before a part. From there every line knows how many lie
before it: if the number is odd, the line goes on with a record; a record that spans lines begins with an odd line after
an even number of them and ends with the next odd line. Only lines of parts that hold odd lines, or begin inside a record,
are put in order, a part at a time, however large a block is; only records that span lines are put together. Records are then
parsed by Spark's own CSV parser.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import StructType

from legtrail.session import staged

_QUOTE = '"'
#: Lines that are put in order at a time.
LINES_PER_PART = 1 << 15
#: Characters of text that one task puts in order, more only by chance, and what a line counts besides its own.
TEXT_PER_TASK = 64 << 20
TEXT_OF_A_LINE = 64
#: Bits of an increasing id below those of its partition.
PLACE_BITS = 33


def _block_by_block(spark: SparkSession) -> SparkSession:
    """A session that cuts files alike whatever others are read with them, and gives each block a task of its own."""
    apart = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            apart.conf.set(name, value)
    apart.conf.set("spark.sql.files.openCostInBytes", apart.conf.get("spark.sql.files.maxPartitionBytes"))
    return apart


def _lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(file, block, part, at, value, odd): all lines; ``at`` grows with the place of a line within its block, ``part`` is
    made from that place."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(_QUOTE), F.lit("")))
    at = F.monotonically_increasing_id()
    lines = _block_by_block(spark).read.option("lineSep", "\n").text(list(files)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        at.alias("at"),
        "value",
        (quotes % 2 == 1).alias("odd"),
    )
    place = F.col("at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return lines.withColumn("part", F.floor(place / LINES_PER_PART))


def _blocks(lines: DataFrame) -> DataFrame:
    """(file, block, part, length, n_odd, n_before, crlf): characters and odd lines in each part of a block, and odd lines in
    what lies before it in its file; whether the first line of the file ends in a carriage return."""
    counts = lines.groupBy("file", "block", "part").agg(
        F.sum(F.length("value") + TEXT_OF_A_LINE).alias("length"),
        F.count_if("odd").alias("n_odd"),
        F.min_by(F.col("value").endswith("\r"), "at").alias("crlf"),
    )
    in_file = W.partitionBy("file").orderBy("block", "part")
    earlier = in_file.rowsBetween(W.unboundedPreceding, -1)
    return counts.select(
        "file",
        "block",
        "part",
        "length",
        "n_odd",
        F.coalesce(F.sum("n_odd").over(earlier), F.lit(0)).alias("n_before"),
        F.first("crlf").over(in_file).alias("crlf"),
    )


def _records(lines: DataFrame, blocks: DataFrame, tasks: int) -> DataFrame:
    """(value) of every record but the first of each file, which is its header; blank lines between records are none.

    ``file`` is best a number here, as it goes through two shuffles with each line. What tasks hold is set by their
    number ``tasks``: sizes of shuffled rows say little, as lines and their places compress well.
    """
    part = ["file", "block", "part"]
    placed = lines.join(blocks, part)
    begins = (F.col("block") == 0) & (F.col("part") == 0)
    calm = (F.col("n_odd") == 0) & (F.col("n_before") % 2 == 0) & ~begins
    in_part = W.partitionBy(part).orderBy("at")
    before = F.col("n_before") + F.coalesce(
        F.sum(F.col("odd").cast("bigint")).over(in_part.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    dealt = placed.filter(~calm).select(*part, "at", "value", "odd", "n_before", "crlf").repartition(tasks, *part)
    ordered = dealt.withColumns({"before": before, "place": F.row_number().over(in_part)})
    ordered = ordered.filter(~(begins & (F.col("place") == 1)))
    # Pairs of odd lines are numbered within their file.
    number = F.when(F.col("before") % 2 == 1, (F.col("before") - 1) / 2).when(F.col("odd"), F.col("before") / 2)
    ordered = ordered.withColumn("record", number.cast("bigint"))
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    spanning = (
        ordered.filter(F.col("record").isNotNull())
        .select("file", "record", "crlf", "block", "at", "value")
        .repartition(tasks, "file", "record")
        .groupBy("file", "record", "crlf")
        .agg(F.array_join(F.transform(parts, lambda part: part["value"]), "\n").alias("value"))
        # as Spark's reader does in files whose lines end so
        .withColumn("value", F.when(F.col("crlf"), F.replace("value", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("value")))
    )
    single = placed.filter(calm).select("value").unionAll(ordered.filter(F.col("record").isNull()).select("value"))
    return single.filter(F.trim(F.regexp_replace("value", "\r$", "")) != "").unionAll(spanning.select("value"))


def _parsed(records: DataFrame, schema: StructType, options: Mapping) -> DataFrame:
    kinds = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    texts = {name: str(value).lower() if isinstance(value, bool) else str(value) for name, value in options.items()}
    row = F.from_csv(F.regexp_replace("value", "\r$", ""), kinds, {**texts, "header": "false"})
    return records.select(row.alias("_row")).select("_row.*")


def scan_ranges(
    spark: SparkSession, files: Sequence[str], schema: StructType, options: Mapping
) -> DataFrame:
    """Typed rows of files with the header of ``schema``, in its order; the first line of a file is left out.

    The text is read once to count, files with odd lines once more for their records. Files without a line break in
    quotes are read by Spark's reader, which cuts them at any line; so are, in one task each, files that Spark
    cannot cut (compressed ones) and files whose quotes do not come in pairs. Quotes within a text must be doubled, as
    this package writes them. What comes to the driver is a row for each of the files.
    """
    lines = _lines(spark, files)
    blocks = staged(_blocks(lines), "csv-blocks")
    totals = blocks.groupBy("file").agg(
        F.sum("n_odd").alias("n_odd"), F.sum("length").alias("length"), F.count_distinct("block").alias("n_blocks")
    ).collect()
    whole = sorted(t.file for t in totals if t.n_blocks == 1 or t.n_odd % 2)
    plain = sorted(t.file for t in totals if t.file not in set(whole) and t.n_odd == 0)
    spanned = sorted(t.file for t in totals if t.file not in {*whole, *plain})
    read = lambda names, multi: spark.read.schema(schema).options(**{**options, "multiLine": multi}).csv(names)
    found = [read(names, multi) for names, multi in ((whole, True), (plain, False)) if names]
    if spanned:
        numbers = staged(spark.createDataFrame(list(enumerate(spanned)), "number int, file string"), "csv-files")
        numbered = lambda rows: rows.join(F.broadcast(numbers), "file").drop("file").withColumnRenamed("number", "file")
        tasks = -(-sum(t.length for t in totals if t.file in set(spanned)) // TEXT_PER_TASK)
        records = _records(numbered(_lines(spark, spanned)), numbered(blocks), tasks)
        found.append(_parsed(records, schema, {**options, "multiLine": True}))
    if not found:
        return spark.read.schema(schema).options(**options).csv(list(files))
    return reduce(DataFrame.unionAll, found)
