"""What the operators share: reading tables, walking Arrow batches, sampling labels."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from legtrail.session import Scratch

#: Rows of a batch that are turned into Python objects at a time.
ROWS_AT_ONCE = 256


#: Characters of text that a worker's cache holds as keys; beyond them it starts anew.
KEPT_CHARACTERS = 5_000_000


class Kept(dict):
    """Values by text, made when first asked for; bounded by the length of the texts, not by their number."""

    def __init__(self):
        super().__init__()
        self.characters = 0

    def made(self, text: str):
        raise NotImplementedError

    def __missing__(self, text: str):
        self.characters += len(text)
        if self.characters > KEPT_CHARACTERS:
            self.clear()
            self.characters = len(text)
        found = self[text] = self.made(text)
        return found


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """The text of each document as ``_text`` (null: empty), after the columns asked for."""
    return docs.select(*columns, F.coalesce(F.col("text"), F.lit("")).alias("_text"))


def pieces(batches) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that only few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def pieces_of_size(batches, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Batches whose texts in ``column`` have about ``size`` bytes together, more only for a single long one."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths) // size
        starts = np.append(0, np.flatnonzero(part[1:] != part[:-1]) + 1) if len(part) else []
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(int(start), int(end - start))


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key's text, modulo ``divisor``; null for a null key."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(divisor))


def smallest_hashes(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """At most ``bound`` rows, those whose key has the smallest hashes.

    Rows are counted first and those far beyond the bound left out by their hash, so that what is put in order is a small
    multiple of the bound, however many partitions there are.
    """
    share = min(1.0, (2 * bound + 1000) / max(1, rows.count()))
    hashed = F.xxhash64(key)
    if share < 1:
        rows = rows.filter(hashed < F.lit(int(-(2**63) + share * 2**64)))
    return rows.orderBy(hashed, key).limit(bound)


#: Bits of an increasing id below those of its partition.
PLACE_BITS = 33


def numbered(rows: DataFrame, kept: Scratch, name: str, first: int = 0) -> tuple[DataFrame, int]:
    """``rows`` with the column ``name``, numbers from ``first`` without gaps in their present order, and how many there are.

    The rows are written down with their place in their partition; only one row per partition goes through a running sum.
    """
    placed = kept.staged(rows.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", PLACE_BITS)
    lengths = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + first
    begins = kept.staged(lengths.select("_part", "_n", before.alias("_before")), f"{name}-parts")
    count = begins.agg(F.sum("_n")).first()[0] or 0
    place = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + F.col("_before")
    full = placed.withColumn("_part", part).join(F.broadcast(begins), "_part")  # as many rows as partitions
    return full.select(*rows.columns, place.alias(name)), count


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, bound: int) -> DataFrame:
    """(doc_id, _text, _label) of at most ``bound`` labelled documents for which ``keep`` holds.

    The documents with the smallest hash of their id are taken; ids without exactly one label value and null
    labels are left out. The ids are bounded, so they may be broadcast.
    """
    chosen = (
        labels.select("doc_id", F.col(label).alias("_label"))
        .filter(F.col("doc_id").isNotNull() & F.col("_label").isNotNull() & keep)
        .groupBy("doc_id")
        .agg(F.min("_label").alias("_label"), F.max("_label").alias("_other"))
        .filter("_label = _other")
        .drop("_other")
    )
    chosen = smallest_hashes(chosen, "doc_id", bound)
    return texts_of(docs, "doc_id").join(F.broadcast(chosen), "doc_id")
