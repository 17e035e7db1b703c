"""Repeated runs of lines, found by a suffix array over line ids, and deletion of their later copies.

The array is built by prefix doubling: the rank of a suffix by its first 2h lines is the place of the pair (rank of
the suffix by h lines, rank of the suffix h lines further on) among all pairs in order. A line that occurs once
ends every common prefix, so only lines that repeat take part, and a run stops where the next line is such a line or
the document ends. Two suffixes have a common prefix of n lines (lie in one longest-common-prefix interval of
that depth) if their ranks by h = 2^k lines agree at the first and at the last h of the n, 2^k the largest power up to n.

A run counts if it holds ``least_words`` words. It is covered by the shortest runs with that many words that begin or
end at its lines, so doubling stops at the longest of those, however long the copies are.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from legtrail.session import Scratch, scratch, staged

#: Words that a repeated run must hold, so that short lines that meet by chance stay.
LEAST_WORDS = 8


def lines_of(docs: DataFrame) -> DataFrame:
    """(d, t, pos, a, b, words): a row for each line; d and t name the document, a and b its line's text."""
    parts = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    ids = F.transform(
        parts,
        lambda line: F.struct(
            F.xxhash64(line).alias("a"),
            F.xxhash64(F.lit(1), line).alias("b"),
            F.regexp_count(line, F.lit(r"\S+")).alias("words"),
        ),
    )
    named = docs.select(F.col("doc_id").alias("d"), text_hash(docs["text"]).alias("t"), ids.alias("ids"))
    return named.select("d", "t", F.posexplode("ids").alias("pos", "one")).select("d", "t", "pos", "one.*")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def ranked(keys: DataFrame, *columns: str) -> DataFrame:
    """``place`` of each distinct key: a number that grows with the key, without a global count."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keys.repartitionByRange(parts, *columns).sortWithinPartitions(*columns)
    return ordered.select(*columns, F.monotonically_increasing_id().alias("place"))


def repeated_lines(lines: DataFrame, kept: Scratch) -> DataFrame:
    """(d, t, pos, words, rank) of the lines whose text occurs more than once."""
    often = lines.groupBy("a", "b").count().filter("count > 1")
    names = kept.staged(ranked(often.select("a", "b"), "a", "b"), "line-names")
    return lines.join(names, ["a", "b"]).select("d", "t", "pos", "words", F.col("place").alias("rank"))


def in_order(suffixes: DataFrame) -> DataFrame:
    """The rows of each document in order of place, without repeats; ``begins`` marks where a row of lines begins."""
    places = Window.partitionBy("d", "t").orderBy("pos")
    marked = suffixes.withColumn("before", F.lag("pos").over(places))
    marked = marked.filter("before is null or before < pos")
    return marked.withColumn("begins", F.coalesce(F.col("before") < F.col("pos") - 1, F.lit(True))).drop("before")


def doubled(suffixes: DataFrame, h: int, kept: Scratch) -> DataFrame:
    """Ranks by 2h lines from ranks by h lines."""
    stretch = Window.partitionBy("d", "t").orderBy("pos")
    rows = in_order(suffixes).withColumn("stretch", F.sum(F.col("begins").cast("int")).over(stretch))
    ahead = Window.partitionBy("d", "t", "stretch").orderBy("pos").rangeBetween(h, h)
    rows = rows.withColumn("next", F.coalesce(F.max("rank").over(ahead), F.lit(-1).cast("bigint")))
    pairs = kept.staged(rows.select("d", "t", "pos", "words", "rank", "next"), "pairs")
    names = kept.staged(ranked(pairs.select("rank", "next").distinct(), "rank", "next"), "ranks")
    return pairs.join(names, ["rank", "next"]).select("d", "t", "pos", "words", F.col("place").alias("rank"))


def window_batches(batches, least_words: int, span: tuple[int, int] | None):
    """Shortest windows that begin or end at each line, of lengths within ``span`` (from, below).

    Rows come ordered by document and place, with the columns d, t, pos, words, rank, begins.
    """
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        begins = np.flatnonzero(rows["begins"].to_numpy())
        cut = int(begins[-1]) if len(begins) else 0
        rest = rows.slice(cut)
        if cut:
            yield from windows_in(rows.slice(0, cut), least_words, span)
    if rest is not None and rest.num_rows:
        yield from windows_in(rest, least_words, span)


def windows_in(rows: pa.Table, least_words: int, span: tuple[int, int] | None):
    n = rows.num_rows
    words = rows["words"].to_numpy().astype(np.int64)
    rank = rows["rank"].to_numpy()
    begins = rows["begins"].to_numpy().astype(bool)
    begins[0] = True
    starts = np.flatnonzero(begins)
    stretch = np.cumsum(begins) - 1
    first, last = starts[stretch], np.append(starts[1:], n)[stretch] - 1
    after = np.cumsum(words)
    before = after - words
    here = np.arange(n)
    to = np.searchsorted(after, before + least_words, side="left")
    fits = to <= last
    back = np.searchsorted(before, after - least_words, side="right") - 1
    fits_back = (back >= first) & (back <= here)
    at = np.concatenate([here[fits], back[fits_back]])
    size = np.concatenate([to[fits] - here[fits] + 1, here[fits_back] - back[fits_back] + 1])
    if span is not None:
        chosen = (size >= span[0]) & (size < span[1])
        at, size = at[chosen], size[chosen]
        h = span[0]
        key, end_key = rank[at], rank[at + size - h]
    else:
        key = end_key = np.zeros(len(at), np.int64)
    at, unique = np.unique(at * (n + 1) + size, return_index=True)
    at = at // (n + 1)
    size, key, end_key = size[unique], key[unique], end_key[unique]
    if not len(at):
        return
    taken = rows.select(["d", "t", "pos"]).take(pa.array(at))
    for name, values in (("size", size), ("key", key), ("end_key", end_key)):
        taken = taken.append_column(name, pa.array(values.astype(np.int64)))
    yield from taken.combine_chunks().to_batches()


def windows(suffixes: DataFrame, least_words: int, span: tuple[int, int] | None = None) -> DataFrame:
    kind = suffixes.schema["d"].dataType.simpleString()
    schema = f"d {kind}, t bigint, pos int, size bigint, key bigint, end_key bigint"
    ordered = in_order(suffixes).select("d", "t", "pos", "words", "rank", "begins")
    return ordered.mapInArrow(lambda batches: window_batches(batches, least_words, span), schema)


def merged_batches(batches):
    """Joins overlapping and touching spans; rows come ordered by document and first line, ``begins`` marks documents."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        begins = np.flatnonzero(rows["begins"].to_numpy())
        cut = int(begins[-1]) if len(begins) else 0
        rest = rows.slice(cut)
        if cut:
            yield from merged_in(rows.slice(0, cut))
    if rest is not None and rest.num_rows:
        yield from merged_in(rest)


def merged_in(rows: pa.Table):
    starts = np.flatnonzero(np.append(True, rows["begins"].to_numpy()[1:]))
    ends = np.append(starts[1:], rows.num_rows)
    first, last = rows["pos"].to_numpy(), rows["pos"].to_numpy() + rows["size"].to_numpy()
    spans = []
    for a, b in zip(starts, ends):
        reach = np.maximum.accumulate(last[a:b])
        new = np.append(True, first[a + 1 : b] > reach[:-1])
        froms = first[a:b][new]
        tos = reach[np.append(np.flatnonzero(new)[1:] - 1, b - a - 1)]
        spans.append([{"first": int(x), "last": int(y)} for x, y in zip(froms, tos)])
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    out = rows.select(["d", "t"]).take(pa.array(starts)).append_column("removed", pa.array(spans, kind))
    yield from out.combine_chunks().to_batches()


def later_copies(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(d, t, removed): for each document with lines in later copies, the disjoint spans (first, last exclusive)."""
    with scratch(docs.sparkSession) as kept:
        lines = kept.staged(lines_of(docs), "lines")
        suffixes = kept.staged(repeated_lines(lines, kept), "suffixes")
        longest = windows(suffixes, least_words).agg(F.max("size")).first()[0] or 0
        found, h = [], 1
        while h <= longest:
            level = windows(suffixes, least_words, (h, 2 * h)).withColumn("level", F.lit(h))
            found.append(kept.staged(level, "windows"))
            h *= 2
            if h <= longest:
                suffixes = kept.staged(doubled(suffixes, h // 2, kept), "suffixes")
        if not found:
            found.append(windows(suffixes, least_words, (1, 2)).withColumn("level", F.lit(1)))
        runs = reduce(DataFrame.unionByName, found)
        place = F.struct("d", "t", "pos")
        same = ["level", "key", "end_key", "size"]
        firsts = runs.groupBy(*same).agg(F.min(place).alias("origin"), F.count("*").alias("n"))
        # written apart from the join, whose large groups Spark can then split
        firsts = kept.staged(firsts.filter("n > 1").drop("n"), "origins")
        copies = runs.join(firsts, same).filter(F.col("origin") < place).select("d", "t", "pos", "size")
        begins = F.row_number().over(Window.partitionBy("d", "t").orderBy("pos")) == 1
        spans = copies.select("d", "t", "pos", "size", begins.alias("begins"))
        kind = docs.schema["doc_id"].dataType.simpleString()
        schema = f"d {kind}, t bigint, removed array<struct<first: int, last: int>>"
        return staged(spans.mapInArrow(merged_batches, schema), "later-copies")


def remaining(text: Column, removed: Column) -> Column:
    """The lines of ``text`` outside the disjoint, ordered spans."""
    lines = F.split(text, "\n", -1)
    starts = F.concat(F.array(F.lit(0)), F.transform(removed, lambda s: s["last"]))
    ends = F.concat(F.transform(removed, lambda s: s["first"]), F.array(F.size(lines)))
    kept = F.arrays_zip(starts.alias("a"), ends.alias("b"))
    return F.array_join(F.flatten(F.transform(kept, lambda k: F.slice(lines, k["a"] + 1, k["b"] - k["a"]))), "\n")


def with_removed(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of ``docs`` under ``doc``, with ``removed`` spans (null if none)."""
    marks = later_copies(docs, least_words)
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("_d"), text_hash(docs["text"]).alias("_t"))
    same = F.col("_d").eqNullSafe(F.col("d")) & (F.col("_t") == F.col("t"))
    return rows.join(marks, same, "left").select("doc", "removed")


def deduplicated(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed, text`` of every row.

    A line is removed if it lies in a run of consecutive lines, with ``least_words`` words or more in all, that
    also occurs earlier: in a document before (by doc_id, nulls first, then by hash of text) or further up. Null texts
    count as empty: one empty line, never removed. Rows that repeat a doc_id and its text are one document and get
    the same result. ``removed`` holds the disjoint spans of line numbers, ``text`` what is left. Other columns of
    ``docs`` are left aside.
    """
    rows = with_removed(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), least_words)
    none = F.array().cast("array<struct<first: int, last: int>>")
    rows = rows.select("doc.*", F.coalesce("removed", none).alias("removed"))
    gone = F.aggregate("removed", F.lit(0), lambda n, s: n + s["last"] - s["first"])
    left = F.when(F.size("removed") > 0, remaining(F.col("text"), F.col("removed"))).otherwise(F.col("text"))
    lines = F.size(F.split("text", "\n", -1))
    return rows.select("doc_id", lines.alias("n_lines"), gone.alias("n_removed"), "removed", left.alias("text"))


def without_copies(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with its own columns: later copies cut out of ``text``, ``n_chars`` (if there) counted anew.

    Documents of which nothing but white space is left are gone; documents that had no later copy stay as they are,
    empty ones too.
    """
    rows = with_removed(docs, least_words)
    text = remaining(F.col("doc.text"), F.col("removed"))
    whole = F.col("removed").isNull()
    cut = rows.select("doc", "removed", F.when(whole, F.col("doc.text")).otherwise(text).alias("left"))
    cut = cut.filter(whole | F.col("left").rlike(r"\S"))
    fresh = {"text": F.col("left")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.when(whole, F.col("doc.n_chars")).otherwise(F.char_length("left"))
    columns = [fresh.get(name, F.col("doc")[name]) for name in docs.columns]
    return cut.select(*[column.cast(f.dataType).alias(f.name) for column, f in zip(columns, docs.schema)])
