"""Near duplicates by SimHash, with pairs discarded by their distances to reference fingerprints.

Fingerprints that differ in at most ``distance`` of 64 bits agree in two at least of ``distance + 2`` blocks of
bits, so all links are found among fingerprints that share the bits of some two blocks. Within such a group,
a table of distances to reference fingerprints is made once; two fingerprints whose distances to some reference
differ by more than ``distance`` cannot be linked (triangle inequality), and only the others are compared bit by bit.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from legtrail.llm.common import pieces, texts_of
from legtrail.llm.components import components
from legtrail.session import staged

#: Seed of the shingle hash, and of the reference fingerprints.
SEED = 42
REFERENCES = 16
#: Rows of a group that one tile takes; larger groups are split and all pairs of their parts are tiles.
TILE = 2048
#: Groups up to this size are compared pair by pair, larger ones by growing components.
SMALL = 6


def fingerprint(text: str, words_per_shingle: int) -> int:
    """SimHash of the shingles of a text, words split at ASCII white space, A-Z lower-cased; 0 without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined, width = b" ".join(words), min(words_per_shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words_per_shingle: int, *more: Column) -> DataFrame:
    """(doc_id, columns asked for, print) of every row; print is the fingerprint's bits as a bigint."""
    rows = texts_of(docs, "doc_id", *more)

    def run(batches):
        for part in pieces(batches):
            *kept, texts = part.columns
            found = [fingerprint(text, words_per_shingle) for text in texts.to_pylist()]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*kept, pa.array(signed)], [*part.schema.names[:-1], "print"])

    kinds = [f"{field.name} {field.dataType.simpleString()}" for field in rows.schema[:-1]]
    return rows.mapInArrow(run, ", ".join([*kinds, "print bigint"]))


def references() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 2**64, REFERENCES, np.uint64)


def distances_to(prints: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Row for each fingerprint, column for each reference."""
    return np.bitwise_count(prints[:, None] ^ refs[None, :]).astype(np.int8)


def linked(prints, table, left, right, distance):
    """Which of the index pairs are linked: first by the table, then the survivors bit by bit."""
    near = (np.abs(table[left] - table[right]) <= distance).all(axis=1)
    at = np.flatnonzero(near)
    return at[np.bitwise_count(prints[left[at]] ^ prints[right[at]]) <= distance]


def forest(prints: np.ndarray, table: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is connected among these rows; fewer than there are rows."""
    waiting, edges = np.arange(len(prints)), []
    while len(waiting):
        front, waiting = [waiting[0]], waiting[1:]
        while front and len(waiting):
            here = front.pop()
            found = linked(prints, table, np.full(len(waiting), here), waiting, distance)
            edges += [(here, x) for x in waiting[found]]
            front += waiting[found].tolist()
            waiting = np.delete(waiting, found)
    both = np.array(edges, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def links_of_group(prints: np.ndarray, refs: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    left, right = forest(prints, distances_to(prints, refs), distance)
    return prints[left], prints[right]


def block_masks(distance: int) -> list[int]:
    """For each pair of blocks of bits, the mask of both."""
    edges = np.linspace(0, 64, distance + 3).astype(int).tolist()
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


def as_signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def links(prints: DataFrame, distance: int) -> DataFrame:
    """(a, b) links between distinct fingerprints (column ``print``) that join all that is connected."""
    masks = block_masks(distance)
    keys = [F.xxhash64(F.lit(i), F.col("print").bitwiseAND(F.lit(as_signed(m)))) for i, m in enumerate(masks)]
    keyed = prints.select("print", F.explode(F.array(*keys)).alias("key"))
    large = keyed.groupBy("key").count().filter(F.col("count") > TILE)
    large = large.select("key", F.ceil(F.col("count") / TILE).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("print", F.lit(1)), F.col("parts")).cast("int")
    tiled = (
        keyed.join(large, "key", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("print", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    )
    refs = references()

    def run(batches):
        """Rows come in order of (key, low, high); a group may go over to the next batch."""
        left_over = None
        for batch in batches:
            rows = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
            if left_over is not None:
                rows = np.concatenate([left_over, rows])
            new = np.flatnonzero((rows[1:, 1:] != rows[:-1, 1:]).any(axis=1)) + 1
            last = new[-1] if len(new) else 0
            left_over = rows[last:]
            yield from found(rows[:last])
        if left_over is not None:
            yield from found(left_over)

    def found(rows):
        if not len(rows):
            return
        prints_, group = rows[:, 0].copy().view(np.uint64), np.zeros(len(rows), np.int64)
        group[1:] = np.cumsum((rows[1:, 1:] != rows[:-1, 1:]).any(axis=1))
        table = distances_to(prints_, refs)
        sizes = np.bincount(group)
        size = sizes[group]
        for gap in range(1, SMALL):
            if gap >= len(rows):
                break
            left = np.flatnonzero((group[:-gap] == group[gap:]) & (size[gap:] <= SMALL))
            hit = linked(prints_, table, left, left + gap, distance)
            yield from pairs(prints_[left[hit]], prints_[left[hit] + gap])
        ends = np.cumsum(sizes)
        for g in np.flatnonzero(sizes > SMALL):
            span = slice(ends[g] - sizes[g], ends[g])
            a, b = forest(prints_[span], table[span], distance)
            yield from pairs(prints_[span][a], prints_[span][b])

    def pairs(a, b):
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    ordered = tiled.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "print")
    return ordered.mapInArrow(run, "a bigint, b bigint").distinct()


def with_roots(prints: DataFrame, distance: int) -> DataFrame:
    """``prints`` (distinct, column ``print``) with ``root``, the smallest fingerprint each can reach; never null."""
    roots = components(links(prints.select("print"), distance))
    rooted = prints.join(roots, F.col("print") == F.col("node"), "left").drop("node")
    return rooted.withColumn("root", F.coalesce("root", "print"))


def near_duplicates(docs: DataFrame, words_per_shingle: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) ``, component_id`` (smallest id it can reach) of every row.

    Null and empty texts, and texts of white space, have fingerprint zero and are linked like any other. Repeated rows
    give repeated rows. A row with a null id takes part by its fingerprint, but cannot name a component: if no
    other row is connected, its component is null. Columns other than ``doc_id`` and ``text`` are left aside.
    """
    marks = staged(fingerprints(docs, words_per_shingle), "fingerprints")
    prints = marks.groupBy("print").agg(F.min("doc_id").alias("first_id"))
    rooted = with_roots(prints, distance)
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.select("print", "root").join(named, "root").select("print", "component_id")
    hexed = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return marks.join(named, "print").select("doc_id", hexed, "component_id")


def one_of_each(docs: DataFrame, words_per_shingle: int = 4, distance: int = 4) -> DataFrame:
    """``docs``, all columns, with one row of each component: the one with the smallest id, nulls last.

    Among rows that share this id it is the one with the smallest text hash. Rows are told apart by id and text, so an id
    that stands for several texts, or a null id, stays with every text that is the first of its component.
    """
    # two hashes, so that texts without an id can be told apart however many there are
    text = F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))
    marks = staged(fingerprints(docs, words_per_shingle, text.alias("hash")), "fingerprints")
    keys = marks.groupBy("print", "doc_id", "hash").agg(F.count("*").alias("n"))
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("i"), F.col("hash").alias("h"), "n")
    rooted = with_roots(keys.groupBy("print").agg(F.min(first).alias("first")), distance)
    chosen = rooted.groupBy("root").agg(F.min("first").alias("first")).select("root", "first.*")
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"), text.alias("hash"))
    found = rows.join(chosen, F.col("id").eqNullSafe(F.col("i")) & (F.col("hash") == F.col("h")))
    repeated = found.filter("n > 1").dropDuplicates(["root"])
    return found.filter("n = 1").select("doc.*").unionByName(repeated.select("doc.*"))
