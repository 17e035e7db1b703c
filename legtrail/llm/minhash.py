"""Document fingerprints by one-permutation MinHash, and likeness of fingerprints.

All shingles are hashed once; the high bits of a hash choose a bin, the smallest hash of each bin stays. An empty bin
takes the value of a bin that has one, chosen by a fixed random order for each bin (optimal densification), so that
equal sets agree everywhere and the share of agreeing bins is unbiased. Only the low bits of each value are stored;
the agreement that chance gives to so few bits is taken out again.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from legtrail.llm.common import Kept, pieces

WORDS_PER_SHINGLE = 5
BINS = 512
LOW_BITS = 4
SEED = 42
#: Donors that are looked up at a time for each empty bin.
TRIES = 64


class WordHashes(Kept):
    def made(self, word: str) -> int:
        return xxhash.xxh64_intdigest(word, SEED)


def mixed(values: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_hashes(text: str, hashes: dict[str, int]) -> np.ndarray:
    """Hashes of the shingles of lower-cased words; a shorter text is one shingle, also without words."""
    words = text.lower().split()
    if not words:
        return mixed(np.zeros(1, np.uint64))
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(WORDS_PER_SHINGLE, len(words))
    count = len(words) - width + 1
    joined = np.full(count, width, np.uint64)
    for i in range(width):
        joined = joined * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + count]
    return mixed(joined)


class Donors(dict):
    """For each turn and bin the bins it asks for a value, in order; a few turns fill all bins."""

    def __init__(self, bins: int = BINS):
        super().__init__()
        self.bins = bins

    def __missing__(self, turn: int) -> np.ndarray:
        asked = np.random.default_rng(SEED + turn).integers(0, self.bins, (self.bins, TRIES))
        if turn < 64:
            self[turn] = asked
        return asked


def fingerprint(hashes: np.ndarray, donors: Donors, low_bits: int = LOW_BITS) -> np.ndarray:
    """Low bits of the value of each bin."""
    bins = donors.bins
    ordered = np.sort(hashes)
    place = (ordered >> np.uint64(64 - (bins - 1).bit_length())).astype(np.int64)
    first = np.append(0, np.flatnonzero(place[1:] != place[:-1]) + 1)
    values = np.zeros(bins, np.uint64)
    filled = np.zeros(bins, bool)
    values[place[first]] = ordered[first]
    filled[place[first]] = True
    source = np.arange(bins)
    empty, turn = np.flatnonzero(~filled), 0
    while len(empty):
        asked = donors[turn][empty]
        hit = filled[asked]
        done = hit.any(axis=1)
        source[empty[done]] = asked[done, hit[done].argmax(axis=1)]
        empty, turn = empty[~done], turn + 1
    # hashed again with the bin, so that bins that share a value do not all agree by one chance
    values = mixed(values[source] + np.arange(bins, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (values & np.uint64((1 << low_bits) - 1)).astype(np.uint8)


def packed(prints: np.ndarray, low_bits: int = LOW_BITS) -> str:
    """Hexadecimal text of the low bits, one bin after the other."""
    bits = np.unpackbits(prints[:, None], axis=1)[:, 8 - low_bits :]
    return np.packbits(bits.ravel()).tobytes().hex()


def unpacked(text: str, bins: int = BINS, low_bits: int = LOW_BITS) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(bytes.fromhex(text), np.uint8))[: bins * low_bits].reshape(bins, low_bits)
    return (bits * (1 << np.arange(low_bits)[::-1])).sum(axis=1).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray, low_bits: int = LOW_BITS) -> float:
    """Estimated share of common shingles: agreement of bins, less what chance gives."""
    chance = 0.5**low_bits
    return float(min(1.0, max(0.0, ((a == b).mean() - chance) / (1 - chance))))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, lead) in partitions, each in descending order of id, its last row a ``lead``.

    The lead repeats the row that comes next in the whole order (after the very last, the first one), so neighbours
    are found without a global sort in one task. Ids are cut into ranges at quantiles, as many as there are shuffle
    partitions; what comes to the driver is the first id of each range.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    shares = [(i + 1) / parts for i in range(parts - 1)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares or [0.5], 100 * parts)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)
    if cuts:
        bounds = F.array(*[F.lit(cut) for cut in cuts])
        above = F.size(F.filter(bounds, lambda cut: cut >= F.col("doc_id")))
        part = F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(above)
    else:
        part = F.lit(0)
    rows = rows.withColumn("part", part.cast("int"))
    order = F.struct(F.col("doc_id").isNotNull().alias("a"), "doc_id", "hash")
    firsts = rows.groupBy("part").agg(F.max(order).alias("first")).orderBy("part").collect()
    into = [firsts[i - 1]["part"] for i in range(len(firsts))]
    known = docs.schema["doc_id"].dataType.simpleString()
    heads = [(row["first"]["doc_id"], row["first"]["hash"], to) for row, to in zip(firsts, into)]
    heads = spark.createDataFrame(heads, f"head_id {known}, head_hash bigint, into int")
    same = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("hash") == F.col("head_hash"))
    rows = rows.join(F.broadcast(heads), same, "left")
    own = F.struct(F.col("part").alias("to"), F.lit(False).alias("lead"))
    more = F.struct(F.col("into").alias("to"), F.lit(True).alias("lead"))
    places = F.when(F.col("into").isNull(), F.array(own)).otherwise(F.array(own, more))
    dealt = rows.select("doc_id", "text", "hash", F.explode(places).alias("place")).select("*", "place.*")
    dealt = dealt.repartitionById(max(parts, len(cuts) + 1), F.col("to"))
    dealt = dealt.sortWithinPartitions("lead", F.col("doc_id").desc_nulls_last(), F.col("hash").desc())
    return dealt.select("doc_id", "text", "lead")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half is the start of the next document.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The next document is
    the one with the next smaller id (equal ids: by hash of text; null ids last; after the last, the first; a single
    document follows itself). Null texts count as empty; all texts without words have one fingerprint, that of
    the empty sequence of words. Repeated rows give repeated rows. Other columns are left aside.
    """

    def run(batches):
        hashes, donors, waiting, out, done = WordHashes(), Donors(), None, [], False
        for part in pieces(batches):
            for doc_id, text, lead in zip(*[column.to_pylist() for column in part.columns]):
                if done:
                    continue  # further rows that repeat the lead
                prints = fingerprint(shingle_hashes(text, hashes), donors)
                if waiting:
                    out.append(compared(hashes, donors, *waiting, text, prints))
                waiting, done = (doc_id, text, prints), lead
            if len(out) >= 256:
                yield as_batch(out)
                out = []
        if out:
            yield as_batch(out)

    def compared(hashes, donors, doc_id, text, prints, next_text, next_prints):
        half = len(text) // 2
        edited = text[: len(text) - half] + next_text[:half]
        edited_prints = fingerprint(shingle_hashes(edited, hashes), donors)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        near = likeness(prints, edited_prints), likeness(prints, next_prints)
        return doc_id, len(text), digest, packed(prints), packed(edited_prints), *near

    def as_batch(rows):
        arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(arrays, names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    known = docs.schema["doc_id"].dataType.simpleString()
    kinds = [pa.int32() if known == "int" else pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
    types = [known, "bigint", "string", "string", "string", "double", "double"]
    return with_next(docs).mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(names, types)))
