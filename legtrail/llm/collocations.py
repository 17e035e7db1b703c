"""Phrase collocations: counts of word sequences in mergeable quotient filters, scored by their weakest cut.

Texts are cut in chunks, and every chunk is encoded with a dictionary of its own. Words that are frequent enough get numbers,
which replace a chunk's own by one join of dictionaries, so texts never meet a table of all words. The sequences of
numbers of a chunk are counted in filters, one for each of ``RANGES`` ranges of permuted keys (see :mod:`quotient`). Filters
of one range are merged ``FAN_IN`` at a time, each result cut in finer ranges; so a task holds about as many entries as
a chunk has, however many chunks there are. Only sequences that are frequent enough leave the last filters.

A word sequence can only be frequent if all its parts are, so leaving rare words out loses nothing.
"""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from legtrail.llm import quotient
from legtrail.llm.common import PLACE_BITS, numbered, texts_of
from legtrail.llm.quotient import Layout
from legtrail.session import Scratch, scratch, staged

#: Characters of text in a chunk, more only for a single long text.
CHUNK = 8 << 20
#: Words, and tokens, in one part of a chunk.
PART = 1 << 15
#: Characters of a chunk that are split in words at a time, more only for a single long text, and tokens whose sequences
#: are counted at a time; what a task holds for one of them on the way is many times its own size.
SPLIT_AT_ONCE = 1 << 20
COUNTED_AT_ONCE = 1 << 18
#: Bits by which a range of keys is cut at each merge, fewer if fewer filters are left, and filters merged at a time.
DEPTH = 10
FAN_IN = 1024
#: Lists of first candidates that are merged at a time when a language has many.
LISTS = 4

# Capital letters, and the bytes at which pieces end and words are cut.
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

LOWER = bytes.maketrans(CAPITALS, CAPITALS.lower())
END = np.zeros(256, bool)
END[list(PIECE_ENDS)] = True
WORD = ~END
WORD[list(BLANKS)] = False


def released() -> None:
    """Gives memory that Arrow holds for later back to the system: workers wait for their next task with what they hold."""
    pa.default_memory_pool().release_unused()


def split(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """All words of a few texts in order, and where a piece begins (other than the first)."""
    data = np.frombuffer("\n".join(texts).encode().translate(LOWER), np.uint8)
    inside = WORD[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.append(0, np.cumsum(ends - starts))
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    flat = pa.Array.from_buffers(pa.large_utf8(), len(starts), buffers)
    pieces_before = np.searchsorted(np.flatnonzero(END[data]), starts)
    return flat, np.flatnonzero(np.diff(pieces_before)) + 1


def words_of(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of the texts as they first come, which of them each word is, and where a piece begins (other
    than the first)."""
    words, begins, n, start, size = [], [], 0, 0, 0
    for i, text in enumerate(texts, 1):
        size += len(text) + 1
        if size < SPLIT_AT_ONCE and i < len(texts):
            continue
        some, at = split(texts[start:i])
        if len(some):
            words.append(some)
            begins += [at + n] if n == 0 else [np.array([n]), at + n]
            n += len(some)
        start, size = i, 0
    if not words:
        return pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(0, np.int64)
    coded = pa.chunked_array(words).dictionary_encode()
    ids = np.concatenate([part.indices.to_numpy() for part in coded.chunks])
    return coded.chunk(coded.num_chunks - 1).dictionary.cast(pa.string()), ids, np.concatenate(begins)


def packed(tokens: np.ndarray) -> bytes:
    """First the low bytes of all tokens, then the next ones: high bytes are nearly all alike, so files and shuffles shrink."""
    return tokens.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<i4").reshape(-1)


def chunk_rows(chunk: int, lang: str, texts: list[str]):
    """Rows of one chunk: ``word`` and ``f`` at each ``place`` of its dictionary, then its ``tokens`` in parts.

    Tokens are places in the dictionary, -1 between pieces. No row grows with the chunk.
    """
    words, ids, begins = words_of(texts)
    del texts
    counts = np.bincount(ids, minlength=len(words)).astype(np.int64)
    tokens = np.insert(ids, begins, -1).astype("<i4")
    parts = [packed(tokens[i : i + PART]) for i in range(0, len(tokens), PART)]
    for start in range(0, len(words), PART):
        some = words[start : start + PART]
        yield rows_of(chunk, lang, start, len(some), [some, pa.array(counts[start : start + PART]), None])
    yield rows_of(chunk, lang, 0, len(parts), [None, None, pa.array(parts, pa.binary())])


def rows_of(chunk: int, lang: str, first: int, n: int, columns: list) -> pa.RecordBatch:
    kinds = pa.string(), pa.int64(), pa.binary()
    columns = [pa.nulls(n, kind) if column is None else column for column, kind in zip(columns, kinds)]
    head = [pa.array([chunk] * n, pa.int64()), pa.array([lang] * n, pa.string()), pa.array(range(first, first + n), pa.int32())]
    return pa.RecordBatch.from_arrays([*head, *columns], ["chunk", "lang", "place", "word", "f", "tokens"])


def chunks(docs: DataFrame) -> DataFrame:
    """Documents of one language and task together, about ``CHUNK`` characters; null languages are ``und``."""

    def run(batches):
        waiting, sizes = defaultdict(list), defaultdict(int)
        held, chunk = 0, TaskContext.get().partitionId() << PLACE_BITS
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                waiting[lang].append(text)
                sizes[lang] += len(text) + 1
                held += len(text) + 1
                if held > 2 * CHUNK or sizes[lang] >= CHUNK:
                    fullest = max(sizes, key=sizes.get)
                    held -= sizes.pop(fullest)
                    yield from chunk_rows(chunk, fullest, waiting.pop(fullest))
                    chunk += 1
        while waiting:
            yield from chunk_rows(chunk, *waiting.popitem())
            chunk += 1
        released()

    rows = texts_of(docs, F.coalesce("lang", F.lit("und")).alias("lang"))
    return rows.mapInArrow(run, "chunk bigint, lang string, place int, word string, f bigint, tokens binary")


def frequent_words(words: DataFrame, least: int, kept: Scratch) -> tuple[DataFrame, int]:
    """(lang, word, f, id) of words that occur ``least`` times, with ids from 1, and how many they are."""
    often = words.groupBy("lang", "word").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return numbered(often, kept, "id", first=1)


def sequences(tokens: np.ndarray, ids: np.ndarray, layout: Layout) -> quotient.Entries:
    """Counts of all sequences of two words or more; ``ids`` has the number of each word (0: rare), a 0 last for -1."""
    counts = []
    for start in range(0, len(tokens), COUNTED_AT_ONCE):
        # those that begin in this stretch may end after it
        numbers = ids[tokens[start : start + COUNTED_AT_ONCE + layout.longest - 1]]
        whole = numbers > 0
        for width in range(2, layout.longest + 1):
            last = len(numbers) - width + 1
            if last < 1:
                break
            whole = whole[:last] & (numbers[width - 1 :] > 0)
            at = np.flatnonzero(whole[:COUNTED_AT_ONCE])
            counts.append(layout.counted(*layout.permuted(*layout.packed([numbers[at + i] for i in range(width)]))))
    return quotient.merged(layout, counts)


def filter_rows(layout: Layout, entries: quotient.Entries, depth: int, group: int) -> pa.Table:
    """A filter for each range of ``depth`` bits."""
    ranges = layout.ranges(entries, depth)
    data = [quotient.to_bytes(layout, depth, part) for _, part in ranges]
    arrays = [pa.array([begin for begin, _ in ranges], pa.int64()), pa.array([group] * len(ranges), pa.int64())]
    return pa.table([*arrays, pa.array(data, pa.binary())], ["range", "group", "filter"])


def first_filters(texts: DataFrame, words: DataFrame, layout: Layout, depth: int, groups: int) -> DataFrame:
    """(range, group, filter) of every chunk: its own words get their numbers, its sequences are counted."""

    def run(chunk: pa.Table, known: pa.Table) -> pa.Table:
        parts = [unpacked(part) for part in chunk.sort_by("place")["tokens"].to_pylist()]
        tokens = np.concatenate(parts) if parts else np.zeros(0, "<i4")
        ids = np.zeros(int(tokens.max(initial=-1)) + 2, np.int64)
        ids[known["at"].to_numpy()] = known["id"].to_numpy()
        rows = filter_rows(layout, sequences(tokens, ids, layout), depth, chunk["group"][0].as_py())
        released()
        return rows

    own = texts.filter("word is not null").select("chunk", "lang", "place", "word")
    # the dictionary has each word once; hashing its part of a partition spares the sort of all rows
    known = own.join(words.hint("shuffle_hash"), ["lang", "word"])
    known = known.select(F.col("chunk").alias("of"), F.col("place").alias("at"), "id")
    group = F.pmod(F.xxhash64("chunk"), F.lit(groups)).alias("group")
    pairs = texts.filter("tokens is not null").select("chunk", "place", "tokens", group).groupBy("chunk").cogroup(known.groupBy("of"))
    return pairs.applyInArrow(run, "range bigint, group bigint, filter binary")


def merge_level(filters: DataFrame, layout: Layout, depth: int, finer: int, groups: int) -> DataFrame:
    """Filters of one range and group as one, cut in ranges of ``finer`` bits; there are ``groups`` groups after it."""

    def run(rows: pa.Table) -> pa.Table:
        entries = read(rows, layout, depth)
        return filter_rows(layout, entries, finer, rows["group"][0].as_py() % groups)

    return filters.groupBy("range", "group").applyInArrow(run, "range bigint, group bigint, filter binary")


def read(rows: pa.Table, layout: Layout, depth: int) -> quotient.Entries:
    pairs = zip(rows["range"].to_pylist(), rows["filter"].to_pylist())
    return quotient.merged(layout, [quotient.from_bytes(layout, depth, begin, data) for begin, data in pairs])


def frequent_sequences(filters: DataFrame, layout: Layout, depth: int, least: int) -> DataFrame:
    """(ids, f) of sequences that occur ``least`` times, from filters of which each range is one group."""

    def run(rows: pa.Table) -> pa.Table:
        entries = read(rows, layout, depth)
        entries = entries[entries.counts >= least]
        numbers = np.column_stack(layout.unpacked(*layout.restored(entries.high, entries.low)))
        used = numbers > 0
        offsets = np.append(0, np.cumsum(used.sum(axis=1))).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers[used]))
        return pa.table([ids, pa.array(entries.counts)], ["ids", "f"])

    return filters.groupBy("range").applyInArrow(run, "ids array<bigint>, f bigint")


def counted_sequences(texts: DataFrame, words: DataFrame, layout: Layout, least: int, kept: Scratch) -> DataFrame:
    """(ids, f) of the frequent sequences; filters go from level to level by shuffles alone, a written copy would be as large again."""
    groups, depth = -(-texts.filter("tokens is not null and place = 0").count() // FAN_IN) or 1, min(DEPTH, layout.high_bits)
    filters = first_filters(texts, words, layout, depth, groups)
    while groups > 1:
        # as many new ranges as filters that meet next: more of them would be many small filters, which take more room
        finer = min(depth + min(DEPTH, (min(groups, FAN_IN) - 1).bit_length()), layout.high_bits)
        groups = -(-groups // FAN_IN)
        filters = merge_level(filters, layout, depth, finer, groups)
        depth = finer
    return kept.staged(frequent_sequences(filters, layout, depth, least), "sequences")


def named(found: DataFrame, words: DataFrame, kept: Scratch) -> DataFrame:
    """(ids, f, lang, words, fs) of sequences, with the text and count of each of their words."""
    flat = found.select("ids", F.col("f").alias("a"), F.posexplode("ids").alias("place", "id"))
    joined = flat.join(words.hint("shuffle_hash"), "id").select("ids", F.col("a").alias("f"), "lang", F.struct("place", "word", "f").alias("one"))
    rows = joined.groupBy("ids", "f", "lang").agg(F.sort_array(F.collect_list("one")).alias("ones"))
    rows = rows.select("ids", "f", "lang", F.col("ones.word").alias("words"), F.col("ones.f").alias("fs"))
    return kept.staged(rows, "named")


def cut_scores(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(ids, score, k, l, r) of each sequence's weakest cut."""
    cuts = rows.select("ids", "f", "fs", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    left = F.struct(F.lit("l").alias("side"), F.slice("ids", F.lit(1), F.col("k")).alias("part"), F.col("fs")[0].alias("one"))
    right = F.struct(
        F.lit("r").alias("side"), F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("part"), F.element_at("fs", -1).alias("one")
    )
    sides = cuts.select("ids", "f", "k", F.explode(F.array(left, right)).alias("at")).select("ids", "f", "k", "at.*")
    single = sides.filter(F.size("part") == 1).select("ids", "f", "k", "side", F.col("one").alias("n"))
    known = found.select(F.col("ids").alias("part"), F.col("f").alias("n"))
    several = sides.filter(F.size("part") > 1).join(known, "part").select("ids", "f", "k", "side", "n")
    both = single.unionByName(several).groupBy("ids", "f", "k").agg(
        F.max(F.when(F.col("side") == "l", F.col("n"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("n"))).alias("r")
    )
    wide = {name: f"cast({name} as decimal(16, 0))" for name in ("f", "l", "r")}
    score = F.expr(f"(cast(1000000 as decimal(7, 0)) * ({wide['f']} * {wide['f']})) div ({wide['l']} * {wide['r']})")
    best = both.select("ids", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy("ids").agg(F.min("cut").alias("cut"))
    return best.select("ids", "cut.*")


def covered(rows: DataFrame, cover: int) -> DataFrame:
    """(ids) of sequences inside a longer one that occurs ``cover`` percent as often or more."""
    size = F.size("ids")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda at: F.slice("ids", at, n)),
        )
    )
    parts = rows.filter(size > 2).select(F.explode(spans).alias("ids"), F.col("f").alias("longer"))
    longest = parts.groupBy("ids").agg(F.max("longer").alias("longer"))
    wide = lambda name: F.col(name).cast("decimal(20, 0)")
    return rows.select("ids", "f").join(longest, "ids").filter(wide("longer") * 100 >= wide("f") * cover).select("ids")


def first_of_each(rows: DataFrame, by: str, order: list, top: int) -> DataFrame:
    """The first ``top`` rows of each group with their ``rank``.

    Large groups are ranked in parts that are merged as a tree, so a task sees about ``LISTS * top`` rows of one group.
    """
    largest = rows.groupBy(by).count().agg(F.max("count")).first()[0] or 0
    parts = -(-largest // (LISTS * top))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(max(1, parts))))
    while parts > 1:
        best = Window.partitionBy(by, "_part").orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).drop("rank")
        parts = -(-parts // LISTS)
        rows = rows.withColumn("_part", F.pmod("_part", F.lit(parts)))
    best = Window.partitionBy(by).orderBy(*order)
    return rows.drop("_part").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)


def phrases(docs: DataFrame, longest: int = 3, least: int = 10, cover: int = 50, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language of ``docs`` (text, lang).

    Letters A-Z are lowered; pieces end at ``.,;:!?`` and line breaks, words at spaces and tabs. A phrase is a
    sequence of 2 to ``longest`` words of one piece that occurs ``a >= least`` times in its language, overlaps included. ``l``
    and ``r`` count the occurrences of the parts of its cut with the lowest score, floor(1000000 a² / (l r)), of several
    the first cut; ``n`` counts the words of the language. A phrase that lies inside a longer one with at least ``cover``
    percent of its occurrences is left out. Ordered by score and a, both descending, then by phrase in order of bytes.

    Null texts count as empty, a null language as ``und``; repeated rows count each. Nothing depends on doc_id or other
    columns. An empty table, and a language without phrases, give no rows. All counts are exact and over all texts.
    """
    if longest < 2:
        raise ValueError("a phrase has two words or more")
    spark = docs.sparkSession
    with scratch(spark) as kept:
        with scratch(spark) as early:
            texts = early.staged(chunks(docs), "chunks")
            own = texts.filter("word is not null").select("lang", "word", "f")
            words, count = frequent_words(own, least, kept)
            sizes = kept.staged(own.groupBy("lang").agg(F.sum("f").alias("n")), "sizes")
            layout = Layout(longest, max(1, count.bit_length()))
            found = counted_sequences(texts, words, layout, least, kept)
        rows = named(found, words, kept)
        scored = cut_scores(rows, found).join(rows.select("ids", "f", "lang", "words"), "ids")
        left = scored.join(covered(rows, cover), "ids", "left_anti")
        phrase = F.array_join("words", " ").alias("phrase")
        left = kept.staged(left.select("lang", phrase, F.col("f").alias("a"), "l", "r", "score"), "phrases")
        order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
        ranked = first_of_each(left, "lang", order, top).join(sizes, "lang")
        rank = F.col("rank").cast("bigint").alias("rank")
        return staged(ranked.select("lang", rank, "phrase", "a", "l", "r", "n", "score"), "collocations")

