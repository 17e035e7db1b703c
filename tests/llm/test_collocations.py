import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from legtrail.llm import collocations, quotient
from legtrail.llm.quotient import Layout
from legtrail.session import Scratch


def pieces(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for end in ".,;:!?\n\x0b\x0c\r":
        text = text.replace(end, "\n")
    for piece in text.split("\n"):
        yield [word for word in piece.replace("\t", " ").split(" ") if word]


def plain(rows, longest, least, cover, top):
    counts = {}
    for _, text, lang in rows:
        known = counts.setdefault(lang or "und", Counter())
        for words in pieces(text):
            for size in range(1, longest + 1):
                known.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = set()
    for lang, known in counts.items():
        n = sum(f for g, f in known.items() if len(g) == 1)
        good = {g: f for g, f in known.items() if len(g) > 1 and f >= least}
        inside = Counter()
        for g, f in good.items():
            for size in range(2, len(g)):
                for i in range(len(g) - size + 1):
                    inside[g[i : i + size]] = max(inside[g[i : i + size]], f)
        found = []
        for g, a in good.items():
            cuts = [(1000000 * a * a // (known[g[:k]] * known[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            if 100 * inside[g] < cover * a:
                found.append((-score, -a, " ".join(g).encode(), a, known[g[:k]], known[g[k:]], n, score))
        for rank, row in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, row[2].decode(), *row[3:]))
    return out


def drawn(seed, n):
    draw = random.Random(seed)
    words = ["The", "of", "ocean", "Ärger", "ärger", "漢字", "x y", "new", "york", "city", "a-b"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?", "\x0b", ":"]
    rows = []
    for i in range(n):
        text = "".join(draw.choice(words) + draw.choice(ends) for _ in range(draw.randint(0, 60)))
        rows.append((i % 50, draw.choice([text, text + "New York City", "new york new york"]), draw.choice(["en", "en", "fr", None])))
    return rows + [(None, None, "en"), (1, "", "de"), (2, " \t. ", "de"), (2, "only once", "es")]


@pytest.mark.parametrize("longest, least, fan_in, depth, chunk", [(3, 10, 1024, 10, 8 << 20), (4, 5, 3, 2, 400), (2, 1, 2, 1, 1)])
def test_against_brute_force(spark, documents, monkeypatch, longest, least, fan_in, depth, chunk):
    monkeypatch.setattr(collocations, "FAN_IN", fan_in)
    monkeypatch.setattr(collocations, "DEPTH", depth)
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(collocations, "PART", 1 << 15 if chunk > 1000 else 7)
    rows = drawn(3, 900 if chunk > 1000 else 60)
    got = collocations.phrases(documents(rows), longest, least, 50, 2000)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, longest, least, 50, 2000) and len(got) > 8


@pytest.mark.parametrize("fan_in", [1024, 3])
def test_filters_are_not_written_down(spark, documents, monkeypatch, fan_in):
    """Shuffles hold all filters, so another copy of them takes as much disk again."""
    monkeypatch.setattr(collocations, "FAN_IN", fan_in)
    monkeypatch.setattr(collocations, "CHUNK", 400)
    written, write = [], Scratch.staged

    def noted(self, df, purpose):
        written.append(df.columns)
        return write(self, df, purpose)

    monkeypatch.setattr(Scratch, "staged", noted)
    rows = drawn(6, 60)
    got = {tuple(r) for r in collocations.phrases(documents(rows), 3, 5, 50, 2000).collect()}
    assert got == plain(rows, 3, 5, 50, 2000) and len(got) > 8
    assert ["ids", "f"] in written and not any("filter" in columns for columns in written)


def test_top_of_many(spark, documents, monkeypatch):
    monkeypatch.setattr(collocations, "LISTS", 2)
    rows = drawn(4, 120)
    got = collocations.phrases(documents(rows), 3, 2, 90, 3).collect()
    assert {tuple(r) for r in got} == plain(rows, 3, 2, 90, 3)


def test_edges_and_empty(spark, edges, nothing):
    assert collocations.phrases(nothing).collect() == []
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in edges.collect()]
    assert {tuple(r) for r in collocations.phrases(edges).collect()} == plain(rows, 3, 10, 50, 2000)


def test_large_counts_score_exactly(spark):
    """a² * 1000000 passes 64 bits."""
    a, l, r = 9_876_543_210, 9_876_543_213, 19_876_543_217
    rows = spark.createDataFrame([([1, 2], a, "en", ["x", "y"], [l, r])], "ids array<bigint>, f bigint, lang string, words array<string>, fs array<bigint>")
    got = collocations.cut_scores(rows, rows.select("ids", "f")).first()
    assert tuple(got) == ([1, 2], 1000000 * a * a // (l * r), 1, l, r)


@pytest.mark.parametrize("longest, bits", [(2, 1), (3, 1), (3, 18), (3, 21), (3, 33), (2, 63), (5, 25)])
def test_filters_lose_nothing(longest, bits):
    layout = Layout(longest, bits)
    draw = np.random.default_rng(bits)
    some = [draw.integers(0, 2**bits, 500, dtype=np.int64) for _ in range(longest)]
    some = [np.concatenate([c, c[:100], np.repeat(c[0], 300)]) for c in some]
    wanted = Counter(zip(*[c.tolist() for c in some]))
    halves = []
    for part in (slice(0, 450), slice(450, None)):
        entries = layout.counted(*layout.permuted(*layout.packed([c[part] for c in some])))
        depth = min(3, layout.high_bits)
        made = [(b, quotient.to_bytes(layout, depth, e)) for b, e in layout.ranges(entries, depth)]
        halves += [(b, quotient.from_bytes(layout, depth, b, data)) for b, data in made]
    got = Counter()
    for begin in {b for b, _ in halves}:
        whole = quotient.merged(layout, [e for b, e in halves if b == begin])
        keys = list(zip(whole.high.tolist(), whole.low.tolist()))
        assert keys == sorted(set(keys))
        for key, n in zip(zip(*[c.tolist() for c in layout.unpacked(*layout.restored(whole.high, whole.low))]), whole.counts.tolist()):
            assert key not in got
            got[key] = n
    assert got == wanted


def test_shorter_sequences_and_empty_filter():
    layout = Layout(3, 7)
    high, low = layout.packed([np.array([5]), np.array([9])])
    assert [c.tolist() for c in layout.unpacked(high, low)] == [[5], [9], [0]]
    nothing = quotient.merged(layout, [])
    assert len(quotient.from_bytes(layout, 2, 1, quotient.to_bytes(layout, 2, nothing))) == 0 and layout.ranges(nothing, 2) == []
    with pytest.raises(ValueError):
        Layout(3, 50)


def test_filters_are_compact():
    layout = Layout(3, 18)
    draw = np.random.default_rng(1)
    entries = layout.counted(*layout.permuted(*layout.packed([draw.integers(1, 2**18, 200_000) for _ in range(3)])))
    sizes = [len(quotient.to_bytes(layout, 10, part)) for _, part in layout.ranges(entries, 10)]
    assert sum(sizes) < 7.5 * len(entries)


@pytest.mark.parametrize("bits", [18, 19, 20, 21])
def test_filters_waste_no_bits(bits):
    """A remainder takes its own bits only; in whole bytes it took several more, but where they happened to fit."""
    layout, n = Layout(3, bits), 100_000
    draw = np.random.default_rng(bits)
    entries = layout.counted(*layout.permuted(*layout.packed([draw.integers(1, 2**bits, n) for _ in range(3)])))
    for depth in (0, 4, 8, 10):
        sizes = [len(quotient.to_bytes(layout, depth, part)) for _, part in layout.ranges(entries, depth)]
        needed = layout.total - depth - np.log2(n / 2**depth)
        assert sum(sizes) * 8 < n * (needed + 5) + 40 * 8 * len(sizes)


@pytest.mark.parametrize("bits", [0, 1, 7, 8, 9, 27, 32, 63])
@pytest.mark.parametrize("n", [0, 1, 3, 8, 100])
def test_numbers_of_any_width_come_back(bits, n):
    values = np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64)
    data = np.frombuffer(quotient.bytes_of(values, bits), np.uint8)
    assert len(data) == quotient.size_of(bits, n)
    assert quotient.numbers_of(data, bits, n).tolist() == (values & quotient.mask(bits)).tolist()


def test_ranges_are_no_finer_than_the_filters_left(spark, documents, monkeypatch):
    """Few groups after the first merge are not cut in 2 ** DEPTH ranges each."""
    monkeypatch.setattr(collocations, "FAN_IN", 8)
    monkeypatch.setattr(collocations, "CHUNK", 400)
    depths, last = [], collocations.frequent_sequences

    def noted(filters, layout, depth, least):
        depths.append(depth)
        return last(filters, layout, depth, least)

    monkeypatch.setattr(collocations, "frequent_sequences", noted)
    monkeypatch.setattr(collocations, "DEPTH", 4)
    rows = drawn(7, 40)
    got = {tuple(r) for r in collocations.phrases(documents(rows), 3, 5, 50, 2000).collect()}
    assert got == plain(rows, 3, 5, 50, 2000) and len(got) > 8
    assert len(depths) == 1 and 4 < depths[0] < 8


def test_chunks_are_split_and_counted_in_slices(monkeypatch):
    draw = random.Random(5)
    texts = ["".join(draw.choice("aB cd é.,\n\t") for _ in range(draw.choice([0, 1, 5, 60]))) for _ in range(400)] + ["", " . "]
    layout = Layout(3, 10)
    found = []
    for size in (1 << 20, 50, 1):
        monkeypatch.setattr(collocations, "SPLIT_AT_ONCE", size)
        monkeypatch.setattr(collocations, "COUNTED_AT_ONCE", size)
        words, ids, begins = collocations.words_of(texts)
        tokens = np.insert(ids, begins, -1)
        known = np.append(np.arange(len(words)) % 3 * np.arange(len(words)), 0)  # some are rare
        entries = collocations.sequences(tokens, known, layout)
        found.append([x.tolist() for x in (ids, begins, entries.high, entries.low, entries.counts)] + [words.to_pylist()])
    assert found[0] == found[1] == found[2]
    expected = [words for text in texts for words in pieces(text) if words]
    starts = [0, *found[0][1], len(found[0][0])]
    assert [[found[0][5][i] for i in found[0][0][a:b]] for a, b in zip(starts, starts[1:])] == expected
    assert collocations.words_of([])[1].tolist() == collocations.words_of(["", "."])[1].tolist() == []


def test_a_chunk_of_short_words_takes_little_memory_on_the_way():
    texts = ["ab cd. ef gh " * 80] * 4000  # 4 million characters, 1.3 million words
    layout, ids = Layout(3, 15), np.array([1, 2, 3, 4, 0])
    tracemalloc.start()
    try:
        for batch in collocations.chunk_rows(0, "x", texts):
            parts = [collocations.unpacked(part) for part in batch.column("tokens").drop_null().to_pylist()]
        tokens = np.concatenate(parts)
        of_split = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        collocations.sequences(tokens, ids, layout)
        of_counts = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert of_split < 45e6 and of_counts < 60e6


def test_tokens_shrink_to_about_two_bytes_each():
    tokens = np.append(np.random.default_rng(3).integers(0, 30_000, 50_000), -1).astype("<i4")
    data = collocations.packed(tokens)
    assert collocations.unpacked(data).tolist() == tokens.tolist() and collocations.unpacked(b"").tolist() == []
    assert pa.compress(data, "lz4", asbytes=True).__len__() < 2.2 * len(tokens) < 0.7 * len(pa.compress(tokens.tobytes(), "lz4", asbytes=True))
