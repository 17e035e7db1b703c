import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from legtrail.llm import components, simhash


def plain_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(values, distance):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("text", ["", " ", "one", "One TWO Ä ß", "a b c d e a b c d e", "x\u0085y z w v u t", "ÀB c\td\ne\x0bf\x0cg"])
def test_fingerprint(text):
    assert simhash.fingerprint(text, 4) == plain_print(text)


def test_spark_hash_is_the_same(spark):
    value = spark.range(1).select(F.xxhash64(F.lit("ab cd ef gh"))).first()[0]
    assert value % 2**64 == xxhash.xxh64_intdigest("ab cd ef gh".encode(), 42)


@pytest.mark.parametrize("tile", [2048, 3])
def test_links_join_what_brute_force_joins(spark, tile, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", tile)
    draw = random.Random(5)
    values = {0, 2**64 - 1, 15, 31}
    for _ in range(12):
        value = draw.getrandbits(64)
        for _ in range(draw.randint(1, 14)):
            values.add(value)
            for bit in draw.sample(range(64), draw.randint(1, 5)):
                value ^= 1 << bit
    values = sorted(values)
    rows = [(simhash.as_signed(v),) for v in values]
    links = simhash.links(spark.createDataFrame(rows, "print bigint"), 4).collect()
    assert all(((a ^ b) % 2**64).bit_count() <= 4 for a, b in links)
    at = {simhash.as_signed(v): i for i, v in enumerate(values)}
    root = list(range(len(values)))
    for _ in range(len(values)):
        for a, b in links:
            low = min(root[at[a]], root[at[b]])
            root[at[a]] = root[at[b]] = low
    assert root == plain_components(values, 4)


def test_forest_has_few_links():
    prints = np.arange(16, dtype=np.uint64)
    left, right = simhash.forest(prints, simhash.distances_to(prints, simhash.references()), 4)
    assert len(left) == 15


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 20)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**{i: 1 for i in range(1, 21)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}


def test_near_duplicates(edges):
    rows = simhash.near_duplicates(edges, 4, 4).collect()
    assert len(rows) == 10
    texts = {row.doc_id: row.text or "" for row in edges.collect()}
    values = {i: plain_print(t) for i, t in texts.items()}
    ids = sorted(values, key=lambda i: (i is None, i))
    roots = plain_components([values[i] for i in ids], 4)
    for row in rows:
        assert row.fingerprint == f"{values[row.doc_id]:016x}"
        assert row.component_id == ids[roots[ids.index(row.doc_id)]]


def test_one_of_each(edges):
    rows = simhash.one_of_each(edges, 4, 4)
    assert rows.columns == edges.columns
    assert sorted(str(r.doc_id) for r in rows.collect()) == ["1", "2", "5", "7", "8", "None"]


def test_one_of_each_keeps_every_text_without_an_id(documents):
    own = [(None, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(40)]
    near = [(1, "one two three four"), (None, "one two three four")]
    rows = simhash.one_of_each(documents(own + own[:5] + near)).collect()
    assert sorted(r.text for r in rows) == sorted([text for _, text in own] + ["one two three four"])
    assert [r.doc_id for r in rows if r.text == "one two three four"] == [1]


def test_one_of_each_with_two_texts_under_one_id(documents):
    shared = "one two three four five"
    for i in range(6):  # whichever text has the smaller hash
        own = f"alone {i} " + " ".join(f"v{i}y{j}" for j in range(9))
        rows = simhash.one_of_each(documents([(1, shared), (2, shared), (2, own), (2, own), (3, own)])).collect()
        assert sorted((r.doc_id, r.text) for r in rows) == sorted([(1, shared), (2, own)])


def test_no_documents(nothing):
    assert simhash.near_duplicates(nothing).collect() == []
    assert simhash.one_of_each(nothing).collect() == []
