import math
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from legtrail.llm import topk
from legtrail.session import shared_folder

KIND = "vec_id bigint, embedding array<double>, score string, dim int"


def plain(rows, k):
    whole = {}
    for vec_id, vector in rows:
        if vec_id is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            whole.setdefault(vec_id, []).append([math.floor(256 * x) for x in vector])
    found = []
    for query in whole:
        if query % 10 == 0:
            own = min(whole[query])
            scores = [(-sum(a * b for a, b in zip(own, v)), i) for i, vs in whole.items() if i != query for v in vs if len(v) == len(own)]
            found += [(query, rank, i, -score) for rank, (score, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


def search(spark, rows, k=5):
    vectors = spark.createDataFrame([(*row, "x", 1) for row in rows], KIND)
    return sorted(tuple(r) for r in topk.search(vectors, F.col("vec_id") % 10 == 0, k).collect())


@pytest.mark.parametrize("block, shard", [(512, 1024), (2, 5)])
def test_against_brute_force(spark, block, shard, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "FAN_IN", 3)
    draw = random.Random(4)
    rows = [(i, [draw.choice([-1.0, -0.5, 0.001, 0.5]) for _ in range(3)]) for i in range(90)]
    rows += [(90, None), (91, [1.0, None, 1.0]), (92, [math.inf, 0.0, 0.0]), (100, [math.nan, 0.0, 0.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(110, [0.5, 0.5]), (111, [0.25, 0.5]), (120, []), (7, [-1.0, 0.5, 0.5]), (10, [0.0, 0.0, 0.0])]
    assert search(spark, rows) == plain(rows, 5)


def test_large_numbers_stay_exact(spark):
    rows = [(0, [2.0**22 + 1 / 256, 1.0]), (1, [2.0**23, 3.0]), (2, [2.0**23, 3 + 1 / 256])]
    assert search(spark, rows) == plain(rows, 5)


def test_fewer_rows_than_k_and_none(spark):
    assert search(spark, [(0, [1.0]), (3, [1.0])]) == [(0, 1, 3, 65536)]
    assert search(spark, [(0, [1.0])]) == [] and search(spark, []) == []


def test_what_is_given_out_does_not_grow_with_the_shards(spark, monkeypatch):
    """Once k rows a query and shard were written down and merged: 14 queries and 60 shards made 3,906 rows."""
    monkeypatch.setattr(topk, "SHARD", 10)
    draw = random.Random(7)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(4)]) for i in range(600) if i < 140 or i % 10]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").coalesce(1)
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    found = topk.search(vectors, F.col("vec_id") % 10 == 0).count()
    written = sum(spark.read.parquet(str(path)).count() for path in set(folder.iterdir()) - before)
    assert found == 14 * 5 and written <= 14 * 5


def cell(blocks, shards, k):
    """Lists of one cell, as (query, row, score); blocks and shards are (ids, vectors)."""
    packs = [(False, *pack) for pack in blocks] + [(True, *pack) for pack in shards]
    columns = {"shard": [], "dim": [], "ids": [], "kind": [], "numbers": [], "largest": [], "part": []}
    for shard, ids, vectors in packs:
        matrix = np.array(vectors, np.float64)
        values = [shard, matrix.shape[1], ids, "<f8", matrix.tobytes(), float(abs(matrix).max()), 0]
        for held, value in zip(columns.values(), values):
            held.append(value)
    batch = pa.record_batch(columns | {"ids": pa.array(columns["ids"], pa.list_(pa.int64()))})
    lists = [row for out in topk.cell_lists([batch], k, 2) for row in out.to_pylist()]
    return sorted((row["query_id"], -row["score"], row["vec_id"]) for row in lists)


@pytest.mark.parametrize("sizes", [[1], [1, 2**13], [1, 2**13, 2**29], [2**29, 1]])
def test_a_cell_over_numbers_of_all_sizes(sizes):
    """Products in floats, in doubles and in Python's integers, and from one to the other within a list."""
    draw = random.Random(3)
    vector = lambda size: [draw.randint(-3, 3) * size for _ in range(3)]
    queries = [(i, vector(draw.choice(sizes))) for i in (4, 0, 2, 9, 7)]
    shards = []
    for start in range(0, 120, 8):
        ids = [start + draw.randrange(40) for _ in range(8)]
        shards.append((ids, [vector(sizes[start * len(sizes) // 120]) for _ in ids]))
    expected = []
    for query, own in queries:
        scores = [(-sum(a * b for a, b in zip(own, v)), i) for ids, vs in shards for i, v in zip(ids, vs) if i != query]
        expected += [(query, *score) for score in sorted(scores)[:5]]
    blocks = [([i for i, _ in part], [v for _, v in part]) for part in (queries[:2], queries[2:])]
    assert cell(blocks, shards, 5) == sorted(expected)


def test_ties_go_to_smaller_ids_in_any_order_of_the_shards():
    hot = [([base + i for i in (5, 1, 3, 4, 2, 0)], [[2, 1]] * 6) for base in (60, 20, 40, 0, 80)]
    assert cell([([1], [[2, 1]])], hot, 4) == [(1, -5, i) for i in (0, 2, 3, 4)]
    assert cell([([1], [[2, 1]])], hot[:3], 4) == [(1, -5, i) for i in (20, 21, 22, 23)]


def test_layout_of_cells():
    assert topk.layout(0, 0, 0, 12, 6) == (1, 12)
    assert topk.layout(1000, 64_000, 50_000, 12, 6) == (1, 12)  # few queries: one copy of the vectors
    assert topk.layout(12_000, 768_000, 600_000, 24, 6) == (2, 9)
    groups, columns = topk.layout(300_000, 300_000 * 64, 15_000_000, 600, 6)
    assert groups == 4 and 18 < groups * columns <= 600
    assert topk.layout(2_000_000, 2_000_000 * 1024, 10**8, 600, 6)[0] == -(-2_000_000 * 1024 // topk.NUMBERS)
