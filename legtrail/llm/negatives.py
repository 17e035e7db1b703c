"""Hard negatives of anchors, found with bounds along a spanning tree of anchors.

Anchors that lie near each other form a block, rows a shard; each pair of block and shard that must meet is one group of a
task. The anchors of a block are joined by a minimum spanning tree. For a row x, the score of a child c with parent p lies
within |c - p| |x| of the score of p (or of its bounds, where that is not known), so most rows can be told to
lie outside of the window of a child, or below enough rows inside it, without a product. The rest get their exact score.
"""

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from legtrail.llm.common import numbered
from legtrail.session import Scratch, scratch, staged

#: Numbers in the vectors of a shard and of a block, which bound the memory of a group, and rows of each.
NUMBERS = 1 << 20
ROWS = 256, 8192
ANCHORS = 64, 4096
#: Anchors of a tree.
TREE = 256
#: Groups of labels, so that anchors only meet rows of their own group where labels must be equal.
LABEL_GROUPS = 64
#: Lists that are merged at a time.
FAN_IN = 64
SCALE = 256.0
#: Leading components whose signs put anchors near each other.
SIGNS = 24

LISTS = "anchor_id bigint, ask int, vec_id bigint, score bigint, part bigint"


def usable(vectors: DataFrame, label: Column) -> DataFrame:
    """(vec_id, label, v, dim) with v = floor(256 x), of rows without a null or a number that is not finite."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    there = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & label.isNotNull()
    rows = vectors.filter(there & good).select(F.col("vec_id").cast("bigint"), label.cast("bigint").alias("label"), v.alias("v"))
    return rows.withColumn("dim", F.size("v"))


def spanning_tree(points: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Minimum spanning tree grown from the first point: (points in order of joining, parent, length of the edge to it)."""
    n = len(points)
    parent, length, inside = np.zeros(n, np.int64), np.zeros(n), np.zeros(n, bool)
    near = np.full(n, np.inf)
    order, at = [], 0
    for _ in range(n):
        order.append(at)
        inside[at] = True
        gap = points - points[at]
        squares = np.einsum("ij,ij->i", gap, gap)
        closer = (squares < near) & ~inside
        near[closer], parent[closer] = squares[closer], at
        open_ = np.where(inside, np.inf, near)
        at = int(open_.argmin())
        length[at] = np.sqrt(open_[at]) if np.isfinite(open_[at]) else length[at]
    return order, parent, length


class Shard:
    """Rows that anchors are compared with: ids, labels and vectors of whole numbers."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, largest: float):
        order = np.argsort(ids, kind="stable")  # so that ties go to the smaller id
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.vectors, self.vectors))
        self.whole = largest < 2.0**53  # products stay whole numbers in doubles
        if not self.whole:
            self.exact = integers(self.vectors)

    def scores(self, anchor: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact inner products with the rows ``at``."""
        if not self.whole:
            return self.exact[at] @ integers(anchor)
        if len(at) > len(self.ids) // 4:
            return (self.vectors @ anchor)[at].astype(np.int64)
        return (self.vectors[at] @ anchor).astype(np.int64)


def integers(x: np.ndarray) -> np.ndarray:
    """Python's integers, which do not overflow."""
    return np.array([int(value) for value in x.ravel()], object).reshape(x.shape)


def first_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, of equal ones the first."""
    if len(scores) > k:
        least = np.sort(scores)[-k] if scores.dtype == object else np.partition(scores, len(scores) - k)[-k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.argsort(-scores[at], kind="stable")[:k]]


def tree_scan(ids, labels, vectors, asks: Sequence[list[dict]], shard: Shard, k: int, same: bool):
    """Yields (anchor's place, ask, rows' places, scores), and at last how many scores were computed.

    For each ask of an anchor: the first k rows, of another id and of the same (or another) label, whose score
    lies from ``low`` to ``high`` (null: open).
    """
    order, parent, length = spanning_tree(vectors)
    bounds, children = {}, np.bincount(parent[order[1:]], minlength=len(order))
    norms, computed = np.sqrt(np.einsum("ij,ij->i", vectors, vectors)), 0
    for at in order:
        if at == order[0]:
            low, high = np.full(len(shard.ids), -np.inf), np.full(len(shard.ids), np.inf)
        else:
            # products, roots and sums of doubles are wrong by far less than this margin
            margin = (length[at] * (1 + 1e-9) + 1e-9 * (norms[at] + norms[parent[at]])) * shard.norms + 1e-6
            low, high = (b + s * margin for b, s in zip(bounds[parent[at]], (-1, 1)))
            children[parent[at]] -= 1
            if not children[parent[at]]:
                del bounds[parent[at]]
        able = ((shard.labels == labels[at]) == same) & (shard.ids != ids[at])
        wanted = np.zeros(len(able), bool)
        for ask in asks[at]:
            least, most = limits(ask)
            inside = able & (high >= least) & (low <= most)
            sure = low[inside & (low >= least) & (high <= most)]
            if len(sure) >= k:
                inside &= high >= np.partition(sure, len(sure) - k)[-k]
            wanted |= inside
        rows = np.flatnonzero(wanted)
        scores = shard.scores(vectors[at], rows)
        computed += len(rows)
        if children[at]:
            low[rows] = high[rows] = scores.astype(float)
            bounds[at] = low, high
        for ask in asks[at]:
            least, most = limits(ask)
            inside = np.flatnonzero((scores >= least) & (scores <= most))
            best = inside[first_of(scores[inside], k)]
            yield at, ask["ask"], rows[best], scores[best]
    yield None, computed, None, None


def limits(ask: dict) -> tuple[float, float]:
    return -np.inf if ask["low"] is None else ask["low"], np.inf if ask["high"] is None else ask["high"]


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def met(anchors: pa.Table, rows: pa.Table, k: int, same: bool) -> pa.Table:
    """Lists of one block over one shard."""
    out = [[], [], [], []]
    if anchors.num_rows and rows.num_rows:
        dim = anchors["dim"][0].as_py()
        anchors = anchors.sort_by([("near", "ascending"), ("vec_id", "ascending")])
        a, v = matrix(anchors["v"], dim), matrix(rows["v"], dim)
        largest = float(np.abs(a).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, dim)
        shard = Shard(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), v, largest)
        ids, labels, asks = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy(), anchors["asks"].to_pylist()
        for begin in range(0, len(ids), TREE):
            part = slice(begin, begin + TREE)
            for at, ask, places, scores in tree_scan(ids[part], labels[part], a[part], asks[part], shard, k, same):
                if at is not None:
                    out[0].append(np.full(len(places), ids[part][at]))
                    out[1].append(np.full(len(places), ask))
                    out[2].append(shard.ids[places])
                    out[3].extend(scores.tolist())
    columns = [np.concatenate(part) if part else [] for part in out[:3]] + [out[3]]
    part = rows["shard"][0].as_py() if rows.num_rows else 0
    columns.append(np.full(len(columns[3]), part))
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["anchor_id", "ask", "vec_id", "score", "part"])


def dealt(rows: DataFrame, name: str, order: list, sizes: tuple[int, int], dim: int, kept: Scratch) -> tuple[DataFrame, int]:
    """``rows`` with the number of the block or shard they lie in, and how many of those there are."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("_salt", F.rand(7))
    ranged = salted.repartitionByRange(parts, *order, "_salt").sortWithinPartitions(*order).drop("_salt")
    placed, count = numbered(ranged, kept, "place")
    size = min(sizes[1], max(sizes[0], -(-count // parts)), max(1, NUMBERS // max(1, dim)))
    place = F.floor(F.col("place") / size).cast("bigint")
    return placed.withColumn(name, place).drop("place"), -(-count // size)


def lists(anchors: DataFrame, rows: DataFrame, k: int, same: bool, kept: Scratch) -> DataFrame:
    """(anchor_id, ask, vec_id, score) of the first ``k`` rows for each ask of each anchor, with their ``rank``."""
    key = F.pmod(F.xxhash64("label"), F.lit(LABEL_GROUPS)) if same else F.lit(0)
    anchors, rows = (df.withColumn("key", key.cast("int")) for df in (anchors, rows))
    dim = rows.agg(F.max("dim")).first()[0] or 0
    blocks, _ = dealt(anchors, "block", ["dim", "key", "near"], ANCHORS, dim, kept)
    shards, count = dealt(rows, "shard", ["dim", "key", "vec_id"], ROWS, dim, kept)
    blocks, shards = kept.staged(blocks, "blocks"), kept.staged(shards, "shards")
    spans = [
        df.groupBy("dim", "key").agg(F.sequence(F.min(name), F.max(name)).alias(f"{name}s"))
        for df, name in ((blocks, "block"), (shards, "shard"))
    ]
    # one row for each length of vectors and group of labels
    left = blocks.join(spans[1], ["dim", "key"]).withColumn("shard", F.explode("shards")).drop("shards")
    right = shards.join(spans[0], ["dim", "key"]).withColumn("block", F.explode("blocks")).drop("blocks")
    group = ["dim", "key", "block", "shard"]
    pairs = left.groupBy(*group).cogroup(right.groupBy(*group))
    found = kept.staged(pairs.applyInArrow(lambda a, b: met(a, b, k, same), LISTS), "lists")
    while count > 1:
        count = -(-count // FAN_IN)
        found = found.withColumn("part", F.pmod("part", F.lit(count)))
        best = Window.partitionBy("anchor_id", "ask", "part").orderBy(F.col("score").desc(), "vec_id")
        found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).drop("rank")
    best = Window.partitionBy("anchor_id", "ask").orderBy(F.col("score").desc(), "vec_id")
    return found.drop("part").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has vec_id, embedding and what ``label`` (a whole number) needs; ``is_anchor`` is a condition on vec_id. Scores
    are inner products of floor(256 x). The positives of an anchor are its first ``positives`` rows of the same label and
    another id; for each, the first ``negatives`` rows of another label whose score lies from ``low`` to ``high`` percent of
    the positive's are returned. Order is by score, descending, then by id. A positive below zero has an empty window.

    Rows with a null id, label or vector, or a component that is null or not finite, take no part. Vectors are compared with
    those of their own length. Rows that repeat an anchor's id are one anchor, that of the smallest label and vector; as
    positives and negatives all repeated rows count, but for those with the anchor's id. An empty table, and anchors without
    positives or negatives, give no rows. Other columns are left aside. Scores beyond 64 bits are an error.
    """
    with scratch(vectors.sparkSession) as kept:
        rows = kept.staged(usable(vectors, label), "rows")
        signs = F.transform(F.slice("v", 1, SIGNS), lambda x: F.when(x > 0, "1").otherwise("0"))
        anchors = rows.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("own"))
        anchors = anchors.select("vec_id", "own.*").withColumns({"dim": F.size("v"), "near": F.array_join(signs, "")})
        anchors = kept.staged(anchors, "anchors")
        whole = F.lit(None).cast("bigint")
        ask = F.array(F.struct(F.lit(0).alias("ask"), whole.alias("low"), whole.alias("high")))
        near = lists(anchors.withColumn("asks", ask), rows, positives, True, kept)
        near = kept.staged(near.select("anchor_id", "rank", F.col("vec_id").alias("positive_id"), "score"), "positives")
        share = lambda percent: F.col("score").cast("decimal(20, 0)") * percent / 100
        window = F.struct(
            F.col("rank").alias("ask"), F.ceil(share(low)).cast("bigint").alias("low"), F.floor(share(high)).cast("bigint").alias("high")
        )
        asks = near.select(F.col("anchor_id").alias("vec_id"), window.alias("w")).filter("w.low <= w.high")
        asks = asks.groupBy("vec_id").agg(F.collect_list("w").alias("asks"))
        found = lists(anchors.join(asks, "vec_id"), rows, negatives, False, kept)
        found = found.select("anchor_id", "ask", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        of = near.select("anchor_id", F.col("rank").alias("ask"), "positive_id", F.col("score").alias("positive_score"))
        columns = ["anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"]
        return staged(found.join(of, ["anchor_id", "ask"]).select(*columns), "negatives")
