"""Exact top-k search by inner product, in cells of queries and vectors.

Queries are packed in blocks and vectors in shards, each a matrix of whole numbers. Blocks are dealt out to a few groups
and shards to columns; every pair of a group and a column is one cell, the work of one task, which gets its blocks once, keeps
the best rows of its queries, and takes its shards as a stream. So a matrix goes to a task once, not once per product, and a
task gives out k rows a query, not k rows a query and shard. The lists of the columns are merged as a tree, so no
task sees more than a bounded number of lists of one query.
"""

from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from legtrail.llm.common import PLACE_BITS
from legtrail.session import scratch, staged

#: Rows of a block of queries and of a shard; with them the size of a product is bounded.
BLOCK = 512
SHARD = 512
#: Lists that are given out at a time, and that are merged at a time.
LISTS = 4096
FAN_IN = 64
#: Products of a cell once there are more cells than the cores need.
PRODUCTS = 1 << 34
#: Groups of queries, which are copies of each shard, and queries that each has at least; more only if their matrices
#: would have more numbers than this.
GROUPS = 4
QUERIES = 4096
NUMBERS = 1 << 24
SCALE = 256.0
NO_ROW = np.iinfo(np.int64).max


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) with v = floor(256 x) of every component; without null, null-holding and non-finite vectors."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good).select("vec_id", v.alias("v"))


PACKS = "dim int, n int, ids array<bigint>, first bigint, kind string, numbers binary, largest double"


def packs(rows: DataFrame, size: int, scale: float) -> DataFrame:
    """Rows of id and numbers packed in matrices of at most ``size`` rows of one length, with ids, smallest id and largest
    number; numbered.

    The matrices hold floor(scale x), in two bytes where all of a matrix fit, else as doubles. Vectors that hold nulls or
    numbers that are not finite are left out.
    """

    def run(batches):
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            ids, lists = batch.column(0).cast(pa.int64()).to_numpy(zero_copy_only=False), batch.column(1)
            lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            for dim in map(int, np.unique(lengths)):
                at = np.flatnonzero(lengths == dim)
                values = lists.take(pa.array(at)).flatten().cast(pa.float64(), safe=False)
                values = values.to_numpy(zero_copy_only=False).reshape(len(at), dim)
                finite = np.isfinite(values).all(axis=1)  # a null is NaN here
                held = ids[at[finite]], np.clip(np.floor(values[finite] * scale), -(2.0**63), 2.0**63)  # as Spark's floor
                if dim in kept:
                    held = tuple(np.concatenate(pair) for pair in zip(kept.pop(dim), held))
                full = len(held[0]) // size * size
                for start in range(0, full, size):
                    yield one(dim, *(part[start : start + size] for part in held))
                if full < len(held[0]):
                    kept[dim] = tuple(part[full:].copy() for part in held)
        for dim, held in kept.items():
            yield one(dim, *held)

    def one(dim, ids, matrix):
        largest = float(np.abs(matrix).max()) if matrix.size else 0.0
        kind = "<i2" if largest < 2**15 else "<f8"
        columns = [[dim], [len(ids)], [ids], [ids.min()], [kind], [matrix.astype(kind).tobytes()], [largest]]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names)

    names = ["dim", "n", "ids", "first", "kind", "numbers", "largest"]
    types = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.string(), pa.binary(), pa.float64()]
    return rows.mapInArrow(run, PACKS).withColumn("number", F.monotonically_increasing_id())


def exact(matrix: np.ndarray, kind: type) -> np.ndarray:
    """Whole numbers as floats, or as Python's integers."""
    if kind is not object:
        return matrix.astype(kind)
    return np.vectorize(int, otypes=[object])(matrix) if matrix.size else matrix.astype(object)


class Asked:
    """Queries of one length, in order of id, with the best rows that they have met so far.

    ``scores`` and ``found`` are the lists, best first; a free place has the score -inf and the id ``NO_ROW``.
    """

    def __init__(self, blocks: list[tuple[np.ndarray, np.ndarray, float]], k: int, block: int):
        ids = np.concatenate([ids for ids, _, _ in blocks])
        order = np.argsort(ids)
        self.ids, self.k, self.block = ids[order], k, block
        self.matrix = np.concatenate([matrix for _, matrix, _ in blocks])[order]
        self.largest = max(largest for _, _, largest in blocks)
        self.forms: dict[type, np.ndarray] = {}
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), NO_ROW)

    def meet(self, ids: np.ndarray, rows: np.ndarray, largest: float) -> None:
        """Products of all queries with the rows, in the smallest numbers that keep every sum whole."""
        bound = max(1.0, self.largest) * max(1.0, largest) * max(1, rows.shape[1])
        kind = np.float32 if bound < 2.0**24 else np.float64 if bound < 2.0**53 else object
        if kind is object:
            self.scores = self.scores.astype(object)
        if kind not in self.forms:
            self.forms[kind] = exact(self.matrix, kind)
        queries, rows = self.forms[kind], exact(rows, kind)
        last = self.scores[:, -1]
        # a row that ties with the last of a list gets in with a smaller id only; all scores are whole
        least = (last + (self.found[:, -1] < ids.min())).astype(kind)
        short = last == -np.inf
        if short.any():
            at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
            own = np.flatnonzero(self.ids[at] == ids)
            at = at[own]
        products = np.empty((min(self.block, len(queries)), len(rows)), kind)  # new memory each time would cost time
        hits = []
        for start in range(0, len(queries), self.block):
            block = queries[start : start + self.block]
            scores = np.matmul(block, rows.T, out=products[: len(block)])
            bar = least[start : start + self.block]
            if short.any():
                here = (at >= start) & (at < start + self.block)
                scores[at[here] - start, own[here]] = -np.inf
                new = np.flatnonzero(bar == -np.inf)
                if len(new) and len(rows) >= self.k:
                    bar[new] = np.partition(scores[new], -self.k, axis=1)[:, -self.k]
            hit = np.flatnonzero(scores.max(axis=1) >= bar)
            if len(hit):
                near = scores[hit]
                place = np.flatnonzero(near >= bar[hit, None])
                line, row = np.divmod(place, len(rows))
                hits.append((hit[line] + start, row, near.ravel()[place]))
        if hits:
            query, row, score = (np.concatenate(x) for x in zip(*hits))
            self.take(query, ids[row], score.astype(self.scores.dtype))

    def take(self, query: np.ndarray, row: np.ndarray, score: np.ndarray) -> None:
        """The rows are merged into the lists of the queries that they scored for, but for rows of the query's own id."""
        last = self.scores[query, -1]
        better = (score > last) | (score == last) & (row < self.found[query, -1])
        better &= (row != self.ids[query]) & (score > -np.inf)
        if not better.any():
            return
        query, row, score = query[better], row[better], score[better]
        changed = np.unique(query)
        query = np.concatenate([query, np.repeat(changed, self.k)])
        row = np.concatenate([row, self.found[changed].ravel()])
        score = np.concatenate([score, self.scores[changed].ravel()])
        if score.dtype == object:
            order = np.array(sorted(range(len(query)), key=lambda i: (query[i], -score[i], row[i])))
        else:
            order = np.lexsort((row, -score, query))
        best = order[np.searchsorted(query[order], changed)[:, None] + np.arange(self.k)]
        self.scores[changed], self.found[changed] = score[best], row[best]

    def lists(self, part: int):
        for start in range(0, len(self.ids), LISTS):
            score = self.scores[start : start + LISTS]
            at, column = np.nonzero(score > -np.inf)
            score, at = score[at, column], at + start
            whole = list(map(int, score)) if score.dtype == object else score.astype(np.int64)
            columns = [self.ids[at], self.found[at, column], whole, np.full(len(at), part)]
            names = ["query_id", "vec_id", "score", "part"]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names)  # beyond 64 bits: an error


def cell_lists(batches, k: int, block: int):
    """Lists of the queries of one cell; its blocks come first, then its shards."""
    warm = np.ones((256, 2048), np.float32)
    np.matmul(warm, warm.T)  # after one larger product a cell was measured to be an eighth faster
    blocks: dict[int, list] = {}
    asked: dict[int, Asked] = {}
    part = 0
    for batch in batches:
        column = {name: batch.column(name) for name in batch.schema.names}
        for i in range(batch.num_rows):
            ids, dim = column["ids"][i].values.to_numpy(), column["dim"][i].as_py()
            numbers = np.frombuffer(column["numbers"][i].as_buffer(), column["kind"][i].as_py())
            pack = ids, numbers.reshape(len(ids), dim), column["largest"][i].as_py()
            if not column["shard"][i].as_py():
                blocks.setdefault(dim, []).append(pack)
                continue
            part = column["part"][i].as_py()
            if dim in blocks:
                asked[dim] = Asked(blocks.pop(dim), k, block)
            if dim in asked:
                asked[dim].meet(*pack)
    for queries in asked.values():
        yield from queries.lists(part)


def layout(queries: int, numbers: int, rows: int, partitions: int, cores: int) -> tuple[int, int]:
    """Groups of queries and columns of vectors.

    There are three cells a core, more if they would have over ``PRODUCTS`` products, but not more than partitions. More groups
    cost copies of the vectors, more columns cost lists.
    """
    cells = max(1, min(partitions, max(3 * cores, queries * rows // PRODUCTS)))
    groups = max(1, min(GROUPS, isqrt(cells // 2), queries // QUERIES), -(-numbers // NUMBERS))
    return groups, max(1, cells // groups)


def dealt(count: int) -> Column:
    """Packs in turn, from another beginning in each partition that they were made in."""
    place = F.col("number").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    begin = F.pmod(F.xxhash64(F.shiftright("number", PLACE_BITS)), F.lit(count))
    return F.pmod(begin + place, F.lit(count)).cast("int")


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best rows for each query, all if there are fewer; ties to smaller ids.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on vec_id. A query is compared with every row
    whose id is another. Vectors that are null, or hold nulls or numbers that are not finite, take no part, nor do rows
    without id. Vectors are compared with those of their own length only. Rows that repeat a query's id are one
    query, that of the smallest vector; as candidates all repeated rows count. Scores beyond 64 bits are an error.
    """
    spark = vectors.sparkSession
    rows = vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").select("vec_id", "embedding")
    queries = whole_vectors(vectors.filter(is_query)).groupBy("vec_id").agg(F.min("v").alias("v"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema, block = "query_id bigint, vec_id bigint, score bigint, part bigint", BLOCK
    with scratch(spark) as kept:
        blocks = kept.staged(packs(queries, BLOCK, 1.0), "query-blocks")
        shards = kept.staged(packs(rows, SHARD, SCALE), "shards")
        asked, numbers = blocks.agg(F.sum("n"), F.sum(F.col("n").cast("bigint") * F.col("dim"))).first()
        count = shards.agg(F.sum("n")).first()[0]
        groups, columns = layout(asked or 0, numbers or 0, count or 0, partitions, spark.sparkContext.defaultParallelism)
        copies = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        blocks = blocks.withColumn("group", dealt(groups)).withColumn("part", copies(columns))
        shards = shards.withColumn("part", dealt(columns)).withColumn("group", copies(groups))
        packed = blocks.withColumn("shard", F.lit(False)).unionByName(shards.withColumn("shard", F.lit(True)))
        cells = packed.repartitionById(groups * columns, F.col("group") * columns + F.col("part"))
        cells = cells.sortWithinPartitions("shard", "first").drop("group", "number", "n", "first")
        lists = cells.mapInArrow(lambda batches: cell_lists(batches, k, block), schema)
        while columns > FAN_IN:
            columns = -(-columns // FAN_IN)
            lists = lists.withColumn("part", F.pmod("part", F.lit(columns)))
            best = Window.partitionBy("query_id", "part").orderBy(F.col("score").desc(), "vec_id")
            lists = lists.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).drop("rank")
        best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        ranked = lists.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        return staged(ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "ranked")
