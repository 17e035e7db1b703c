"""Quality of documents: boosted trees over statistics of the text."""

from collections.abc import Iterator
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from legtrail.llm.common import labelled_sample, remainder
from legtrail.llm.trees import Forest, fit

#: Labelled documents the trees are grown on, at most.
LABELLED_DOCUMENTS = 20_000
#: Score from which a document counts as good.
GOOD = 0.7

# Bytes of signs that are counted one by one, and groups of bytes.
SIGNS = b"!?.,;:|#$%&*<>{}[]()=+-_/\\@\"'"
STATISTICS = 18 + len(SIGNS)


def statistics(text: str) -> list[float]:
    """Scale-free statistics of a text; all zero for one without characters."""
    words = text.split()
    if not words:
        return [0.0] * STATISTICS
    data = np.frombuffer(text.encode(), np.uint8)
    counts = np.bincount(data, minlength=256)
    size, n = len(data), len(words)
    lines = [line for line in text.split("\n") if line.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    kinds = set(words)
    shares = counts[counts > 0] / size
    pairs = set(zip(words, islice(words, 1, None)))
    found = [
        np.log1p(size),
        np.log1p(n),
        np.log1p(len(lines)),
        n / len(lines),
        float(lengths.mean()),
        float(lengths.std()),
        float(lengths.max()),
        len(kinds) / n,
        len(pairs) / max(1, n - 1),
        len(kinds) / np.sqrt(n),
        len(set(lines)) / len(lines),
        sum(map(eq, words, islice(words, 1, None))) / n,
        sum(map(str.isupper, words)) / n,
        sum(map(str.isalpha, words)) / n,
        float(counts[48:58].sum()) / size,
        float(counts[65:91].sum()) / max(1, int(counts[65:91].sum() + counts[97:123].sum())),
        float(counts[128:].sum()) / size,
        float(-(shares * np.log2(shares)).sum()),
    ]
    return found + (counts[list(SIGNS)] / n).tolist()


@F.udf(ArrayType(DoubleType()), useArrow=True)
def statistics_udf(text):
    return [float(value) for value in statistics(text)]


def train(docs: DataFrame, labels: DataFrame, keep: Column, bound: int = LABELLED_DOCUMENTS, label: str = "quality") -> Forest:
    """Trees from at most ``bound`` labelled documents for which ``keep`` (over labels) holds.

    Only their statistics come to the driver. Without labels every score is 1, with one class it is the
    smoothed share of label 1.
    """
    sample = labelled_sample(docs, labels, label, keep, bound)
    rows = sample.select(F.xxhash64("doc_id", "_text").alias("at"), "_label", statistics_udf("_text").alias("x")).toArrow()
    order = np.argsort(rows["at"].to_numpy(), kind="stable")
    x = np.array(rows["x"].to_pylist(), float).reshape(-1, STATISTICS)[order]
    y = rows["_label"].to_numpy().astype(float)[order]
    return fit(x, y)


def score(model: Forest, text: Column) -> Column:
    """Score of each whole text (null: empty), from 0 to 1."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [texts.iloc[at : at + 512] for at in range(0, len(texts), 512)]
            scores = [model.scores(np.array([statistics(t) for t in part], float)) for part in parts]
            yield pd.Series(np.concatenate(scores) if scores else np.array([], float))

    return run(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (doc_id, text).

    Documents whose id has remainder 2 (crc32 of its text, modulo 4) are held out of training. Null and empty texts
    get the score of a text without statistics; repeated rows give repeated rows; a null id is not held out.
    """
    out = remainder(F.col("doc_id"), 4) == 2
    model = train(docs, labels, ~out)
    rows = docs.select("doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), score(model, F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is good."""
    model = train(docs, labels, ~(remainder(F.col("doc_id"), 4) == 2))
    return docs.filter(score(model, F.col("text")) >= GOOD)
