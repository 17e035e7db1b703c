"""From raw documents to encoded training data: reject, deduplicate, mix, encode.

Each stage reads what the one before it wrote. All but the last give rows with the columns of documents.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from legtrail.llm import bpe, line_runs, mixing, quality, simhash
from legtrail.llm.common import table
from legtrail.session import Scratch

#: The stages train trees and cut lines, which SQL does not express; tests hold run() against a plain version.
ORACLE_SQL = None


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is good; columns as they are."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs are cut out of the texts; documents of which nothing is left are gone."""
    return line_runs.without_copies(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate component (of repeated rows, one)."""
    return simhash.one_of_each(docs, words_per_shingle=4, distance=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of their sources has them, each at least once."""
    return mixing.mixed(docs, repeats=mixing.MOST_REPEATS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document in the mixture."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality", reject_poor),
    ("line_dedup", cut_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again.

    What a stage wrote is removed when the next one has written.
    """
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        held = Scratch(spark)
        docs = held.staged(stage(spark, docs, sf_dir), name)
        if last:
            last.remove()
        last = held
    return STAGES[-1][1](spark, docs, sf_dir)
