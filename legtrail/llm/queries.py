"""One query for each operator, over its whole table and with production parameters."""

import public_tokenizers
from pyspark.sql import functions as F

from legtrail.llm import bpe, collocations, language, line_runs, minhash, mixing, negatives, oracles, quality, secret_scan
from legtrail.llm import simhash, topk, toxicity, urls
from legtrail.llm.common import table
from legtrail.llm.registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]

URL_RULES = [
    urls.Rule(False, "com", "/"),
    urls.Rule(True, "example.com", "/en/"),
    urls.Rule(False, "www.example.com", "/en/"),
    urls.Rule(True, "net", "/es/"),
    urls.Rule(True, "net", "/fr/"),
]


@query()
def op1_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, with_ids=False)


@query()
def op2_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=4, distance=4)


@query(oracles.SECRETS)
def op3_secrets(spark, sf_dir):
    versions = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text")
    return secret_scan.digest(secret_scan.scan(versions, secret_scan.new_ledger(spark)))


@query()
def op4_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(oracles.LINE_DEDUP)
def op5_line_dedup(spark, sf_dir):
    rows = line_runs.deduplicated(table(spark, sf_dir, "documents"))
    span = lambda s: F.concat_ws("-", s["first"].cast("string"), s["last"].cast("string"))
    return rows.select(
        "doc_id",
        F.col("n_lines").cast("bigint").alias("n_lines"),
        F.col("n_removed").cast("bigint").alias("n_removed"),
        F.array_join(F.transform("removed", span), ",").alias("removed"),
        F.sha2("text", 256).alias("text_sha256"),
    )


@query()
def op6_fingerprints(spark, sf_dir):
    return minhash.edited_fingerprints(table(spark, sf_dir, "documents"))


@query(oracles.MIXING)
def op8_mixing(spark, sf_dir):
    rows = mixing.mixture(table(spark, sf_dir, "documents"), repeats=mixing.MOST_REPEATS)
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return rows.withColumn("copy", copy).select("doc_id", "source", "tokens", "weight", "epoch")


@query(oracles.TOP_K)
def op9_top_k(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query()
def op10_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query()
def op7_toxicity(spark, sf_dir):
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(oracles.COLLOCATIONS)
def op11_collocations(spark, sf_dir):
    return collocations.phrases(table(spark, sf_dir, "documents"), longest=3, least=10, cover=50, top=2000)


@query()
def op12_url_filter(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query(oracles.NEGATIVES)
def op13_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, label, positives=5, negatives=10, low=30, high=90)
