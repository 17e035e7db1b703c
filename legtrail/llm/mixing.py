"""Mixing sources to target weights by temperature.

A source's weight is its share of tokens to the power of an exponent, normalised: 1 keeps the shares, 0 makes all
equal. The exponent is bisected to meet a target entropy of the weights, or the largest number of times a
source may be repeated. Then the weights are realised: each source is laid out as whole permutations of its
documents (blocks), and a last block that stops where the source's budget of tokens ends. Only Spark's own expressions
are used; what is brought together in one row is the list of sources, not of documents.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from legtrail.session import staged

#: How often the mixture of the query and the pipeline may show the most repeated source.
MOST_REPEATS = 2.0
#: Steps of the bisection; each halves the interval of the exponent.
STEPS = 50
#: Hexadecimal digits of the hash that cut a permutation into parts, so that no task needs a whole source in order.
PART_DIGITS = 3


def token_count(text: Column) -> Column:
    """Words of a text (null: none); stands for tokens, of which shares are asked."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\r\n]+")), F.lit(0)).cast("bigint")


def text_hash(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def shares(tokens: DataFrame) -> DataFrame:
    """One row: ``sources``, an array of (source, tokens) in order of source, of sources that have tokens."""
    totals = tokens.groupBy("source").agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")
    return totals.agg(F.array_sort(F.collect_list(F.struct("source", "tokens"))).alias("sources"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def _weights(sources: Column, exponent: Column) -> Column:
    top = F.array_max(F.transform(sources, lambda s: s["tokens"])).cast("double")
    raised = F.transform(sources, lambda s: F.pow(s["tokens"] / top, exponent))
    return F.transform(raised, lambda value: value / _sum(raised))


def _entropy(weights: Column) -> Column:
    return -_sum(F.transform(weights, lambda w: F.when(w > 0, w * F.log(w)).otherwise(0.0)))


def _largest_repeat(weights: Column, sources: Column) -> Column:
    """How often the most repeated source is seen when the least repeated is seen once."""
    ratios = F.transform(F.arrays_zip(weights.alias("w"), sources.alias("s")), lambda x: x["w"] / x["s"]["tokens"])
    return F.array_max(ratios) / F.array_min(ratios)


def exponent(one: DataFrame, entropy_share: float | None, repeats: float | None) -> DataFrame:
    """Adds ``exponent``, in [0, 1], to the row of sources.

    It is the largest at which the entropy of the weights reaches ``entropy_share`` of the largest possible, or the
    smallest at which no source is repeated more than ``repeats`` times.
    """
    if (entropy_share is None) == (repeats is None):
        raise ValueError("give either a target entropy or a repetition limit")
    sources = F.col("sources")

    def step(interval, _):
        middle = (interval["low"] + interval["high"]) / 2
        weights = _weights(sources, middle)
        if repeats is None:
            lower = _entropy(weights) < entropy_share * F.log(F.size(sources).cast("double"))
        else:
            lower = _largest_repeat(weights, sources) <= repeats
        low = F.when(lower, interval["low"]).otherwise(middle)
        high = F.when(lower, middle).otherwise(interval["high"])
        return F.struct(low.alias("low"), high.alias("high"))

    start = F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high"))
    rounds = F.sequence(F.lit(1), F.lit(STEPS))
    found = F.aggregate(rounds, start, step, lambda interval: F.round((interval["low"] + interval["high"]) / 2, 9))
    return one.withColumn("exponent", found)


def budgets(tokens: DataFrame, entropy_share: float | None, repeats: float | None, budget: int | None) -> DataFrame:
    """(source, tokens, weight, target): tokens that each source gives to the mixture.

    Without ``budget`` the mixture is the smallest that holds every document at least once.
    """
    one = exponent(shares(tokens), entropy_share, repeats)
    one = one.withColumn("weights", _weights(F.col("sources"), F.col("exponent")))
    rows = one.select("exponent", F.explode(F.arrays_zip("sources", "weights")).alias("x"), "sources", "weights")
    if budget is None:
        each = F.transform(F.arrays_zip("sources", "weights"), lambda x: x["sources"]["tokens"] / x["weights"])
        wanted = F.array_max(each)
    else:
        wanted = F.lit(float(budget))
    target = F.greatest(F.round(F.col("x.weights") * wanted), F.col("x.sources.tokens") if budget is None else F.lit(0))
    return rows.select(
        F.col("x.sources.source").alias("source"),
        F.col("x.sources.tokens").alias("source_tokens"),
        F.round("x.weights", 9).alias("weight"),
        target.cast("bigint").alias("target"),
    )


def mixture(
    docs: DataFrame, entropy_share: float | None = None, repeats: float | None = None, budget: int | None = None
) -> DataFrame:
    """(doc_id, text_hash, source, tokens, weight, epoch): a row for each time a document is in the mixture.

    ``epoch`` numbers the blocks of a source from 0. The documents of each block are permuted by a hash of document and
    block; the last block takes documents while the tokens before them are below what is left of the source's target.
    A null source is a source of its own. Documents without tokens (null, empty) cost nothing: they are in block 0
    once. Rows that repeat a document are taken together, each with its own copy. An empty table gives no rows.
    """
    kept = docs.select(
        "doc_id",
        text_hash(F.col("text")).alias("text_hash"),
        "source",
        token_count(F.col("text")).alias("tokens"),
    )
    tokens = staged(kept.groupBy(*kept.columns).agg(F.count("*").alias("copies")), "tokens")
    all_tokens = tokens.select("source", (F.col("tokens") * F.col("copies")).alias("tokens"))
    plan = staged(budgets(all_tokens, entropy_share, repeats, budget), "budgets")
    plan = plan.withColumn("whole", F.floor(F.col("target") / F.col("source_tokens")).cast("int"))
    plan = plan.withColumn("left", F.col("target") - F.col("whole") * F.col("source_tokens"))

    rows = tokens.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
    rows = rows.drop("s")
    out = ["doc_id", "text_hash", "source", "tokens", "copies", "weight", "epoch"]
    free = rows.filter("tokens = 0").withColumn("epoch", F.lit(0))
    filled = rows.filter("tokens > 0 and whole > 0")
    filled = filled.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)))

    name = F.concat_ws(":", F.col("doc_id").cast("string"), "text_hash", F.col("whole").cast("string"))
    last = rows.filter("tokens > 0 and left > 0").withColumn("key", F.md5(name))
    last = last.withColumn("part", F.substring("key", 1, PART_DIGITS)).withColumn("epoch", F.col("whole"))
    cost = F.col("tokens") * F.col("copies")
    sizes = last.groupBy("source", "part").agg(F.sum(cost).alias("size"), F.first("left").alias("left"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("begin", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    sizes = sizes.filter("begin < left").select(F.col("source").alias("s"), F.col("part").alias("p"), "begin", "size")
    reached = last.join(sizes, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))).drop("s", "p")
    within = Window.partitionBy("source", "part").orderBy("key", "doc_id", "text_hash")
    running = F.coalesce(F.sum(cost).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = reached.withColumn("begin", F.col("begin") + running).filter("begin < left")
    return free.select(*out).unionByName(filled.select(*out)).unionByName(reached.select(*out))


def mixed(docs: DataFrame, repeats: float) -> DataFrame:
    """The rows of ``docs``, all columns, as often as the mixture has them; every document at least once."""
    seen = mixture(docs, repeats=repeats).groupBy("doc_id", "text_hash", "source")
    times = seen.agg(F.count("*").cast("int").alias("times"))
    times = times.withColumnsRenamed({"doc_id": "_d", "text_hash": "_t", "source": "_s"})
    rows = docs.select(F.struct("*").alias("doc")).withColumn("hash", text_hash(F.col("doc.text")))
    same_document = F.col("doc.doc_id").eqNullSafe(F.col("_d")) & (F.col("hash") == F.col("_t"))
    rows = rows.join(times, same_document & F.col("doc.source").eqNullSafe(F.col("_s"))).select("doc", F.explode(F.sequence(F.lit(1), "times")))
    return rows.select("doc.*")
