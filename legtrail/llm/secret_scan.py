"""Secret scans over a ledger of blobs.

Every version of every file is addressed by the hash of its text. The ledger says which pairs of blob and rule
version have been scanned and what was found; a run scans only pairs that the ledger lacks, adds them, and joins
the findings of all its blobs back to the paths. Only Spark's own expressions are used.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from legtrail.session import empty, new_folder, staged

SPANS = "array<struct<first: int, last: int>>"
FINDINGS = f"array<struct<rule: string, spans: {SPANS}>>"
#: A row for each scan of a blob, with the rule versions it was scanned by and what each found.
LEDGER = f"blob string, findings {FINDINGS}"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; they count if ``group`` has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    hint: str  # a pattern that every text with a match holds; cheaper to look for

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The kinds asked for, in the order in which they are listed, and then the further ones.
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
        r"[Ss][Ss][Ww]|[Ee][Cc][Rr][Ee][Tt]|[Oo][Kk][Ee][Nn]|[Kk][Ee][Yy]",
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18, "AKIA"),
    # A run of 16 or more is one maximal run, so shorter ones need not be found and dropped.
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16, r"[0-9a-f]{16}"),
)
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, "-----BEGIN "),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 1, "eyJ"),
)
RULES = BASE_RULES + MORE_RULES


def spans_of(text: Column, rule: Rule) -> Column:
    """Array of (first, last) of the matches that count, in code points, last exclusive.

    The text between matches and the matches themselves alternate, so summing their lengths gives the places.
    """
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    lengths = F.transform(whole, F.char_length)
    counted = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.char_length)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    rows = F.arrays_zip(lengths.alias("long"), counted.alias("counted"), F.slice(gaps, 1, F.size(whole)).alias("gap"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first: int, last: int>>").alias("found"))

    def step(state, row):
        first = state["at"] + row["gap"]
        last = first + row["long"]
        here = F.array(F.struct(first.alias("first"), last.alias("last")))
        found = F.when(row["counted"] >= rule.least, F.concat(state["found"], here)).otherwise(state["found"])
        return F.struct(last.alias("at"), found.alias("found"))

    none = F.array().cast("array<struct<first: int, last: int>>")
    return F.when(text.rlike(rule.hint), F.aggregate(rows, start, step, lambda state: state["found"])).otherwise(none)


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Everything scanned so far: (blob, rule, spans), one row for each pair of blob and rule version."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(LEDGER).parquet(path) if there else empty(spark, StructType.fromDDL(LEDGER))


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds to the ledger what it lacks on the texts of ``versions`` (key, text), then gives the findings of every row.

    ``key, blob, findings``: a row for each row of ``versions``; findings are (rule, spans) of the rules that found
    something in its text, an empty array if none did. Null texts count as empty. Blobs are scanned once, however
    many rows hold them: of each blob that has unseen rules, the row with the smallest key is scanned.
    """
    spark = versions.sparkSession
    named = versions.select("key", F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))
    blobs = named.groupBy("blob").agg(F.min("key").alias("first_key"))
    scanned = open_ledger(spark, ledger).select("blob", F.explode("findings.rule").alias("rule"))
    seen = scanned.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    wanted = F.array(*[F.lit(rule.name) for rule in rules])
    unseen = (
        blobs.join(seen, "blob", "left")
        .withColumn("todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
        .filter(F.size("todo") > 0)
        .select("blob", "first_key", "todo")
    )
    match = (F.col("n.blob") == F.col("u.blob")) & F.col("n.key").eqNullSafe(F.col("u.first_key"))
    texts = named.alias("n").join(unseen.alias("u"), match).select("n.blob", "n.text", "u.todo")
    nothing = F.lit(None).cast(SPANS)
    found = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.when(F.array_contains("todo", rule.name), spans_of(F.col("text"), rule)).otherwise(nothing).alias("spans"),
        )
        for rule in rules
    ]
    fresh = texts.select("blob", F.filter(F.array(*found), lambda one: one["spans"].isNotNull()).alias("findings"))
    fresh.dropDuplicates(["blob"]).write.mode("append").parquet(ledger)

    names = [rule.name for rule in rules]
    hits = lambda one: (F.size(one["spans"]) > 0) & one["rule"].isin(names)
    findings = open_ledger(spark, ledger).select("blob", F.filter("findings", hits).alias("findings"))
    findings = findings.filter(F.size("findings") > 0).groupBy("blob")
    findings = findings.agg(F.array_distinct(F.flatten(F.collect_list("findings"))).alias("findings"))
    findings = staged(findings, "findings")  # apart from the join, whose large groups Spark can then split
    found = F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings")
    return named.select("key", "blob").join(findings, "blob", "left").select("key", "blob", found)


def digest(scanned: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Counts of the base kinds, and all spans as ``kind:start:end`` by start, then as the kinds are listed."""
    order = F.create_map(*[F.lit(x) for i, rule in enumerate(rules) for x in (rule.name, i)])
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    one = F.transform(
        "findings",
        lambda f: F.transform(
            f["spans"], lambda s: F.struct(s["first"].alias("first"), order[f["rule"]].alias("kind"), s["last"].alias("last"))
        ),
    )
    spans = F.array_sort(F.flatten(one))
    text = lambda s: F.concat_ws(":", kinds[s["kind"]], s["first"].cast("string"), s["last"].cast("string"))
    joined = lambda some: F.array_join(F.transform(some, text), ",")
    rows = scanned.select("key", spans.alias("spans"))
    rows = rows.withColumn("base", F.filter("spans", lambda s: s["kind"] < len(base)))
    of_kind = lambda i: F.filter("base", lambda s: s["kind"] == i)
    counts = [F.size(of_kind(i)).cast("bigint").alias(f"n_{rule.kind}") for i, rule in enumerate(base)]
    return rows.select(
        F.col("key").alias("doc_id"),
        *counts,
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def new_ledger(spark: SparkSession) -> str:
    """A place for a ledger that nobody has used; keep your own path to scan only what is new next time."""
    return new_folder(spark, "ledger")
