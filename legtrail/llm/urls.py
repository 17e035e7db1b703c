"""URL filter: rules over hosts and paths, and boosted trees over lexical features where no rule fits.

The trees learn from URLs that the rules decide. Their features are lengths, depth, shares of digits and other signs,
entropy, numbers of parameters, and statistics of suffixes: how common the last label of the host, its last two labels and
the file ending are among all URLs, and which share of those that rules decide is blocked. Suffixes are counted in
a fixed number of cells by their hash, so that what every task is given does not grow with the URLs.
"""

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from legtrail.llm.common import smallest_hashes
from legtrail.llm.trees import Forest, constant, fit

#: Decided URLs the trees are grown on, at most.
LABELLED_URLS = 20_000
#: Score from which a URL is blocked.
BLOCKED = 0.5
#: Cells of the statistics of each kind of suffix.
CELLS = 4096
ROWS_AT_ONCE = 1024

# Where a URL's parts begin and end, and kinds of suffixes.
PARTS = re.compile(r"://([^/?#]*)([^?#]*)(\??[^#]*)(#?)", re.DOTALL)
KINDS = ("last", "last two", "ending")
SIGNS = b".-_%~+@&=;:,"
VOWELS = b"aeiou"


@dataclass(frozen=True)
class Rule:
    """Decides URLs of ``host`` and its subdomains whose path starts with ``path``."""

    block: bool
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Suffixes:
    """By kind and cell: the log of the share of all URLs, and the smoothed share of blocked ones."""

    common: np.ndarray
    blocked: np.ndarray


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return lowered(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def deciding(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name of the longest rule that fits, and whether it blocks; both null without one.

    Of fitting rules of one length that with the longer host counts, then the one given first.
    """
    name, block = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    longest = sorted(rules, key=lambda rule: (len(rule.name), len(rule.host)), reverse=True)
    for i, rule in enumerate(longest):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        name = F.when(fits, rule.name) if not i else name.when(fits, rule.name)
        block = F.when(fits, rule.block) if not i else block.when(fits, rule.block)
    return name, block


def suffixes(host: Column, path: Column) -> Column:
    """One text for each of ``KINDS``."""
    ending = F.regexp_extract(path, r"\.([^./]*)$", 1)
    return F.array(F.substring_index(host, ".", -1), F.substring_index(host, ".", -2), ending)


def cells(host: Column, path: Column) -> Column:
    return F.transform(suffixes(host, path), lambda s: F.pmod(F.xxhash64(s), F.lit(CELLS)).cast("int"))


def suffix_statistics(rows: DataFrame) -> Suffixes:
    """From all rows (url, cells, block); shares of blocked ones only from URLs that no tree is grown on.

    At most ``CELLS`` rows for each kind come to the driver.
    """
    told = F.col("block").isNotNull() & ~grown_on(F.col("url"))
    counted = (
        rows.select(F.posexplode("cells").alias("kind", "cell"), told.alias("told"), "block")
        .groupBy("kind", "cell")
        .agg(
            F.count("*").alias("n"),
            F.count_if("told").alias("told"),
            F.count_if(F.col("told") & F.col("block")).alias("blocked"),
        )
        .collect()
    )
    n, told, blocked = np.zeros((3, len(KINDS), CELLS))
    for row in counted:
        at = row["kind"], row["cell"]
        n[at], told[at], blocked[at] = row["n"], row["told"], row["blocked"]
    whole = max(1.0, float(n[0].sum()))
    share = (blocked[0].sum() + 1) / (told[0].sum() + 2)
    return Suffixes(np.log((n + 1) / whole), (blocked + 10 * share) / (told + 10))


def grown_on(url: Column) -> Column:
    """Whether a decided URL may serve to grow trees; the others give the shares of blocked suffixes."""
    return F.pmod(F.xxhash64(F.lit("trees"), url), F.lit(2)) == 0


def byte_counts(texts: Sequence[bytes]) -> np.ndarray:
    """Rows x 256."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    at = np.repeat(np.arange(len(texts)) * 256, sizes) + np.frombuffer(b"".join(texts), np.uint8)
    return np.bincount(at, minlength=256 * len(texts)).reshape(-1, 256)


def entropy(counts: np.ndarray) -> np.ndarray:
    """Bits per byte of each row; none for an empty one."""
    shares = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
    return -(shares * np.log2(np.where(shares > 0, shares, 1))).sum(axis=1)


def features(urls: Sequence[str], cells_of: np.ndarray, known: Suffixes) -> np.ndarray:
    """Rows x features of whole URLs (null: empty); ``cells_of`` is rows x kinds."""
    found = [PARTS.search(url) for url in urls]
    split = [m.groups() if m else ("", "", "", "") for m in found]
    host, path, query = [[part[i].encode() for part in split] for i in range(3)]
    whole = [url.encode() for url in urls]
    counts = [byte_counts(texts) for texts in (whole, host, path, query)]
    sizes = [c.sum(axis=1) for c in counts]
    columns = [np.log1p(size) for size in sizes]
    columns += [entropy(c) for c in counts]
    columns += [c[:, 48:58].sum(axis=1) / np.maximum(1, n) for c, n in zip(counts, sizes)]
    columns += [c[:, 65:91].sum(axis=1) / np.maximum(1, n) for c, n in zip(counts[:2], sizes)]
    columns += [c[:, list(VOWELS)].sum(axis=1) / np.maximum(1, n) for c, n in zip(counts[:2], sizes)]
    columns.append(counts[2][:, ord("/")])  # depth
    columns.append(np.array([sum(map(bool, re.split(b"[?&;]", q))) for q in query]))  # parameters
    columns.append(counts[3][:, ord("=")])
    columns.append(counts[1][:, ord(".")] + 1)  # labels of the host
    columns.append(np.array([max(map(len, h.split(b"."))) for h in host]))
    columns.append(np.array([max(map(len, p.split(b"/"))) for p in path]))
    columns.append(np.array([bool(part[3]) for part in split]))
    columns.append(np.array([url.startswith("https") for url in urls]))
    columns += list(counts[0][:, list(SIGNS)].T)
    columns += [counts[1][:, ord("-")]]
    kinds = np.arange(len(KINDS))
    columns += list(known.common[kinds, cells_of].T) + list(known.blocked[kinds, cells_of].T)
    return np.column_stack([np.asarray(column, float) for column in columns])


def train(rows: DataFrame, known: Suffixes, bound: int = LABELLED_URLS) -> Forest:
    """Trees from at most ``bound`` different decided URLs, those with the smallest hashes; without any all is allowed."""
    told = rows.filter(F.col("block").isNotNull())
    one = told.groupBy("url").agg(F.first("cells").alias("cells"), F.first("block").alias("block"))
    sample = smallest_hashes(one.filter(grown_on(F.col("url"))), "url", bound).toArrow().sort_by("url")
    if not sample.num_rows:  # the few there are all went to the suffixes
        sample = smallest_hashes(one, "url", bound).toArrow().sort_by("url")
    if not sample.num_rows:
        return constant(0.0)
    at = np.array(sample["cells"].to_pylist(), int)
    return fit(features(sample["url"].to_pylist(), at, known), sample["block"].to_numpy().astype(float))


def score(model: Forest, known: Suffixes, url: Column, cells_of: Column) -> Column:
    """How likely a URL is one to block, from 0 to 1."""

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for urls, places in batches:
            scores = [np.zeros(0)]
            for at in range(0, len(urls), ROWS_AT_ONCE):
                some = urls.iloc[at : at + ROWS_AT_ONCE]
                where = np.stack(places.iloc[at : at + ROWS_AT_ONCE].to_numpy())
                scores.append(model.scores(features(some.tolist(), where, known)))
            yield pd.Series(np.concatenate(scores))

    return run(url, cells_of)


def judge(pages: DataFrame, rules: Sequence[Rule], bound: int = LABELLED_URLS) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row of ``pages`` (page_id, url).

    ``host`` and ``path`` are empty for a null url and for one without ``://``; no rule fits an empty host. ``rule`` is the
    name of the longest rule that fits, ``verdict`` is allow or block: the rule's, else block from a ``score`` of
    ``BLOCKED`` up. A null url is scored as an empty one. Without URLs that rules decide all others are allowed, with
    decisions of one kind only they get that kind. Repeated rows give repeated rows; other columns are left aside. The
    rules become part of the plan, so they are a list of at most some hundreds.
    """
    if any(not rule.host for rule in rules):
        raise ValueError("a rule needs a host")
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    name, block = deciding(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", name.alias("rule"), block.alias("block"), cells(F.col("host"), F.col("path")).alias("cells"))
    known = suffix_statistics(rows.select("url", "cells", "block"))
    model = train(rows.select("url", "cells", "block"), known, bound)
    scored = rows.withColumn("score", score(model, known, F.col("url"), F.col("cells")))
    blocked = F.coalesce("block", F.col("score") >= BLOCKED)
    verdict = F.when(blocked, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
