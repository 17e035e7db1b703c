"""Connected components of a graph given as links, by shrinking it to stars."""

from pyspark.sql import DataFrame, functions as F

from legtrail.session import Scratch, staged


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))")).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), root the smallest node it can reach.

    Rounds go on until nothing changes (all stars). Groups are only reduced to a minimum, so a node with many links is no
    large group; every round is written to the shared folder, which cuts the lineage, and the one before is removed.
    Links that hold a null, and links of a node to itself, do not count.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = links.filter("a is not null and b is not null and a > b").distinct()
    old, new = None, Scratch(links.sparkSession)
    try:
        links = new.staged(links, "links")
        before, state = None, _state(links)
        while state[0] and state != before:
            old, new = new, Scratch(links.sparkSession)
            links = new.staged(shrunk(links), "links")
            old.remove()
            before, state = state, _state(links)
        ends = [links.select(F.col(end).alias("node"), F.col("b").alias("root")) for end in ("a", "b")]
        return staged(ends[0].unionByName(ends[1]).distinct(), "components")
    finally:
        new.remove()


def shrunk(links: DataFrame) -> DataFrame:
    """One round: the larger neighbours of each node hang on its smallest neighbour, then the smaller ones."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    hung = both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    hung = hung.filter("a > b").distinct()
    lowest = hung.groupBy("a").agg(F.min("b").alias("low"))
    moved = hung.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a > b")
    return moved.unionByName(lowest.select("a", F.col("low").alias("b"))).distinct()
