"""Connected components of a table of links, by alternating large-star and small-star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r.n, r.h


def components(links: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(node, label) for every node of ``links(a, b)``; the label is the smallest node of the component.

    Nodes without a link do not appear. Each contraction is a few aggregations and equi-joins on a node; only its links are
    written, so the state never exceeds the links. Loops (a = b), repeats and nulls are ignored.
    """
    links = links.select("a", "b").filter("a <> b")
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = scratch.keep(links, "links")
    before = _state(links)
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # now every link leads to a smaller node
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        links = scratch.keep(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
