"""Mixing of sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Targets: sources in code-point order, null last, weigh 5, 2, 1, repeating, and share ``SHARE`` of all words; no target exceeds
``CAP`` times its source's size, and what is above is shared again by weight. That limit is reached at once: the target is the
lesser of the cap and weight x level, where the level follows from the sources in the order of cap per weight.

Documents: a source is first taken in whole epochs, as many as fit. For the rest each document draws the key Exp(1) / quality,
and documents are taken in the order of the keys until their sizes add up to what is missing; of the two prefixes around it
the nearer one is taken. Where the prefix ends is found without sorting a source: sizes are summed by cells of the key, then by
finer cells within the one that holds the end, and only the documents of one finer cell are put in order. The end (a key, a
doc_id, a row number) is one row for each source, so whether a document is taken is decided on its own row.

Texts are measured once: rows are written with what was measured, and all further passes read those columns.

Keys come from a hash of the seed and the doc_id, or of the row number where there is no id: reruns over the same files agree.
Quality falls with the share of symbol characters.

Cases: null and empty texts have size 0 and are never taken. A null source is a source. Rows with null ids have keys of their
own; rows that repeat an id share its key and are taken one by one, by text and row, as equal rows are. Without any word all
targets are 0; an empty table gives an empty one. Extra columns stay, but for those named like a result, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, fresh

WEIGHTS, SHARE, CAP = (5, 2, 1), 1.5, 2
#: Cells of the first pass for each unit of the key, the greatest such cell, and the cells of the second pass within one.
CELLS, LAST_CELL, FINER = 256, 65_536, 4_096
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_of(text: Column, size: Column) -> Column:
    """1 for plain text; less for each symbol character a word, at least 0.1."""
    symbols = F.coalesce(F.regexp_count(text, F.lit(r"[#$%&*|!<>{}=~^_\\]")), F.lit(0))
    return F.greatest(F.lit(0.1), F.lit(1.0) / (1.0 + 2.0 * symbols / F.greatest(size, F.lit(1))))


def uniform(doc_id: Column, seed: str, row: Column | None = None) -> Column:
    """A number in (0, 1) with 52 random bits, by the id, or by the row where that is null."""
    other = F.lit("") if row is None else F.concat(F.lit("row "), row.cast("string"))
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), other)))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def measured(docs: DataFrame, seed: str = "mix", quality: Column | None = None) -> DataFrame:
    """``docs`` with a struct column ``_m``: source name that is never null, size, key and the rest of the order."""
    (m,) = fresh(docs, "_m")
    text = F.col("text").cast("string")
    size = size_of(text)
    name = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    sized = docs.withColumn(m, F.struct(name.alias("name"), size.alias("size"), F.monotonically_increasing_id().alias("row")))
    row = F.col(f"{m}.row")
    key = -F.log(uniform(F.col("doc_id"), seed, row)) / (quality_of(text, F.col(f"{m}.size")) if quality is None else quality)
    rank = F.struct(key.alias("key"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id"), F.xxhash64(text).alias("tie"), row.alias("row"))
    return sized.withColumn(m, F.struct(F.col(f"{m}.name"), F.col(f"{m}.size"), rank.alias("rank"))), m


def targets(sizes: DataFrame) -> DataFrame:
    """``sizes(name, source_size)`` with the target of each source. One row for each source goes through one task."""
    order = W.orderBy(F.when(F.col("name") == "", 1).otherwise(0), "name")
    nth = F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS)))
    weight = F.lit(float(WEIGHTS[-1]))
    for i in reversed(range(len(WEIGHTS) - 1)):
        weight = F.when(F.col("nth") == i, float(WEIGHTS[i])).otherwise(weight)
    rows = sizes.withColumn("nth", nth).withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(CAP))
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), "name")
    everything = W.partitionBy()
    rows = (
        rows.withColumn("below", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("all", F.sum("source_size").over(everything))
        .withColumn("level", (F.col("all") * SHARE - F.col("below")) / F.col("open"))
        .withColumn("nth", F.row_number().over(by_ratio))
        .withColumn("level", F.min(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.struct("nth", "level"))).over(everything)["level"])
    )
    target = F.least(F.col("cap"), F.col("weight") * F.coalesce("level", F.lit(float("inf"))))
    return rows.select("name", "source_size", target.alias("target"))


def cells(key: Column) -> tuple[Column, Column]:
    coarse = F.least(F.floor(key * CELLS), F.lit(LAST_CELL)).cast("long")
    return coarse, F.floor((key * CELLS - coarse) * FINER).cast("long")


def _ending(rows: DataFrame, cell: str, before: str) -> DataFrame:
    """Of sums by (name, cell), the cell of each source in which the missing words are reached, and the sum before it."""
    order = W.partitionBy("name").orderBy(cell)
    rows = rows.withColumn("upto", F.col(before) + F.sum("words").over(order))
    rows = rows.filter("upto >= missing").withColumn("nth", F.row_number().over(order)).filter("nth = 1")
    return rows.select("name", "missing", cell, (F.col("upto") - F.col("words")).alias("before"))


def ends(base: DataFrame, scratch: Scratch) -> DataFrame:
    """A row for each source of ``base(name, size, rank)``: size, target, epochs, and the rank at which its selection ends."""
    sizes = base.groupBy("name").agg(F.sum("size").alias("source_size"))
    plan = targets(sizes).withColumn("epochs", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long"))
    plan = scratch.keep(plan.withColumn("missing", F.col("target") - F.col("epochs") * F.col("source_size")), "plan")
    coarse, fine = cells(F.col("rank.key"))
    placed = base.filter("size > 0").select("name", "size", "rank", coarse.alias("coarse"), fine.alias("fine"))
    open_ = plan.filter("missing > 0").select("name", "missing")
    first = placed.groupBy("name", "coarse").agg(F.sum("size").alias("words")).join(open_, "name")
    first = scratch.keep(_ending(first.withColumn("zero", F.lit(0.0)), "coarse", "zero"), "first")
    ending = placed.join(first.withColumnRenamed("before", "base"), ["name", "coarse"])
    second = ending.groupBy("name", "missing", "base", "fine").agg(F.sum("size").alias("words"))
    second = scratch.keep(_ending(second, "fine", "base").join(first.select("name", "coarse"), "name"), "second")
    last = placed.join(second, ["name", "coarse", "fine"])
    order = W.partitionBy("name").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    last = last.withColumn("upto", F.col("before") + F.sum("size").over(order))
    # up to the missing words, or one document more if that is nearer
    near = (F.col("upto") <= F.col("missing")) | (F.col("upto") - F.col("missing") < F.col("missing") - (F.col("upto") - F.col("size")))
    inside = last.filter(near).groupBy("name").agg(F.max("rank").alias("upto"))
    ended = second.select("name", F.col("coarse").alias("end_coarse"), F.col("fine").alias("end_fine")).join(inside, "name", "left")
    out = scratch.keep(plan.join(ended, "name", "left"), "ends")
    scratch.drop("plan", "first", "second")
    return out


def taken(size: Column, rank: Column, end: Column) -> Column:
    """Words that the mix takes of a document, given its source's end."""
    coarse, fine = cells(rank["key"])
    before = (coarse < end["end_coarse"]) | ((coarse == end["end_coarse"]) & (fine < end["end_fine"]))
    at_end = (coarse == end["end_coarse"]) & (fine == end["end_fine"]) & (rank <= end["upto"])
    chosen = F.coalesce(before | at_end, F.lit(False))
    return F.when(size > 0, size * (end["epochs"] + chosen.cast("long"))).otherwise(F.lit(0)).cast("long")


def mix(docs: DataFrame, scratch: Scratch, seed: str = "mix", quality: Column | None = None, narrow: bool = False) -> DataFrame:
    """``docs`` (with doc_id, text and source) with size, source_size, target and taken; ``narrow`` leaves the text out."""
    docs, m = measured(docs.drop("size", "source_size", "target", "taken"), seed, quality)
    docs = scratch.keep(docs.drop("text") if narrow else docs, "measured")
    own = [c for c in docs.columns if c != m]
    end = ends(docs.select(f"{m}.*"), scratch)
    (e,) = fresh(docs, "_end")
    joined = docs.join(end.select(F.struct(*end.columns).alias(e)), F.col(f"{m}.name") == F.col(f"{e}.name"))
    size = F.col(f"{m}.size")
    return joined.select(*own, size.alias("size"), F.col(f"{e}.source_size").alias("source_size"), F.col(f"{e}.target").alias("target"), taken(size, F.col(f"{m}.rank"), F.col(e)).alias("taken"))
