"""Readers and writers of the tab-separated tables: entities, true links, candidates, results."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scratch

SEARCH = (".", "models", "output", "dataset/train", "dataset/test", "dataset")


def resolve(name: str, search_dirs: tuple[str, ...] | list[str] = (), must_exist: bool = True) -> str:
    """The path as it is, or its base name in the given and the usual folders; a path of another file system as it is."""
    if "://" in name:
        return name
    if os.path.exists(name):
        return name
    for folder in (*search_dirs, *SEARCH):
        path = os.path.join(folder, os.path.basename(name))
        if os.path.exists(path):
            return path
    if must_exist:
        raise FileNotFoundError(name)
    return name


def lines(spark: SparkSession, path: str) -> DataFrame:
    """All cells as text, without quoting; blank lines skipped, short lines filled with nulls.

    ``ord`` follows the files: their paths, then the places in them.
    """
    table = spark.read.csv(path, sep="\t", header=True, quote="", mode="PERMISSIVE", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return table.select(*(F.col(f"`{c}`").alias(c.strip().lower()) for c in table.columns), place.alias("ord"))


def header(spark: SparkSession, path: str) -> list[str]:
    """The column names of a file, as they stand there: its first line alone is read. A missing path is an error."""
    p, fs = scratch.filesystem(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    return spark.read.csv(path, sep="\t", header=True, quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).columns


def preview(table: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` rows, by ``ord`` where there is one, else by file and row."""
    if "ord" in table.columns:
        return table.orderBy("ord").limit(n).drop("ord")
    return table.limit(n)


def combined(first: DataFrame, second: DataFrame, key: str = "entity_id", keep: str = "first") -> DataFrame:
    """Rows of both tables, one for each key: of a key in both, that of the table named by ``keep`` (first or second)."""
    others = [c for c in first.columns if c != key]
    rank = {"first": (0, 1), "second": (1, 0)}[keep]
    both = first.withColumn("_rank", F.lit(rank[0])).unionByName(second.select(*first.columns).withColumn("_rank", F.lit(rank[1])))
    one = both.groupBy(key).agg(F.min_by(F.struct(*others), "_rank").alias("r"))
    return one.select(key, *(F.col(f"r.{c}") for c in others))


def last_rows(table: DataFrame, key: str) -> DataFrame:
    """The last row of each key."""
    others = [c for c in table.columns if c not in (key, "ord")]
    return table.groupBy(key).agg(F.max_by(F.struct(*others, F.lit(0).alias("_")), "ord").alias("r"), F.max("ord").alias("ord")).select(key, *(F.col(f"r.{c}") for c in others), "ord")


def entities(table: DataFrame, max_rows: int | None = None) -> DataFrame:
    """entity_id, business_name, business_address, country, ord: cells trimmed, empty ids out, the last row of an id.

    Only entity_id must be there; other columns are null where they are missing. ``max_rows`` keeps the first distinct ids.
    """
    if "entity_id" not in table.columns:
        raise ValueError("no column entity_id")
    cells = [F.trim(F.col(c)).alias(c) if c in table.columns else F.lit(None).cast("string").alias(c) for c in ("entity_id", "business_name", "business_address", "country")]
    order = F.col("ord") if "ord" in table.columns else F.monotonically_increasing_id().alias("ord")
    out = last_rows(table.select(*cells, order).filter("entity_id <> ''"), "entity_id")
    return out if max_rows is None else out.orderBy("ord", "entity_id").limit(max_rows)


def truth_columns(names: list[str]) -> tuple[str, str]:
    """Which columns of a table of true links hold the id and the list."""
    one = [n for n in names if "source1" in n or n in ("s1_id", "entity_id")]
    two = [n for n in names if n not in one and any(x in n for x in ("matched", "match", "target"))]
    return (one[-1], two[-1]) if one and two else (names[0], names[1])


def split_list(x: Column) -> Column:
    """Distinct non-empty items of a comma list, trimmed, in order."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), ","), lambda t: F.trim(t)), lambda t: t != ""))


def truth(table: DataFrame) -> DataFrame:
    """s1_id and its matched ids as an array; entities without matches stay with an empty one."""
    names = [c for c in table.columns if c != "ord"]
    one, two = truth_columns(names)
    order = F.col("ord") if "ord" in table.columns else F.monotonically_increasing_id().alias("ord")
    rows = table.select(F.trim(F.col(one)).alias("s1_id"), F.col(two).alias("ids"), order).filter("s1_id <> ''")
    return last_rows(rows, "s1_id").select("s1_id", split_list(F.col("ids")).alias("matched_entity_ids"))


def exploded(table: DataFrame, ids: str = "matched_entity_ids", to: str = "target_id") -> DataFrame:
    return table.select("s1_id", F.explode(ids).alias(to))


def pair_columns(names: list[str]) -> tuple[str, str]:
    if len(names) < 2:
        raise ValueError("a candidate table has two columns")
    one = next((n for n in names if "source1" in n or "s1" in n), names[0])
    two = next((n for n in names if n != one and any(x in n for x in ("candidate", "target", "s2", "s3", "match"))), next(n for n in names if n != one))
    return one, two


def pairs(table: DataFrame, max_pairs: int | None = None) -> DataFrame:
    """Distinct pairs (s1_id, cand_id) of a grouped or pairwise table; candidates of S1 itself are dropped."""
    one, two = pair_columns([c for c in table.columns if c != "ord"])
    order = F.col("ord") if "ord" in table.columns else F.monotonically_increasing_id().alias("ord")
    rows = table.select(F.trim(F.col(one)).alias("s1_id"), F.posexplode(split_list(F.col(two))).alias("pos", "cand_id"), order).filter("s1_id <> ''")
    rows = rows.filter(~F.startswith("cand_id", F.lit("S1-"))).groupBy("s1_id", "cand_id").agg(F.min(F.struct("ord", "pos")).alias("first"))
    if max_pairs is not None:
        rows = rows.orderBy("first", "s1_id", "cand_id").limit(max_pairs)
    return rows.select("s1_id", "cand_id")


def queried(table: DataFrame) -> DataFrame:
    """S1 ids of a candidate table, those without candidates too."""
    one, _ = pair_columns([c for c in table.columns if c != "ord"])
    return table.select(F.trim(F.col(one)).alias("s1_id")).filter("s1_id <> ''").distinct()


def profile(table: DataFrame, name: str) -> DataFrame:
    """Rows, columns and their types (of text files as inferred, where the table was read so) of a table, as one row."""
    columns = [f for f in table.schema.fields if f.name != "ord"]
    return table.agg(
        F.lit(name).alias("table_name"),
        F.count("*").alias("rows"),
        F.lit(len(columns)).cast("long").alias("n_columns"),
        F.lit(",".join(f.name for f in columns)).alias("columns"),
        F.lit(",".join(f.dataType.simpleString() for f in columns)).alias("types"),
    )


def inferred(spark: SparkSession, path: str) -> DataFrame:
    """A file with the types that its cells fit, as a look at the data needs them."""
    return spark.read.csv(path, sep="\t", header=True, inferSchema=True)


def write(table: DataFrame, path: str) -> None:
    """Tab-separated text with a header, a file for each partition."""
    table.write.csv(path, sep="\t", header=True, quote="", escapeQuotes=False, emptyValue="", mode="overwrite")


def write_one(table: DataFrame, path: str) -> str:
    """One tab-separated file with a header and newline ends, rows in the order of ``table``; folders are made.

    Rows are written as parts by the executors; the driver then joins the parts' bytes, a buffer at a time, so no task and no
    memory ever holds the whole table.
    """
    spark = table.sparkSession
    where = f"{scratch.root(spark)}/parts-{uuid.uuid4().hex}"
    cells = F.concat_ws("\t", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in table.columns))
    table.select(cells.alias("value")).write.text(where, lineSep="\n")
    target, fs = scratch.filesystem(spark, path if "://" in path else "file://" + os.path.abspath(path))
    folder, parts = scratch.filesystem(spark, where)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs.mkdirs(target.getParent())
    raw = fs.getRawFileSystem() if hasattr(fs, "getRawFileSystem") and target.toUri().getScheme() == "file" else fs  # no checksum file beside it
    out = raw.create(target, True)
    try:
        out.write(bytearray(("\t".join(table.columns) + "\n").encode()))
        names = sorted(st.getPath().getName() for st in parts.listStatus(folder) if st.getPath().getName().startswith("part-"))
        for name in names:
            part = parts.open(jvm.org.apache.hadoop.fs.Path(folder, name))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
            part.close()
    finally:
        out.close()
        parts.delete(folder, True)
    return path
