"""Bounded samples of labelled rows, and the fold that no model sees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Folds by checksum of the id's text; the rows of fold 0 are held out.
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a row is in the fold that is never learnt from; rows without an id are."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % FOLDS == 0


def sampled(rows: DataFrame, bound: int, salt: str = "") -> DataFrame:
    """About ``bound`` of ``rows`` with a doc_id, by a hash of the id; all of them if they are fewer."""
    n = rows.count()
    if n <= bound:
        return rows
    share = int(bound / n * (1 << 32))
    return rows.filter(F.crc32(F.concat(F.lit(salt + ":"), F.col("doc_id").cast("string")).cast("binary")) < share)


def learnable(labels: DataFrame, column: str, bound: int) -> DataFrame:
    """(doc_id, y) of at most about ``bound`` labelled rows outside the held-out fold; one row for each id."""
    rows = labels.select("doc_id", F.col(column).cast("int").alias("y")).filter("doc_id is not null and y is not null").filter(~held_out(F.col("doc_id")))
    return sampled(rows.groupBy("doc_id").agg(F.max("y").alias("y")), bound, column)
