"""Entities, true links and a business fixture for the queries, derived from the tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import blocking, features
from ..sources.scratch import kept

#: Hand-made rows: designators, states, suffixes, null words, accents, digit runs.
BUSINESS = (
    ("S1-1", "Acme Technologies, Inc.", "12 North Main Street, Suite 4", "United States"),
    ("S2-1", "ACME Tech Inc", "12 N Main St Ste 4", "usa"),
    ("S3-1", "Acme Technology Holdings LLC", "12 Main Road", "US"),
    ("S1-2", "Smith & Sons Company", "5 Oak Avenue, Raleigh North Carolina 27601", "USA"),
    ("S2-2", "Smith and Sons Co", "5 Oak Ave Raleigh NC 27601", "United Kingdom"),
    ("S1-3", "Co Ltd", None, "India"),
    ("S2-3", "null", "77 Lake Rd", None),
    ("S3-3", "", "No digits here", "Great Britain"),
    ("S1-4", "New York Center of York", "New York, New York", "U.S.A."),
    ("S3-4", "Café_1 Brothers PLC", "12_3 A4 56-78", "Deutschland"),
    ("S2-5", "Private Group plc", "9 st nr park", "in"),
    ("S1-5", "  Universal   Enterprises\tInternational  ", "1 West Virginia Way, Building 2, Floor 3", "none"),
    ("S2-6", "Northern Solutions Limited Company Inc", "44 Southeast Parkway, Rhode Island", "Japan"),
    ("S3-6", "NaN", "nan", "NULL"),
)
COLUMNS = ("entity_id", "business_name", "business_address", "country")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def business(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(BUSINESS), ", ".join(f"{c} string" for c in COLUMNS))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the documents as each source: words 1-5 are the name, 6-14 the address, the language is the country.

    The entities are written once and read from there, so that a query with many branches reads the texts once.
    """
    source = F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"))
    words = T.first_words(F.col("text"), 30)
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", source.alias("source"), words.alias("w"))
    rows = rows.select(
        "source",
        F.concat("source", F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        F.array_join(F.slice("w", 1, 5), " ").alias("business_name"),
        F.array_join(F.slice("w", 6, 9), " ").alias("business_address"),
        F.col("lang").alias("country"),
        F.when(F.size("w") >= 30, F.array_join(F.slice("w", 15, 16), " ")).alias("same"),
        F.col("doc_id").alias("ord"),
    )
    return kept(rows, "entities")


def s1(ents: DataFrame) -> DataFrame:
    return ents.filter("source = 'S1'")


def targets(ents: DataFrame) -> DataFrame:
    return ents.filter("source <> 'S1'")


def truth(ents: DataFrame) -> DataFrame:
    """Links of one country whose words 15-30 agree."""
    left = s1(ents).select("country", "same", F.col("entity_id").alias("s1_id"))
    right = targets(ents).select("country", "same", F.col("entity_id").alias("target_id"))
    return left.join(right, ["country", "same"]).select("s1_id", "target_id")


def scored(ents: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """(s1_id, cand_id, prob) of the pairs, by default of the blocking candidates, with a fixed score of three set similarities; written once."""
    pairs = blocking.candidates(ents, 25) if pairs is None else pairs
    names = ("name_jaccard_word", "addr_jaccard_word", "name_jaccard_char_3gram")
    f = features.pair_features(pairs, s1(ents), targets(ents), names)
    return kept(f.select("s1_id", "cand_id", (0.4 * F.col(names[0]) + 0.4 * F.col(names[1]) + 0.2 * F.col(names[2])).alias("prob")), "scored")
