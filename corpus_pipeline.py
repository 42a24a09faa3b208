"""A corpus pipeline of five stages over ``documents``: each stage reads what the one before it has written.

Stages are functions of (spark, docs, sf_dir). All but the last return the columns of ``documents``; n_chars is kept true to the
text. Every row is a document of its own where a stage keeps one document of each group, whatever its doc_id.

Cases: a null text is read as an empty one; it is classified and kept or not like any other, it is no near copy of anything,
loses nothing to the cut (which makes it the empty text) and has size 0, so that the mix, which takes words, leaves it out. Null
ids, languages and sources are values of their own; rows that share or lack an id are told apart. An empty table gives an empty
one. Columns other than those of ``documents`` are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korrel.llm import mixing, neardup, pieces, quality, repeats
from korrel.llm.common import Scratch, read
from korrel.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.learn(docs, read(spark, sf_dir, "labels"), Scratch(spark, "keep-quality"))
    return quality.score(docs.select(*COLUMNS), model, "quality_score").filter(F.col("quality_score") >= quality.KEEP).select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near-duplicates, and no other row of it; a null id counts as the largest."""
    scratch = Scratch(spark, "keep-one")
    rows = scratch.keep(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = neardup.near_duplicates(rows.select("doc_id", "text", "_row"), scratch, row="_row")
    gone = scratch.keep(found.filter("not kept").select("_row"), "gone")
    return rows.join(gone, "_row", "left_anti").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated 200-byte strings; a character that loses some of its bytes goes whole, no other one does."""
    out = repeats.remove_repeats(docs.select(*COLUMNS), Scratch(spark, "cut-repeats"), spans_col="_spans", kept_col="_kept", as_text=True)
    return out.select("doc_id", F.col("_kept").alias("text"), "lang", "source").withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    mixed = mixing.mix(docs.select(*COLUMNS), Scratch(spark, "mix-sources"))
    times = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    return mixed.filter(times > 0).withColumn("_time", F.explode(F.sequence(F.lit(1), times))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document's text, and digests of them and of what they decode to."""
    coded = pieces.encode_decode(docs.select("doc_id", "text"), pieces.model_bytes(tokenizer_path()))
    return pieces.digests(coded, "ids")


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", keep_one_of_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

#: Trained classifiers and hashed signatures have no SQL form: the pipeline is tested against brute-force stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents").select(*COLUMNS)
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
