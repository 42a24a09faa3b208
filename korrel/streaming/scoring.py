"""Candidate files as a stream: pairs are scored as files arrive, against static entity tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import features, models
from ..sources.scratch import kept

SCHEMA = "source1_entity_id string, candidate_entity_ids string"


def pair_stream(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """Pairs (s1_id, cand_id) of grouped candidate files in a folder; blank ids and lists are skipped, repeats stay."""
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).csv(folder, sep="\t", header=True, quote="")
    each = F.explode(F.filter(F.transform(F.split("candidate_entity_ids", ","), lambda x: F.trim(x)), lambda x: x != ""))
    return rows.filter("trim(source1_entity_id) <> ''").select(F.trim("source1_entity_id").alias("s1_id"), each.alias("cand_id"))


def score_stream(pairs: DataFrame, model: PipelineModel, left: DataFrame, right: DataFrame, threshold: float, out: str, checkpoint: str) -> StreamingQuery:
    """Write matches of a stream of pairs to Parquet, exactly once per file. Entities are prepared once and joined in each batch."""
    left, right = kept(features.prepare(left), "left"), kept(features.prepare(right), "right")
    columns = features.columns()

    def batch(rows: DataFrame, number: int) -> None:
        scored = models.score(model, features.attach(rows, left, right).select("s1_id", "cand_id", *(c.alias(n) for n, c in columns.items())))
        scored.filter(F.col("prob") >= F.lit(float(threshold))).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return pairs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
