"""Match results, one row for each S1 entity, and the checks on candidates and results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CANDIDATE_COLUMNS = ["source1_entity_id", "candidate_entity_ids"]


def matches(scored: DataFrame, threshold: float) -> DataFrame:
    """``scored(s1_id, cand_id, prob)`` at or above the threshold."""
    return scored.filter(F.col("prob") >= F.lit(float(threshold)))


def assemble(s1: DataFrame, matched: DataFrame) -> DataFrame:
    """source1_entity_id and its matches by falling probability, ties by id, each once; empty if it has none."""
    one = matched.groupBy("s1_id", "cand_id").agg(F.max("prob").alias("prob"))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("prob")).alias("order"), F.col("cand_id").alias("id"))))
    lists = one.groupBy("s1_id").agg(F.array_join(F.transform(ranked, lambda x: x["id"]), ",").alias("matched_entity_ids"))
    ids = s1.select(F.col("entity_id").alias("source1_entity_id")).distinct()
    out = ids.join(lists, F.col("source1_entity_id") == F.col("s1_id"), "left").select("source1_entity_id", F.coalesce("matched_entity_ids", F.lit("")).alias("matched_entity_ids"))
    return out.orderBy("source1_entity_id")


def summary(results: DataFrame) -> DataFrame:
    has = F.col("matched_entity_ids") != ""
    return results.agg(F.count("*").alias("entities"), F.count_if(has).alias("with_match"), F.count_if(~has).alias("without_match"))


def long_matches(results: DataFrame) -> DataFrame:
    """(s1_id, target_id) of result rows."""
    each = F.explode(F.filter(F.split("matched_entity_ids", ","), lambda x: x != ""))
    return results.select(F.col("source1_entity_id").alias("s1_id"), each.alias("target_id"))


def check_candidates(candidates: DataFrame, truth_ids: DataFrame) -> DataFrame:
    """Rule and number of violations, for a grouped candidate table and the S1 ids that must be in it."""
    wrong = int(candidates.columns != CANDIDATE_COLUMNS)
    ids = candidates.select(F.col(candidates.columns[0]).alias("s1_id"))
    doubles = ids.agg(F.lit("duplicate_s1").alias("rule"), (F.count("s1_id") - F.count_distinct("s1_id")).alias("violations"))
    missing = truth_ids.select("s1_id").distinct().join(ids, "s1_id", "left_anti").agg(F.lit("missing_s1").alias("rule"), F.count("*").alias("violations"))
    columns = candidates.sparkSession.range(1).select(F.lit("columns").alias("rule"), F.lit(wrong).cast("long").alias("violations"))
    return columns.unionByName(doubles).unionByName(missing)


def check_results(results: DataFrame, s1: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rule and number of violations of results: repeated or missing S1 ids, wrong prefixes, matches that are no candidates."""
    own = long_matches(results)
    doubles = results.agg(F.lit("duplicate_s1").alias("rule"), (F.count("source1_entity_id") - F.count_distinct("source1_entity_id")).alias("violations"))
    prefix = own.agg(F.lit("bad_prefix").alias("rule"), F.count_if(~(F.startswith("target_id", F.lit("S2-")) | F.startswith("target_id", F.lit("S3-")))).alias("violations"))
    outside = own.join(pairs.select("s1_id", F.col("cand_id").alias("target_id")), ["s1_id", "target_id"], "left_anti").agg(F.lit("outside_candidates").alias("rule"), F.count("*").alias("violations"))
    missing = s1.select(F.col("entity_id").alias("source1_entity_id")).distinct().join(results, "source1_entity_id", "left_anti").agg(F.lit("missing_s1").alias("rule"), F.count("*").alias("violations"))
    return doubles.unionByName(prefix).unionByName(outside).unionByName(missing)
