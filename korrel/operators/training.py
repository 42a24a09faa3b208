"""Training pairs, labels, the grouped split and class weights. Every choice is by a hash of ids, so reruns agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.scratch import kept

NEGATIVES, HARD, BUCKET, VALIDATION = 1.5, 0.7, 25, 0.2
#: Targets that hard negatives are looked for among, at most.
SAMPLE = 150_000


def shuffled(*ids: str, seed: str = "") -> Column:
    """A sort key that is random but fixed."""
    return F.md5(F.concat_ws("|", F.lit(seed), *ids))


def label(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """``pairs(s1_id, cand_id, …)`` with label 1 for a true link ``truth(s1_id, target_id)``, else 0."""
    true = truth.select("s1_id", F.col("target_id").alias("cand_id"), F.lit(1).alias("hit")).distinct()
    return pairs.join(true, ["s1_id", "cand_id"], "left").select(*pairs.columns, F.coalesce("hit", F.lit(0)).alias("label"))


def positives(truth: DataFrame, s1: DataFrame, targets: DataFrame, cap: int) -> DataFrame:
    """At most ``cap`` true links whose ids exist, in hash order."""
    held = truth.select("s1_id", F.col("target_id").alias("cand_id")).distinct()
    held = held.join(s1.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi").join(targets.select(F.col("entity_id").alias("cand_id")), "cand_id", "left_semi")
    return held.orderBy(shuffled("s1_id", "cand_id"), "s1_id", "cand_id").limit(cap).select("s1_id", "cand_id")


def hard_negatives(s1: DataFrame, targets: DataFrame, truth: DataFrame, quota: int, bucket: int = BUCKET, sample: int = SAMPLE) -> DataFrame:
    """Untrue pairs that share the first token of the cleaned name, among ``sample`` targets; a token keeps ``bucket`` of them."""
    targets = targets.orderBy(shuffled("entity_id", seed="sample"), "entity_id").limit(sample)
    key = F.get(F.split(T.clean(F.col("business_name")), " "), 0)
    held = targets.select(F.col("entity_id").alias("cand_id"), key.alias("token")).filter("token <> ''")
    held = held.withColumn("nth", F.row_number().over(W.partitionBy("token").orderBy(shuffled("cand_id"), "cand_id"))).filter(F.col("nth") <= bucket)
    asking = s1.select(F.col("entity_id").alias("s1_id"), key.alias("token")).filter("token <> ''")
    pairs = asking.join(held.select("token", "cand_id"), "token").select("s1_id", "cand_id")
    pairs = pairs.join(truth.select("s1_id", F.col("target_id").alias("cand_id")), ["s1_id", "cand_id"], "left_anti")
    return pairs.orderBy(shuffled("s1_id", "cand_id", seed="hard"), "s1_id", "cand_id").limit(quota)


def _numbered(ids: DataFrame, name: str) -> DataFrame:
    """Distinct ids with numbers from 0, in hash order, without one global sort: shards are numbered, then ids within them."""
    shard = F.pmod(F.xxhash64(name), F.lit(max(1, ids.count() // 4096)))
    ids = ids.withColumn("shard", shard)
    sizes = ids.groupBy("shard").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(W.orderBy("shard")) - F.col("n")).select("shard", "before")
    nth = F.row_number().over(W.partitionBy("shard").orderBy(shuffled(name), name))
    return ids.withColumn("nth", nth).join(before, "shard").select(name, (F.col("before") + F.col("nth") - 1).alias(f"{name}_at"))


def soft_negatives(s1: DataFrame, targets: DataFrame, truth: DataFrame, seen: DataFrame, quota: int) -> DataFrame:
    """``quota`` untrue, unseen pairs of random entities and targets; fewer only where there are no more.

    Pairs are drawn by numbers, twice as many in each turn as in the one before, until there are enough. Where all pairs are few,
    all are drawn. So it always ends, and what is drawn is in proportion to the quota.
    """
    left = kept(_numbered(s1.select(F.col("entity_id").alias("s1_id")).distinct(), "s1_id"), "left")
    right = kept(_numbered(targets.select(F.col("entity_id").alias("cand_id")).distinct(), "cand_id"), "right")
    n, m = left.count(), right.count()
    true = truth.select("s1_id", F.col("target_id").alias("cand_id")).unionByName(seen.select("s1_id", "cand_id")).distinct()
    draws = 2 * quota + 64
    while True:
        every = n * m <= 2 * draws
        i = F.col("id")
        numbers = s1.sparkSession.range(n * m if every else draws)
        if every:
            numbers = numbers.select((i / max(m, 1)).cast("long").alias("s1_id_at"), F.pmod(i, F.lit(max(m, 1))).alias("cand_id_at"), i)
        else:
            numbers = numbers.select(F.pmod(F.xxhash64(i, F.lit("a")), F.lit(n)).alias("s1_id_at"), F.pmod(F.xxhash64(i, F.lit("b")), F.lit(m)).alias("cand_id_at"), i)
        pairs = numbers.join(left, "s1_id_at").join(right, "cand_id_at").select("s1_id", "cand_id").distinct().join(true, ["s1_id", "cand_id"], "left_anti")
        pairs = kept(pairs.orderBy(shuffled("s1_id", "cand_id", seed="soft"), "s1_id", "cand_id").limit(max(quota, 0)), "soft")
        if every or pairs.count() >= quota:
            return pairs
        draws *= 2


def training_pairs(truth: DataFrame, s1: DataFrame, targets: DataFrame, samples: int = 50_000) -> DataFrame:
    """Labelled pairs (s1_id, cand_id, label): true links, and hard and soft negatives of their entities, one and a half times as many.

    What the hard negatives lack of their share the soft ones fill. At most ``samples`` / 2 true links are taken.
    """
    good = kept(positives(truth, s1, targets, samples // 2), "good")
    quota = int(good.count() * NEGATIVES)
    own = s1.join(good.select(F.col("s1_id").alias("entity_id")).distinct(), "entity_id", "left_semi")
    hard = kept(hard_negatives(own, targets, truth, int(quota * HARD)), "hard")
    soft = soft_negatives(own, targets, truth, hard, quota - hard.count())
    bad = hard.unionByName(soft).withColumn("label", F.lit(0))
    return good.withColumn("label", F.lit(1)).unionByName(bad)


def split(pairs: DataFrame, share: float = VALIDATION) -> DataFrame:
    """``pairs`` with ``validation``: whole S1 entities, the first share of them in hash order."""
    ids = pairs.select("s1_id").distinct().withColumn("h", shuffled("s1_id", seed="split"))
    # an exact share without one global sort: entities are counted by the first hash digits, and only one of those groups is cut
    head = F.substring("h", 1, 4)
    counts = ids.groupBy(head.alias("head")).agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(W.orderBy("head")) - F.col("n")).withColumn("total", F.sum("n").over(W.partitionBy()))
    placed = ids.withColumn("head", head).join(before, "head")
    nth = F.row_number().over(W.partitionBy("head").orderBy("h", "s1_id")) + F.col("before")
    chosen = placed.withColumn("validation", nth <= F.floor(F.col("total") * share)).select("s1_id", "validation")
    return pairs.join(chosen, "s1_id")


def class_weights(labelled: DataFrame) -> DataFrame:
    """(label, n, weight): weights that balance the classes."""
    counts = labelled.groupBy("label").agg(F.count("*").alias("n"))
    every = W.partitionBy()
    return counts.select("label", "n", (F.sum("n").over(every) / (F.count("*").over(every) * F.col("n"))).alias("weight"))
