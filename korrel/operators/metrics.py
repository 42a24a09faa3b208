"""Confusion counts, F-beta, the threshold sweep and entity metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Thresholds of the sweep: 86 of them, as a floating-point range makes them.
GRID = tuple(0.1 + i * ((0.1 + 0.01) - 0.1) for i in range(86))


def f_beta(p: Column, r: Column, beta: float = 0.5) -> Column:
    b2 = beta * beta
    return F.when((p <= 0) | (r <= 0), 0.0).otherwise((1 + b2) * p * r / (b2 * p + r))


def rates(counts: DataFrame, beta: float = 0.5) -> DataFrame:
    """``counts(…, tp, fp, fn)`` with precision, recall, f_beta and f1; 0 where a denominator is."""
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    counts = counts.withColumns({"precision": p, "recall": r})
    return counts.withColumns({"f_beta": f_beta(F.col("precision"), F.col("recall"), beta), "f1": f_beta(F.col("precision"), F.col("recall"), 1.0)})


def confusion(scored: DataFrame, threshold: float) -> DataFrame:
    """tp, fp, fn, tn of ``scored(prob, label)``; a score at the threshold counts as a match."""
    hit, true = F.col("prob") >= F.lit(float(threshold)), F.col("label") == 1
    return scored.agg(F.count_if(hit & true).alias("tp"), F.count_if(hit & ~true).alias("fp"), F.count_if(~hit & true).alias("fn"), F.count_if(~hit & ~true).alias("tn"))


def sweep(scored: DataFrame, beta: float = 0.5) -> DataFrame:
    """Counts and rates at every threshold of the grid, from one pass: scores fall into the grid's steps, which are summed from above."""
    grid = F.array(*(F.lit(t) for t in GRID))
    step = F.size(F.filter(grid, lambda t: t <= F.col("prob")))  # thresholds that the score reaches
    bins = scored.groupBy(step.alias("step")).agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg"))
    ids = scored.sparkSession.range(len(GRID) + 1).select(F.col("id").cast("int").alias("step"))
    bins = ids.join(F.broadcast(bins), "step", "left").fillna(0, ["pos", "neg"])  # at most 87 rows
    up, every = W.orderBy(F.desc("step")), W.partitionBy()
    rows = bins.select("step", F.sum("pos").over(up).alias("tp"), F.sum("neg").over(up).alias("fp"), F.sum("pos").over(every).alias("p"), F.sum("neg").over(every).alias("n"))
    rows = rows.filter("step > 0").select(F.get(grid, F.col("step") - 1).alias("threshold"), "tp", "fp", (F.col("p") - F.col("tp")).alias("fn"), (F.col("n") - F.col("fp")).alias("tn"))
    return rates(rows, beta)


def best(swept: DataFrame) -> DataFrame:
    """The threshold of the greatest F-beta after rounding to four places; of equals the lowest."""
    rounded = F.floor(F.col("f_beta") * 10000 + 0.5)
    return swept.withColumn("score", rounded / 10000).orderBy(F.desc(rounded), "threshold").limit(1)


def entity_metrics(truth: DataFrame, predicted: DataFrame, beta: float = 0.5) -> DataFrame:
    """Counts over all true and predicted links (s1_id, target_id), summed over entities, and their rates."""
    t = truth.select("s1_id", "target_id", F.lit(1).alias("t")).distinct()
    p = predicted.select("s1_id", "target_id", F.lit(1).alias("p")).distinct()
    both = t.join(p, ["s1_id", "target_id"], "full")
    counts = both.agg(F.count_if(F.col("t").isNotNull() & F.col("p").isNotNull()).alias("tp"), F.count_if(F.col("t").isNull()).alias("fp"), F.count_if(F.col("p").isNull()).alias("fn"))
    return rates(counts, beta)
