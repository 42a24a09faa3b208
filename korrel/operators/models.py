"""Match classifiers on Spark ML: a factory by name, fitting with balanced classes, scoring, saving with a threshold."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import filesystem
from .features import NAMES
from .training import class_weights

#: Names that mean the same kind of model.
KINDS = {"random_forest": "random_forest", "rf": "random_forest", "randomforest": "random_forest", "lightgbm": "lightgbm", "lgb": "lightgbm", "gradient_boosting": "gradient_boosting", "gb": "gradient_boosting"}


def estimator(kind: str, trees: int | None = None, depth: int | None = None, seed: int = 42):
    """An untrained classifier. Leaf-wise boosting has no counterpart in Spark ML: depth-wise boosted trees stand in for it."""
    name = KINDS.get(kind.lower())
    if name is None:
        raise ValueError(f"unknown model type {kind!r}")
    common = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight", "seed": seed}
    if name == "random_forest":
        return RandomForestClassifier(numTrees=trees or 100, maxDepth=depth or 14, minInstancesPerNode=2, **common)
    if name == "lightgbm":
        return GBTClassifier(maxIter=trees or 150, stepSize=0.08, maxDepth=min(depth or 8, 10), **common)
    return GBTClassifier(maxIter=100, stepSize=0.1, maxDepth=5, **common)


def fit(labelled: DataFrame, kind: str = "random_forest", trees: int | None = None, depth: int | None = None, names: tuple[str, ...] = NAMES, seed: int = 42) -> PipelineModel:
    """A model of ``labelled(label, features…)``; classes are balanced but for plain gradient boosting."""
    weights = class_weights(labelled).select("label", "weight")
    rows = labelled.join(F.broadcast(weights), "label")  # one row for each class
    if KINDS.get(kind.lower()) == "gradient_boosting":
        rows = rows.withColumn("weight", F.lit(1.0))
    return Pipeline(stages=[VectorAssembler(inputCols=list(names), outputCol="features"), estimator(kind, trees, depth, seed)]).fit(rows)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` with ``prob``, the likelihood of a match."""
    kept = [c for c in rows.columns if c not in NAMES]
    return model.transform(rows).select(*kept, vector_to_array("probability")[1].alias("prob"))


def importances(model: PipelineModel, spark: SparkSession, names: tuple[str, ...] = NAMES) -> DataFrame:
    """(position, feature, importance) in the order of the features; empty if the model has none."""
    values = getattr(model.stages[-1], "featureImportances", None)
    rows = [] if values is None else [(i, n, float(values[i])) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "position int, feature string, importance double")


def save(model: PipelineModel, path: str, threshold: float, kind: str, params: dict | None = None) -> None:
    """The model, and beside it a record of its kind, features, parameters and threshold."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/model")
    side = json.dumps({"model_type": KINDS[kind.lower()], "threshold": threshold, "feature_names": list(NAMES), "model_params": params or {}, "is_fitted": True})
    spark.createDataFrame([(side,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/sidecar")


def load(path: str) -> tuple[PipelineModel, dict]:
    """A saved model and its record; a path without one is an error."""
    spark = SparkSession.active()
    p, fs = filesystem(spark, f"{path}/sidecar")
    if not fs.exists(p):
        raise FileNotFoundError(path)
    side = json.loads(spark.read.text(f"{path}/sidecar").first().value)
    return PipelineModel.load(f"{path}/model"), side


def threshold(given: float | None, config: dict | None, stored: dict | None) -> float:
    """The threshold to use: the given one, else the configuration's, else the model's; a stored 0 counts as unset."""
    if given is not None:
        return given
    if config and config.get("selected_threshold") is not None:
        return float(config["selected_threshold"])
    return float((stored or {}).get("threshold") or 0.5)


def rounded(metrics: dict, beta: float = 0.5) -> dict:
    """A row of rates as the threshold record holds it: rates of four places, counts."""
    return {"threshold": metrics["threshold"], **{n: round(metrics[c], 4) for n, c in (("precision", "precision"), ("recall", "recall"), (f"f{beta}", "f_beta"), ("f1", "f1"))}, **{n: int(metrics[n]) for n in ("tp", "fp", "fn", "tn")}}


def write_threshold(path: str, best: dict, default: dict, kind: str, train: int, validation: int, beta: float = 0.5) -> dict:
    """Write the threshold record as JSON; folders are made. Two rows of rates and some counts: the driver writes it."""
    record = {
        "selected_threshold": best["threshold"], "metric_optimized": f"F{beta}", "validation_metrics": rounded(best, beta), "default_metrics": rounded(default, beta),
        "model_type": KINDS[kind.lower()], "num_train_pairs": train, "num_val_pairs": validation,
    }
    p, fs = filesystem(SparkSession.active(), path)
    fs.mkdirs(p.getParent())
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(record, indent=2).encode()))
    out.close()
    return record


def read_threshold(path: str) -> dict | None:
    """A threshold record; none where there is no such file."""
    spark = SparkSession.active()
    p, fs = filesystem(spark, path)
    if not fs.exists(p):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first().value)
