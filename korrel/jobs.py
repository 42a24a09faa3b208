"""The stages of record linkage as jobs on tab-separated files: block, mock, train, predict, validate and look.

``python -m korrel JOB --help`` lists a job's options. Jobs read and write through Spark, so paths may be of any file system that
it knows; the driver holds counts, rates and records only.
"""

from __future__ import annotations

import argparse
import os
import subprocess
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import blocking, features, metrics, models, results, training
from .sources import tsv
from .sources.scratch import kept

TEST, OUTPUT = ("dataset/test", "."), ("output", "dataset/test", ".")


def _raw(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Rows of a source as they stand, for blocking: repeated ids stay."""
    table = tsv.lines(spark, path)
    cells = [F.col(c) if c in table.columns else F.lit(None).cast("string").alias(c) for c in ("entity_id", "business_name", "business_address", "country")]
    return table.select(F.lit(source).alias("source"), *cells, "ord").filter("entity_id is not null")


def block(spark: SparkSession, source1: str, source2: str, source3: str, out: str = "output/candidate_pairs.tsv", max_token_freq: int = 100, ground_truth: str | None = None) -> dict:
    """Candidate pairs of three sources, a line for each line of source 1 in its order; with true links, the recall ceiling."""
    s1 = kept(_raw(spark, source1, "S1"), "s1")
    ents = kept(s1.drop("ord").unionByName(_raw(spark, source2, "S2").drop("ord")).unionByName(_raw(spark, source3, "S3").drop("ord")), "entities")
    pairs = kept(blocking.candidates(ents, max_token_freq), "pairs")
    tsv.write_one(blocking.grouped(s1, pairs, "ord").orderBy("ord").drop("ord"), out)
    report = {"out": out, "countries": [r.asDict() for r in blocking.country_stats(s1, pairs).orderBy("country").collect()]}  # a row for each country
    if ground_truth:
        truth = tsv.exploded(tsv.truth(tsv.lines(spark, ground_truth)))
        report |= blocking.recall(truth, pairs).first().asDict()
    return report


def mock(spark: SparkSession, source1: str, source3: str, source2: str | None = None, out: str = "output/candidate_pairs.tsv", num_candidates: int = 5000) -> dict:
    """A candidate file by first tokens, to try the later jobs with."""
    s2 = tsv.resolve(source2, TEST, must_exist=False) if source2 else None
    s2 = tsv.entities(tsv.lines(spark, s2)) if s2 and ("://" in s2 or os.path.isfile(s2)) else None
    s1 = _raw(spark, tsv.resolve(source1, TEST), "S1").select("ord", F.trim("entity_id").alias("entity_id"), F.trim("business_name").alias("business_name"))
    table = kept(blocking.mock_candidates(s1, s2, tsv.entities(tsv.lines(spark, tsv.resolve(source3, TEST))), num_candidates), "mock")
    tsv.write_one(table.orderBy("ord", "source1_entity_id").drop("ord"), out)
    has = F.col("candidate_entity_ids") != ""
    counts = table.agg(F.count("*").alias("entities"), F.count_if(has).alias("with_candidates"), F.coalesce(F.sum(F.when(has, F.size(F.split("candidate_entity_ids", ",")))), F.lit(0)).alias("pairs"))
    return {"out": out, **counts.first().asDict()}


def train(
    spark: SparkSession, source1: str, source2: str, source3: str, ground_truth: str, output_model: str = "models/matching_model", output_threshold: str = "models/threshold_config.json",
    train_candidates: str | None = None, model_type: str = "random_forest", num_samples: int = 50_000, n_estimators: int = 100, max_depth: int = 14, val_ratio: float = training.VALIDATION, random_seed: int = 42,
) -> dict:
    """Fit a classifier on true links and negatives, choose its threshold on entities kept apart, save both."""
    s1 = kept(tsv.entities(tsv.lines(spark, source1)), "s1")
    two, three = (tsv.entities(tsv.lines(spark, p)) for p in (source2, source3))
    targets = kept(tsv.combined(two, three), "targets")
    truth = kept(tsv.exploded(tsv.truth(tsv.lines(spark, ground_truth))), "truth")
    if train_candidates:
        pairs = training.label(tsv.pairs(tsv.lines(spark, train_candidates), num_samples if num_samples > 0 else None), truth)
    else:
        pairs = training.training_pairs(truth, s1, targets, num_samples if num_samples > 0 else 50_000)
    pairs = kept(pairs, "pairs")
    rows = kept(training.split(pairs.join(features.pair_features(pairs, s1, targets), ["s1_id", "cand_id"]), val_ratio), "rows")
    params = {"n_estimators": n_estimators, "max_depth": max_depth, "random_state": random_seed}
    model = models.fit(rows.filter("not validation"), model_type, n_estimators, max_depth, seed=random_seed)
    scored = kept(models.score(model, rows.filter("validation")).select("prob", "label"), "scored")
    best = metrics.best(metrics.sweep(scored)).first().asDict()
    default = metrics.rates(metrics.confusion(scored, 0.5)).withColumn("threshold", F.lit(0.5)).first().asDict()
    sizes = {r.validation: r["count"] for r in rows.groupBy("validation").count().collect()}
    models.save(model, output_model, best["threshold"], model_type, params)
    record = models.write_threshold(output_threshold, best, default, model_type, sizes.get(False, 0), sizes.get(True, 0))
    top = [(r.feature, r.importance) for r in models.importances(model, spark).orderBy(F.desc("importance"), "position").limit(10).collect()]
    return {**record, "model": output_model, "importances": top}


def predict(
    spark: SparkSession, source1: str, source3: str, candidates: str, source2: str | None = None, model: str = "models/matching_model", threshold_config: str | None = "models/threshold_config.json",
    threshold: float | None = None, out: str = "output/matching_results.tsv", validator: str | None = "validate_submission.py",
) -> dict:
    """Score candidate pairs and write one line for each entity of source 1, verified; an outer validator runs if it is found."""
    path = tsv.resolve(candidates, OUTPUT)
    fitted, side = models.load(model)
    cut = models.threshold(threshold, models.read_threshold(threshold_config) if threshold_config else None, side)
    where = tsv.resolve(source1, TEST)
    s1 = kept(tsv.entities(tsv.lines(spark, where)), "s1")
    targets = tsv.entities(tsv.lines(spark, tsv.resolve(source3, TEST)))
    two = tsv.resolve(source2, TEST, must_exist=False) if source2 else None
    if two and ("://" in two or os.path.isfile(two)):
        # of an id in both sources the third one's row counts
        targets = tsv.combined(tsv.entities(tsv.lines(spark, two)), targets, keep="second")
    pairs = kept(tsv.pairs(tsv.lines(spark, path)), "pairs")
    scored = kept(results.matches(models.score(fitted, features.pair_features(pairs, s1, targets)), cut), "matches")
    table = kept(results.assemble(s1, scored), "results")
    wrong = {r.rule: r.violations for r in results.check_results(table, s1, pairs).collect() if r.violations}
    if wrong:
        raise ValueError(f"results break rules: {wrong}")
    tsv.write_one(table.orderBy("source1_entity_id"), out)
    report = {"out": out, "threshold": cut, "pairs": pairs.count(), "matches": scored.count(), **results.summary(table).first().asDict()}
    script = tsv.resolve(validator, (".", "utils"), must_exist=False) if validator else None
    if script and os.path.isfile(script):
        done = subprocess.run([sys.executable, script, "--matching", out, "--candidate", path, "--test-dir", os.path.dirname(where) or "."], capture_output=True, text=True)
        report |= {"validator": done.returncode, "validator_says": done.stdout + done.stderr}
    return report


def validate(spark: SparkSession, candidates: str = "output/candidate_pairs.tsv", ground_truth: str = "data/train_ground_truth.tsv") -> dict:
    """Whether a candidate file is there, has the right columns, names no entity twice and none of the true links' is missing."""
    try:
        names = tsv.header(spark, candidates)
    except FileNotFoundError:
        return {"found": False, "passed": False}
    if names != results.CANDIDATE_COLUMNS:
        return {"found": True, "columns": names, "passed": False}
    table = tsv.lines(spark, candidates).drop("ord")
    truth = tsv.truth(tsv.lines(spark, ground_truth)).select("s1_id")
    rules = {r.rule: r.violations for r in results.check_candidates(table, truth).collect()}
    counts = table.agg(F.count("*").alias("rows"), F.count_distinct("source1_entity_id").alias("entities")).first().asDict()
    return {"found": True, **rules, "columns": names, **counts, "true_entities": truth.distinct().count(), "passed": not any(rules.values())}


def look(spark: SparkSession, files: list[str]) -> list[dict]:
    """Rows, columns, inferred types and the first three rows of files."""
    out = []
    for path in files:
        about = tsv.profile(tsv.inferred(spark, path), os.path.basename(path)).first().asDict()
        out.append(about | {"head": [r.asDict() for r in tsv.preview(tsv.lines(spark, path)).collect()]})
    return out


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="korrel", description="Record linkage on tab-separated files.")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, does: str, needed: tuple[str, ...], **options) -> argparse.ArgumentParser:
        one = jobs.add_parser(name, help=does, description=does)
        for n in needed:
            one.add_argument(f"--{n}", required=True)
        for n, default in options.items():
            kind = {} if default is None else {"type": type(default)}
            one.add_argument(f"--{n.replace('_', '-')}", default=default, **kind)
        return one

    sources = ("source1", "source2", "source3")
    job("block", "write candidate pairs", sources, out="output/candidate_pairs.tsv", max_token_freq=100, ground_truth=None)
    job("mock", "write candidate pairs by first tokens", ("source1", "source3"), source2=None, out="output/candidate_pairs.tsv", num_candidates=5000)
    job("train", "fit a classifier and its threshold", (*sources, "ground-truth"), output_model="models/matching_model", output_threshold="models/threshold_config.json", train_candidates=None, model_type="random_forest", num_samples=50_000, n_estimators=100, max_depth=14, val_ratio=training.VALIDATION, random_seed=42)
    one = job("predict", "write matching results", ("source1", "source3", "candidates"), source2=None, model="models/matching_model", threshold_config="models/threshold_config.json", out="output/matching_results.tsv", validator="validate_submission.py")
    one.add_argument("--threshold", type=float)
    job("validate", "check a candidate file", (), candidates="output/candidate_pairs.tsv", ground_truth="data/train_ground_truth.tsv")
    jobs.add_parser("look", help="rows, columns, types and first rows of files").add_argument("files", nargs="+")
    return parser


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    options = vars(_parser().parse_args(arguments))
    name = options.pop("job")
    spark = spark or SparkSession.builder.appName(f"korrel-{name}").getOrCreate()
    done = {"block": block, "mock": mock, "train": train, "predict": predict, "validate": validate, "look": look}[name](spark, **options)
    for part in done if isinstance(done, list) else [done]:
        for k, v in part.items():
            print(f"{k}: {v}")
    return int(isinstance(done, dict) and done.get("passed") is False)
