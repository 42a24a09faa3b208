import pytest
from pyspark.sql import functions as F

from korrel.operators import blocking, features, metrics, models, results, training
from korrel.plans import entities as E
from korrel.sources import tsv


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def ents(spark):
    data = [
        ("S1", "S1-1", "Alpha Beta Inc", "1 Main St", "US", None, 1),
        ("S1", "S1-2", "Gamma", None, "US", None, 2),
        ("S1", "S1-3", "Alpha", "9 Elm", None, None, 3),
        ("S2", "S2-1", "Alpha Limited", "7 Main Street", "US", None, 4),
        ("S2", "S2-2", "Beta Beta Beta", "", "US", None, 5),
        ("S3", "S3-1", "Alpha", "1 Main", "GB", None, 6),
        ("S3", "S3-2", "Gamma Delta", "", "US", None, 7),
    ]
    return spark.createDataFrame(data, "source string, entity_id string, business_name string, business_address string, country string, same string, ord long")


def test_blocking(spark, ents):
    assert rows(blocking.candidates(ents, 25)) == [("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-2", "S3-2")]
    # beta occurs three times in one S2 name: occurrences count, not entities
    assert rows(blocking.candidates(ents, 2)) == [("S1-1", "S2-1"), ("S1-2", "S3-2")]
    assert rows(blocking.candidates(ents, 25, ("address",))) == [("S1-1", "S2-1")]
    for k in (1, 2, 3):
        assert set(rows(blocking.candidates(ents, k))) <= set(rows(blocking.candidates(ents, k + 1)))
    g = blocking.grouped(E.s1(ents), blocking.candidates(ents, 25))
    assert rows(g) == [("S1-1", "S2-1,S2-2"), ("S1-2", "S3-2"), ("S1-3", "")]
    assert rows(blocking.first_token(E.s1(ents), E.targets(ents), 1)) == [("S1-1", "S2-1"), ("S1-2", "S3-2"), ("S1-3", "S2-1")]
    assert rows(blocking.first_token(E.s1(ents), E.targets(ents), 10, 1)) == [("S1-1", "S2-1"), ("S1-1", "S3-1")]


def test_recall(spark, ents):
    pairs = blocking.candidates(ents, 25)
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-3", "S3-1")], "s1_id string, target_id string")
    assert blocking.recall(truth, pairs).first()[:] == (2, 1, 0.5, 3, 1.5)
    assert blocking.recall(truth.limit(0), pairs.limit(0)).first()[:] == (0, 0, 1.0, 0, 0.0)


def test_features_of_unknown_ids(spark):
    b = E.business(spark)
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-99"), ("S1-3", "S2-3")], "s1_id string, cand_id string")
    got = {r.cand_id: r for r in features.pair_features(pairs, b, b).collect()}
    assert got["S2-1"].name_exact_match == 1 and got["S2-1"].addr_edit_sim == 1 and got["S2-1"].country_match == 1
    r = got["S2-99"]
    assert r.name_missing == r.addr_missing == r.country_missing == 1 and r.name_length_diff == 1 and r.country_match == 0.5 and r.addr_numeric_exact == 0
    assert len(features.NAMES) == 21


def test_loaders(spark, tmp_path):
    path = tmp_path / "s.tsv"
    path.write_text('Entity_ID\tbusiness_name\tcountry\nS1-1\t" quoted\tUS\n\nS1-2\nS1-1\tlater\tNA\n\tno id\tUS\n')
    table = tsv.entities(tsv.lines(spark, str(path)))
    assert sorted(map(str, rows(table.select("entity_id", "business_name", "business_address", "country")))) == sorted(map(str, [("S1-1", "later", None, "NA"), ("S1-2", None, None, None)]))
    t = spark.createDataFrame([("S1-1", "S2-1, S3-1,,S2-1", 1), ("S1-2", None, 2), ("S1-1", "S2-9", 3)], "source1_entity_id string, matched_entity_ids string, ord long")
    assert rows(tsv.truth(t)) == [("S1-1", ["S2-9"]), ("S1-2", [])]
    p = spark.createDataFrame([("S1-1", "S2-1,S1-2,S2-1,S3-1", 1), ("S1-4", "", 2), ("S1-1", "S3-1", 3)], "source1_entity_id string, candidate_entity_ids string, ord long")
    assert rows(tsv.pairs(p)) == [("S1-1", "S2-1"), ("S1-1", "S3-1")]
    assert rows(tsv.pairs(p, 1)) == [("S1-1", "S2-1")]
    assert rows(tsv.queried(p)) == [("S1-1",), ("S1-4",)]
    with pytest.raises(ValueError):
        tsv.entities(t)
    with pytest.raises(FileNotFoundError):
        tsv.resolve("no/such/file")
    assert tsv.truth_columns(["a", "b"]) == ("a", "b")
    assert tsv.resolve(str(path)) == str(path)


def test_metrics(spark):
    s = spark.createDataFrame([(0.9, 1), (0.5, 1), (0.5, 0), (0.2, 1), (0.1, 0), (0.05, 0)], "prob double, label int")
    assert metrics.confusion(s, 0.5).first()[:] == (2, 1, 1, 2)
    swept = metrics.sweep(s).orderBy("threshold").collect()
    assert len(swept) == 86
    for r in swept:
        assert metrics.confusion(s, r.threshold).first()[:] == (r.tp, r.fp, r.fn, r.tn)
    none = metrics.rates(spark.createDataFrame([(0, 0, 3, 1)], "tp long, fp long, fn long, tn long")).first()
    assert (none.precision, none.recall, none.f_beta) == (0, 0, 0)
    tied = spark.createDataFrame([(0.8, 1), (0.1, 0)], "prob double, label int")
    assert metrics.best(metrics.sweep(tied)).first().threshold == metrics.GRID[1]
    truth = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "s1_id string, target_id string")
    got = metrics.entity_metrics(truth, spark.createDataFrame([("a", "x"), ("c", "z")], "s1_id string, target_id string")).first()
    assert (got.tp, got.fp, got.fn) == (1, 1, 2)


def test_results(spark):
    s1 = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    scored = spark.createDataFrame([("S1-1", "S3-1", 0.9), ("S1-1", "S2-1", 0.9), ("S1-1", "S3-3", 0.4), ("S1-1", "S3-1", 0.95), ("S1-9", "S2-1", 1.0)], "s1_id string, cand_id string, prob double")
    out = results.assemble(s1, results.matches(scored, 0.9))
    assert rows(out) == [("S1-1", "S3-1,S2-1"), ("S1-2", "")]
    assert results.summary(out).first()[:] == (2, 1, 1)
    bad = spark.createDataFrame([("S1-1", "S2-1,S1-7"), ("S1-1", "S3-1")], "source1_entity_id string, matched_entity_ids string")
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S3-1")], "s1_id string, cand_id string")
    assert dict(rows(results.check_results(bad, s1, pairs))) == {"duplicate_s1": 1, "bad_prefix": 1, "outside_candidates": 1, "missing_s1": 1}
    wrong = spark.createDataFrame([("", "S1-1")], "candidate_entity_ids string, source1_entity_id string")
    assert dict(rows(results.check_candidates(wrong, pairs)))["columns"] == 1


def test_training(spark, sf):
    ents = E.entities(spark, sf)
    pairs = training.training_pairs(E.truth(ents), E.s1(ents), E.targets(ents), 200)
    got = pairs.collect()
    assert len({(r.s1_id, r.cand_id) for r in got}) == len(got)
    true = set(map(tuple, E.truth(ents).collect()))
    assert all(((r.s1_id, r.cand_id) in true) == (r.label == 1) for r in got)
    n = sum(r.label for r in got)
    assert n == len(true) and len(got) - n == int(n * training.NEGATIVES)
    parts = training.split(blocking.candidates(ents, 25)).collect()
    assert not {r.s1_id for r in parts if r.validation} & {r.s1_id for r in parts if not r.validation}
    ids = {r.s1_id for r in parts}
    assert len({r.s1_id for r in parts if r.validation}) == int(len(ids) * 0.2)
    w = {r.label: r.weight for r in training.class_weights(pairs).collect()}
    assert w[0] * (len(got) - n) == pytest.approx(w[1] * n)


def test_models(spark, tmp_path):
    data = spark.range(60).select(F.concat(F.lit("S1-"), F.col("id").cast("string")).alias("s1_id"), F.lit("S2-1").alias("cand_id"), (F.col("id") % 2).cast("int").alias("label"), *((F.col("id") % 2).cast("double").alias(n) for n in features.NAMES))
    for kind in ("rf", "lgb", "gb"):
        model = models.fit(data, kind, 3, 2)
        scored = models.score(model, data).collect()
        assert all(0 <= r.prob <= 1 and (r.prob > 0.5) == (r.label == 1) for r in scored)
    models.save(model, str(tmp_path / "m"), 0.0, "gb")
    loaded, side = models.load(str(tmp_path / "m"))
    assert models.threshold(None, None, side) == 0.5 and models.threshold(None, {"selected_threshold": 0.3}, side) == 0.3 and models.threshold(0.7, {"selected_threshold": 0.3}, side) == 0.7
    assert rows(models.score(loaded, data).select("s1_id", "prob")) == sorted((r.s1_id, r.prob) for r in scored)
    assert models.importances(model, spark).count() == 21
    with pytest.raises(ValueError):
        models.estimator("svm")


def test_stream(spark, tmp_path):
    from korrel.streaming import scoring

    b = E.business(spark)
    data = spark.range(20).select(F.lit("a").alias("s1_id"), F.lit("b").alias("cand_id"), (F.col("id") % 2).cast("int").alias("label"), *((F.col("id") % 2).cast("double").alias(n) for n in features.NAMES))
    model = models.fit(data, "rf", 3, 2)
    (tmp_path / "in").mkdir()
    for i, line in enumerate(("S1-1\tS2-1,,S3-1", "S1-2\tS2-2", " \tS2-1", "S1-3\t")):
        (tmp_path / "in" / f"{i}.tsv").write_text(f"source1_entity_id\tcandidate_entity_ids\n{line}\n")
    q = scoring.score_stream(scoring.pair_stream(spark, str(tmp_path / "in")), model, b, b, 0.0, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("s1_id", "cand_id")) == [("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-2", "S2-2")]
