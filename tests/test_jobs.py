import json
import os
import random

import pytest
from pyspark.sql import functions as F

from korrel import jobs
from korrel.functions import text as T
from korrel.operators import blocking, models, training
from korrel.sources import scratch, tsv

WORDS = "alder birch cedar elm fir hazel juniper larch maple oak pine rowan spruce willow yew acacia".split()


def table(path, header, rows):
    path.write_text("\t".join(header) + "\n" + "".join("\t".join("" if x is None else x for x in r) + "\n" for r in rows), encoding="utf-8")
    return str(path)


@pytest.fixture
def data(tmp_path):
    rnd = random.Random(4)
    s1, s2, s3, truth = [], [], [], []
    for i in range(60):
        name = f"{rnd.choice(WORDS)} {rnd.choice(WORDS)} unit{i} Inc."
        address = f"{i} {rnd.choice(WORDS)} Street"
        country = rnd.choice(["US", "France"])
        s1.append((f"S1-{i}", name, address, country))
        if i % 3:
            s2.append((f"S2-{i}", name.replace("Inc.", "Incorporated").upper(), address.replace("Street", "St"), country))
        if i % 2:
            s3.append((f"S3-{i}", name + " é", None, country))
        links = [x for x in (f"S2-{i}" if i % 3 else None, f"S3-{i}" if i % 2 else None) if x]
        truth.append((f"S1-{i}", ", ".join(links)))
    s1.append(("S1-99", "nothing alike", None, None))
    head = ("entity_id", "business_name", "business_address", "country")
    return {
        "source1": table(tmp_path / "s1.tsv", head, s1), "source2": table(tmp_path / "s2.tsv", head, s2), "source3": table(tmp_path / "s3.tsv", head, s3),
        "truth": table(tmp_path / "gt.tsv", ("source1_entity_id", "matched_entity_ids"), truth), "ids": [r[0] for r in s1], "links": dict(truth), "s1": s1, "s2": s2, "s3": s3,
    }


def args(d, *names):
    return [x for n in names for x in (f"--{n}", d[n])]


def test_from_files_to_results(spark, data, tmp_path, capsys):
    out, results, model, record = (str(tmp_path / "out" / x) for x in ("pairs.tsv", "results.tsv", "model", "deep/threshold.json"))
    sources = args(data, "source1", "source2", "source3")
    assert jobs.main(["block", *sources, "--out", out, "--ground-truth", data["truth"]], spark) == 0
    assert "recall: 1.0" in capsys.readouterr().out
    text = open(out, "rb").read()
    lines = text.decode().split("\n")
    assert lines[0] == "source1_entity_id\tcandidate_entity_ids" and lines[-1] == "" and b"\r" not in text
    assert [x.split("\t")[0] for x in lines[1:-1]] == data["ids"]
    held = {x.split("\t")[0]: x.split("\t")[1] for x in lines[1:-1]}
    assert held["S1-99"] == "" and all(v == ",".join(sorted(set(v.split(",")))) for v in held.values())
    assert os.listdir(tmp_path / "out") == ["pairs.tsv"]

    assert jobs.main(["validate", "--candidates", out, "--ground-truth", data["truth"]], spark) == 0
    assert jobs.validate(spark, str(tmp_path / "none.tsv"), data["truth"]) == {"found": False, "passed": False}
    wrong = table(tmp_path / "wrong.tsv", ("candidate_entity_ids", "source1_entity_id"), [("S2-1", "S1-1")])
    assert jobs.main(["validate", "--candidates", wrong, "--ground-truth", data["truth"]], spark) == 1
    twice = table(tmp_path / "twice.tsv", ("source1_entity_id", "candidate_entity_ids"), [("S1-1", ""), ("S1-1", "S2-1")])
    got = jobs.validate(spark, twice, data["truth"])
    assert (got["rows"], got["entities"], got["duplicate_s1"], got["missing_s1"], got["passed"]) == (2, 1, 1, 59, False)

    assert jobs.main(["train", *sources, "--ground-truth", data["truth"], "--output-model", model, "--output-threshold", record, "--n-estimators", "8", "--max-depth", "4"], spark) == 0
    found = json.load(open(record))
    assert list(found) == ["selected_threshold", "metric_optimized", "validation_metrics", "default_metrics", "model_type", "num_train_pairs", "num_val_pairs"]
    assert list(found["validation_metrics"]) == ["threshold", "precision", "recall", "f0.5", "f1", "tp", "fp", "fn", "tn"]
    side = models.load(model)[1]
    assert side["threshold"] == found["selected_threshold"] and side["model_params"] == {"n_estimators": 8, "max_depth": 4, "random_state": 42}
    with pytest.raises(FileNotFoundError):
        models.load(model + "-none")

    validator = tmp_path / "validator.py"
    validator.write_text("import sys; print(len(sys.argv)); sys.exit(3)")
    got = jobs.predict(spark, data["source1"], data["source3"], out, data["source2"], model, record, out=results, validator=str(validator))
    assert got["validator"] == 3 and got["validator_says"] == "7\n" and got["threshold"] == found["selected_threshold"]
    lines = open(results, "rb").read().decode().split("\n")
    assert lines[0] == "source1_entity_id\tmatched_entity_ids" and [x.split("\t")[0] for x in lines[1:-1]] == sorted(data["ids"])
    matched = {x.split("\t")[0]: set(filter(None, x.split("\t")[1].split(","))) for x in lines[1:-1]}
    true = {k: set(filter(None, v.replace(" ", "").split(","))) for k, v in data["links"].items()}
    both = sum(len(matched[k] & true[k]) for k in true)
    assert both >= 0.9 * sum(map(len, true.values())) and sum(map(len, matched.values())) <= 1.2 * both
    assert matched["S1-99"] == set()
    got = jobs.predict(spark, data["source1"], data["source3"], out, str(tmp_path / "no-s2.tsv"), model, None, threshold=2.0, out=results)
    assert got["matches"] == 0 and "validator" not in got


def mock(s1, s2, s3, limit, bucket, most):
    """Line by line, as the file is specified."""
    names = dict(list({i: n for i, n in s3}.items())[: most[1]])
    names.update(dict(list({i: n for i, n in s2}.items())[: most[0]]))
    index, out, hits = {}, [], 0
    for i, n in names.items():
        token = (n.lower().split() or [""])[0]
        if token:
            index.setdefault(token, [])
            if len(index[token]) < bucket:
                index[token].append(i)
    for i, n in s1:
        own = index.get((n.lower().split() or [""])[0], []) if hits < limit else []
        hits += bool(own)
        out.append((i, ",".join(own)))
    return out


@pytest.mark.parametrize(("limit", "bucket", "most"), [(5000, 10, (100_000, 150_000)), (7, 2, (20, 15)), (0, 1, (5, 5))])
def test_mock_candidates(spark, limit, bucket, most):
    rnd = random.Random(limit)

    def rows(source, n):
        return [(f"{source}-{i}", " ".join(rnd.choice(WORDS[:5]) for _ in range(rnd.choice([0, 1, 2])))) for i in range(n)]

    s1, s2, s3 = rows("S1", 40), [*rows("S2", 30), ("S3-3", "yew")], rows("S3", 30)
    frames = [spark.createDataFrame([(i, n, k) for k, (i, n) in enumerate(t)], "entity_id string, business_name string, ord long") for t in (s1, s2, s3)]
    got = blocking.mock_candidates(*frames, limit, bucket, most).orderBy("ord").collect()
    assert [(r.source1_entity_id, r.candidate_entity_ids) for r in got] == mock(s1, s2, s3, limit, bucket, most)


def test_mock_job(spark, data, tmp_path):
    out = str(tmp_path / "mock.tsv")
    got = jobs.mock(spark, data["source1"], data["source3"], data["source2"], out, 10)
    want = mock(*([(r[0], r[1]) for r in data[k]] for k in ("s1", "s2", "s3")), 10, 10, (100_000, 150_000))
    assert [tuple(x.split("\t")) for x in open(out).read().split("\n")[1:-1]] == want and got["with_candidates"] == 10


def test_look(spark, data):
    got = jobs.look(spark, [data["source1"]])[0]
    assert got["rows"] == 61 and got["types"] == "string,string,string,string" and [r["entity_id"] for r in got["head"]] == ["S1-0", "S1-1", "S1-2"]


def test_the_last_row_counts_over_several_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k, n in (("a", 3), ("b", 4000), ("c", 2)):
        table(tmp_path / "in" / f"{k}.tsv", ("entity_id", "business_name"), [("S1-1", f"{k}{i}") for i in range(n)])
    got = tsv.entities(tsv.lines(spark, str(tmp_path / "in"))).first()
    assert got.business_name == "c1"


def test_soft_negatives_reach_the_quota(spark):
    s1 = spark.createDataFrame([(f"S1-{i}",) for i in range(12)], "entity_id string")
    targets = spark.createDataFrame([(f"S2-{i}",) for i in range(10)], "entity_id string")
    truth = spark.createDataFrame([(f"S1-{i}", f"S2-{i}") for i in range(10)], "s1_id string, target_id string")
    seen = spark.createDataFrame([("S1-0", "S2-1")], "s1_id string, cand_id string")
    for quota, n in ((0, 0), (5, 5), (60, 60), (109, 109), (500, 109)):
        got = {(r.s1_id, r.cand_id) for r in training.soft_negatives(s1, targets, truth, seen, quota).collect()}
        assert len(got) == n and not got & ({(f"S1-{i}", f"S2-{i}") for i in range(10)} | {("S1-0", "S2-1")})
    assert training.soft_negatives(s1.limit(0), targets, truth, seen, 5).count() == 0
    many = spark.range(9000).select(F.concat(F.lit("S2-"), F.col("id").cast("string")).alias("entity_id"))
    assert training.soft_negatives(s1, many, truth, seen, 700).distinct().count() == 700


def test_features_use_every_partition(spark, sf):
    from korrel.operators import features
    from korrel.plans import entities as E

    ents = E.entities(spark, sf)
    out = features.pair_features(blocking.candidates(ents, 25), E.s1(ents), E.targets(ents))
    assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_first_words_are_those_of_the_cleaned_text(spark):
    texts = [None, "", "null", " NaN ", "null.", "a&b c", "&&& x", "  lead, and-more é_1 " * 30, "...", "one", "हिंदी x y", "&a&", "A" * 5000 + " b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for n in (1, 3, 30):
        got = df.select(T.first_words(F.col("t"), n).alias("w"), F.slice(T.tokens(T.clean(F.col("t"))), 1, n).alias("v")).collect()
        assert all(r.w == r.v for r in got)


def test_kept_tables_are_in_the_scratch_folder(spark):
    df = scratch.kept(spark.range(5))
    assert df.count() == 5 and scratch.root(spark) in df.inputFiles()[0]
