import random

import numpy as np

from korrel.llm import linear, quality
from korrel.llm.common import Scratch, read
from korrel.llm.samples import held_out
from pyspark.sql import functions as F


def test_held_out_accuracy(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    got = quality.classified(read(spark, sf, "documents"), read(spark, sf, "labels"), Scratch(spark, "test"))
    assert got.count() == read(spark, sf, "documents").count()
    rows = got.join(read(spark, sf, "labels"), "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    # clean documents stay
    assert sum(r.predicted == 1 for r in rows if r.quality == 1) >= 0.98 * sum(r.quality == 1 for r in rows)


def test_views_teach_each_other():
    rnd = np.random.default_rng(3)
    y = rnd.integers(0, 2, 400).astype(float)
    a = y[:, None] * 2 + rnd.normal(0, 0.7, (400, 3))
    b = y[:, None] * 2 + rnd.normal(0, 0.7, (400, 2))
    pool_y = rnd.integers(0, 2, 500)
    pool_a, pool_b = pool_y[:, None] * 2 + rnd.normal(0, 0.7, (500, 3)), pool_y[:, None] * 2 + rnd.normal(0, 0.7, (500, 2))
    m = quality.cotrain(a[:40], b[:40], y[:40], np.arange(40) % 4 == 0, pool_a, pool_b)
    assert len(m.exchanged) > 1 and all(x > 0 for x in m.exchanged[0])
    assert np.mean((m.score(a[40:], b[40:]) > 0.5) == y[40:]) > 0.95


def test_edge_cases(spark):
    rows = [(1, None, None, None, 1), (2, "", "en", "x", 2), (3, "word " * 40_000, "en", "x", 3), (None, "a b", "de", None, 4), (2, "", "en", "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, calibrate int")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (9, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality.classified(docs, labels, Scratch(spark, "test")).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [True]
    none = quality.classified(docs, labels.limit(0), Scratch(spark, "test")).collect()
    assert len({r.score for r in none}) == 1
    assert quality.classified(docs.limit(0), labels, Scratch(spark, "test")).count() == 0


def test_sample_ignores_held_out_labels(spark, sf):
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one = {r.doc_id: r.score for r in quality.classified(docs, labels, Scratch(spark, "test")).collect()}
    two = {r.doc_id: r.score for r in quality.classified(docs, flipped, Scratch(spark, "test")).collect()}
    assert one == two


def test_logistic_of_one_class():
    m = linear.fit(np.ones((4, 2)), np.ones(4))
    assert m.score(np.zeros((1, 2)))[0] > 0.5


def test_the_text_view_learns_words(spark):
    # good and bad texts are made alike and differ in words alone; language and source tell nothing
    rnd = random.Random(3)
    words = [f"{a}{b}{c}" for a in "bdklm" for b in "aeiou" for c in "nrst"]
    good, bad, common = words[:20], words[20:40], words[40:]
    rows, marks = [], []
    for i in range(1200):
        y = i % 2
        rows.append((i, " ".join(rnd.choice((good if y else bad) if rnd.random() < 0.2 else common) for _ in range(60)), "en", "x"))
        marks.append((i, y, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame(marks[:800], "doc_id long, quality int, toxic int")
    got = quality.classified(docs, labels, Scratch(spark, "test")).collect()
    right = [r.predicted == r.doc_id % 2 for r in got if r.held_out or r.doc_id >= 800]
    assert len(right) > 400 and sum(right) >= 0.9 * len(right)


def test_repeated_ids_do_not_grow_the_sample(spark):
    docs = spark.createDataFrame([(1, f"text {i}", "en", "x") for i in range(500)] + [(i, "good text" if i % 2 else "### $$$", "en", "x") for i in range(2, 60)], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 60)], "doc_id long, quality int, toxic int")
    got = quality.classified(docs, labels, Scratch(spark, "test")).collect()
    assert len(got) == 558 and all((r.score > 0.5) == (r.doc_id % 2 == 1) for r in got if r.doc_id > 1)
