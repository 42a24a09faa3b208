import itertools
import random

import numpy as np
import pytest

from korrel.llm import toxicity
from korrel.llm.common import Scratch, read

END = toxicity.END


def distance(a, b):
    """Edits with swaps of neighbours, each letter edited once."""
    d = {(i, j): max(i, j) for i in range(len(a) + 1) for j in range(len(b) + 1) if i == 0 or j == 0}
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_automaton_is_brute_force():
    rnd = random.Random(2)
    terms = ["abcab" + END, "bacca" + END, "abcabcabcc" + END, "ccba" + END, "bcbcbcb", "aabb"]
    auto = toxicity.Automaton(terms)
    words = {"".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 12))) for _ in range(4000)}
    words |= {t.rstrip(END)[:k] + x + t.rstrip(END)[k + s :] for t in terms for k in range(len(t)) for s in (0, 1) for x in ("", "a", "d", "ab")}
    for w in words:
        found = []
        for k, t in enumerate(terms):
            most, bare = auto.edits(t), t.rstrip(END)
            e = distance(bare, w) if t.endswith(END) else min(distance(bare, w[:n]) for n in range(len(w) + 1))
            if e <= most:
                found.append((e, k))
        got = auto.match(w)
        assert (got is None) == (not found), w
        assert got is None or got[0] == min(found)[0], w


@pytest.fixture(scope="module")
def learnt(spark):
    rnd = random.Random(4)
    vocab = ["".join(rnd.choice("bdfgklmnprstvaeiou") for _ in range(rnd.randint(2, 9))) for _ in range(800)]
    bad = ["wretchbag", "grumpkin", "snivelhead", "zorkling"]
    rows, labels = [], []
    for i in range(900):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(5, 80))]
        toxic = i % 6 == 0
        if toxic:
            words[rnd.randrange(len(words))] = rnd.choice(bad)
            words[rnd.randrange(len(words))] = rnd.choice(bad)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), Scratch(spark, "test"))


def test_misspelled_terms_and_quotation(learnt):
    _, _, model = learnt
    assert {t.rstrip(END) for t in model.terms} >= {"wretchbag", "grumpkin", "snivelhead", "zorkling"}
    s = toxicity.Scorer(model)

    def score(text):
        return float(model.fitted.score(np.array([s.features(text)[:3]]))[0])

    assert score("") < 0.5 and score("a perfectly kind sentence") < 0.5
    assert score("you are a grumpkin") > 0.5
    assert score("you are a gr1mpkin and a wretchbga") > 0.5
    assert s.hits('he said "grumpkin" twice')[0][3] > s.hits("you grumpkin you")[0][3]
    assert score('the word "grumpkin" was called a term') < score("you are a grumpkin")


def test_held_out_accuracy(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    docs = read(spark, sf, "documents")
    got = toxicity.flagged(docs, read(spark, sf, "labels"), Scratch(spark, "test"))
    assert got.count() == docs.count()
    rows = got.join(read(spark, sf, "labels"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.93 * len(rows)
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 1


def test_edge_cases(spark, learnt):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "grumpkin you", 2), (4, "x " * 200_000 + "wretchbag", 3)], "doc_id long, text string, hits int")
    got = {r.doc_id: r for r in toxicity.score(docs, learnt[2]).collect()}
    assert got[1].toxicity == got[2].toxicity < 0.5 and got[None].toxicity > 0.5 and got[4].hits == 1
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.flagged(docs, none, Scratch(spark, "test")).collect()
    assert len(rows) == 4 and all(r.score < 0.5 and r.predicted == 0 for r in rows)
    assert toxicity.flagged(docs.limit(0), none, Scratch(spark, "test")).count() == 0
