import random
from collections import defaultdict

import pytest

from korrel.llm import mixing
from korrel.llm.common import Scratch


def water(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + ([None] if None in sizes else [])
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    target, left = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values())
    free = list(names)
    while free and left > 1e-9:
        total = sum(weight[n] for n in free)
        for n in free:
            target[n] += left * weight[n] / total
        left = 0.0
        for n in list(free):
            if target[n] >= 2 * sizes[n]:
                left += target[n] - 2 * sizes[n]
                target[n] = 2.0 * sizes[n]
                free.remove(n)
    return target


def run(spark, rows, **how):
    df = spark.createDataFrame([(d, t, s, 1, "x") for d, t, s in rows], "doc_id long, text string, source string, size int, upto string")
    scratch = Scratch(spark, "test")
    got = mixing.mix(df, scratch, **how).collect()
    scratch.drop()
    return got


@pytest.mark.parametrize("cells", [(256, 4096), (2, 3)])
def test_targets_and_taken(spark, monkeypatch, cells):
    monkeypatch.setattr(mixing, "CELLS", cells[0])
    monkeypatch.setattr(mixing, "FINER", cells[1])
    rnd = random.Random(3)
    rows = [(i, "w " * rnd.choice([0, 1, 5, 30, 200]) + ("###" if i % 7 == 0 else ""), rnd.choice(["a", "a", "a", "b", "é", "", None, "z"])) for i in range(400)]
    got = run(spark, rows, narrow=True)
    assert len(got) == len(rows) and all(r.upto == "x" for r in got)
    size, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
    want = water(size)
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source])
    for s in size:
        assert abs(taken[s] - want[s]) <= most[s] / 2 + 1e-6
    assert sorted(map(str, got)) == sorted(map(str, run(spark, rows, narrow=True)))
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in run(spark, rows))


def test_order_of_keys(spark):
    rows = [(i, "a b c", "s") for i in range(200)] + [(1000 + i, "a b c", "t") for i in range(200)]
    got = {r.doc_id: r for r in run(spark, rows)}
    from pyspark.sql import functions as F

    ids = spark.createDataFrame([(d,) for d, _, _ in rows], "doc_id long")
    key = {r.doc_id: -r.k for r in ids.select("doc_id", F.log(mixing.uniform(F.col("doc_id"), "mix")).alias("k")).collect()}
    for lo in (0, 1000):
        own = sorted(range(lo, lo + 200), key=key.get)
        extra = [got[d].taken > min(got[x].taken for x in own) for d in own]
        assert extra == sorted(extra, reverse=True)


def test_edge_cases(spark):
    got = run(spark, [(1, None, "a"), (2, "", None), (3, " \t\n", "a")])
    assert all((r.size, r.target, r.taken) == (0, 0, 0) for r in got)
    assert run(spark, []) == []
    got = run(spark, [(None, "x y", "a"), (None, "x y", "a"), (5, "x\x0by", "a"), (5, "x\x0by", "a")])
    assert sum(r.taken for r in got) == 12 and all(r.size == 2 for r in got)


def test_copies_and_long_texts(spark):
    # a third of all rows is one text without an id, another third repeats one id: rows are taken one by one all the same
    rows = [(None, "same words here", "a")] * 300 + [(7, f"other words {i}", "a") for i in range(300)] + [(1000 + i, "w " * (50_000 if i == 0 else 5), "b") for i in range(300)]
    got = run(spark, rows)
    want = water({"a": 1800, "b": 51_495})
    for s in "ab":
        taken = [r.taken for r in got if r.source == s]
        assert abs(sum(taken) - want[s]) <= max(r.size for r in got if r.source == s) / 2 + 1e-6
    assert sorted(r.taken for r in got) == sorted(r.taken for r in run(spark, rows, narrow=True))
