import math

import numpy as np
import pytest

from korrel.llm import topk
from korrel.llm.common import Scratch


def brute(rows, k, one_in):
    own = [(i, [math.floor(64.0 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in own if i % one_in == 0}):
        asked = {tuple(v) for i, v in own if i == q}
        best = sorted((-sum(x * y for x, y in zip(a, v, strict=False)), i) for a in asked for i, v in own if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


def run(spark, rows, k=5, one_in=4):
    df = spark.createDataFrame([(i, v, "k") for i, v in rows], "vec_id long, embedding array<float>, key string")
    scratch = Scratch(spark, "test")
    got = [tuple(r) for r in topk.top_k(df, k, one_in, scratch).select("query_id", "rank", "vec_id", "score").collect()]
    scratch.drop()
    return sorted(got)


@pytest.mark.parametrize(("shard", "block", "group", "home"), [(32_768, 128, 4096, 8), (16, 3, 7, 4), (16, 3, 7, 1000)])
def test_same_as_brute_force(spark, monkeypatch, shard, block, group, home):
    for name, value in (("SHARD", shard), ("BLOCK", block), ("GROUP", group), ("HOME", home)):
        monkeypatch.setattr(topk, name, value)
    rnd = np.random.default_rng(1)
    centres = rnd.normal(0, 0.3, (4, 10))
    rows = [(i, (centres[i % 4] + rnd.normal(0, 0.05, 10)).tolist()) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(40)]  # many equal vectors: ties
    rows += [(300 + i, [0.0] * 10) for i in range(12)]
    assert run(spark, rows) == brute(rows, 5, 4)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (4, [1.0]), (8, None), (12, [nan, 1.0]), (16, [inf, 1.0]), (20, [None, 1.0]), (None, [1.0, 1.0]), (3, [-1.0, -2.0]), (5, [0.5, 0.5, 0.5]), (24, []), (28, [-0.3, 1e6])]
    assert run(spark, rows) == brute(rows, 5, 4)
    assert run(spark, rows[:1]) == [] and run(spark, []) == []


def test_repeated_rows_and_ids(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 16)
    rows = [(20, [1.0, 0.5]), (5, [1.0, 0.5]), (5, [1.0, 0.5]), (6, [0.9, 0.5]), (5, [0.1, 0.1])] * 2 + [(20, [-1.0, 0.0]), (None, [9.0, 9.0])]
    rows += [(7, [0.3, 0.3])] * 60  # one row, many times
    assert run(spark, rows) == brute(rows, 5, 4)
    assert run(spark, rows, 80) == brute(rows, 80, 4)


def test_lists_are_read_only_down_to_the_cutoff(spark):
    rnd = np.random.default_rng(4)
    c = rnd.integers(-30, 30, (4000, 16)) // np.arange(1, 4001)[:, None].clip(1, 30)
    cell, q = topk.Cell(np.arange(4000), c), rnd.integers(-30, 30, (9, 16))
    asking = np.full(9, -1)
    scores = q @ c.T
    cut = [int(np.sort(s)[-5]) for s in scores]
    seen = []
    real = topk.Cell.lists

    class Part(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, tuple) and isinstance(at[1], slice):
                seen.append(at[1].stop)
            return np.asarray(super().__getitem__(at))

    cell.lists = lambda *a: [(d, o, n, p.view(Part)) for d, o, n, p in real(cell, *a)]
    got = {i: sorted(zip((-s).tolist(), at.tolist(), strict=True)) for i, s, at in cell.collected(q, asking, 5, cut)}
    assert got == {i: sorted((-int(s), j) for j, s in enumerate(row))[:5] for i, row in enumerate(scores)}
    assert seen and max(seen) < 4000


def test_large_components(spark):
    rows = [(i, [float(i) * 3e4, -float(i) * 7e3, 5e5]) for i in range(30)]
    assert run(spark, rows) == brute(rows, 5, 4)
