import random
from collections import Counter, defaultdict

import pytest

from korrel.llm import neardup
from korrel.llm.common import Scratch
from korrel.llm.components import components


def brute(rows):
    """(n_shingles, smallest doc_id reachable) of each row by comparing all sets that share a shingle."""
    own = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        own.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(own):
        for j, both in Counter(j for x in s for j in holders[x]).items():
            if 100 * both >= 75 * (len(s) + len(own[j]) - both):
                root[find(i)] = find(j)
        for x in s:
            holders[x].append(i)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[find(i)] += [d] if d is not None else []
    return [(d, len(own[i]), min(ids[find(i)], default=None)) for i, (d, _) in enumerate(rows)]


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "x", 1, b"n") for d, t in rows], "doc_id long, text string, pivot string, label int, node binary")
    scratch = Scratch(spark, "test")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, scratch).collect()]
    scratch.drop()
    return got


def key(r):
    return tuple((x is None, x) for x in r)


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"x{rnd.randrange(9999)}"
    return words


def test_same_as_brute_force(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    passage = [rnd.choice(vocab) for _ in range(30)]
    rows, n = [], 0
    for _ in range(60):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([3, 5, 12, 60, 200]))] + (passage if rnd.random() < 0.5 else [])
        for _ in range(rnd.choice([1, 1, 2, 5])):
            rows.append((n, " ".join(edited(rnd, base, rnd.choice([0, 0, 1, 2, 4])))))
            n += 1
    # a drifting chain: neighbours are alike, its ends are not
    chain = [rnd.choice(vocab) for _ in range(150)]
    for _ in range(12):
        rows.append((n, "\t".join(chain).upper()))
        chain = edited(rnd, chain, 2)
        n += 1
    assert sorted(run(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_many_near_copies_of_one_text(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BROADCAST_IDS", 0)
    rnd = random.Random(6)
    base = [f"w{rnd.randrange(500)}" for _ in range(200)]
    rows = [(1000 + i, " ".join(edited(rnd, base, rnd.choice([1, 2, 3])))) for i in range(150)] + [(i, " ".join(f"v{rnd.randrange(500)}" for _ in range(200))) for i in range(20)]
    assert sorted(run(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_nulls_empties_repeats(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE\x0btwo"), (5, "ONE\x0btwo"), (6, "one two three"), (None, "one two"), (None, None), (None, "alone here"), (7, "é " * 50_000), (8, "é " * 50_000 + "z")]
    assert sorted(run(spark, rows), key=key) == sorted(brute(rows), key=key)
    empty = neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string"), Scratch(spark, "test"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]


@pytest.mark.parametrize("n", [2, 33])
def test_components_of_a_path(spark, n):
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(i + 1, i) for i in range(n)] + [(900, 900), (800, 801)], "a int, b int")
    got = dict(components(links, Scratch(spark, "test")).collect())
    assert got == {**{i: 0 for i in range(n + 1)}, 800: 800, 801: 800}


def test_branching_and_blocks(spark, monkeypatch):
    for name, value in (("LEAF", 4), ("EASY", 0), ("BLOCK", 3), ("ROUNDS", 0)):
        monkeypatch.setattr(neardup, name, value)
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(6):
        base = [rnd.choice(vocab) for _ in range(120)]
        for k in range(14):
            rows.append((n, " ".join(edited(rnd, base, k % 7))))
            n += 1
    got, want = run(spark, rows), brute(rows)
    assert len(got) == len(want)
    # deep trees may miss a pair, which other trees then find: no false link, and nearly every true one
    parts, true = {d: c for d, _, c in got}, {d: c for d, _, c in want}
    assert all(true[d] == true[c] for d, c in parts.items())
    assert sum(parts[d] == true[d] for d in true) >= 0.97 * len(true)


@pytest.mark.parametrize("n", [2, 200])
def test_a_root_that_is_not_compared_hides_no_pair(spark, n):
    # all share the root of position 0, which is large; every two also share a small root of position 1 and one of position 2
    rows = []
    for i in range(n):
        for pos in (1, 2):
            rows.append((1000 * pos + i // 2, b"%06d" % i, b"%06d" % i, [i // 2 << 20] * 4, [7, i // 2, -i // 2], 1, pos))
    df = spark.createDataFrame(rows, "path long, node binary, label binary, sketch array<long>, roots array<int>, large long, pos int")
    got = {bytes(r.a) for r in neardup.compared(df, "nodes", 128).collect()}
    assert got == {b"%06d" % i for i in range(n)}
    got = {(bytes(r.a), bytes(r.b)) for r in neardup.compared(df, "touches", 128).collect()}
    assert {frozenset(p) for p in got} == {frozenset((b"%06d" % i, b"%06d" % (i + 1))) for i in range(0, n, 2)}


@pytest.mark.parametrize(("others", "leaf"), [(5, 8), (60, 8), (0, 200), (60, 200)])
def test_every_two_components_meet_in_a_cell(spark, monkeypatch, others, leaf):
    monkeypatch.setattr(neardup, "LEAF", leaf)
    monkeypatch.setattr(neardup, "CELL", leaf)
    nodes = [(i, b"%04d" % i, b"top" if i >= others else b"%03d" % (i // 2)) for i in range(90)]
    df = spark.createDataFrame([(7, 0, n, x, 90, others, b"top") for _, n, x in nodes], "path long, pos int, node binary, label binary, many long, others long, top binary")
    cells = {}
    for r in neardup._cells(df).collect():
        cells.setdefault(r.path, set()).add((bytes(r.node), bytes(r.label)))
    met = {frozenset((a, b)) for c in cells.values() for a, x in c for b, y in c if x != y}
    assert met == {frozenset((a, b)) for _, a, x in nodes for _, b, y in nodes if x != y} and {a for c in cells.values() for a, _ in c} == {n for _, n, _ in nodes}
    if leaf < 90:
        assert max(map(len, cells.values())) <= max(4 * leaf, others + 3 * leaf if others <= leaf else 0) and 7 not in cells


@pytest.mark.parametrize("easy", [0, 10**9])
def test_large_paths_in_blocks(spark, monkeypatch, easy):
    for name, value in (("LEAF", 6), ("CELL", 4), ("EASY", easy), ("BLOCK", 5), ("DEPTH", 1)):
        monkeypatch.setattr(neardup, name, value)
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(400)]
    shared, rows = [rnd.choice(vocab) for _ in range(60)], []
    for k in range(70):
        base = shared + [rnd.choice(vocab) for _ in range(40)]
        rows += [(100 * k + j, " ".join(edited(rnd, base, j))) for j in range(1 if k % 3 else 4)]
    # what one level did not part is compared in blocks: nothing is lost
    assert sorted(run(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_recall_where_paths_branch(spark):
    """Default parameters: a passage of most of each text puts more sets on a path than are compared at once."""
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(5000)]
    shared, rows = [rnd.choice(vocab) for _ in range(90)], []
    for k in range(12_500):
        own = [rnd.choice(vocab) for _ in range(30)]
        rows.append((2 * k, " ".join(shared + own)))
        if k % 25 == 0:  # a pair of a similarity of 0.75 to 0.8 whose edits fall into the passage and the text's own words
            words = shared + own
            for at in rnd.sample(range(2, 20), 1) + rnd.sample(range(40, 50), 1) + rnd.sample(range(100, 112), 1):
                words[at] = f"x{rnd.randrange(10**6)}"
            rows.append((2 * k + 1, " ".join(words)))
    sets = {d: {tuple(t.split()[i : i + 5]) for i in range(116)} for d, t in rows if d % 50 < 2}
    true = [d for d in sets if d % 2 and len(sets[d] & sets[d - 1]) >= 0.75 * len(sets[d] | sets[d - 1])]
    assert len(true) > 300
    got = {d: c for d, _, c in run(spark, rows)}
    caught = sum(got[d] == d - 1 for d in true) / len(true)
    print(f"recall of {len(true)} pairs on branching paths: {caught:.3f}")
    assert caught >= 0.9
    assert all(got[d] == d - d % 2 or got[d] == d for d in got)
