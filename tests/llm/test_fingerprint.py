import random

from pyspark.sql import functions as F

from korrel.llm import fingerprint
from korrel.llm.common import Scratch


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, digits string")
    scratch = Scratch(spark, "test")
    got = fingerprint.fingerprints(df, scratch).collect()
    scratch.drop()
    return got


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def like(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_and_likeness(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "BLOCK", 7)
    monkeypatch.setattr(fingerprint, "RUN", 3)
    rnd = random.Random(8)
    vocab = [f"é{i}" for i in range(400)]
    base = [rnd.choice(vocab) for _ in range(600)]
    rows = []
    for i in range(60):
        words = list(base) if i % 3 else [rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 8, 40, 300, 900]))]
        for _ in range(rnd.choice([0, 5, 20, 60])):
            words[rnd.randrange(len(words))] = rnd.choice(vocab)
        rows.append((i * 3 - 20, " ".join(words)))
    rnd.shuffle(rows)
    text = dict(rows)
    order = sorted(text, reverse=True)
    after = dict(zip(order, order[1:] + order[:1], strict=True))
    errors, codes = [], {}
    for r in run(spark, rows):
        t, n = text[r.doc_id], text[after[r.doc_id]]
        h = len(t) // 2
        want = t[: len(t) - h] + n[:h]
        assert r.edited == want and r.n_chars == len(t)
        assert len(r.fingerprint) == len(r.edited_fingerprint) == fingerprint.BINS
        codes.setdefault(t, r.fingerprint)
        errors += [r.near_next - like(t, n), r.near_edited - like(t, want)]
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert len(errors) == 120 and max(map(abs, errors)) < 0.2
    assert sum(e * e for e in errors) / len(errors) < 0.05**2


def test_no_bias(spark):
    # the pairs share no text: errors of near copies of one base would go the same way
    rnd, rows = random.Random(3), []
    for _ in range(800):
        a = [f"é{rnd.randrange(4000)}" for _ in range(rnd.choice([20, 100, 300, 600]))]
        b = list(a)
        for _ in range(rnd.randrange(0, len(a) // 8)):
            b[rnd.randrange(len(a))] = f"x{rnd.randrange(9999)}"
        rows.append((" ".join(a), " ".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    df = fingerprint.with_digits(fingerprint.with_digits(df, "a", "x"), "b", "y")
    errors = [r.l - like(r.a, r.b) for r in df.select("a", "b", fingerprint.likeness(F.col("x"), F.col("y")).alias("l")).collect()]
    assert abs(sum(errors)) / len(errors) < 0.005 and sum(e * e for e in errors) / len(errors) < 0.04**2


def test_edge_cases(spark):
    rows = [(3, None), (2, ""), (1, " \t"), (0, "a b"), (0, "a b"), (None, "z " * 30_000)]
    got = {(r.doc_id, r.n_chars): r for r in run(spark, rows)}
    assert len(run(spark, rows)) == 6
    assert got[3, 0].fingerprint == "-" * 256 and got[3, 0].near_next == 1.0 and got[3, 0].near_edited == 1.0
    assert got[2, 0].near_next == 1.0
    assert got[1, 2].edited == " a" and got[1, 2].near_next == 0.0
    assert got[0, 3].edited == "a z" or got[0, 3].edited == "a a"
    one = run(spark, [(7, "a b c d e f g h")])[0]
    assert one.near_next == 1.0 and one.edited == "a b c d a b c d"[:8] + "a b c d "[:7]
    assert run(spark, []) == []


def test_bins_and_densification_are_brute_force(spark):
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice("abcdefghij") + str(rnd.randrange(99)) for _ in range(n)) for n in (1, 2, 4, 5, 6, 9, 30, 90, 300, 900, 3000)] + ["", "x y " * 400]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprint.with_digits(df, "text", "digits").collect()}
    words, many = fingerprint.hashes_of(F.col("text"))
    hashes = {r.doc_id: r.h for r in df.withColumn("_words", words).select("doc_id", many.alias("h")).collect()}
    bins, low = fingerprint.BINS, (1 << fingerprint.VALUE) - 1
    pairs = spark.range(bins).crossJoin(spark.range(bins).withColumnRenamed("id", "j")).select("id", "j", F.xxhash64(F.col("id").cast("int"), F.col("j").cast("int")).alias("h"))
    other = {(r.id, r.j): r.h for r in pairs.collect()}
    for i, t in enumerate(texts):
        if not t.split():
            assert got[i].digits == []
            continue
        assert len(hashes[i]) == max(1, len(t.split()) - 4)
        least = {}
        for h in hashes[i]:
            b, v = h >> fingerprint.VALUE, h & low
            least[b] = min(v, least.get(b, low))
        want = []
        for b in range(bins):
            own = next((p for p in [b, *fingerprint._probes()[b]] if p in least), None)
            if own is None:
                own = min(least, key=lambda j: other[b, j])
            want.append(least[own] & 15)
        assert [d & 15 for d in got[i].digits] == want


def test_blocks_with_outlying_null_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "BLOCK", 20)
    rows = [(i, f"text number {i} of all") for i in range(600)] + [(1 << 62, "far away"), (-(1 << 62), "far below")]
    rows += [(None, f"without id {i}") for i in range(300)] + [(50, f"again {i}") for i in range(300)] + [(51, "the same text") for _ in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    scratch = Scratch(spark, "test")
    keys = scratch.keep(df.withColumn("key", fingerprint._key()).select("key"))
    sizes = [r["count"] for r in fingerprint._placed(keys, fingerprint._borders(keys)).groupBy("block").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 80
    got = run(spark, rows)
    tie = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), tie[r[1]]))
    want = []
    for (d, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        h = len(t) // 2
        want.append((d, t[: len(t) - h] + n[:h]))
    assert sorted(((r.doc_id, r.edited) for r in got), key=str) == sorted(want, key=str)


def test_borders_of_many_blocks(spark, monkeypatch):
    # a border's number times the sample's size goes beyond 32 bits, as it does from 3 million documents on
    n = 50_000
    monkeypatch.setattr(fingerprint, "BLOCK", 1)
    monkeypatch.setattr(fingerprint, "BLOCKS", n)
    monkeypatch.setattr(fingerprint, "SAMPLED", 1)
    scratch = Scratch(spark, "test")
    keys = scratch.keep(spark.range(n).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).withColumn("key", fingerprint._key()).select("key"))
    placed = fingerprint._placed(keys, scratch.keep(fingerprint._borders(keys))).select("key.down", "block").collect()
    scratch.drop()
    # the whole order is the sample, so that each document is a block of its own: ids descend as blocks rise
    assert sorted((r.block, ~r.down) for r in placed) == [(i, n - 1 - i) for i in range(n)]
