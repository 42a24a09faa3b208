import random
from collections import Counter

import pytest

from korrel.llm import repeats
from korrel.llm.common import Scratch


def brute(texts):
    own = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + 200] for d in own for i in range(len(d) - 199))
    out = []
    for d in own:
        gone = bytearray(len(d))
        for i in range(len(d) - 199):
            if count[d[i : i + 200]] > 1:
                gone[i : i + 200] = b"\x01" * 200
        spans = [i for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1])]
        out.append((len(d), sum(gone), len(spans), bytes(b for b, g in zip(d, gone) if not g)))
    return out


def run(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, tid string")
    scratch = Scratch(spark, "test")
    got = sorted(repeats.remove_repeats(df, scratch).collect(), key=lambda r: r.doc_id)
    scratch.drop()
    assert all(r.tid == "x" for r in got)
    return [(len((r.text or "").encode()), sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in got]


def corpus(seed):
    rnd = random.Random(seed)

    def prose(n):
        return "".join(rnd.choice("abcdefgh éß\n") for _ in range(n))

    shared = [prose(n) for n in (120, 150, 170, 180, 199, 200, 201, 260, 500, 900)]
    texts = []
    for _ in range(70):
        parts = []
        for _ in range(rnd.randint(1, 5)):
            s = rnd.choice(shared)
            a = rnd.choice([0, 0, rnd.randrange(60)])
            parts += [prose(rnd.choice([0, 1, 5, 80, 300])), s[a : len(s) - rnd.choice([0, 0, rnd.randrange(60)])]]
        texts.append("".join(parts))
    texts += ["", None, "short", "a" * 199, "a" * 200, "b" * 201, "b" * 900, "ab" * 400, "Eron, " * 90, texts[3], texts[3], prose(4000) * 2]
    return texts


@pytest.mark.parametrize(("split", "group", "wide"), [(256, 20_000, 16), (1, 20_000, 16), (1, 20_000, 3), (1, 1, 16), (2, 3, 50)])
def test_same_as_brute_force(spark, monkeypatch, split, group, wide):
    for name, value in (("SPLIT", split), ("GROUP", group), ("RANGE", wide), ("AT_ONCE", 50)):
        monkeypatch.setattr(repeats, name, value)
    texts = corpus(split + group + wide)
    assert run(spark, texts) == brute(texts)


def test_a_line_that_all_texts_have(spark):
    # 400 texts share 150 bytes, some of them 220, with other bytes around: production parameters split the contents of the line
    rnd = random.Random(12)

    def prose(n):
        return "".join(rnd.choice("abcdefgh \n") for _ in range(n))

    line, more = prose(150), prose(70)
    texts = [prose(160) + line + (more if i % 9 == 0 else "") + prose(160) for i in range(400)]
    got, want = run(spark, texts), brute(texts)
    assert got == want and sum(r[1] > 0 for r in got) == 45


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 700)
    texts = corpus(3)
    assert run(spark, texts) == brute(texts)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove_repeats(df, Scratch(spark, "test")).count() == 0
