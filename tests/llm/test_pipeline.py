import hashlib
import random
from collections import Counter

import corpus_pipeline as P
import pytest
import sentencepiece
from korrel.llm.common import Scratch, read
from korrel.llm.queries import tokenizer_path

from .test_neardup import brute as near_brute


@pytest.fixture(scope="module")
def steps(spark, sf):
    scratch, docs, out = Scratch(spark, "test"), read(spark, sf, "documents"), []
    for name, stage in P.STAGES:
        docs = scratch.keep(stage(spark, docs, sf), "stage")
        out.append(docs)
    return out


def rows(df):
    return sorted(map(tuple, df.select(*P.COLUMNS).collect()))


def whole(texts):
    """Texts without the characters that lose a byte to a repeated 200-byte string."""
    own = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + 200] for d in own for i in range(len(d) - 199))
    out = []
    for t, d in zip(texts, own, strict=True):
        gone, at, kept = bytearray(len(d)), 0, []
        for i in range(len(d) - 199):
            if count[d[i : i + 200]] > 1:
                gone[i : i + 200] = b"\x01" * 200
        for c in t or "":
            n = len(c.encode())
            if not any(gone[at : at + n]):
                kept.append(c)
            at += n
        out.append("".join(kept))
    return out


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, size int, _row string, _spans int"


def odd(spark):
    """Rows that share or lack ids, hold U+FFFD and characters of several bytes, are empty, null or very long; extra columns."""
    rnd = random.Random(9)
    words = [f"{a}{b}" for a in ("ba", "dé", "ko", "l\ufffd", "mu", "日") for b in ("ra", "si", "tö", "na")]

    def prose(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    # shared passages are cut out of texts at places inside characters, which the characters before and after make
    shared = "é" * 130 + prose(60) + "日" * 90
    texts = [prose(80) + " " + "x" * k + shared[k:] + (f"{k}\ufffd keep {k} " + prose(20)) for k in range(4)]
    texts += ["ê" + shared[1:], "keep \ufffd me " + prose(40), prose(30_000), "", None, None, prose(50), prose(50)]
    ids = [1, None, None, 7, 7, 7, None, 3, None, 4, 5, 5]
    rows = [(d, t, rnd.choice(["en", None]), rnd.choice(["web", None, "x"]), len(t or ""), "n", 3, "r", 0) for d, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def some(df):
    return sorted((tuple(r) for r in df.select(*P.COLUMNS).collect()), key=str)


def test_stages_on_odd_rows(spark, sf):
    docs = odd(spark)
    first = some(docs)
    got = some(P.keep_quality(spark, docs, sf))
    assert not Counter(got) - Counter(first)
    got = some(P.keep_one_of_near_copies(spark, docs, sf))
    distinct = [(r[0], r[1]) for r in first]
    assert not Counter(got) - Counter(first) and [r[1] for r in got if not r[1]] == [r[1] for r in first if not r[1]]
    assert len(got) == len({c if c is not None else ("", i) for i, (_, n, c) in enumerate(near_brute([(i, t) for i, (_, t) in enumerate(distinct)]))})
    got = some(P.cut_repeats(spark, docs, sf))
    want = whole([r[1] for r in first])
    assert got == sorted(((r[0], t, r[2], r[3], len(t)) for r, t in zip(first, want, strict=True)), key=str)
    assert any("keep \ufffd me" in r[1] for r in got) and any("\ufffd keep" in r[1] for r in got)
    got = Counter(some(P.mix_sources(spark, docs, sf)))
    assert not set(got) - set(first) and all(r[1] and n <= 2 * first.count(r) for r, n in got.items())
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    got = sorted(((r.doc_id, r.ids) for r in P.encode(spark, docs, sf).collect()), key=str)
    assert got == sorted(((r[0], sp.encode(r[1] or "")) for r in first), key=str)


def test_stages_on_an_empty_table(spark, sf):
    docs = odd(spark).limit(0)
    for _, stage in P.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() == 0 and (out.columns == list(P.COLUMNS) or stage is P.encode)


def test_columns_and_quality(spark, sf, steps):
    assert len(P.STAGES) in (4, 5)
    for df in steps[:-1]:
        assert df.columns == list(P.COLUMNS)
    first = set(rows(steps[0]))
    assert first <= set(rows(read(spark, sf, "documents")))
    labels = {r.doc_id: r.quality for r in read(spark, sf, "labels").collect()}
    kept = {r[0] for r in first}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.97 * len(good)
    assert sum(d in kept for d, q in labels.items() if q == 0) <= 0.1 * sum(q == 0 for q in labels.values())


def test_each_stage_is_brute_force(steps):
    before = rows(steps[0])
    want = {d for d, _, c in near_brute([(r[0], r[1]) for r in before]) if d == c}
    assert rows(steps[1]) == [r for r in before if r[0] in want]
    before = rows(steps[1])
    want = [(r[0], t) for r, t in zip(before, whole([r[1] for r in before]), strict=True)]
    assert [(r[0], r[1]) for r in rows(steps[2])] == want
    assert all(r[4] == len(r[1]) for r in rows(steps[2]))
    sizes = {r[0]: len(r[1].split()) for r in rows(steps[2])}
    mixed = [r[0] for r in rows(steps[3])]
    assert set(rows(steps[3])) <= set(rows(steps[2])) and max(mixed.count(d) for d in set(mixed)) <= 2
    assert abs(sum(sizes[d] for d in mixed) - 1.5 * sum(sizes.values())) < 0.1 * sum(sizes.values())
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    want = []
    for r in rows(steps[3]):
        ids = sp.encode(r[1])
        want.append((r[0], ids, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, steps[4].collect())) == sorted(want)


def test_run_is_the_stages(spark, sf, steps):
    assert sorted(map(tuple, P.run(spark, sf).collect())) == sorted(map(tuple, steps[4].collect()))


def test_near_copies_go_by_row_not_by_id(spark, sf):
    base = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcdefg"]
    rows = [(1, base[0]), (None, base[0] + " more"), (None, base[1]), (None, base[2]), (2, base[3]), (3, base[3] + " more"), (3, base[4])]
    rows += [(None, base[5]), (None, base[5]), (4, base[6]), (4, base[6]), (None, None), (5, "")]
    df = spark.createDataFrame([(d, t, "en", "x", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in P.keep_one_of_near_copies(spark, df, sf).collect()), key=str)
    want = [(1, base[0]), (None, base[1]), (None, base[2]), (2, base[3]), (3, base[4]), (None, base[5]), (4, base[6]), (None, None), (5, "")]
    assert got == sorted(want, key=str)
