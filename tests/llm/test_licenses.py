import math
import random
import re

from korrel.llm import licenses


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, word string")
    return licenses.scan(df).collect()


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text):
    w = words(text)
    at = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in at]
    return len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))


def test_base_places_are_brute_force(spark):
    rnd = random.Random(1)
    pieces = ["CC-BY", "cc by cc", "General Public\nLicense", "GNU general public license version 3", "All rights reserved.", "all rights", "reserved", "the", "by", "Öl K", "x1", "MIT License", "public license", "cc"]
    rows = [(i, " ".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "..."), (503, "all rights reserved " * 3000), (504, "cc by"), (504, "cc by")]
    got = sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in run(spark, rows))
    assert str(got) == str(sorted((d, *brute(t)) for d, t in rows))


def test_own_labels(spark):
    rows = [
        (1, "Prose before. Released under the MIT License. And after."),
        (2, "Licensed under the Apache License, Version 2.0."),
        (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "Licensed under CC BY-NC 4.0."),
        (5, "Permission to mit the license was refused; general remarks on public rights."),
        (6, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ]
    got = {r.doc_id: r for r in run(spark, rows + [(100 + i, "the and of this software is a public work of general version") for i in range(50)])}
    assert got[1].labels == "mit" and got[2].labels == "apache-2.0" and got[6].labels == "mit"
    assert got[3].labels == "gpl,gpl-3.0" and got[3].base_labels == "gpl"
    assert got[4].labels.startswith("cc-by,") and "cc-by-nc" in got[4].labels
    assert got[5].labels == "" and got[5].score == 0 and got[100].labels == ""
    assert all(0 <= r.score <= 1 for r in got.values()) and got[1].score > 0.9


def test_empty_table(spark):
    assert run(spark, []) == []


def test_own_labels_open_at_the_key_phrase(spark):
    # most files lack "associated documentation", and the key phrase may start a file
    short = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    rows = [(i, short) for i in range(5)] + [(100, "Apache License, Version 2.0, January 2004"), (101, "CC BY-SA 4.0"), (102, "granted free of charge")]
    got = {r.doc_id: r for r in run(spark, rows + [(1000 + i, "the quick brown fox") for i in range(200)])}
    assert all(got[i].labels == "mit" for i in range(5)) and got[100].labels == "apache-2.0"
    assert "cc-by-sa" in got[101].labels and got[102].labels == "" and got[1000].labels == ""


def full(rows):
    """Labels and score of each text by a look at every place of every wording, without an index."""
    own = [words(t) for _, t in rows]
    vocabulary = {w for t in licenses.templates() for w in t.words}
    idf = {w: math.log((len(own) + 1) / (sum(w in x for x in map(set, own)) + 0.5)) for w in vocabulary}
    out = []
    for (d, _), w in zip(rows, own, strict=True):
        labels, score = set(), 0.0
        for t in licenses.templates():
            for begin in range(-len(t.words), len(w)):
                there = [0 <= begin + i < len(w) and w[begin + i] == x for i, x in enumerate(t.words)]
                share = sum(idf[x] for x, y in zip(t.words, there, strict=True) if y) / sum(idf[x] for x in t.words)
                if all(there[t.key_at : t.key_at + len(t.key)]) and share >= licenses.SHARE:
                    labels.add(t.label)
                    score = max(score, min(1.0, share))
        out.append((d, ",".join(sorted(labels)), round(score, 5)))
    return sorted(out)


def test_labels_and_score_are_brute_force(spark):
    rnd = random.Random(2)
    vocabulary = sorted({w for t in licenses.templates() for w in t.words}) + ["other", "words"]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            t = list(rnd.choice(licenses.templates()).words)
            for _ in range(rnd.choice([0, 0, 1, 3])):
                t[rnd.randrange(len(t))] = rnd.choice(vocabulary)
            parts += t[rnd.choice([0, 0, 1, 3]) : len(t) - rnd.choice([0, 0, 2])] + [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 6))]
        rows.append((i, " ".join(parts)))
    got = sorted((r.doc_id, r.labels, round(r.score, 5)) for r in run(spark, rows))
    assert got == full(rows) and len({r[1] for r in got}) > 20


def test_the_rarest_word_of_the_key_phrase_is_the_index():
    every = licenses.templates()
    idf = {w: float(i) for i, w in enumerate(sorted({w for t in every for w in t.words}, reverse=True))}
    for t, at in zip(every, licenses.indexed(idf), strict=True):
        assert t.words[at] == min(t.key) and t.key_at <= at < t.key_at + len(t.key)


def test_long_texts_of_licence_words(spark):
    rows = [(1, "all rights reserved by cc " * 40_000), (2, "version 2 0 " * 50_000)]
    got = {r.doc_id: r for r in run(spark, rows)}
    assert got[1].n_base == 40_000 and got[1].last_word == 5 * 39_999 and got[2].labels == ""
