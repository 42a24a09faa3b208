"""License scans by a positional index of rare words, in DataFrame operations only.

``TEMPLATES`` are short wordings of public licences and notices, each with a key phrase that must stand in a file word by word.
The words of all templates are counted over the whole corpus, by documents. Each template is indexed under the word of its key
phrase with the highest inverse document frequency, whatever that word is, with its position in the wording: the key phrase is
mandatory, so every place of a match is found through it. A file's words are looked up in the index; a hit names a template and
the place where it would begin. There the postings of all words of the wording are intersected by relative position: the words
that stand where they should, weighted by their rarity, give the match's share, and the key phrase must be there whole. A phrase
of ``BASE`` is a template that is its own key phrase.

Texts are read twice, once for the counts and once for the places; nothing is shuffled but the counts of the templates' words.

Cases: a null text is the empty one: no words, no labels, score 0. Texts are read whole; repeated rows and null ids are rows of
their own; an empty table gives an empty one. Phrases are found across any separators, line ends too; a wording may begin before
its file does. Extra columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases whose places are counted, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: (label, wording, key phrase). Words as the scan splits them.
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "licensed under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("bsd", "licensed under the bsd license", "bsd license"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc0", "released under cc0 1 0 universal public domain dedication", "cc0 1 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "released into the public domain"),
)
#: The least share of a wording that makes a match.
SHARE = 0.5


@dataclass(frozen=True)
class Template:
    label: str
    base: bool
    words: tuple[str, ...]
    key_at: int
    key: tuple[str, ...]


def templates() -> list[Template]:
    out = []
    for label, wording, key, base in [(label, text, text, True) for text, label in BASE.items()] + [(*t, False) for t in TEMPLATES]:
        words, must = tuple(wording.split()), tuple(key.split())
        out.append(Template(label, base, words, next(i for i in range(len(words)) if words[i : i + len(must)] == must), must))
    return out


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def rarity(docs: DataFrame, text: str = "text") -> dict[str, float]:
    """The inverse document frequency of every word of the templates, over all of ``docs``."""
    vocabulary = sorted({w for t in templates() for w in t.words})
    own = F.array_intersect(words_of(F.col(text)), F.array(*map(F.lit, vocabulary)))
    # the empty word, which no text has, stands for the document itself
    counts = docs.select(F.explode(F.concat(own, F.array(F.lit("")))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    files = {r.word: r.n for r in counts.collect()}  # a row for each word of the templates
    return {w: math.log((files.get("", 0) + 1) / (files.get(w, 0) + 0.5)) for w in vocabulary}


def indexed(idf: dict[str, float]) -> list[int]:
    """For each template the position of its index word: the rarest one of the key phrase, of equals the first."""
    return [max(range(t.key_at, t.key_at + len(t.key)), key=lambda i, t=t: (idf[t.words[i]], -i)) for t in templates()]


def _literals(values) -> Column:
    return F.array(*map(F.lit, values))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base phrases and labels of each row of ``docs(doc_id, text)``."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    idf, every = rarity(docs), templates()
    postings: dict[str, list[tuple[int, int]]] = {}
    for k, at in enumerate(indexed(idf)):
        postings.setdefault(every[k].words[at], []).append((k, at))
    index = F.create_map(*(x for w, own in postings.items() for x in (F.lit(w), F.array(*(F.struct(F.lit(k).alias("t"), F.lit(at).alias("at")) for k, at in own)))))
    table = F.array(*(
        F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), _literals(t.words).alias("words"), F.lit(t.key_at).alias("key_at"), _literals(t.key).alias("key"),
            _literals([idf[w] for w in t.words]).alias("idf"), F.lit(sum(idf[w] for w in t.words)).alias("whole"),
        )
        for t in every
    ))

    words = F.col("words")
    places = F.filter(F.transform(words, lambda w, i: F.when(w.isin(*postings), F.struct(w.alias("word"), i.alias("pos")))), lambda p: p.isNotNull())
    begins = F.flatten(F.transform(places, lambda p: F.transform(index[p["word"]], lambda x: F.struct(F.get(table, x["t"]).alias("t"), (p["pos"] - x["at"]).alias("begin")))))

    def whole(b: Column) -> Column:
        """Whether the key phrase stands where it should."""
        first = b["begin"] + b["t"]["key_at"]
        return (first >= 0) & (F.slice(words, F.greatest(first + 1, F.lit(1)), F.size(b["t"]["key"])) == b["t"]["key"])

    def share(b: Column) -> Column:
        there = F.transform(b["t"]["words"], lambda w, i: F.when(F.get(words, b["begin"] + i) == w, F.get(b["t"]["idf"], i)).otherwise(0.0))
        return F.least(F.lit(1.0), F.aggregate(there, F.lit(0.0), lambda n, x: n + x) / b["t"]["whole"])

    found = F.transform(F.filter("begins", whole), lambda b: F.struct(b["t"]["label"].alias("label"), b["t"]["base"].alias("base"), b["begin"].alias("begin"), share(b).alias("share")))
    rows = docs.select("doc_id", words_of(F.col("text")).alias("words")).select("doc_id", "words", begins.alias("begins"))
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), F.filter(found, lambda m: m["share"] >= SHARE).alias("found"))
    rows = rows.select("doc_id", "n_words", "found", F.filter("found", lambda m: m["base"]).alias("placed"))

    def names(column: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(column, lambda m: m["label"]))), ",")

    starts = F.transform("placed", lambda m: m["begin"].cast("long"))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("placed").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names("placed").alias("base_labels"),
        names("found").alias("labels"),
        F.round(F.coalesce(F.array_max(F.transform("found", lambda m: m["share"])), F.lit(0.0)), 6).alias("score"),
    )
