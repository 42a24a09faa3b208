"""Quality classifier by co-training of a text view and a metadata view.

The text view describes the content: which words there are (hashed), and what the text is made of (letters, symbols, capitals,
repeated words and lines, word lengths); the metadata view describes the page: language, source, size and layout. Each has its own logistic classifier. Starting from
labelled documents they work through rounds over a pool of unlabelled ones: each gives the documents it is surest of to the
other as pseudo-labelled examples, good and bad in the proportion of the labels, and both are fitted anew. A fold of the
labelled rows is kept apart to calibrate both views and to weigh them against each other; the combination scores all documents.

What is learnt from is bounded: about ``SAMPLE`` labelled rows outside the held-out fold and ``POOL`` unlabelled ones. A view that
the calibration finds to know nothing gets no weight.

Cases: null texts are empty ones, null languages and sources values of their own; all are scored. Without labels of both kinds
every score is the same, the rate of the labels that there are. Repeated rows get equal scores; of rows that share a labelled id
one is learnt from, the least by text, language and source. An empty table gives an empty one. Extra columns stay in ``score``,
but one named like the score, which is replaced.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import linear
from .common import Scratch, give_back, released
from .samples import held_out, learnable, sampled

#: Labelled and unlabelled documents that are learnt from, at most about so many.
SAMPLE, POOL = 8_000, 8_000
#: Rounds of exchange, pseudo-labels that a view gives in one as a share of the pool, and how sure of them it must be.
ROUNDS, GIVEN, SURE = 5, 0.05, 0.9
#: Columns that languages and sources are hashed to, and columns of words, with a stronger ridge for each of those.
BUCKETS, WORDS, RIDGE = 16, 64, 20.0
#: Score from which a document counts as good.
KEEP = 0.5

_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91)]] = 1
_KIND[[*range(97, 123)]] = 2
_KIND[[*range(48, 58)]] = 3
_KIND[[9, 10, 11, 12, 13, 32]] = 4
_KIND[[ord(c) for c in ".,;:'\"()?-"]] = 5
_KIND[128:] = 6
_KINDS = _KIND.tobytes()


_BUCKET: dict[str, int] = {}


def _bucket(word: str) -> int:
    """The column of a word; a worker remembers some."""
    found = _BUCKET.get(word)
    if found is None:
        if len(_BUCKET) > 200_000:
            _BUCKET.clear()
        found = _BUCKET[word] = xxhash.xxh32_intdigest(word.lower()) % WORDS
    return found


def text_view(text: str) -> list[float]:
    data = text.encode()
    n = max(1, len(data))
    kind = np.bincount(np.frombuffer(data.translate(_KINDS), np.uint8), minlength=7) / n
    words = text.split()
    m = max(1, len(words))
    counts = Counter(words)
    top = max(counts.values(), default=0) / m
    # of the distinct words of plain prose there are about m ** 0.8: what is missing tells of repetition
    fresh = math.log((len(counts) + 1) / (m**0.8 + 1))
    again = sum(map(eq, words, words[1:])) / m
    lines = [x for x in text.split("\n") if x]
    double = 1 - len(set(lines)) / max(1, len(lines))
    short = sum(1 for w in counts if len(w) == 1) / max(1, len(counts))
    hashed = np.bincount([_bucket(w) for w in counts], list(counts.values()), WORDS) if counts else np.zeros(WORDS)
    made = [*kind[:7].tolist(), math.sqrt(kind[0]), kind[1] / (kind[1] + kind[2] + 1e-3), top, fresh, again, math.sqrt(again), double, short, (n - kind[4] * n) / m / 10]
    return made + np.sqrt(hashed / m).tolist()


def meta_view(text: str, lang: str | None, source: str | None) -> list[float]:
    lines = text.count("\n") + 1
    size = len(text)
    out = [math.log1p(size), math.log1p(size) ** 2 / 10, math.log(lines), math.log1p(size / lines)]
    for name, value in (("l", lang), ("s", source)):
        hot = [0.0] * BUCKETS
        hot[xxhash.xxh32_intdigest(f"{name}:{value}") % BUCKETS] = 1.0
        out += hot
    return out


@dataclass(frozen=True)
class Model:
    text: linear.Logistic
    meta: linear.Logistic
    joint: linear.Logistic
    exchanged: tuple[tuple[int, int], ...] = ()

    def score(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.joint.score(np.stack([self.text.logit(a), self.meta.logit(b)], 1))


def cotrain(a: np.ndarray, b: np.ndarray, y: np.ndarray, calibrate: np.ndarray, pool_a: np.ndarray, pool_b: np.ndarray, ridge: float | np.ndarray = 1.0) -> Model:
    """Fit both views on the rows outside ``calibrate`` and the pool, and their combination on ``calibrate``; ``ridge`` is the first view's."""
    fit_rows = ~calibrate if 0 < calibrate.sum() < len(y) else np.ones(len(y), bool)
    views, pools = (a[fit_rows], b[fit_rows]), (pool_a, pool_b)
    ya = y[fit_rows]
    rate = float(ya.mean()) if len(ya) else 0.5
    taught: list[list[tuple[int, int]]] = [[], []]  # what each view was given: (row of the pool, label)
    exchanged = []

    def fitted(v: int) -> linear.Logistic:
        rows = np.array([r for r, _ in taught[v]], np.int64)
        given = np.array([t for _, t in taught[v]], float)
        weight = np.concatenate([np.ones(len(ya)), np.full(len(given), 0.5)])
        return linear.fit(np.concatenate([views[v], pools[v][rows]]), np.concatenate([ya, given]), 1.0 if v else ridge, weight)

    models = [fitted(0), fitted(1)]
    if len(pool_a) and 0 < rate < 1:
        for _ in range(ROUNDS):
            given = []
            for v in (0, 1):
                known = {r for r, _ in taught[1 - v]}
                p = models[v].score(pools[v])
                quota = max(1, round(GIVEN * len(p)))
                n = 0
                for label, order, want in ((1, np.argsort(-p, kind="stable"), rate), (0, np.argsort(p, kind="stable"), 1 - rate)):
                    sure = [int(r) for r in order[: quota * ROUNDS] if (p[r] if label else 1 - p[r]) >= SURE and int(r) not in known]
                    new = sure[: max(1, round(quota * want))]
                    taught[1 - v] += [(r, label) for r in new]
                    n += len(new)
                given.append(n)
            exchanged.append(tuple(given))
            models = [fitted(0), fitted(1)]
            if not any(given):
                break
    rows = calibrate if calibrate.any() else np.ones(len(y), bool)
    logits = np.stack([models[0].logit(a[rows]), models[1].logit(b[rows])], 1) if len(y) else np.zeros((0, 2))
    return Model(models[0], models[1], linear.fit(logits, y[rows], 1.0), tuple(exchanged))


def _views(docs: DataFrame) -> DataFrame:
    """Both views of the rows of ``docs(text, lang, source, y, calibrate)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, lang, source = (batch.column(i).to_pylist() for i in range(3))
            a = [np.array(text_view(t), np.float32).tobytes() for t in text]
            b = [np.array(meta_view(*r), np.float32).tobytes() for r in zip(text, lang, source, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), batch.column(3), batch.column(4)], names=["a", "b", "y", "calibrate"])

    return docs.mapInArrow(released(run), "a binary, b binary, y int, calibrate boolean")


def learn(docs: DataFrame, labels: DataFrame, scratch: Scratch, sample: int = SAMPLE, pool: int = POOL) -> Model:
    """Co-train on about ``sample`` labelled rows outside the held-out fold and ``pool`` rows without labels."""
    known = learnable(labels, "quality", sample).withColumn("labelled", F.lit(True))
    ids = docs.select("doc_id").filter("doc_id is not null").distinct().join(labels.select("doc_id").distinct(), "doc_id", "left_anti")
    unknown = sampled(ids, pool, "pool").select("doc_id", F.lit(None).cast("int").alias("y"), F.lit(False).alias("labelled"))
    wanted = scratch.keep(known.unionByName(unknown), "ids")
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    rows = rows.join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct("text", "lang", "source")).alias("r")).select("doc_id", "y", "r.*")
    apart = F.crc32(F.concat(F.lit("c:"), F.col("doc_id").cast("string")).cast("binary")) % 4 == 0
    # one row for each id: bounded by the two sample sizes
    got = _views(rows.select("text", "lang", "source", "y", apart.alias("calibrate"))).collect()
    got.sort(key=lambda r: (r.y is None, r.y, bytes(r.a), bytes(r.b)))
    taught, other = [r for r in got if r.y is not None], [r for r in got if r.y is None]
    wide_a, wide_b = len(text_view("")), len(meta_view("", None, None))

    def matrix(rows: list, of: str, wide: int) -> np.ndarray:
        return np.frombuffer(b"".join(bytes(r[of]) for r in rows), np.float32).reshape(-1, wide).astype(float)

    y = np.array([r.y for r in taught], float)
    calibrate = np.array([r.calibrate for r in taught], bool)
    ridge = np.where(np.arange(wide_a) < wide_a - WORDS, 1.0, RIDGE)
    sides = [matrix(rows, of, wide) for rows in (taught, other) for of, wide in (("a", wide_a), ("b", wide_b))]
    del got, taught, other
    model = cotrain(sides[0], sides[1], y, calibrate, sides[2], sides[3], ridge)
    del sides
    give_back()
    return model


def score(docs: DataFrame, model: Model, score_col: str = "quality_score") -> DataFrame:
    """``docs`` (with text, lang and source) with the score of each row: the likelihood that it is good."""
    stay = [f for f in docs.schema.fields if f.name != score_col]
    schema = T.StructType([*stay, T.StructField(score_col, T.DoubleType(), False)])
    own = [docs.columns.index(f.name) for f in stay]
    t, l, s = (docs.columns.index(c) for c in ("text", "lang", "source"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for k in range(0, big.num_rows, 1024):
                batch = big.slice(k, 1024)
                text = [x or "" for x in batch.column(t).to_pylist()]
                a = np.array([text_view(x) for x in text])
                b = np.array([meta_view(*r) for r in zip(text, batch.column(l).to_pylist(), batch.column(s).to_pylist(), strict=True)])
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in own), pa.array(model.score(a, b))], names=[f.name for f in schema])

    return docs.mapInArrow(released(run), schema)


def classified(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, held_out, score and predicted (1: good) of every row of ``docs``."""
    model = learn(docs, labels, scratch)
    scored = score(docs.select("doc_id", "text", "lang", "source"), model, "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= KEEP).cast("int").alias("predicted"))
