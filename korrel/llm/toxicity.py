"""Toxicity of whole texts: a learnt lexicon, met through Levenshtein automata, weighed by context.

Learning takes a bounded sample of labelled documents outside the held-out fold. Terms (whole words, and stems that many words
start with) that toxic documents have and others lack form the lexicon. It is a trie; the Levenshtein automata of all terms run
over it at once: a state is the set of (trie node, edits so far), made deterministic as words need it, so a word costs one table
look-up a letter whatever the lexicon's size, and most words end in the dead state after a few letters. Misspelled terms that
innocent documents of the sample use as words are left out, and how far to trust the others is measured on words that only one
document of the sample has.

Around every hit a window of words and marks tells quotation (quotation marks, reporting words, talk about words) from abuse
(address in the second person); how much less a hit in a quotation counts is learnt. The summed weights of the hits go through a logistic model.

Cases: a null or empty text, and one without hits, gets the score of no hits. Texts are read whole. Labels are looked up by
doc_id only while learning; of rows that share a labelled id one is learnt from, the least by text. Without any label of one
kind the score is a constant below one half. Repeated rows get equal scores; an empty table gives an empty one. Extra columns stay
in ``score``, but those named toxicity, hits and quoted, which are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import linear
from .common import Scratch, released
from .samples import held_out, learnable

#: Labelled documents that are learnt from, at most about so many.
SAMPLE = 12_000
#: Least letters of a term; of a whole word and of a stem that one misspelling, and of a word that two, may be met by.
SHORT, ONE, ONE_STEM, TWO = 4, 5, 7, 9
#: Of toxic documents the least share that has a term, and of the documents with a term the least share that is toxic.
SUPPORT, PRECISION = 0.02, 0.8
WINDOW = 8
WORD = re.compile(r"\w+")
#: Marks of quotation, and words that tell of speech or of an address, in the languages of the corpus.
QUOTES = "\"“”„«»‘’`"
REPORTING = frozenset("said says say wrote writes called calls quoted quote quotes quoting term word words phrase slur insult insults sagte nannte wort a dit mot appelé dijo palabra llamó".split()) - {"a"}
ADDRESS = frozenset("you your youre ur u du dich dir ihr tu te toi vous votre tú usted eres are bist es".split())
END = "\0"


class Automaton:
    """Levenshtein automata of all terms, intersected with their trie and made deterministic on demand.

    A term ending in ``END`` is a whole word; any other is a stem, met by words that start with it.
    """

    DEAD = 0

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.child: list[dict[str, int]] = [{}]
        self.at: list[int] = [-1]
        self.stem: list[bool] = [False]
        self.most: list[int] = [0]
        for k, term in enumerate(terms):
            word, node, edits = term.rstrip(END), 0, self.edits(term)
            self.most[0] = max(self.most[0], edits)
            for c in word:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.at.append(-1)
                    self.stem.append(False)
                    self.most.append(0)
                node = self.child[node][c]
                self.most[node] = max(self.most[node], edits)
            if self.at[node] < 0 or not term.endswith(END):
                self.at[node], self.stem[node] = k, not term.endswith(END)
        self.letters = {c for t in terms for c in t}
        self._number: dict[frozenset, int] = {frozenset(): 0}
        self._sets: list[frozenset] = [frozenset()]
        self._step: list[dict[str, int]] = [{}]
        self._ends: list[tuple[int, int] | None] = [None]
        self._stems: list[tuple[int, int] | None] = [None]
        self.start = self._state({(0, 0, "")})

    @staticmethod
    def edits(term: str) -> int:
        n = len(term.rstrip(END))
        if not term.endswith(END):
            return int(n >= ONE_STEM)
        return 2 if n >= TWO else int(n >= ONE)

    def _state(self, items: set[tuple[int, int, str]]) -> int:
        todo = list(items)
        while todo:  # a term's letter may be missing from the word
            node, e, wait = todo.pop()
            if not wait:
                for c in self.child[node].values():
                    if e < self.most[c] and (c, e + 1, "") not in items:
                        items.add((c, e + 1, ""))
                        todo.append((c, e + 1, ""))
        least: dict[tuple[int, str], int] = {}
        for node, e, wait in items:
            least[node, wait] = min(e, least.get((node, wait), 9))
        key = frozenset((n, e, w) for (n, w), e in least.items())
        if key not in self._number:
            self._number[key] = len(self._sets)
            self._sets.append(key)
            self._step.append({})
            done = [(e, self.at[n], self.stem[n]) for n, e, w in key if not w and self.at[n] >= 0 and e <= self.edits(self.terms[self.at[n]])]
            self._ends.append(min(((e, k) for e, k, _ in done), default=None))
            self._stems.append(min(((e, k) for e, k, s in done if s), default=None))
        return self._number[key]

    def _next(self, state: int, c: str) -> int:
        out: set[tuple[int, int, str]] = set()
        for node, e, wait in self._sets[state]:
            if wait:
                if c == wait:
                    out.add((node, e, ""))
                continue
            if c in self.child[node]:
                out.add((self.child[node][c], e, ""))
            if e < self.most[node]:
                out.add((node, e + 1, ""))  # a letter too many
            for x, n in self.child[node].items():
                if e < self.most[n]:
                    out.add((n, e + 1, ""))  # another letter
                    if c in self.child[n] and c != x:
                        out.add((self.child[n][c], e + 1, x))  # two letters the wrong way round
        return self._state({(n, e, w) for n, e, w in out if e <= self.most[n]})

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the closest term that a lower-cased word meets."""
        state, best = self.start, None
        for c in word:
            c = c if c in self.letters else "�"
            step = self._step[state]
            nxt = step.get(c)
            if nxt is None:
                nxt = step[c] = self._next(state, c)
            state = nxt
            if state == self.DEAD:
                return best
            if self._stems[state] is not None and (best is None or self._stems[state] < best):
                best = self._stems[state]
        end = self._ends[state]
        return end if end is not None and (best is None or end < best) else best


def terms_of(text: str) -> set[str]:
    """Whole words (with an end mark) and stems of a text."""
    out: set[str] = set()
    for w in set(WORD.findall(text.lower())):
        if len(w) >= SHORT:
            out.add(w + END)
            out.update(w[:k] for k in range(SHORT, min(len(w), 12) + 1))
    return out


def choose(counts: dict[str, tuple[int, int]], toxic: int, other: int) -> list[str]:
    """The lexicon from (toxic, other) document counts of terms: of nested terms the longest that still has nearly all hits."""
    # so many toxic documents in a row are less likely, by chance, than one in the number of terms that are tried
    chance = math.ceil(12 / math.log((toxic + other) / toxic))
    least = max(chance, math.ceil(SUPPORT * toxic))
    good = {t: p for t, (p, n) in counts.items() if p >= least and p >= PRECISION * (p + n)}
    out: set[str] = set()
    for t in sorted(good, key=lambda t: (len(t), t)):
        if any(t[:k] in out for k in range(SHORT, len(t))):
            continue
        while True:
            longer = [q for q in good if len(q) == len(t) + 1 and q.startswith(t) and good[q] >= 0.9 * good[t]]
            if not longer:
                break
            t = max(longer, key=lambda q: (good[q], q))
        out.add(t)
    return sorted(out)


#: What a hit in a quotation may count, of one elsewhere.
QUOTED = (0.25, 0.05, 0.5, 1.0)


@dataclass
class Model:
    terms: list[str]
    weight: dict[tuple[int, int], float] = field(default_factory=dict)
    innocent: frozenset = frozenset()
    quoted: float = QUOTED[0]
    fitted: linear.Logistic | None = None


class Scorer:
    """A model with its automaton and what it remembers of words."""

    def __init__(self, model: Model):
        self.model, self.automaton = model, Automaton(model.terms)
        self.seen: dict[str, tuple[int, int] | None] = {}

    def meet(self, word: str) -> tuple[int, int] | None:
        if word in self.seen:
            return self.seen[word]
        hit = self.automaton.match(word)
        if hit is not None and hit[0] and word in self.model.innocent:
            hit = None
        if len(self.seen) > 400_000:
            self.seen.clear()
        self.seen[word] = hit
        return hit

    def hits(self, text: str) -> list[tuple[int, int, str, float]]:
        """(edits, term, word, quotation score 0 to 1) of every hit in a text."""
        lower = text.lower()
        if not any(self.meet(w) for w in set(WORD.findall(lower))):
            return []
        words = [(m.start(), m.end(), m[0]) for m in WORD.finditer(lower)]
        out = []
        for i, (a, b, w) in enumerate(words):
            hit = self.meet(w)
            if hit is None:
                continue
            lo, hi = words[max(0, i - WINDOW)][0], words[min(len(words) - 1, i + WINDOW)][1]
            before, after = lower[lo:a], lower[b:hi]
            near = {x for _, _, x in words[max(0, i - WINDOW) : i + WINDOW + 1]}
            marks = any(c in QUOTES for c in before) and any(c in QUOTES for c in after)
            quoting = 0.6 * marks + 0.4 * bool(near & REPORTING) - 0.4 * (bool(near & ADDRESS) and not marks)
            out.append((*hit, w, min(1.0, max(0.0, quoting))))
        return out

    def features(self, text: str) -> tuple[float, float, float, int]:
        """Summed and greatest weight of the hits, the share in quotations, and their number."""
        return self.weighed(self.hits(text), self.model.quoted)

    def weighed(self, hits: list[tuple[int, int, str, float]], weight: float) -> tuple[float, float, float, int]:
        """The same of hits, where one in a quotation counts ``weight``."""
        total, most, quoted, n = 0.0, 0.0, 0.0, 0
        for e, k, _, q in hits:
            w = self.model.weight.get((k, e), 0.0) * (1 - (1 - weight) * q)
            if w > 0:
                total += w
                most = max(most, w)
                quoted += q
                n += 1
        return math.log1p(total), most, quoted / n if n else 0.0, n


def _words_key(text: str) -> int:
    """A document's least shingle hash: copies of a text mostly share it."""
    w = text.split()
    return min((xxhash.xxh3_64_intdigest(" ".join(w[i : i + 5])) for i in range(max(1, len(w) - 4))), default=0)


def learn(docs: DataFrame, labels: DataFrame, scratch: Scratch, sample: int = SAMPLE) -> Model:
    """A model from about ``sample`` labelled rows of ``docs(doc_id, text)`` outside the held-out fold."""
    wanted = learnable(labels, "toxic", sample)
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("text", "y")
    rows = scratch.keep(rows, "sample")  # a bounded table, read three times

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        counts: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        rows = [0, 0]
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                key = (_words_key(text), y)
                if key in seen:
                    continue
                seen.add(key)
                rows[y] += 1
                for t in terms_of(text):
                    counts[t][y] += 1
        counts[""] = rows
        # terms that no toxic document of this task has are counted only if another task's has them: all go out
        yield pa.RecordBatch.from_pydict({"term": list(counts), "other": [c[0] for c in counts.values()], "toxic": [c[1] for c in counts.values()]})

    table = rows.mapInArrow(released(count), "term string, other long, toxic long").groupBy("term").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    # the sample is bounded, and so is what of it may be a term
    got = {r.term: (r.toxic, r.other) for r in table.filter(f"term = '' or (toxic >= 3 and toxic >= {PRECISION} * (toxic + other))").collect()}
    toxic, other = got.pop("", (0, 0))
    model = Model(choose(got, toxic, other) if toxic and other else [])
    lift = math.log((other + 1) / (toxic + 1))
    for k, t in enumerate(model.terms):
        p, n = got[t]
        model.weight[k, 0] = max(0.0, min(8.0, math.log((p + 0.5) / (n + 0.5)) + lift))

    bare = Model(model.terms)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(bare)
        for batch in batches:
            out = []
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                many = Counter((w, e, k) for e, k, w, _ in scorer.hits(text) if e)
                out += [(w, e, k, y, n) for (w, e, k), n in many.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()))], names=["w", "e", "k", "y", "n"])

    novel: dict[tuple[int, int], list[int]] = defaultdict(lambda: [0, 0])
    innocent = set()
    if model.terms:
        met = rows.mapInArrow(released(meet), "w string, e int, k int, y int, n long").groupBy("w", "e", "k")
        met = met.agg(F.count_if(F.col("y") == 0).alias("other"), F.count_if(F.col("y") == 1).alias("toxic"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("n0"), F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("n1"))
        for r in met.collect():  # a row for each distinct word of the sample that is some edits from a term
            if r.other:
                innocent.add(r.w)
            if r.other + r.toxic == 1:
                novel[r.k, r.e][0] += r.n0
                novel[r.k, r.e][1] += r.n1
    model.innocent = frozenset(innocent)
    for k in range(len(model.terms)):
        for e in (1, 2):
            p, n = novel[k, e][1], novel[k, e][0]
            trust = (p + 1.0) / (p + n * (other + toxic) / max(1, toxic) * 0.2 + 1.5)
            model.weight[k, e] = model.weight[k, 0] * trust / e if trust > 0.4 else 0.0

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            hits = [scorer.hits(t) for t in batch.column(0).to_pylist()]
            x = [[v for quoted in QUOTED for v in scorer.weighed(h, quoted)[:3]] for h in hits]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])

    got = rows.mapInArrow(released(use), "y int, x array<double>").collect() if model.terms else []  # a row for each of the sample
    x = np.array([r.x for r in got]).reshape(-1, len(QUOTED), 3)
    y = np.array([r.y for r in got], float)
    if not model.terms:
        y, x = np.zeros(1), np.zeros((1, len(QUOTED), 3))
    # what a quoted hit counts is learnt too: the weight under which the labels are likeliest, the first one unless another is better
    fits = [linear.fit(x[:, i], y, 1.0) for i in range(len(QUOTED))]
    losses = [float((np.logaddexp(0, f.logit(x[:, i])) - y * f.logit(x[:, i])).sum()) for i, f in enumerate(fits)]
    best = min(range(len(QUOTED)), key=lambda i: (losses[i] > min(losses) + 0.01 * max(1.0, abs(losses[0])), i))
    model.quoted, model.fitted = QUOTED[best], fits[best]
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with toxicity (0 to 1), the number of hits and the share of them in quotations."""
    new = ["toxicity", "hits", "quoted"]
    stay = [f for f in docs.schema.fields if f.name not in new]
    schema = T.StructType([*stay, T.StructField("toxicity", T.DoubleType(), False), T.StructField("hits", T.LongType(), False), T.StructField("quoted", T.DoubleType(), False)])
    at, own = docs.columns.index(text_col), [docs.columns.index(f.name) for f in stay]
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for big in batches:
            for k in range(0, big.num_rows, 1024):
                batch = big.slice(k, 1024)
                x = np.array([scorer.features(t or "") for t in batch.column(at).to_pylist()], float)
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in own), pa.array(model.fitted.score(x[:, :3])), pa.array(x[:, 3].astype(np.int64)), pa.array(x[:, 2])], names=names)

    return docs.mapInArrow(released(run), schema)


def flagged(docs: DataFrame, labels: DataFrame, scratch: Scratch, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``, by a model learnt from ``labels``."""
    model = learn(docs, labels, scratch, sample)
    return score(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"), "hits", "quoted")
