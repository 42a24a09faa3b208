"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks.

A page is a chain of leaf blocks (``html_blocks``). Features of a block are its ancestors' tags, what their class, id and role
attributes say, its own tag, and the size and form of its text; features of a transition are the two labels and whether both
blocks have the same parent. The field is trained on labelled pages (``html_pages``) by maximum likelihood, with exact marginals
from the forward-backward recursion, and a page is labelled by Viterbi. Its article is the text of the blocks of the first label.

Cases: a null or empty page has an empty text, as has one whose blocks are all of the second label. Pages are read whole, cut or
broken markup too. Repeated rows get equal results; null urls and ids stay; an empty table gives an empty one. Extra columns stay
in ``extract``, but one named like the text, which is replaced.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import released
from .html_blocks import CUES, Block, Paths, blocks
from .html_pages import labelled

#: Pages that the field is trained on, passes of training, and the weight of the prior.
PAGES, PASSES, RIDGE = 1500, 160, 0.3

_TAGS = "body p h1 h2 h3 h4 h5 h6 li ul ol td th tr table div section article main nav header footer aside form label button legend pre blockquote figure figcaption dl dt dd dialog menu address details summary fieldset center".split()
_ABOVE = "nav header footer aside form article main section table ul ol li blockquote figure dialog menu address details div p fieldset".split()
_NAMES = [
    *(f"tag:{t}" for t in [*_TAGS, "?"]),
    *(f"above:{t}" for t in _ABOVE),
    *(f"cue:{c}" for c in CUES),
    *(f"own:{c}" for c in CUES),
    "bad-in-good", "good-only", "heading-in-header-of-article", "depth:0", "depth:1", "depth:2", "depth:3", "depth:4",
    *(f"size:{k}" for k in range(12)),
    *(f"links:{k}" for k in range(5)),
    "stop", "commas", "sign", "bars", "first", "second", "early", "late", "last", "bias",
]
_AT = {n: i for i, n in enumerate(_NAMES)}
_GOOD_TAGS = frozenset(["article", "main"])
_BAD_TAGS = frozenset(["nav", "header", "footer", "aside", "form", "dialog", "menu", "address"])
_BAD_CUES = frozenset(["nav", "header", "footer", "side", "ad", "notice", "comment", "share", "form", "hidden"])


#: Bits of the features that an ancestor's tag and what its attributes say set.
_TAG_BIT = {t: 1 << _AT[f"above:{t}"] for t in _ABOVE}
_CUE_BIT = {c: 1 << _AT[f"cue:{c}"] for c in CUES}


def _step(state: tuple, tag: str, cue: frozenset) -> tuple:
    """(bits, good, bad, bad inside good, header, depth) of a path from those of its parent."""
    bits, good, bad, inner_bad, header, depth = state
    bits |= _TAG_BIT.get(tag, 0)
    for c in cue:
        bits |= _CUE_BIT[c]
    is_bad = tag in _BAD_TAGS or (bool(cue & _BAD_CUES) and "main" not in cue)
    is_good = (tag in _GOOD_TAGS or "main" in cue) and not is_bad
    return bits, good or is_good, bad or is_bad, inner_bad or (good and is_bad), header or tag == "header", depth + 1


def path_features(paths: Paths, path: int) -> tuple[int, ...]:
    """Numbers of the features that follow from a block's ancestors alone. Each path is worked out once, from its parent's state."""
    todo, p, known = [], path, paths.state
    while p >= 0 and p not in known:
        todo.append(p)
        p = paths.parent[p]
    state = known[p] if p >= 0 else (0, False, False, False, False, 0)
    for p in reversed(todo):
        state = known[p] = _step(state, paths.tag[p], paths.cue[p])
    bits, good, bad, inner_bad, header, depth = state
    tag = paths.tag[path]
    out = [k for k in range(bits.bit_length()) if bits >> k & 1]
    out += [_AT[f"tag:{tag}"] if f"tag:{tag}" in _AT else _AT["tag:?"], *(_AT[f"own:{c}"] for c in paths.cue[path])]
    if good and bad and inner_bad:
        out.append(_AT["bad-in-good"])
    if good and not bad:
        out.append(_AT["good-only"])
    if header and good and inner_bad and tag in ("h1", "h2"):
        out.append(_AT["heading-in-header-of-article"])
    out.append(_AT[f"depth:{min(4, depth // 2)}"])
    return tuple(sorted(out))


def text_features(b: Block) -> tuple[int, ...]:
    n = len(b.text)
    out = [_AT[f"size:{min(11, n.bit_length())}"], _AT[f"links:{min(4, int(4.001 * b.linked / n)) if b.linked else 0}"], _AT["bias"]]
    if b.text[-1] in ".!?…":
        out.append(_AT["stop"])
    if "," in b.text:
        out.append(_AT["commas"])
    if "©" in b.text or b.text[:9].lower() == "copyright":
        out.append(_AT["sign"])
    if " | " in b.text or " · " in b.text:
        out.append(_AT["bars"])
    return tuple(out)


def place_features(i: int, n: int) -> list[int]:
    out = []
    if i == 0:
        out.append(_AT["first"])
    if i == 1:
        out.append(_AT["second"])
    if i == n - 1:
        out.append(_AT["last"])
    out.append(_AT["early" if 2 * i < n else "late"])
    return out


def _chain(page: list[Block], paths: Paths, known: dict[int, tuple[int, ...]]) -> list[list[int]]:
    out = []
    for i, b in enumerate(page):
        above = known.get(b.path)
        if above is None:
            above = known[b.path] = path_features(paths, b.path)
        out.append([*above, *text_features(b), *place_features(i, len(page))])
    return out


class Field:
    """Weights: ``emit`` for the first label (article) against the second, ``move[same parent][from][to]``, labels 1 and 0."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move

    def label(self, page: list[Block], paths: Paths, scores: dict[int, float]) -> list[int]:
        """The most likely labels of a page's blocks. ``scores`` remembers what paths add."""
        n = len(page)
        if not n:
            return []
        emit, move = self.emit, self.move.tolist()
        weight = emit.tolist()
        back: list[tuple[int, int]] = []
        v0 = v1 = 0.0
        for i, b in enumerate(page):
            s = scores.get(b.path)
            if s is None:
                s = scores[b.path] = float(emit[list(path_features(paths, b.path))].sum())
            for k in text_features(b):
                s += weight[k]
            for k in place_features(i, n):
                s += weight[k]
            if i:
                m = move[paths.parent[b.path] == paths.parent[page[i - 1].path]]
                a0, a1 = v0 + m[0][0], v1 + m[1][0]
                b0, b1 = v0 + m[0][1], v1 + m[1][1]
                back.append((int(a1 > a0), int(b1 > b0)))
                v0, v1 = max(a0, a1), max(b0, b1) + s
            else:
                v0, v1 = 0.0, s
        out = [int(v1 > v0)]
        for pair in reversed(back):
            out.append(pair[out[-1]])
        return out[::-1]


def train(pages: list[tuple[str, list[str]]], passes: int = PASSES) -> Field:
    """Maximum likelihood with a ridge, by full-batch gradient steps with per-weight step sizes (Rprop)."""
    paths, known = Paths(), {}
    chains, labels, same = [], [], []
    for page, article in pages:
        own, left = blocks(page, paths), list(article)
        y = []
        for b in own:
            hit = b.text in left
            if hit:
                left.remove(b.text)
            y.append(int(hit))
        if own:
            chains.append(_chain(own, paths, known))
            labels.append(y)
            same.append([0] + [int(paths.parent[a.path] == paths.parent[b.path]) for a, b in zip(own, own[1:], strict=False)])
    gradient, n = likelihood(chains, labels, same), len(_NAMES)
    emit, move = np.zeros(n), np.zeros((2, 2, 2))
    size = np.full(n + 8, 0.05)
    last = np.zeros(len(size))
    for _ in range(passes):
        _, g_emit, g_move = gradient(emit, move)
        grad = np.concatenate([g_emit - RIDGE * emit, (g_move - RIDGE * move).ravel()])
        turn = grad * last
        size = np.clip(np.where(turn > 0, size * 1.2, np.where(turn < 0, size * 0.5, size)), 1e-6, 0.5)
        grad = np.where(turn < 0, 0, grad)
        step = np.sign(grad) * size
        emit, move, last = emit + step[:n], move + step[n:].reshape(2, 2, 2), grad
    return Field(emit, move)


def likelihood(chains: list[list[list[int]]], labels: list[list[int]], same: list[list[int]]):
    """A function of (emit, move): the log-likelihood of labelled chains and its gradient in both, by forward-backward.

    Chains stand in order of falling length, so those that reach step t are the first ``live[t]``.
    """
    order = sorted(range(len(chains)), key=lambda i: -len(chains[i]))
    n, m = len(chains), max(map(len, chains))
    live = [sum(len(c) > t for c in chains) for t in range(m)]
    y, s = np.zeros((m, n), np.int64), np.zeros((m, n), np.int64)
    rows = np.zeros((m, n), np.int64)  # where block t of chain i stands in ``flat``
    flat, k = np.zeros((sum(map(len, chains)), len(_NAMES)), np.float32), 0
    for at, i in enumerate(order):
        for t, f in enumerate(chains[i]):
            flat[k, f] = 1
            y[t, at], s[t, at], rows[t, at] = labels[i][t], same[i][t], k
            k += 1
    told = np.zeros(len(flat))
    for t in range(m):
        told[rows[t, : live[t]]] = y[t, : live[t]]
    seen_emit = (told.astype(np.float32) @ flat).astype(float)
    seen_move = np.zeros((2, 2, 2))
    for t in range(1, m):
        np.add.at(seen_move, (s[t, : live[t]], y[t - 1, : live[t]], y[t, : live[t]]), 1.0)

    def value(emit: np.ndarray, move: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        e = flat @ emit.astype(np.float32)
        alpha = np.zeros((m, n, 2))
        alpha[0, :, 1] = e[rows[0]]
        for t in range(1, m):
            on, w = live[t], move[s[t, : live[t]]]
            alpha[t, :on] = np.logaddexp(alpha[t - 1, :on, 0, None] + w[:, 0], alpha[t - 1, :on, 1, None] + w[:, 1])
            alpha[t, :on, 1] += e[rows[t, :on]]
            alpha[t, on:] = alpha[t - 1, on:]
        z = np.logaddexp(alpha[-1, :, 0], alpha[-1, :, 1])
        p, g_move = np.zeros(len(flat)), seen_move.copy()
        beta = np.zeros((n, 2))
        for t in range(m - 1, -1, -1):
            on = live[t]
            p[rows[t, :on]] = np.exp(np.clip(alpha[t, :on, 1] + beta[:on, 1] - z[:on], -50, 0))
            if not t:
                break
            w, ahead = move[s[t, :on]], beta[:on].copy()
            ahead[:, 1] += e[rows[t, :on]]
            w = w + ahead[:, None, :]
            pair = np.exp(np.clip(alpha[t - 1, :on, :, None] + w - z[:on, None, None], -50, 0))
            for kind in (0, 1):
                g_move[kind] -= pair[s[t, :on] == kind].sum(axis=0)
            beta[:on] = np.logaddexp(w[:, :, 0], w[:, :, 1])
        score = float(e @ told) + float((seen_move * move).sum()) - float(z.sum())
        return score, seen_emit - p.astype(np.float32) @ flat, g_move

    return value


@functools.lru_cache(maxsize=2)
def trained(pages: int = PAGES, seed: int = 0) -> Field:
    return train(labelled(pages, seed))


class Extractor:
    """A field and what a worker remembers of paths."""

    def __init__(self, field: Field):
        self.field, self.paths, self.scores = field, Paths(), {}

    def article(self, page: str | None) -> str:
        if len(self.paths.tag) > 200_000:
            self.paths, self.scores = Paths(), {}
        own = blocks(page or "", self.paths)
        return " ".join(b.text for b, y in zip(own, self.field.label(own, self.paths, self.scores), strict=True) if y)


def extract(pages: DataFrame, field: Field, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` without the markup, with the article's text."""
    stay = [f for f in pages.schema.fields if f.name not in (html_col, text_col)]
    schema = T.StructType([*stay, T.StructField(text_col, T.StringType(), False)])
    at, own, names = pages.columns.index(html_col), [pages.columns.index(f.name) for f in stay], [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = Extractor(field)
        for big in batches:
            for k in range(0, big.num_rows, 1024):
                batch = big.slice(k, 1024)
                text = [worker.article(h) for h in batch.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in own), pa.array(text, pa.string())], names=names)

    return pages.mapInArrow(released(run), schema)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages(page_id, url, html)``."""
    out = extract(pages.select("page_id", "url", F.col("html").cast("string").alias("html")), trained())
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
