"""Word shingles of whole texts as arrays of 64-bit hashes, a batch at a time, for the workers."""

from __future__ import annotations

import numpy as np

U = np.uint64
_MIX = (U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB))
_BASE = 0x9E3779B97F4A7C15 | 1
_POW = np.ones(1, U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix finalizer)."""
    x = (x ^ (x >> U(30))) * _MIX[0]
    x = (x ^ (x >> U(27))) * _MIX[1]
    return x ^ (x >> U(31))


def _powers(n: int) -> np.ndarray:
    global _POW
    if len(_POW) < n:
        step = np.full(max(n, 4096), _BASE, U)
        step[0] = 1
        _POW = np.cumprod(step)
    return _POW


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, words split at ASCII white space; and the words in each text."""
    words = [t.lower().split() for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    if not counts.sum():
        return np.zeros(0, U), counts
    data = np.frombuffer(b"".join(b" ".join(w) + b" " for w in words if w), np.uint8)
    ends = np.flatnonzero(data == 32)
    starts = np.concatenate(([0], ends[:-1] + 1))
    sizes = ends - starts + 1
    inner = np.arange(len(data)) - np.repeat(starts, sizes)
    value = (data.astype(U) + U(1)) * _powers(int(sizes.max()))[inner]
    value[ends] = 0
    return mix(np.add.reduceat(value, starts) + mix(sizes.astype(U))), counts


def shingle_hashes(texts: list[bytes], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``size``-word shingles of each text, repeats kept, and how many each text has.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    words, counts = word_hashes(texts)
    weight = mix(np.arange(1, size + 1, dtype=U)) | U(1)
    first = np.cumsum(counts) - counts
    many = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    if not len(words):
        return np.zeros(0, U), many
    long_ = np.repeat(first[counts >= size], many[counts >= size])
    at = np.arange(len(long_)) - np.repeat(np.cumsum(many[counts >= size]) - many[counts >= size], many[counts >= size]) + long_
    out = np.zeros(int(many.sum()), U)
    place = np.repeat(counts >= size, many)
    total = np.zeros(len(at), U)
    for j in range(size):
        total += words[at + j] * weight[j]
    out[place] = mix(total + U(size))
    if (short := np.flatnonzero((counts > 0) & (counts < size))).size:
        where = np.cumsum(many) - many
        for i in short:
            n = int(counts[i])
            out[where[i]] = mix((words[first[i] : first[i] + n] * weight[:n]).sum(dtype=U, keepdims=True) + U(n))[0]
    return out, many
