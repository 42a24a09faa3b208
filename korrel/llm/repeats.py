"""Removal of every byte that a repeated 200-byte string covers, by prefix-free parsing.

A rolling hash of ``GRAM`` bytes cuts each text into phrases: a position triggers where its hash is the least (of equals the
last) among ``SPAN`` neighbours. Whether it does is decided by bytes inside a window, so equal windows are cut alike, and each
window start belongs to the first trigger at or after it: the window is the end of one phrase (a dictionary suffix) followed by
the start of the parse from that trigger on (a parse suffix). Two windows are equal if and only if both parts are.

1. Every trigger gives one narrow row: the hash of the bytes that all its windows share, and that of all the bytes they cover.
   A trigger whose shared bytes stand nowhere else has no repeated window: an aggregation finds them and most of a corpus ends here.
2. Of the others, triggers whose whole cover stands elsewhere too are repeated throughout, without a look at the bytes.
3. What remains are the edges of repeats. For each trigger content, the distinct phrase suffixes and parse suffixes are sorted
   into two suffix arrays with the lengths of common parts of neighbours; runs of the two orders combine into the classes of
   equal windows. A trigger content with more than ``SPLIT`` distinct covers, such as a line that very many texts have, is cut by
   ranges of ``RANGE`` window starts: the bytes that all windows of a range have tell groups apart, and each group has its own
   suffix arrays. Only where more than ``GROUP`` covers agree in those, too, all but ``RANGE`` - 1 bytes of a window, single
   windows are counted by 128-bit hashes instead, which gives the same classes.

Cases: a null text is the empty one; texts of under 200 bytes have no window; copies of a text, rows that repeat a doc_id and
null ids are ordinary rows, for texts are told apart by their own hash; an empty table gives an empty one. Extra columns stay in
``remove_repeats``, but those named like a result, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, fresh, released
from .shingles import U, mix

WINDOW, SPAN, GRAM = 200, 128, 16
SHARED = WINDOW - SPAN + 1
#: Distinct covers from which a trigger content is cut, window starts of a range, and distinct covers that a task sorts at most.
SPLIT, RANGE, GROUP = 256, 16, 20_000
#: Covers that a task takes up at once.
AT_ONCE = 40_000
#: Bytes of a text that are cut at once; longer texts are cut in overlapping pieces.
PIECE = 1 << 18
_LOW = U((1 << 24) - 1)
_SALT = mix(np.arange(1, 64, dtype=U) * U(0x9E3779B97F4A7C15))


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position, as one number."""
    return np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,)).astype(U)


def cut(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, trigger, first window, last window) of all triggers of texts that stand side by side in ``data``."""
    fit = np.flatnonzero(sizes >= WINDOW)
    if not len(fit):
        return (np.zeros(0, np.int64),) * 4
    v = _words(data)
    h = mix(mix(v[:-8]) ^ v[8:])
    key = (h & ~_LOW) | (_LOW - np.arange(len(h), dtype=U))
    step = 1
    while step < SPAN:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    many = sizes[fit] - WINDOW + 1
    text = np.repeat(fit, many)
    at = np.arange(int(many.sum())) + np.repeat(starts[fit] - (np.cumsum(many) - many), many)
    trigger = (_LOW - (key[at] & _LOW)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (trigger[1:] != trigger[:-1]) | (text[1:] != text[:-1]))))
    last = np.concatenate((new[1:] - 1, [len(at) - 1]))
    return text[new], trigger[new], at[new], at[last]


def _hash(v: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of the strings of at least eight bytes at ``start``."""
    acc = mix(size.astype(U) ^ _SALT[seed]) + mix(v[start + size - 8] + _SALT[seed + 1])
    live = np.arange(len(start))
    j = 0
    while len(live := live[size[live] >= 8 * j + 8]):
        acc[live] += mix(v[start[live] + 8 * j] ^ _SALT[(j + 7) % 63]) * (_SALT[(j + seed) % 61] | U(1))
        j += 1
    return mix(acc).view(np.int64)


def _binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def _texts(batch: pa.RecordBatch, at: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """Row numbers and bytes of a batch's texts, some megabytes at a time."""
    rows, texts, size = [], [], 0
    for i, t in enumerate(batch.column(at)):
        rows.append(i)
        texts.append(t.as_buffer().to_pybytes() if t.is_valid else b"")
        size += len(texts[-1])
        if size >= PIECE:
            yield rows, texts
            rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(data, text, offset in it, start in data, size) of texts side by side; a very long text comes in pieces of its own."""
    own = [i for i, t in enumerate(texts) if WINDOW <= len(t) <= PIECE]
    if own:
        size = np.array([len(texts[i]) for i in own])
        yield np.frombuffer(b"".join(texts[i] for i in own), np.uint8), np.array(own), np.zeros(len(own), np.int64), np.cumsum(size) - size, size
    for i, t in enumerate(texts):
        if len(t) > PIECE:
            for k in range(0, len(t) - WINDOW + 1, PIECE):
                part = np.frombuffer(t[k : k + PIECE + WINDOW - 1], np.uint8)
                yield part, np.array([i]), np.array([k]), np.array([0]), np.array([len(part)])


TRIGGERS = "shared long, cover long, tid binary, place long"


def triggers(texts: DataFrame) -> DataFrame:
    """A row for each trigger of ``texts(tid, text)``; ``place`` packs its offset and the lengths before its first and last window."""
    schema = pa.schema([("shared", pa.int64()), ("cover", pa.int64()), ("tid", pa.binary()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tid = batch.column(0)
            for rows, own in _texts(batch, 1):
                for data, which, offset, start, size in _pieces(own):
                    text, t, lo, hi = cut(data, start, size)
                    v = _words(data)
                    shared = _hash(v, t, np.full(len(t), SHARED), 3)
                    cover = _hash(v, lo, hi - lo + WINDOW, 11)
                    place = (t - start[text] + offset[text] << 16) | (t - lo << 8) | (t - hi)
                    ids = tid.take(pa.array(np.array(rows)[which][text]))
                    yield pa.RecordBatch.from_arrays([pa.array(shared), pa.array(cover), ids, pa.array(place)], schema=schema)

    return texts.select("tid", "text").mapInArrow(released(run), TRIGGERS)


COVERS = "shared long, cover long, many long, groups long, least int, most int, suffix binary, parse binary"
GROUPED = "key long, shared long, cover long, many long, least int, most int, suffix binary, parse binary"


def covers(wanted: DataFrame) -> DataFrame:
    """The phrase suffix and the parse suffix of each wanted trigger of ``wanted(text, at array<struct>)``."""
    schema = pa.schema([("shared", pa.int64()), ("cover", pa.int64()), ("many", pa.int64()), ("groups", pa.int64()), ("least", pa.int32()), ("most", pa.int32()), ("suffix", pa.binary()), ("parse", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, at in zip(batch.column(0), batch.column(1), strict=True):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                for x in at.as_py():
                    t, most, least = x["place"] >> 16, x["place"] >> 8 & 255, x["place"] & 255
                    out.append((x["shared"], x["cover"], x["many"], x["groups"], least, most, data[t - most : t], data[t : t - least + WINDOW]))
                if len(out) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return wanted.mapInArrow(released(run), COVERS)


def by_ranges(contexts: DataFrame) -> DataFrame:
    """Covers cut into ranges of window starts; ``key`` is a hash of the bytes that all windows of a range have."""
    schema = pa.schema([("key", pa.int64()), ("shared", pa.int64()), ("cover", pa.int64()), ("many", pa.int64()), ("least", pa.int32()), ("most", pa.int32()), ("suffix", pa.binary()), ("parse", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                out = []
                for shared, cover, many, _, least, most, suffix, parse in zip(*(c.to_pylist() for c in batch.slice(k, 1024).columns), strict=True):
                    for lo in range(least // RANGE * RANGE, most + 1, RANGE):
                        a, b = max(least, lo), min(most, lo + RANGE - 1)
                        common = suffix[len(suffix) - lo :] + parse[: WINDOW - lo - RANGE + 1]
                        key = xxhash.xxh3_64_intdigest(common, lo) - (1 << 63)
                        out.append((key, shared, cover, many, a, b, suffix[len(suffix) - b :], parse[: WINDOW - a]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return contexts.mapInArrow(released(run), GROUPED)


def _suffix_array(key: np.ndarray, rows: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows by (key, bytes), whether the key changes before each, and the common length with the one before."""
    data = np.zeros((len(rows), 8 + width), np.uint8)
    data[:, :8] = key.astype(">u8").view(np.uint8).reshape(-1, 8)
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    joined = np.frombuffer(b"".join(rows), np.uint8)
    r = np.repeat(np.arange(len(rows)), size)
    data[r, 8 + np.arange(len(joined)) - np.repeat(np.cumsum(size) - size, size)] = joined
    order = np.lexsort((size, data.view(f"S{8 + width}").ravel()))
    data, size = data[order], size[order]
    differ = data[1:] != data[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), 8 + width)
    common = np.minimum(first - 8, np.minimum(size[1:], size[:-1]))
    return order, np.concatenate(([True], first < 8)), np.concatenate(([0], np.maximum(common, 0)))


def repeated(key: np.ndarray, suffix: list[bytes], parse: list[bytes], many: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Whether the window with ``a`` bytes before the trigger is repeated: a matrix of rows and ``a``. Equal keys must be together."""
    n = len(key)
    d_order, d_new, d_common = _suffix_array(key, [s[::-1] for s in suffix], SPAN)
    p_order, p_new, p_common = _suffix_array(key, parse, WINDOW)
    out = np.zeros((n, SPAN), bool)
    d_run, p_run = np.empty(n, np.int64), np.empty(n, np.int64)
    for a in range(int(least.min()), int(most.max()) + 1):
        rows = np.flatnonzero((least <= a) & (a <= most))
        if not len(rows):
            continue
        d_run[d_order] = np.cumsum(d_new | (d_common < a))
        p_run[p_order] = np.cumsum(p_new | (p_common < WINDOW - a))
        _, of = np.unique(d_run[rows] * (n + 1) + p_run[rows], return_inverse=True)
        out[rows, a] = np.bincount(of, many[rows])[of] >= 2
    return out


SPANS = "shared long, cover long, ranges array<int>"


def edges(contexts: DataFrame) -> DataFrame:
    """Ranges of repeated windows, as bytes before the trigger (from, to, from, to ...), of covers sorted by ``key``."""
    schema = pa.schema([("shared", pa.int64()), ("cover", pa.int64()), ("ranges", pa.list_(pa.int32()))])

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        key, shared, cover, many, least, most, suffix, parse = zip(*rows, strict=True)
        many_, least_, most_ = (np.array(x, np.int64) for x in (many, least, most))
        found = repeated(np.array(key, np.int64).view(U), list(suffix), list(parse), many_, least_, most_)
        found[many_ > 1] = False  # these are repeated throughout, and known
        turn = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, up = np.nonzero(turn == 1)
        down = np.nonzero(turn == -1)[1] - 1
        counts = np.bincount(row, minlength=len(rows)) * 2
        ranges = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(np.stack((up, down), 1).ravel().astype(np.int32)))
        keep = pa.array(counts > 0)
        return pa.RecordBatch.from_arrays([pa.array(shared, pa.int64()).filter(keep), pa.array(cover, pa.int64()).filter(keep), ranges.filter(keep)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(held) >= AT_ONCE and row[0] != held[-1][0]:
                    yield solve(held)
                    held = []
                held.append(row)
        if held:
            yield solve(held)

    return contexts.mapInArrow(released(run), SPANS)


def single_windows(contexts: DataFrame) -> DataFrame:
    """A row for each window of a cover, named by a 128-bit hash: for trigger contents with very many covers."""
    schema = pa.schema([("shared", pa.int64()), ("cover", pa.int64()), ("many", pa.int64()), ("before", pa.int32()), ("window", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                out = []
                for _, shared, cover, many, least, most, suffix, parse in zip(*(c.to_pylist() for c in batch.slice(k, 256).columns), strict=True):
                    whole = suffix + parse
                    out += [(shared, cover, many, a, xxhash.xxh3_128_digest(whole[most - a : most - a + WINDOW])) for a in range(least, most + 1)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return contexts.mapInArrow(released(run), "shared long, cover long, many long, before int, window binary")


def repeated_spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(tid, at) for each distinct text of ``docs(tid, text)`` with a repeated window: places of triggers and their ranges."""
    found = scratch.keep(triggers(docs), "triggers")
    again = scratch.keep(found.groupBy("shared").agg(F.count("*").alias("n")).filter("n > 1").select("shared"), "again")
    # both sides of the join are shuffled for it alone, so that a trigger content with very many places can be split
    hits = found.join(again, "shared").repartition("shared", "cover", "tid", "place")
    hits = scratch.keep(hits.groupBy("shared", "cover", "tid", "place").agg(F.count("*").alias("many")), "hits")
    scratch.drop("triggers")
    by_cover = scratch.keep(hits.groupBy("shared", "cover").agg(F.sum("many").alias("many"), F.min(F.struct("tid", "place")).alias("one")), "covers")
    open_ = by_cover.groupBy("shared").agg(F.count("*").alias("groups"), F.min("many").alias("fewest")).filter("groups > 1 and fewest = 1").select("shared", "groups")
    open_ = scratch.keep(open_, "open")  # so that the join's stage only joins, and a very frequent content can be split
    wanted = by_cover.join(open_, "shared").select("one.tid", F.struct("shared", "cover", "many", "groups", "one.place").alias("x"))
    wanted = scratch.keep(wanted.groupBy("tid").agg(F.collect_list("x").alias("at")), "wanted")
    once = docs.groupBy("tid").agg(F.first("text").alias("text"))  # of copies one text, before the shuffle
    contexts = covers(once.join(wanted, "tid").select("text", "at"))
    names = [c for c in contexts.columns if c not in ("shared", "cover")]
    contexts = scratch.keep(contexts.groupBy("shared", "cover").agg(*(F.first(c).alias(c) for c in names)), "contexts")
    alone = contexts.filter(F.col("groups") <= SPLIT).select(F.col("shared").alias("key"), *(c for c in contexts.columns if c != "groups"))
    parts = scratch.keep(by_ranges(contexts.filter(F.col("groups") > SPLIT)), "parts")
    groups = parts.groupBy("key").agg(F.count("*").alias("n"), F.min("many").alias("fewest")).filter("n > 1 and fewest = 1").select("key", "n")
    parts = parts.join(scratch.keep(groups, "groups"), "key")
    few = alone.unionByName(parts.filter(F.col("n") <= GROUP).drop("n"))
    ranges = edges(few.repartition("key").sortWithinPartitions("key"))
    windows = single_windows(parts.filter(F.col("n") > GROUP).drop("n"))
    twice = windows.groupBy("shared", "before", "window").agg(F.sum("many").alias("n")).filter("n > 1")
    apart = windows.filter("many = 1").join(twice.select("shared", "before", "window"), ["shared", "before", "window"])
    apart = apart.groupBy("shared", "cover").agg(F.flatten(F.collect_list(F.array("before", "before"))).alias("ranges"))
    whole = by_cover.filter("many > 1").select("shared", "cover", F.lit(None).cast("array<int>").alias("ranges"))
    good = scratch.keep(whole.unionByName(ranges).unionByName(apart), "good")
    spans = scratch.keep(hits.join(good, ["shared", "cover"]).groupBy("tid").agg(F.collect_list(F.struct("place", "ranges")).alias("at")), "spans")
    scratch.drop("again", "hits", "covers", "open", "wanted", "contexts", "parts", "groups", "good")
    return spans


def spans_of(at: list[dict] | None) -> list[tuple[int, int]]:
    """Removed byte runs, merged and in order."""
    runs = []
    for x in at or ():
        t, most, least = x["place"] >> 16, x["place"] >> 8 & 255, x["place"] & 255
        ranges = x["ranges"] or (least, most)
        runs += [(t - ranges[i + 1], t - ranges[i] + WINDOW) for i in range(0, len(ranges), 2)]
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def whole_characters(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs, made wider so that each holds the whole of every character that it touches."""
    out: list[tuple[int, int]] = []
    for a, b in runs:
        while a > 0 and data[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(data) and data[b] & 0xC0 == 0x80:
            b += 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, scratch: Scratch, text_col: str = "text", spans_col: str = "spans", kept_col: str = "kept", as_text: bool = False) -> DataFrame:
    """``docs`` with the removed byte runs [start, end) and the remaining bytes of each text.

    With ``as_text`` a character goes as soon as one of its bytes does, and what remains is a string. Columns of ``docs`` that are
    named like ``spans_col`` or ``kept_col`` are replaced.
    """
    tid, at, own = fresh(docs, "tid", "at", "own_text")
    own_text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select("*", own_text.alias(own), F.unhex(F.md5(own_text)).alias(tid))
    spans = repeated_spans(keyed.select(F.col(tid).alias("tid"), F.col(own).alias("text")), scratch)
    spans = spans.select(F.col("tid").alias(tid), F.col("at").alias(at))
    stay = [f for f in docs.schema.fields if f.name not in (spans_col, kept_col)]
    joined = keyed.join(spans, tid, "left").select(*(F.col(f.name) for f in stay), own, at)
    run_type = T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)])
    schema = T.StructType(stay + [T.StructField(spans_col, T.ArrayType(run_type, False), False), T.StructField(kept_col, T.StringType() if as_text else T.BinaryType(), False)])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for k in range(0, big.num_rows, 512):
                batch = big.slice(k, 512)
                spans, kept = [], []
                for text, where in zip(batch.column(len(stay)), batch.column(len(stay) + 1), strict=True):
                    data, runs = text.as_buffer().to_pybytes(), spans_of(where.as_py())
                    runs = whole_characters(data, runs) if as_text else runs
                    spans.append([{"start": a, "end": b} for a, b in runs])
                    ends = [0, *(b for _, b in runs)]
                    kept.append(b"".join(data[a:b] for a, b in zip(ends, [*(a for a, _ in runs), len(data)], strict=True)))
                kind = pa.list_(pa.struct([pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False)]))
                rest = pa.array([k.decode() for k in kept], pa.string()) if as_text else _binary(kept)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(stay)], pa.array(spans, kind), rest], names=names)

    return joined.mapInArrow(released(run), schema)
