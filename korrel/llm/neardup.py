"""Near-duplicate documents by a chosen-path set similarity join.

A document's set is its distinct five-word shingles. Documents with equal sets form one node; the join works on nodes. Each
node has a minwise signature, and a tree of the join sends a node down every path (position, signature value) of the
positions that the tree's hash chooses there, 1 / similarity of them on average, so two sets that are similar enough keep
meeting at one child per level on average. Several independent trees lift the chance that a pair meets to near 1.

First each tree node links its members to its least one, which costs one pair per member. Then only sets of different components
are of interest: tree nodes of at most ``LEAF`` members, and larger ones that are nearly of one component, are compared
exhaustively across components, in blocks of ``LEAF`` members; the others branch again, level by level. Candidates pass a sketch of the signatures and then a
finer one, with cut-offs some five standard deviations below the threshold, and are confirmed on the full sets. In the first
rounds a tree node proposes only the pairs that would join its components, best first. In the last one every candidate counts:
a set is held against all members of each component that it may touch, in blocks of ``BLOCK`` members, and one link of each block
is returned. So the rows that move follow the sets, not the pairs, in however large a group of copies. Links inside a component
that is already joined are not looked for: they cannot change the result.

Cases: an empty table gives an empty one. A null or empty text, or one without words, has the empty set and is linked with nothing. Rows with equal sets are
linked, repeated rows and rows that repeat a doc_id too. A null doc_id takes part; it is never the smallest, and a component of
null ids only has a null id. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, released
from .components import components
from .shingles import U, mix, shingle_hashes

SHINGLE, NUM, DEN = 5, 75, 100
#: Signature positions, those of them that the roots of the trees choose, and the most members that are compared exhaustively.
POSITIONS, ROOT_PATHS, LEAF, DEPTH = 128, 32, 8192, 12
#: Members of the largest component that are compared with the others at once.
CELL = 1024
#: A larger node is compared too, in blocks, if that takes at most so many comparisons a member.
EASY = 512
#: Of POSITIONS two-bit minima, the fewest that must agree: at a similarity of 0.75 104 are expected, with a deviation of 4.4.
SKETCH_LEAST = 82
#: Of so many finer two-bit minima, the fewest that must agree: 832 are expected, with a deviation of 12.5.
FINE, FINE_LEAST = 1024, 768
#: Rounds of proposals, and members of a component that one task compares a set with.
ROUNDS, BLOCK = 1, 512
#: Ids that are broadcast at most (8 bytes each, and a hash table's overhead).
BROADCAST_IDS = 1_000_000

_CHUNK_BYTES = 1 << 20


def _chunks(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a batch, about a megabyte at a time."""
    first, texts, size = 0, [], 0
    for i, t in enumerate(batch.column(at)):
        data = t.as_buffer().to_pybytes() if t.is_valid else b""
        texts.append(data)
        size += len(data)
        if size >= _CHUNK_BYTES:
            yield first, texts
            first, texts, size = i + 1, [], 0
    if texts:
        yield first, texts


def signatures(hashes: np.ndarray, counts: np.ndarray, positions: int = POSITIONS) -> np.ndarray:
    """uint32 minima (rows: texts with shingles, in order) under ``positions`` hash functions."""
    full = counts[counts > 0]
    starts = np.cumsum(full) - full
    out = np.empty((len(full), positions), np.uint32)
    factor = mix(np.arange(1, positions + 1, dtype=U) * U(0x632BE59BD9B4E019)) | U(1)
    buf = np.empty_like(hashes)
    for j in range(positions):
        np.multiply(hashes, factor[j], out=buf)
        out[:, j] = np.minimum.reduceat(buf, starts) >> U(32) if len(full) else 0
    return out


def sketches(sig: np.ndarray) -> np.ndarray:
    """Two low bits of mixed minima, 32 positions to a 64-bit word."""
    two = mix(sig.astype(U)) & U(3)
    shift = (np.arange(sig.shape[1]) % 32 * 2).astype(U)
    return np.bitwise_or.reduce((two << shift).reshape(len(sig), sig.shape[1] // 32, 32), axis=2).view(np.int64)


FEATURES = "doc_id long, row long, n_shingles long, node binary, sig array<int>, sketch array<long>"


def features(docs: DataFrame) -> DataFrame:
    """Set size, set identity (128 bits), minwise signature and sketch of each row of ``docs(doc_id, text, row)``; null identity for an empty set."""
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()), ("sig", pa.list_(pa.int32())), ("sketch", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _chunks(batch, 1):
                hashes, counts = shingle_hashes(texts, SHINGLE)
                sig = signatures(hashes, counts)
                sk = sketches(sig)
                n, node, at, k = [], [], 0, 0
                rows = np.full(len(texts), -1)
                for i, c in enumerate(counts.tolist()):
                    own = np.unique(hashes[at : at + c])
                    at += c
                    n.append(len(own))
                    node.append(xxhash.xxh3_128_digest(own.tobytes()) if c else None)
                    if c:
                        rows[i] = k
                        k += 1
                full = rows >= 0

                def lists(x: np.ndarray, kind: pa.DataType, full: np.ndarray = full) -> pa.Array:
                    offsets = np.concatenate(([0], np.cumsum(np.where(full, x.shape[1], 0)))).astype(np.int32)
                    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(x).ravel(), kind))

                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), batch.column(2).slice(first, len(texts)), pa.array(n, pa.int64()), pa.array(node, pa.binary()), lists(sig.view(np.int32), pa.int32()), lists(sk, pa.int64())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("row").cast("long").alias("row")).mapInArrow(released(run), FEATURES)


def sets(docs: DataFrame) -> DataFrame:
    """(node, shingles, fine) of documents that have words: the whole set, as sorted hashes, and its finer sketch."""
    schema = pa.schema([("node", pa.binary()), ("shingles", pa.list_(pa.int64())), ("fine", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _chunks(batch, 0):
                hashes, counts = shingle_hashes(texts, SHINGLE)
                fine = sketches(signatures(hashes, counts, FINE))
                node, own, at = [], [], 0
                for c in counts.tolist():
                    if c:
                        own.append(np.unique(hashes[at : at + c]))
                        node.append(xxhash.xxh3_128_digest(own[-1].tobytes()))
                        at += c
                if own:
                    offsets = np.concatenate(([0], np.cumsum([len(x) for x in own]))).astype(np.int32)
                    even = np.arange(len(own) + 1, dtype=np.int32) * (FINE // 32)
                    yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(own).view(np.int64))), pa.ListArray.from_arrays(pa.array(even), pa.array(fine.ravel()))], schema=schema)

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(released(run), "node binary, shingles array<long>, fine array<long>")


def agreement(x: Column, y: Column, positions: int = POSITIONS) -> Column:
    """Positions of two sketches that agree."""
    odd = F.lit(0x5555555555555555)

    def differing(p: Column, q: Column) -> Column:
        z = p.bitwiseXOR(q)
        return F.bit_count(z.bitwiseOR(F.shiftrightunsigned(z, 1)).bitwiseAND(odd))

    if positions > POSITIONS:
        return F.lit(positions) - F.aggregate(F.zip_with(x, y, differing), F.lit(0), lambda n, d: n + d)
    return F.lit(positions) - sum((differing(x[i], y[i]) for i in range(1, positions // 32)), differing(x[0], y[0]))


def _agreeing(labels: list[bytes], sketch: np.ndarray, roots: np.ndarray, large: np.ndarray, pos: int, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(i, rows j, agreement) of rows of other labels whose sketches agree enough with row i; j's label is no smaller than i's.

    At a root path of position ``pos`` a pair counts only if it is the first compared root path that both share: bit p of
    ``large`` says that the root path of position p is not compared.
    """
    compared = (large[:, None] >> np.arange(pos)) & 1 == 0 if pos > 0 else None
    code = {x: i for i, x in enumerate(dict.fromkeys(labels))}
    label = np.fromiter((code[x] for x in labels), np.int64, len(labels))
    many = np.bincount(label)
    order = np.lexsort((label, many[label]))  # the largest label comes last and is not compared within itself
    label, sketch = label[order], sketch[order]
    odd = U(0x5555555555555555)
    if len(order) <= 128:
        z = sketch[:, None] ^ sketch[None]
        agree = 32 * sketch.shape[1] - np.bitwise_count((z | (z >> U(1))) & odd).sum(axis=2, dtype=np.int64)
        near = np.triu((agree >= least) & (label[:, None] != label[None]), 1)
        if pos > 0 and near.any():
            at = np.nonzero(near)
            a, b = order[at[0]], order[at[1]]
            near[at] = ~((roots[a, :pos] == roots[b, :pos]) & compared[a]).any(axis=1)
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            hit = np.flatnonzero(near[i])
            yield int(order[i]), order[hit], agree[i, hit]
        return
    for i in range(len(order) - int(many.max())):
        rest = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
        z = sketch[rest] ^ sketch[i]
        agree = 32 * sketch.shape[1] - np.bitwise_count((z | (z >> U(1))) & odd).sum(axis=1, dtype=np.int64)
        hit = np.flatnonzero(agree >= least)
        if pos > 0 and len(hit):
            hit = hit[~((roots[order[rest[hit]], :pos] == roots[order[i], :pos]) & compared[order[i]]).any(axis=1)]
        if len(hit):
            yield int(order[i]), order[rest[hit]], agree[hit]


def compared(members: DataFrame, want: str, least: int = SKETCH_LEAST) -> DataFrame:
    """What the sketches of members (path, node, label, sketch, roots, large, pos) of each path propose across labels, as (a, b).

    ``joins``: for each node the best pair with another label. ``nodes``: every node that agrees enough with some node of
    another label, twice. ``touches``: every (a, b) where node a agrees enough with some node of the label b.
    """
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def propose(nodes: list[bytes], labels: list[bytes], held: list[tuple], pos: int, out: set) -> None:
        rows = _agreeing(labels, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held]), pos, least)
        if want == "nodes":
            hit = np.zeros(len(nodes), bool)
            for i, j, _ in rows:
                hit[i] = hit[j] = True
            out.update((nodes[x], nodes[x]) for x in np.flatnonzero(hit).tolist())
        elif want == "touches":
            for i, j, _ in rows:
                out.update((nodes[i], x) for x in {labels[y] for y in j.tolist()})
        else:
            for i, j, agree in rows:
                pair = nodes[i], nodes[int(j[agree.argmax()])]
                out.add((max(pair), min(pair)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pos, nodes, labels, held = None, -1, [], [], []
        out: set[tuple[bytes, bytes]] = set()
        for batch in batches:
            path = batch.column(0).to_numpy()
            if not len(path):
                continue
            own = batch.column(3).flatten().to_numpy().view(U).reshape(len(path), -1)
            roots = batch.column(4).flatten().to_numpy().reshape(len(path), -1)
            large = batch.column(6).to_numpy()
            starts = [0, *(np.flatnonzero(path[1:] != path[:-1]) + 1).tolist(), len(path)]
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                if nodes and path[lo] != last:
                    propose(nodes, labels, held, pos, out)
                    nodes, labels, held = [], [], []
                last, pos = path[lo], batch.column(5)[lo].as_py()
                nodes += batch.column(1).slice(lo, hi - lo).to_pylist()
                labels += batch.column(2).slice(lo, hi - lo).to_pylist()
                held.append((own[lo:hi], roots[lo:hi], large[lo:hi]))
            if len(out) >= 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], schema=schema)
                out.clear()
        if nodes:
            propose(nodes, labels, held, pos, out)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], schema=schema)

    ordered = members.select("path", "node", "label", "sketch", "roots", "pos", "large").repartition("path").sortWithinPartitions("path")
    return ordered.mapInArrow(released(run), "a binary, b binary").distinct()


def _full(nodes: DataFrame, docs: DataFrame, reps: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """The whole sets of some nodes, from the texts of one document each."""
    ids = scratch.keep(nodes.distinct().join(reps, "node").select("doc_id", "node"), f"{tag}-ids")
    few = ids.count() <= BROADCAST_IDS
    own = ids.select(F.col("doc_id").alias("_id"))
    texts = docs.select("doc_id", "text").join(F.broadcast(own) if few else own, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    # a doc_id may stand at several texts: only the wanted sets stay, one row for each
    full = sets(texts).join(F.broadcast(ids.select("node")) if few else ids.select("node"), "node", "left_semi")
    return scratch.keep(full.dropDuplicates(["node"]), f"{tag}-sets")


def _confirmed(pairs: DataFrame, docs: DataFrame, reps: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """Those of ``pairs(a, b)`` of nodes whose full sets are similar enough."""
    pairs = scratch.keep(pairs, f"{tag}-pairs")
    full = _full(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))), docs, reps, scratch, tag)
    fine = full.select("node", "fine")
    near = pairs.join(fine.select(F.col("node").alias("a"), F.col("fine").alias("fa")), "a").join(fine.select(F.col("node").alias("b"), F.col("fine").alias("fb")), "b")
    near = scratch.keep(near.filter(agreement(F.col("fa"), F.col("fb"), FINE) >= FINE_LEAST).select("a", "b"), f"{tag}-near")
    a = full.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = full.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    either = F.size("sa") + F.size("sb") - both
    return scratch.keep(near.join(a, "a").join(b, "b").filter(DEN * both.cast("long") >= NUM * either.cast("long")).select("a", "b"), f"{tag}-links")


def _touching(touch: DataFrame, label: DataFrame, full: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) between node a of ``touch(a, b)`` and members of component b, one for each block that has any.

    ``label(node, label)`` and the sets ``full`` are those of all nodes that may have a link to another component.
    """
    touch = scratch.keep(touch, "touch")
    sizes = label.join(touch.select(F.col("b").alias("label")).distinct(), "label")
    blocks = sizes.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    held = sizes.join(blocks, "label").select("label", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"), F.lit(0).alias("side"), "node")
    sent = touch.select(F.col("b").alias("label"), F.col("a").alias("node")).join(blocks, "label")
    sent = sent.select("label", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("side"), "node")
    rows = held.unionByName(sent)
    rows = rows.join(full, "node").repartition("label", "block").sortWithinPartitions("label", "block", "side")
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    odd = U(0x5555555555555555)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, nodes, own, fine, table = None, [], [], [], None
        for batch in batches:
            out: list[tuple[bytes, bytes]] = []
            for group, block, side, node, shingles, sketch in zip(*(batch.column(i) for i in range(6)), strict=True):
                key, node = (group.as_py(), block.as_py()), node.as_py()
                if key != last:
                    last, nodes, own, fine, table = key, [], [], [], None
                s, f = shingles.values.to_numpy(), sketch.values.to_numpy().view(U)
                if side.as_py() == 0:
                    nodes.append(node)
                    own.append(s)
                    fine.append(f)
                    continue
                table = np.stack(fine) if table is None else table
                z = table ^ f
                agree = FINE - np.bitwise_count((z | (z >> U(1))) & odd).sum(axis=1, dtype=np.int64)
                for k in np.argsort(-agree, kind="stable").tolist():
                    if agree[k] < FINE_LEAST:
                        break
                    both = len(np.intersect1d(s, own[k], assume_unique=True))
                    if nodes[k] != node and DEN * both >= NUM * (len(s) + len(own[k]) - both):
                        out.append((node, nodes[k]))
                        break
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], schema=schema)

    return scratch.keep(rows.select("label", "block", "side", "node", "shingles", "fine").mapInArrow(released(run), "a binary, b binary"), "touching")


def _labels(links: list[DataFrame], sketch: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Labels of linked nodes, and (node, sketch, label) of all that meet others."""
    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)
    label = components(every, scratch)
    return label, scratch.keep(sketch.join(label, "node", "left").select("node", "sketch", "roots", F.coalesce("label", "node").alias("label")), "sketched")


def _mixed(open_: DataFrame, sketched: DataFrame, scratch: Scratch) -> DataFrame:
    """Members (path, node) of paths that several components meet in: whether comparing those is easy, their number and largest label."""
    n = F.col("n").cast("double")
    by_label = open_.join(sketched.select("node", "label"), "node").groupBy("path", "label").agg(F.count("*").alias("n"))
    paths = by_label.groupBy("path").agg(F.sum("n").alias("many"), ((F.sum(n) * F.sum(n) - F.sum(n * n)) / 2).alias("cross"), F.count("*").alias("labels"), F.max_by("label", F.struct("n", "label")).alias("top"), F.max("n").alias("most")).filter("labels > 1")
    easy = (F.col("many") <= LEAF) | (F.col("cross") <= EASY * F.col("many"))
    paths = paths.select("path", "many", "top", (F.col("many") - F.col("most")).alias("others"), easy.alias("easy"))
    return open_.join(scratch.keep(paths, "paths"), "path")


def _cells(members: DataFrame) -> DataFrame:
    """Members (path, pos, node, label, many, others, top) dealt to the cells that are compared, as their path.

    Where the components beside the largest one have at most ``CELL`` members, the path is cut into blocks of about so many, and
    those members go to every block, so that each pair of two components meets in one at least. Else a path of at most ``LEAF``
    members is one cell, and of a larger one every two blocks of so many make a cell. So no cell grows with the path.
    """
    few = F.col("others") <= CELL
    blocks = F.ceil(F.col("many") / F.when(few, CELL).otherwise(LEAF)).cast("long")
    own = F.pmod(F.xxhash64("node", F.lit("block")), blocks)
    every = F.sequence(F.lit(0).cast("long"), blocks - 1)
    beside = F.when(F.col("label") == F.col("top"), F.array(own)).otherwise(every)
    pairs = F.transform(every, lambda x: F.least(x, own) * blocks + F.greatest(x, own))
    cells = F.when(blocks <= 1, F.array(F.lit(0).cast("long"))).when(few, beside).otherwise(pairs)
    cell = F.explode(cells).alias("cell")
    rest = [c for c in members.columns if c not in ("path", "many", "others", "top")]
    return members.select(F.when(blocks <= 1, F.col("path")).alias("alone"), "path", *rest, cell).select(F.coalesce("alone", F.xxhash64("path", "cell", F.lit("cell"))).alias("path"), *rest)


def _with_large(own: DataFrame, at: DataFrame) -> DataFrame:
    """Nodes ``own``, and which of their root paths ``at(pos, node, easy)`` are not compared: bit ``pos`` of ``large``."""
    large = at.filter("not easy").groupBy("node").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos").cast("int"))).alias("large"))
    return own.join(large, "node", "left").withColumn("large", F.coalesce("large", F.lit(0).cast("long")))


def near_duplicates(docs: DataFrame, scratch: Scratch, row: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs(doc_id, text)``.

    With ``row``, a column of distinct numbers, that column is returned too, and exactly one row of each component is kept: the
    first by doc_id (null ids last) and ``row``. A row without words is kept.
    """
    every = docs.select("doc_id", "text", (F.col(row) if row else F.lit(None)).alias("row"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    feats = scratch.keep(features(every), "features")
    having = feats.filter("node is not null")
    reps = having.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row"))

    # Roots: one path for each of the first positions, each tree having 1 / similarity of them.
    roots = having.select("node", F.posexplode(F.slice("sig", 1, ROOT_PATHS)).alias("pos", "value")).select("node", "pos", F.xxhash64("pos", "value").alias("path"))
    ends = roots.groupBy("path").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).filter("pivot <> last").select("path", "pivot")
    ends = scratch.keep(ends, "ends")  # so that the join's stage only joins, and a path with very many members can be split
    members = scratch.keep(roots.join(ends, "path").distinct(), "members")
    sketch = having.groupBy("node").agg(F.first("sketch").alias("sketch"))
    to_pivot = members.filter("node <> pivot").select("node", "pivot").distinct()
    near = to_pivot.join(sketch, "node").join(sketch.select(F.col("node").alias("pivot"), F.col("sketch").alias("ps")), "pivot").select("node", "pivot", agreement(F.col("sketch"), F.col("ps")).alias("agree")).filter(F.col("agree") >= SKETCH_LEAST)
    best = near.groupBy("node").agg(F.max_by("pivot", F.struct("agree", "pivot")).alias("b"))
    links = _confirmed(best.select(F.col("node").alias("a"), "b"), docs, reps, scratch, "pivot")

    # What is left: pairs of different components that meet in a tree node.
    own_sketch = having.groupBy("node").agg(F.first("sketch").alias("sketch"), F.first(F.slice("sig", 1, ROOT_PATHS)).alias("roots"))
    own_sketch = scratch.keep(members.select("node").distinct().join(own_sketch, "node"), "sketch")
    links = [links]
    for turn in range(ROUNDS):
        label, sketched = _labels(links, own_sketch, scratch)
        at = _mixed(members.select("path", "pos", "node"), sketched, scratch)
        pairs = compared(_cells(at.filter("easy").drop("easy").join(_with_large(sketched, at), "node")), "joins")
        links.append(_confirmed(pairs, docs, reps, scratch, f"join{turn}"))
    label, sketched = _labels(links, own_sketch, scratch)
    open_, easy = members.select("path", "pos", "node"), None
    for depth in range(DEPTH):
        at = scratch.keep(_mixed(open_, sketched, scratch), f"level{depth}")
        own = at.filter("easy").drop("easy")
        easy = own if easy is None else easy.unionByName(own)
        large = at.filter("not easy")
        if depth == 0:
            sketched = scratch.keep(_with_large(sketched, at), "sketched")
        if large.isEmpty():
            break
        sig = having.select("node", "sig").join(large.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("sig").alias("sig"))
        one_in = round(POSITIONS * NUM / DEN)
        chosen = F.filter(F.sequence(F.lit(0), F.lit(POSITIONS - 1)), lambda p: F.pmod(F.xxhash64("path", p), F.lit(one_in)) == 0)
        open_ = scratch.keep(large.select("path", "node").join(sig, "node").select("node", "sig", "path", F.explode(chosen).alias("at")).select(F.xxhash64("path", "at", F.col("sig")[F.col("at")]).alias("path"), F.lit(-1).alias("pos"), "node"), f"open{depth}")
    else:
        # Sets that a dozen levels did not part are compared as they are, block by block.
        easy = easy.unionByName(_mixed(open_, sketched, scratch).drop("easy"))
    near = scratch.keep(compared(_cells(easy.join(sketched, "node")), "nodes").select(F.col("a").alias("node")), "near")
    full = _full(near, docs, reps, scratch, "touch")
    finer = sketched.select("node", "label", "roots", "large").join(full.select("node", F.col("fine").alias("sketch")), "node")
    touch = compared(_cells(easy.join(finer, "node")), "touches", FINE_LEAST)
    more = _touching(touch, finer.select("node", "label"), full, scratch)
    if not more.isEmpty():
        label, _ = _labels([*links, more], own_sketch, scratch)

    scratch.drop(but=("features", "links", "rows"))
    firsts = having.groupBy("node").agg(F.min("doc_id").alias("doc_id"), first.alias("first")) if row else reps.withColumn("first", F.lit(None).cast("struct<row: bigint>"))
    of_node = firsts.join(label, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "doc_id", "first")
    of_label = of_node.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.min("first").alias("first"))
    of_node = of_node.select("node", "label").join(of_label, "label").select("node", "component_id", F.col("first.row").alias("first"))
    out = having.select("doc_id", "row", "n_shingles", "node").join(of_node, "node").select("doc_id", "row", "n_shingles", "component_id", "first")
    alone = feats.filter("node is null").select("doc_id", "row", "n_shingles", F.col("doc_id").alias("component_id"), F.col("row").alias("first"))
    out = out.unionByName(alone)
    if row:
        return out.select("doc_id", "n_shingles", "component_id", (F.col("row") == F.col("first")).alias("kept"), F.col("row").alias(row))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
