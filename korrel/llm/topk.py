"""Exact top-k inner products by the three-phase uniform threshold.

The dimensions are cut into ``SLICES``; a vector's score with a query is the sum of its slices' local scores. Candidates lie in
shards and queries in groups; a cell is one of each. In a cell every slice is a node: it holds its part of the candidates in a list
that falls by the length of that part, and a local score is at most the product of two lengths.

1. In a few home shards (one in ``HOME``) each node gathers its best ``k`` local scores; what they name is scored in full. The k-th
   best of these is a cutoff that the true k-th best score cannot be below, whatever the other shards hold.
2. With the cutoff, each node of every shard collects the entries whose local score reaches cutoff / slices. It reads its list only
   down to the length at which none can reach that any more. A vector that no node collects has a smaller sum than the cutoff.
3. What was collected is scored exactly, in integers, and each cell returns its best ``k``, never more.

Cells are dealt by rows, so equal vectors spread over all shards. Each candidate is sent once for each group of queries and each query
once for each shard, so what moves is candidates x queries / ``GROUP`` + queries x candidates / ``SHARD`` rows.

Cases: vectors that are null or hold null or non-finite components take no part, nor do null ids. Shorter vectors count as
filled up with zeros. Repeated rows are candidates of their own, each with its own rank; a query is never its own candidate, by
id. Rows that repeat an id and a vector ask once; an id with several vectors gets the best pairs of all of them. With fewer
candidates than k all are returned, none from an empty table. Ties go to the smaller id. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, released

#: Slices, most candidates in a shard and queries in a group, about, and queries that are scored at once.
SLICES, SHARD, GROUP, BLOCK = 2, 32_768, 4096, 128
#: One shard in so many is a home shard. A small table still has up to ``SPREAD`` shards of at least ``LEAST`` candidates.
HOME, SPREAD, LEAST = 8, 8, 2048
#: Partitions that cells are dealt to at most; a task takes its cells one after the other.
TASKS = 8192
SCALE = 64.0


def quantized(rows: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows of ``rows(vec_id, embedding)`` that take part."""
    e = F.col("embedding").cast("array<double>")
    fine = F.coalesce(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    return rows.filter(F.col("vec_id").isNotNull()).filter(fine).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(e, lambda x: F.floor(F.lit(SCALE) * x)).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    size = np.diff(column.offsets.to_numpy())
    wide = int(size.max(initial=0))
    out = np.zeros((len(size), wide), np.int64)
    out[np.arange(wide) < size[:, None]] = column.flatten().to_numpy()
    return out


def _wider(x: np.ndarray, wide: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, wide - x.shape[1]))) if x.shape[1] < wide else x


class Cell:
    """The candidates of a shard, ordered by id, and each slice's list of them."""

    def __init__(self, ids: np.ndarray, c: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.c = ids[order], c[order]
        self.top = float(np.abs(self.c).max(initial=0))
        self._lists: dict = {}

    def lists(self, wide: int, kind: type) -> list[tuple]:
        """(dimensions, places of the candidates by falling length, lengths, parts in that order) of each slice."""
        if (wide, kind) not in self._lists:
            self.c, made = _wider(self.c, wide), []
            for dims in np.array_split(np.arange(wide), SLICES):
                length = np.sqrt((self.c[:, dims].astype(float) ** 2).sum(axis=1))
                order = np.argsort(-length, kind="stable")
                made.append((dims, order, length[order], np.ascontiguousarray(self.c[order][:, dims].astype(kind).T)))
            self._lists = {(wide, kind): made}
        return self._lists[wide, kind]

    def ready(self, q: np.ndarray) -> tuple[np.ndarray, list[tuple], type]:
        """Queries as wide as the candidates, the lists, and a number type in which local scores are exact."""
        wide = max(q.shape[1], self.c.shape[1])
        top = float(np.abs(q).max(initial=0)) * self.top * max(1, wide)
        kind = np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64 if top < 1 << 62 else object
        return _wider(q, wide), self.lists(wide, kind), kind

    def own(self, asking: np.ndarray) -> Iterator[tuple[int, slice]]:
        """Where the candidates with each query's own id stand."""
        lo, hi = np.searchsorted(self.ids, asking, "left"), np.searchsorted(self.ids, asking, "right")
        return ((i, slice(a, b)) for i, (a, b) in enumerate(zip(lo.tolist(), hi.tolist(), strict=True)) if a < b)

    def gathered(self, q: np.ndarray, asking: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Phase 1: for each query the best (scores, places) among what the nodes' best ``k`` local scores name."""
        q, lists, kind = self.ready(q)
        n, named = len(self.ids), np.zeros((len(q), len(self.ids)), bool)
        for dims, order, _, part in lists:
            local = (q[:, dims].astype(kind) @ part).astype(float)
            rank = np.empty(n, np.int64)
            rank[order] = np.arange(n)
            for i, at in self.own(asking):
                local[i, rank[at]] = -np.inf
            some = np.argpartition(-local, k - 1, axis=1)[:, :k] if n > k else np.tile(np.arange(n), (len(q), 1))
            np.put_along_axis(named, order[some], True, axis=1)
        yield from self._scored(q, named, asking, k, [None] * len(q))

    def collected(self, q: np.ndarray, asking: np.ndarray, k: int, cut: list) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Phases 2 and 3: for each query the best (scores, places) among what some node collects."""
        q, lists, kind = self.ready(q)
        floor = np.array([-np.inf if x is None else float(x) for x in cut])
        # an entry counts as collected from a little below the threshold: rounding must not lose one
        uniform = floor / SLICES - 1e-6 * np.where(np.isfinite(floor), np.abs(floor), 0)
        found = np.zeros((len(q), len(self.ids)), bool)
        for dims, order, length, part in lists:
            own = q[:, dims]
            reach = np.sqrt((own.astype(float) ** 2).sum(axis=1))
            # lists are read down to the length from which a query of this block can still reach its threshold
            need = np.where(uniform > 0, uniform / np.maximum(reach, 1e-300), 0) * (1 - 1e-9)
            deep = int(np.searchsorted(-length, -need.min(initial=np.inf), "right"))
            if not deep:
                continue
            i, j = np.nonzero((own.astype(kind) @ part[:, :deep]) >= uniform[:, None])
            found[i, order[j]] = True
        yield from self._scored(q, found, asking, k, cut)

    def _scored(self, q: np.ndarray, some: np.ndarray, asking: np.ndarray, k: int, cut: list) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for i, at in self.own(asking):
            some[i, at] = False
        for i in range(len(q)):
            at = np.flatnonzero(some[i])
            scores = self.c[at] @ q[i]
            if cut[i] is not None:
                keep = scores >= cut[i]
                at, scores = at[keep], scores[keep]
            if len(at) > k:
                least = np.partition(scores, len(at) - k)[len(at) - k]
                above = np.flatnonzero(scores > least)
                # places follow the ids: of the ties the first ones have the smallest
                keep = np.concatenate((above, np.flatnonzero(scores == least)[: k - len(above)]))
                at, scores = at[keep], scores[keep]
            if len(at):
                yield i, scores, at


def _visited(rows: DataFrame, cells: int, k: int, final: bool) -> DataFrame:
    """What each cell returns for each of its queries: the best (score, vec_id)."""
    schema = pa.schema([("q", pa.int64()), ("query_id", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ids, parts, cell = None, [], [], None
        for big in batches:
            for lo in range(0, big.num_rows, BLOCK):
                batch = big.slice(lo, BLOCK)
                at, side = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                bounds = [0, *(np.flatnonzero((at[1:] != at[:-1]) | (side[1:] != side[:-1])) + 1).tolist(), len(at)]
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    part = batch.slice(a, b - a)
                    if at[a] != last:
                        last, ids, parts, cell = at[a], [], [], None
                    own = part.column(3).to_numpy()
                    if side[a] == 0:
                        ids.append(own)
                        parts.append(_matrix(part.column(4)))
                        continue
                    if cell is None:
                        if not ids:
                            continue
                        wide = max(p.shape[1] for p in parts)
                        cell = Cell(np.concatenate(ids), np.concatenate([_wider(p, wide) for p in parts]))
                    q = _matrix(part.column(4))
                    best = cell.collected(q, own, k, part.column(5).to_pylist()) if final else cell.gathered(q, own, k)
                    out = [(i, s, cell.ids[places]) for i, s, places in best]
                    if out:
                        i = np.repeat([x[0] for x in out], [len(x[1]) for x in out])
                        columns = (part.column(2).to_numpy()[i], own[i], np.concatenate([x[1] for x in out]).astype(np.int64), np.concatenate([x[2] for x in out]))
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], schema=schema)

    dealt = rows.select("cell", "side", "q", "vec_id", "v", "cut").repartition(max(1, min(cells, TASKS)), "cell").sortWithinPartitions("cell", "side")
    return dealt.mapInArrow(released(run), "q long, query_id long, score long, vec_id long")


def top_k(rows: DataFrame, k: int, one_in: int, scratch: Scratch) -> DataFrame:
    """The best ``k`` other rows of ``rows(vec_id, embedding)`` for every row whose id is divisible by ``one_in``."""
    vectors = scratch.keep(quantized(rows).withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = vectors.filter(F.pmod("vec_id", F.lit(one_in)) == 0).select("vec_id", "v").distinct()
    asked = scratch.keep(asked.withColumn("q", F.monotonically_increasing_id()), "asked")
    n = vectors.count()
    shards = max(1, -(-n // SHARD), min(SPREAD, -(-n // LEAST)))
    groups = max(1, -(-asked.count() // GROUP))
    home = -(-shards // HOME)

    def place(row: Column, many: int) -> Column:
        return F.pmod(F.xxhash64(row), F.lit(many).cast("long"))

    held = vectors.select("vec_id", "v", place(F.col("row"), shards).alias("shard"))

    def calls(cut: DataFrame, at_home: bool) -> DataFrame:
        """Rows of the cells: all of them, or those of each group's home shards, which are next to each other."""
        every = F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))
        near = F.filter(every, lambda g: F.pmod(F.col("shard") - g, F.lit(shards).cast("long")) < home) if at_home else every
        left = held.select(F.explode(near).alias("group"), "shard", F.lit(0).alias("side"), F.lit(0).cast("long").alias("q"), "vec_id", "v", F.lit(None).cast("long").alias("cut"))
        steps = F.explode(F.sequence(F.lit(0).cast("long"), F.lit((home if at_home else shards) - 1).cast("long")))
        right = cut.select(place(F.col("q"), groups).alias("group"), steps.alias("step"), F.lit(1).alias("side"), "q", "vec_id", "v", "cut")
        right = right.select("group", F.pmod(F.col("group") + F.col("step"), F.lit(shards).cast("long")).alias("shard"), "side", "q", "vec_id", "v", "cut")
        return left.unionByName(right).withColumn("cell", F.col("group") * shards + F.col("shard"))

    nth = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score")))
    first = _visited(calls(asked.withColumn("cut", F.lit(None).cast("long")), True), groups * home, k, False)
    cut = first.select("q", "score").withColumn("nth", nth).filter(F.col("nth") <= k).filter(F.col("nth") == k).select("q", F.col("score").alias("cut"))
    cut = scratch.keep(asked.join(cut, "q", "left"), "cut")
    best = _visited(calls(cut, False), groups * shards, k, True)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
