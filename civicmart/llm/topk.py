"""Exact top-k search by reading sorted lists only (no random access).

Every dimension of a shard of vectors is a list sorted by value.  A query reads a list
from its upper end where its own component is positive, else from the lower end, so what
comes next in a list never adds more than what came before.  Each vector has a lower
bound of its score, in which the lists that it was not yet met in count with their last
entry, and an upper bound, in which they count with their next one.  Both only need what was
read: a block of entries adds to the lower bounds of the vectors that it names.

Blocks are read from the lists that still leave most open, by the query's component times
the range of values not yet read.  A vector that was met in no list cannot qualify once the
sum of the next entries is below the k-th lower bound; nor can one whose upper bound is.
Reading goes on until every vector that can still qualify was met in all lists that
matter, so its lower bound is its score.  No component is ever looked up.

The first shard is read first.  Its k-th score is a bound that goes with the query to all
other shards, which then need to read only as far as that bound requires.  A task has one shard
and at most some ``TASK_QUERIES`` queries, taken in blocks, so memory and work are bounded, and
a query's k best are all that leaves a shard.
Arithmetic is exact: whole numbers in double precision while every sum stays below
2**51, else in 64-bit integers.

Defined results: a vector that is null, empty, or holds a null or non-finite component
takes no part; vectors are compared with those of the same length; rows that repeat are
rows each, as candidates and as queries, and a query's copies are candidates of it; ties go
to the smaller id; fewer candidates than k give fewer rows; a null id takes no part;
further columns are ignored.  Scores must fit in 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.llm.common import staged

SHARD_ROWS = 4096
BLOCK_QUERIES = 512
TASK_QUERIES = 1 << 13
READS = 16  # blocks that a whole list is read in
ROUNDS_PER_TEST = 2
_FOUND = "query_row long, query_id long, vec_id long, score long"


def quantised(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(row_id, vec_id, v array<bigint>): each component as floor(scale * x) of rows that take part."""
    whole = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embeddings.where(whole & ~odd).select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"),
    )


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each of ``queries`` its k best among the other ``vectors``.

    Both are stored rows (row_id, vec_id, v); equal row numbers name the same row.
    """
    shards = max(1, math.ceil(vectors.count() / shard_rows))
    parts = max(1, math.ceil(queries.count() / TASK_QUERIES))
    dealt = vectors.select("row_id", "vec_id", "v", F.pmod(F.xxhash64("row_id"), F.lit(shards)).alias("shard"))
    part = F.pmod(F.xxhash64("row_id"), F.lit(parts)).alias("part")
    asked = queries.select("row_id", "vec_id", "v", part, F.lit(None).cast("long").alias("bound"))
    found = _met(dealt.where("shard = 0"), asked, F.array(F.lit(0).cast("long")), 1, parts, k)
    if shards > 1:
        found = staged(found, "first-shard")
        full = found.groupBy("query_row").agg(F.min("score").alias("bound"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
        bounded = asked.drop("bound").join(full.select(F.col("query_row").alias("row_id"), "bound"), "row_id", "left")
        others = F.sequence(F.lit(1).cast("long"), F.lit(shards - 1).cast("long"))
        found = found.unionByName(_met(dealt.where("shard > 0"), bounded, others, shards - 1, parts, k))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _met(dealt: DataFrame, asked: DataFrame, which: Column, shards: int, parts: int, k: int) -> DataFrame:
    """The k best of each shard for each query: a shard's vectors come first, then a part of the queries passes by.

    One task has one shard and one part, so its work is bounded; shards are repeated for each part.
    """
    columns = ["d", "shard", "part", "asks", "row_id", "vec_id", "v", "bound"]
    size = F.size("v").alias("d")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part")
    held = dealt.select(size, "shard", every, F.lit(0).alias("asks"), "row_id", "vec_id", "v", F.lit(None).cast("long").alias("bound"))
    passing = asked.select(size, F.explode(which).alias("shard"), "part", F.lit(1).alias("asks"), "row_id", "vec_id", "v", "bound")
    rows = held.select(columns).union(passing.select(columns))
    rows = rows.repartitionByRange(shards * parts, "shard", "part", "d")
    rows = rows.sortWithinPartitions("shard", "part", "d", "asks", "row_id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, gathered, lists = None, [], None
        for batch in batches:
            kinds = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("shard", "part", "d", "asks")], axis=1)
            cuts = np.flatnonzero((kinds[1:] != kinds[:-1]).any(axis=1)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(kinds)]):
                part = batch.slice(low, high - low)
                *place, d, asks = kinds[low].tolist()
                if (place, d) != key:
                    key, gathered, lists = (place, d), [], None
                if not asks:
                    gathered.append(part)
                elif gathered:
                    lists = lists or _lists(gathered, d)
                    for first in range(0, part.num_rows, BLOCK_QUERIES):
                        yield _answers(lists, part.slice(first, BLOCK_QUERIES), d, k)

    return rows.mapInArrow(search, _FOUND)


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _lists(parts: list[pa.RecordBatch], d: int) -> SortedLists:
    rows, ids = (np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("row_id", "vec_id"))
    return SortedLists(rows, ids, np.concatenate([_matrix(p, d) for p in parts]))


def _answers(lists: SortedLists, block: pa.RecordBatch, d: int, k: int) -> pa.RecordBatch:
    rows, ids = (block.column(c).to_numpy() for c in ("row_id", "vec_id"))
    bounds = [-(1 << 62) if b is None else b for b in block.column("bound").to_pylist()]
    found, _ = lists.search(rows, _matrix(block, d), np.array(bounds, np.int64), k)
    which = np.array([q for q, _, _ in found], dtype=np.int64)
    columns = [rows[which], ids[which], np.array([i for _, i, _ in found], np.int64), np.array([s for _, _, s in found], np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_row", "query_id", "vec_id", "score"])


class SortedLists:
    """One shard: a list per dimension, sorted by value."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, values: np.ndarray):
        self.rows, self.ids, self.shape = rows, ids, values.shape
        self.order = np.argsort(values, axis=0, kind="stable")
        self.rising = np.take_along_axis(values, self.order, axis=0)
        self.largest = float(np.abs(values).max(initial=0)) * values.shape[1]

    def search(self, own: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int) -> tuple[list[tuple[int, int, int]], np.ndarray]:
        """(query, vec_id, score) of the k best for each query, and the share of entries read for it.

        ``own`` are the queries' rows, which are no candidates; no score below ``bounds`` is wanted.
        """
        n, d = self.shape
        kind = np.float64 if self.largest * float(np.abs(queries).max(initial=0)) < 2.0**51 else np.int64
        rising = self.rising.astype(kind)
        low, high = rising[0], rising[-1]
        up, down = np.maximum(queries, 0).T.astype(kind), np.minimum(queries, 0).T.astype(kind)
        active = np.arange(len(queries))
        # One row per vector, one column per query that is still reading.
        lower = np.tile(low @ up + high @ down, (n, 1))
        met_up, met_down = np.zeros((n, d), bool), np.zeros((n, d), bool)
        depth = np.zeros(d, np.int64)
        step = max(1, -(-n // READS))
        found: list[tuple[int, int, int]] = []
        shares = np.zeros(len(queries))
        rounds = 0
        while len(active):
            ahead_up, ahead_down = self._ahead(rising, depth)
            left = np.abs((ahead_up - low)[:, None] * up).sum(axis=1) + np.abs((ahead_down - high)[:, None] * down).sum(axis=1)
            unread = np.flatnonzero(depth < n)
            chosen = unread[np.argsort(-left[unread], kind="stable")][: max(1, d // 2)]
            read_up, read_down = np.zeros((n, len(chosen)), kind), np.zeros((n, len(chosen)), kind)
            for i, j in enumerate(chosen):
                a, b = depth[j], min(n, depth[j] + step)
                top, bottom = self.order[n - b : n - a, j], self.order[a:b, j]
                read_up[top, i] = rising[n - b : n - a, j] - low[j]
                read_down[bottom, i] = rising[a:b, j] - high[j]
                met_up[top, j] = met_down[bottom, j] = True
                depth[j] = b
            # One product adds what all blocks of this round hold, to all queries.
            lower += read_up @ up[chosen]
            lower += read_down @ down[chosen]
            rounds += 1
            if rounds % ROUNDS_PER_TEST and (depth < n).any():
                continue
            whole = not (depth < n).any()
            ahead_up, ahead_down = self._ahead(rising, depth)
            floors, unmet = bounds[active].astype(kind), ahead_up @ up + ahead_down @ down
            ready = np.flatnonzero((unmet < np.maximum(floors, lower.max(axis=0))) | whole)
            if n > k and len(ready):
                # The own row may be among the best, so the k-th of the others is at least the next one.
                among = np.partition(np.ascontiguousarray(lower[:, ready].T), n - k - 1, axis=1)[:, n - k - 1]
                floors[ready] = np.maximum(floors[ready], among)
                ready = ready[(unmet < floors)[ready] | whole]
            ended = []
            more = (~met_up).astype(kind) @ ((ahead_up - low)[:, None] * up[:, ready])
            more += (~met_down).astype(kind) @ ((ahead_down - high)[:, None] * down[:, ready])
            for column, most in zip(ready, more.T):
                q, at_least = active[column], lower[:, column]
                can = np.flatnonzero((at_least + most >= floors[column]) & (self.rows != own[q]))
                if most[can].any():
                    continue
                best = can[np.lexsort((self.ids[can], -at_least[can]))[:k]]
                found += [(int(q), int(i), int(s)) for i, s in zip(self.ids[best], at_least[best])]
                shares[q] = depth.sum() / (n * d)
                ended.append(column)
            if ended:
                kept = np.setdiff1d(np.arange(len(active)), ended)
                active, lower, up, down = active[kept], np.ascontiguousarray(lower[:, kept]), up[:, kept], down[:, kept]
        return found, shares

    def _ahead(self, rising: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next entry of each list from its upper and from its lower end; the last one where all is read."""
        n, d = self.shape
        lists = np.arange(d)
        return rising[np.maximum(n - 1 - depth, 0), lists], rising[np.minimum(depth, n - 1), lists]
