"""Hard negatives by a secondary sort: rows that score just below a positive of their anchor.

Scores are taken tile by tile: the rows are dealt into shards, and the anchors stream past each
shard in blocks.  What leaves a tile is bounded.  First every shard gives each anchor its
best rows of the anchor's label, of which the best of all shards are the positives.
A positive of score s opens the window of rows of other labels that score from ``floor`` * s
to s.  With the windows known, every shard gives each anchor the first rows in each
window; the first of all shards are among them.

Positives and negatives then go through one shuffle by anchor, sorted by the packed key
(anchor, descending score, positive first, id).  An iterator runs over the sorted rows:
a positive opens its window, a negative is given to the windows that are open, and a
window closes when it is full or scores fall below it.  So no anchor's rows are gathered.
(``repartition`` with ``sortWithinPartitions`` is what ``repartitionAndSortWithinPartitions``
is for RDDs; rows stay in the JVM until the iterator takes them.)

Defined results: rows without id, label or vector, with an empty vector, or with a null or
non-finite component take no part; vectors score only with those of their length; rows that
repeat are rows each, as candidates and as anchors, and an anchor's copies are other rows;
equal anchors are scored once; ties go to the smaller id; an empty table gives no rows;
further columns are ignored.  Scores must fit in 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicmart.llm.common import staged

SHARD_ROWS = 16384
_BLOCK = 256
_FOUND = "anchor long, score long, vec_id long"


def labelled_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(row_id, vec_id, label, v) of the rows that take part; components are floor(scale * x)."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    return embeddings.where(known).where((F.size("embedding") > 0) & ~odd).select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"),
    )


# ---- tiles -------------------------------------------------------------------------------


class _Shard:
    """The vectors of one shard in the order of their ids."""

    def __init__(self, parts: list[pa.RecordBatch], d: int):
        ids = np.concatenate([p.column("vec_id").to_numpy() for p in parts])
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.rows = np.concatenate([p.column("row_id").to_numpy() for p in parts])[order]
        self.labels = np.concatenate([p.column("label").to_numpy() for p in parts])[order]
        self.values = np.concatenate([_matrix(p, d) for p in parts])[order]
        self.largest = float(np.abs(self.values).max(initial=0)) * d
        self.doubles = self.values.astype(np.float64).T

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products, exact: in double precision while every sum stays below 2**53."""
        if self.largest * float(np.abs(anchors).max(initial=0)) < 2.0**53:
            return (anchors.astype(np.float64) @ self.doubles).astype(np.int64)
        return anchors @ self.values.T

    def best(self, scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
        """The first k of ``places`` by descending score, then id."""
        here = scores[places]
        if len(places) > k:
            least = np.partition(here, len(here) - k)[len(here) - k]
            places, here = places[here >= least], here[here >= least]
        return places[np.argsort(-here, kind="stable")[:k]]


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _tiles(vectors: DataFrame, anchors: DataFrame, choose) -> DataFrame:
    """``choose(shard, scores, anchor)`` gives the places of a shard to keep: (anchor, score, vec_id).

    ``anchors`` (row_id, vec_id, label, v, windows) meet every shard of their length.
    """
    spark = vectors.sparkSession
    shards = max(1, math.ceil(vectors.count() / SHARD_ROWS), spark.sparkContext.defaultParallelism)
    columns = ["d", "shard", "asks", "row_id", "vec_id", "label", "v", "windows"]
    size = F.size("v").alias("d")
    dealt = vectors.select(
        size, F.pmod(F.xxhash64("row_id"), F.lit(shards)).alias("shard"), F.lit(0).alias("asks"), "row_id", "vec_id", "label", "v",
        F.lit(None).cast("array<long>").alias("windows"),
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard")
    asked = anchors.select(size, every, F.lit(1).alias("asks"), "row_id", "vec_id", "label", "v", "windows")
    # A shard's vectors come first, then the anchors pass by.
    rows = dealt.select(columns).union(asked.select(columns))
    rows = rows.repartitionByRange(shards, "shard", "d").sortWithinPartitions("shard", "d", "asks", "row_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, shard = None, [], None
        for batch in batches:
            change = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("shard", "d", "asks")], axis=1)
            cuts = np.flatnonzero((change[1:] != change[:-1]).any(axis=1)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(change)]):
                part = batch.slice(low, high - low)
                number, d, asks = change[low].tolist()
                if (number, d) != key:
                    key, parts, shard = (number, d), [], None
                if not asks:
                    parts.append(part)
                elif parts:
                    shard = shard or _Shard(parts, d)
                    yield from _kept(shard, part, d, choose)

    return rows.mapInArrow(run, _FOUND)


def _kept(shard: _Shard, anchors: pa.RecordBatch, d: int, choose) -> Iterator[pa.RecordBatch]:
    for low in range(0, anchors.num_rows, _BLOCK):
        block = anchors.slice(low, _BLOCK)
        scores = shard.scores(_matrix(block, d))
        names, best, ids = [], [], []
        for row, asked in zip(scores, block.select(["row_id", "label", "windows"]).to_pylist()):
            places = choose(shard, row, asked)
            names.append(np.full(len(places), asked["row_id"]))
            best.append(row[places])
            ids.append(shard.ids[places])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (names, best, ids)], ["anchor", "score", "vec_id"])


# ---- mining ------------------------------------------------------------------------------


def mined(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, floor: float = 0.8) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` as of ``labelled_vectors``, ``anchors`` some of them.  For each anchor and each of its first
    ``positives`` rows of the same label, the first ``negatives`` rows of other labels with
    floor * positive_score <= negative_score <= positive_score; ``floor`` in whole hundredths.
    """
    hundredths = round(floor * 100)
    anchors = anchors.groupBy("vec_id", "label", "v").agg(F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("copies"))
    anchors = staged(anchors.withColumn("windows", F.lit(None).cast("array<long>")), "anchors")

    def same_label(shard: _Shard, scores: np.ndarray, anchor: dict) -> np.ndarray:
        places = np.flatnonzero((shard.labels == anchor["label"]) & (shard.rows != anchor["row_id"]))
        return shard.best(scores, places, positives)

    def in_windows(shard: _Shard, scores: np.ndarray, anchor: dict) -> np.ndarray:
        others = np.flatnonzero(shard.labels != anchor["label"])
        if not anchor["windows"] or not len(others):
            return others[:0]
        here = scores[others]
        kept = []
        for top in anchor["windows"]:
            # Scores from 0.8 * top to top, in whole numbers.
            least = -(-hundredths * top // 100)
            kept.append(shard.best(scores, others[(here >= least) & (here <= top)], negatives))
        return np.unique(np.concatenate(kept))

    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
    found = _tiles(vectors, anchors, same_label)
    chosen = staged(found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives).drop("n"), "positives")
    windows = chosen.groupBy("anchor").agg(F.collect_set("score").alias("windows"))
    opened = anchors.drop("windows").join(windows.withColumnRenamed("anchor", "row_id"), "row_id")
    within = _tiles(vectors, opened, in_windows)

    pairs = chosen.withColumn("kind", F.lit(0)).unionByName(within.withColumn("kind", F.lit(1)))
    key = F.struct("anchor", (-F.col("score")).alias("down"), "kind", "vec_id")
    dealt = pairs.select(key.alias("key")).repartition("key.anchor").sortWithinPartitions("key")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, windows = None, []
        for batch in batches:
            out = []
            keys = batch.column("key")
            for name, down, kind, vec_id in zip(*[keys.field(c).to_pylist() for c in ("anchor", "down", "kind", "vec_id")]):
                if name != anchor:
                    anchor, windows = name, []
                if kind == 0:
                    windows.append([vec_id, -down, 0])
                    continue
                windows = [w for w in windows if w[2] < negatives and hundredths * w[1] <= -100 * down]
                for window in windows:
                    window[2] += 1
                    out.append((anchor, window[0], window[2], vec_id, window[1], -down))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, kinds)], names)

    names = ["anchor", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    kinds = [pa.int32() if n == "rank" else pa.int64() for n in names]
    mined_rows = dealt.mapInArrow(emit, ", ".join(f"{n} {'int' if n == 'rank' else 'long'}" for n in names))
    # Every copy of an anchor has the same rows.
    copies = anchors.select(F.col("row_id").alias("anchor"), F.col("vec_id").alias("anchor_id"), "copies")
    each = mined_rows.join(copies, "anchor").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select("anchor_id", *names[1:])
