"""SimHash near-duplicates by exact comparison of tiles.

Fingerprints of 64 bits are compared with numpy's exclusive-or and bit counts, tile
against tile; tile pairs whose population counts differ by more than the radius are
skipped.  All tiles against all would grow with the square of the corpus, so tiles are
formed among the fingerprints that agree on one of ``radius + 1`` equal parts of the
bits: two fingerprints within the radius agree on at least one part, so no link is lost.

A bucket of more than ``TILE_ROWS`` fingerprints is cut into tiles by population count
and a hash, and each pair of its tiles is a group of its own, so no task ever holds a hot
bucket.  A group gives a spanning forest of its links, never all pairs.

Defined results: a null or blank text has fingerprint zero and is linked like any other;
fewer words than the shingle's are one shingle; repeated rows are linked to each other; a
component whose ids are all null has a null id; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.llm.common import shielded, staged
from civicmart.llm.components import components, forest

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
TILE_ROWS = 1024
_INNER_ROWS = 256
_SHORT_RUN = 12
_VOTES = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64 bits; a bit is set if it is set in over half of the shingles' XXH64."""
    import xxhash

    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = list(accumulate(map(len, parts), lambda end, n: end + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    count = max(1, len(parts) - words + 1)
    spans = map(slice, starts[:count], ends[-count:])
    hashes = map(xxhash.xxh64_intdigest, map(joined.__getitem__, spans), repeat(seed))
    values = np.fromiter(hashes, np.uint64, count)
    votes = np.zeros(64, np.int64)
    for low in range(0, count, _VOTES):
        part = values[low : low + _VOTES].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp): one row per document; fp as a signed long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, words) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), of("text").alias("fp"))


def links(fps: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (fp) that connect all within the radius."""
    width = 64 // (radius + 1)
    parts = [
        F.struct(
            F.lit(i).alias("part"),
            (F.shiftrightunsigned("fp", i * width).bitwiseAND((1 << width) - 1)).alias("value"),
        )
        for i in range(radius + 1)
    ]
    entries = fps.select(
        "fp", F.bit_count("fp").alias("ones"), F.explode(F.array(*parts)).alias("bucket")
    ).select("fp", "ones", "bucket.part", "bucket.value")
    key = ["part", "value"]

    big = entries.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile_rows).select(key)
    big = staged(big, "big-buckets")
    small = entries.join(big, key, "left_anti").withColumns({"a": F.lit(0), "b": F.lit(0), "tile": F.lit(0)})

    crowded = entries.join(big, key, "left_semi")
    sizes = crowded.groupBy(*key, "ones").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("cuts"))
    sizes = staged(sizes, "tile-sizes")
    tiles = sizes.select(*key, "ones", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"))
    tiles = tiles.select(*key, "ones", (F.col("ones") * F.lit(1 << 24) + F.col("cut")).alias("tile"))
    other = tiles.select(*key, F.col("ones").alias("other_ones"), F.col("tile").alias("other"))
    pairs = tiles.join(other, key).where(
        (F.col("tile") <= F.col("other")) & (F.abs(F.col("ones") - F.col("other_ones")) <= radius)
    )
    ends = pairs.select(
        *key,
        F.col("tile").alias("a"),
        F.col("other").alias("b"),
        F.explode(F.array_distinct(F.array("tile", "other"))).alias("tile"),
    )
    placed = crowded.join(sizes, [*key, "ones"]).withColumn(
        "tile", F.col("ones") * F.lit(1 << 24) + F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")
    )
    shared = placed.select("fp", "ones", *key, "tile").join(ends, [*key, "tile"])

    columns = ["part", "value", "a", "b", "tile", "ones", "fp"]
    grouped = small.select(columns).unionByName(shared.select(columns))
    order = ["part", "value", "a", "b"]
    dealt = grouped.repartition(*order).sortWithinPartitions(*order, "tile", "ones")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            heads = batch[order].to_numpy()
            last = len(batch) - int(np.argmax((heads[::-1] != heads[-1]).any(axis=1)))
            if (heads == heads[-1]).all():
                last = 0
            rest = batch.iloc[last:]
            if last:
                yield _linked(batch.iloc[:last], order, radius)
        if rest is not None and len(rest):
            yield _linked(rest, order, radius)

    return dealt.mapInPandas(compare, "a long, b long")


def _linked(rows: pd.DataFrame, order: list[str], radius: int) -> pd.DataFrame:
    """A spanning forest of the links in each run of rows with the same group."""
    fp = rows["fp"].to_numpy(np.int64).view(np.uint64)
    tile, ones = rows["tile"].to_numpy(), rows["ones"].to_numpy()
    heads = rows[order].to_numpy()
    starts = np.flatnonzero(np.r_[True, (heads[1:] != heads[:-1]).any(axis=1)])
    lengths = np.diff(np.r_[starts, len(fp)])
    run = np.repeat(np.arange(len(starts)), lengths)
    short = (lengths <= _SHORT_RUN)[run] & (heads[:, 2] == heads[:, 3])
    found: list[np.ndarray] = []
    for step in range(1, _SHORT_RUN):
        at = np.flatnonzero((run[step:] == run[:-step]) & short[step:])
        if not len(at):
            break
        near = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= radius]
        found.append(np.stack([near, near + step], axis=1))
    for start, length in zip(starts, lengths):
        if not short[start]:
            found.append(start + _run_links(fp[start : start + length], tile[start : start + length], ones[start : start + length], radius))
    pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
    signed = fp.view(np.int64)
    out = forest(zip(signed[pairs[:, 0]].tolist(), signed[pairs[:, 1]].tolist()))
    return pd.DataFrame(np.array(out, dtype=np.int64).reshape(-1, 2), columns=["a", "b"])


def _run_links(fp: np.ndarray, tile: np.ndarray, ones: np.ndarray, radius: int) -> np.ndarray:
    """Links (as stars) within one tile, or between the two tiles of a group."""
    cut = int(np.searchsorted(tile, tile[-1]))
    left, right = (np.arange(cut), np.arange(cut, len(fp))) if cut else (np.arange(len(fp)),) * 2
    label = np.arange(len(fp))
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    for i in range(0, len(left), _INNER_ROWS):
        a = left[i : i + _INNER_ROWS]
        for j in range(0 if cut else i, len(right), _INNER_ROWS):
            b = right[j : j + _INNER_ROWS]
            if ones[a[0]] - ones[b[-1]] > radius or ones[b[0]] - ones[a[-1]] > radius:
                continue
            near = np.bitwise_count(fp[a][:, None] ^ fp[b][None, :]) <= radius
            if near.any():
                hits.append(_stars(near, a, b, label))
    return np.concatenate(hits) if hits else np.empty((0, 2), np.int64)


def _stars(near: np.ndarray, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """At most one link per row and column that connect what ``near`` connects.

    Least labels spread along the links until nothing changes.
    """
    size = len(label)
    rows, columns = a.astype(np.int64), b.astype(np.int64)
    mine, theirs = rows.copy(), columns.copy()
    while True:
        least = np.where(near, theirs[None, :], size).min(axis=1)
        new = np.minimum(mine, least)
        back = np.minimum(theirs, np.where(near, new[:, None], size).min(axis=0))
        if (new == mine).all() and (back == theirs).all():
            break
        mine, theirs = new, back
    links = np.concatenate([np.stack([rows, mine], axis=1), np.stack([columns, theirs], axis=1)])
    return links[links[:, 0] != links[:, 1]]


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, kept_hash) for every row of (doc_id, text).

    ``component_id`` is the smallest doc_id that is reachable; the row with that id and
    the least text hash ``kept_hash`` stands for the component.
    """
    rows = staged(fingerprints(docs, words), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")).alias("first")
    distinct = staged(rows.groupBy("fp").agg(first), "distinct-fingerprints")
    parts = components(links(distinct.select("fp"), radius))
    rooted = distinct.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    rooted = staged(rooted, "roots")
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    named = rooted.select("fp", "root").join(heads, "root")
    named = staged(
        named.select("fp", F.col("head.doc_id").alias("component_id"), F.col("head.text_hash").alias("kept_hash")),
        "components",
    )
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id", "kept_hash")


@shielded("doc_id", "text")
def deduplicated(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row of each component, with all columns of ``docs``."""
    found = near_duplicates(docs, words, radius)
    same = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("kept_hash"))
    kept = found.where(same).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    keyed = docs.withColumns({"__hash": F.xxhash64("text"), "__id": F.col("doc_id")})
    marked = keyed.join(
        kept.withColumns({"__known": F.coalesce("__id", F.lit(-1)), "__none": F.col("__id").isNull()}).drop("__id"),
        (F.coalesce(keyed["__id"], F.lit(-1)) == F.col("__known"))
        & (keyed["__id"].isNull() == F.col("__none"))
        & (keyed["__hash"] == kept["__hash"]),
        "left_semi",
    )
    return marked.dropDuplicates(["__id", "__hash"]).drop("__id", "__hash")
