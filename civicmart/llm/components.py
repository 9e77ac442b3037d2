"""Connected components of a graph given as edges, by alternating stars.

Large-star links every larger neighbour of a node to the smallest node that it knows,
small-star does so for the smaller ones; both keep the components and end in stars
around each component's smallest node.  Every round is a few joins and aggregations, so
a hub with a third of all edges is pre-aggregated and its join split; no component is
ever gathered.  Rounds are written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.llm.common import staged


def forest(pairs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same connections as stars: (node, smallest node of its part), without the latter itself."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, r) for x in parent if (r := root(x)) != x]


def _contracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = forest(zip(batch["a"].tolist(), batch["b"].tolist()))
        yield pd.DataFrame(np.array(out, dtype=np.int64).reshape(-1, 2), columns=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    Nodes are whole numbers.  Edges from a node to itself and repeated edges change
    nothing; nulls are left out; no edges give no rows.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    edges = staged(edges.mapInPandas(_contracted, "a long, b long").distinct(), "edges")
    before = None
    while (state := _state(edges)) != before:
        before = state
        edges = staged(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
