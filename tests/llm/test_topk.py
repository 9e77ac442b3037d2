from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicmart.llm import topk
from civicmart.llm.common import staged
from civicmart.llm.queries import op9_sorted_list_search

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=50, k=5):
    kept = [
        (i, [math.floor(256 * x) for x in v])
        for i, v, _ in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (i, v) in enumerate(kept):
        if i % every == 0:
            scored = [(-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(kept) if b != a and len(w) == len(v)]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.fixture
def answer(spark, tmp_path):
    def run(rows, extra=()):
        df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in extra})
        df.repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
        found = op9_sorted_list_search(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score")
        return sorted(tuple(r) for r in found.collect())

    return run


def vectors(seed, n, d=4, step=0.25):
    rng = random.Random(seed)
    return [(i, [rng.randint(-3, 4) * step for _ in range(d)], 0) for i in range(n)]


def test_equals_brute_force_with_ties_and_odd_rows(spark, answer):
    rows = vectors(1, 400)
    rows += [(500, [1.0, 0.5], 1), (501, [1.0, 0.25], 1), (550, [], 1), (600, None, 1), (650, [float("nan")] * 4, 1)]
    rows += [(None, [1.0] * 4, 1), (700, [None, 1.0, 0.0, 0.0], 1), (750, [float("inf"), 1.0, 0.0, 0.0], 1), (800, [0.0] * 4, 2), (850, [9.0], 2)]
    assert answer(rows, ("row_id", "v", "d", "shard", "asks", "part", "bound", "query_row", "score")) == brute(rows)


def test_repeated_rows_are_rows_each(spark, answer):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.5, 0.0], 0), (0, [1.0, 1.0], 0), (0, [1.0, 1.0], 0)]
    assert answer(rows) == brute(rows)
    assert [r[2] for r in brute(rows)][:4] == [0, 0, 1, 1]


def test_many_shards_and_blocks(spark, answer, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(topk, "TASK_QUERIES", 6)
    monkeypatch.setattr(topk.top_k, "__defaults__", (5, 60))
    rows = vectors(2, 1000, d=6)
    assert answer(rows) == brute(rows)


def test_large_components_are_exact(spark, answer):
    rows = [(i, [float(2**20 + i), float(2**21 - 3 * i), -float(2**19 + 7 * i)], 0) for i in range(160)]
    assert answer(rows) == brute(rows)


def test_fewer_candidates_than_k_and_empty(spark, answer):
    rows = [(0, [1.0], 0), (3, [2.0], 0), (4, [1.0, 2.0], 0)]
    assert answer(rows) == [(0, 1, 3, 131072)]


def test_empty_table(spark, answer):
    assert answer([]) == []


def shard(values, first=0):
    ids = np.arange(first, first + len(values))
    return topk.SortedLists(ids, ids, values)


def test_clustered_vectors_stop_early_and_bounds_from_elsewhere_sooner(spark):
    """Few vectors point where the query points, as many as it wants; the others point elsewhere."""
    rng = np.random.default_rng(3)
    values = rng.integers(-20, 20, (4000, 16))
    values[::400] += 1000
    query = np.full((1, 16), 300)
    lists, none = shard(values), np.array([-(1 << 62)])
    found, share = lists.search(np.array([-1]), query, none, 5)
    scores = values @ query[0]
    best = sorted(zip(-scores, range(4000)))[:5]
    assert [(i, s) for _, i, s in found] == [(i, -s) for s, i in best]
    assert share[0] <= 0.25
    far = shard(rng.integers(-20, 20, (4000, 16)))
    found, bounded = far.search(np.array([-1]), query, np.array([int(-best[-1][0])]), 5)
    assert found == [] and bounded[0] <= 0.1
    _, unbounded = far.search(np.array([-1]), query, none, 5)
    assert unbounded[0] > bounded[0]


def test_scores_come_from_lists_alone(spark):
    """Every share of reading gives the exact scores; a query of zeros ties everywhere."""
    rng = np.random.default_rng(4)
    for d in (1, 2, 9):
        values = rng.integers(-5, 6, (300, d))
        queries = rng.integers(-5, 6, (40, d))
        queries[0] = 0
        found, share = shard(values).search(np.arange(40), queries, np.full(40, -(1 << 62)), 3)
        for q in range(40):
            expected = sorted((-int(values[i] @ queries[q]), i) for i in range(300) if i != q)[:3]
            assert [(-s, i) for p, i, s in found if p == q] == expected
        assert (share > 0).all() and (share <= 1).all()
