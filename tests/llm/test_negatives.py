from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from civicmart.llm import negatives
from civicmart.llm.queries import op13_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    kept = []
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for a, (i, label, v) in enumerate(kept):
        if i % 100:
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w)), j, other)
            for b, (j, other, w) in enumerate(kept)
            if b != a and len(w) == len(v)
        ]
        scored.sort()
        for down, j, _ in [s for s in scored if s[2] == label][:5]:
            fit = [s for s in scored if s[2] != label and 80 * -down <= 100 * -s[0] <= 100 * -down][:5]
            out += [(i, j, rank, s[1], -down, -s[0]) for rank, s in enumerate(fit, 1)]
    return sorted(out)


@pytest.fixture
def answer(spark, tmp_path):
    def run(rows, extra=()):
        df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in extra})
        df.repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
        found = op13_hard_negatives(spark, str(tmp_path))
        names = "anchor_id positive_id rank negative_id positive_score negative_score".split()
        return sorted(tuple(r) for r in found.select(names).collect())

    return run


def vectors(seed, n, d=4, step=0.25, labels=3):
    """Few distinct components, so many scores tie."""
    rng = random.Random(seed)
    return [(i, [rng.randint(-2, 4) * step for _ in range(d)], rng.randrange(labels)) for i in range(n)]


def test_equals_brute_force_with_ties_and_odd_rows(spark, answer):
    rows = vectors(3, 900)
    rows += [(1000, [1.0, 0.5], 1), (1001, [1.0, 0.25], 1), (1002, [1.0, 0.25], 2), (1003, [], 1), (1100, None, 1)]
    rows += [(1200, [1.0, float("nan"), 0.0, 0.0], 1), (1201, [None, 1.0, 0.0, 0.0], 1), (None, [1.0] * 4, 1), (1300, [1.0] * 4, None)]
    rows += [(1400, [float("inf"), 1.0, 0.0, 0.0], 1), (1500, [0.0] * 4, 2)]
    expected = brute(rows)
    assert len(expected) > 100
    assert answer(rows, ("d", "shard", "asks", "v", "windows", "row_id", "anchor", "score", "key")) == expected


def test_repeated_rows_are_rows_each(spark, answer):
    rows = vectors(5, 150) * 2 + [(0, [1.0, 0.5, 0.0, 0.25], 1)] * 40
    assert answer(rows) == brute(rows)


def test_many_shards_and_blocks(spark, answer, monkeypatch):
    monkeypatch.setattr(negatives, "SHARD_ROWS", 50)
    monkeypatch.setattr(negatives, "_BLOCK", 2)
    rows = vectors(8, 1200, d=6)
    assert answer(rows) == brute(rows)


def test_large_components_are_exact(spark, answer):
    rows = [(i, [float(2**20 + i), float(2**21 - 3 * i)], i % 2) for i in range(130)]
    assert answer(rows) == brute(rows)


def test_empty_table_and_lonely_anchor(spark, answer):
    assert answer([]) == []


def test_anchor_without_positives(spark, answer):
    assert answer([(100, [1.0], 1), (101, [1.0], 2)]) == []
