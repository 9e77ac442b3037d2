from __future__ import annotations

import random

import numpy as np
import xxhash

from civicmart.llm import simhash
from civicmart.llm.components import components, forest


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").split() if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, radius=3):
    pairs = [(a, b) for a in values for b in values if a < b and bin(a ^ b).count("1") <= radius]
    root = dict(forest(pairs))
    return {v: root.get(v, v) for v in values}


def signed(values):
    return [int(np.uint64(v).view(np.int64)) for v in values]


def test_fingerprint_is_the_majority_of_shingle_hashes():
    for text in ["", None, "One", "one TWO", "a b c", "a\tb\nc d  e", "É a É b É c", "x " * 500 + "y z"]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_hash_agrees(spark):
    text = "alpha beta gamma"
    row = spark.sql(f"SELECT xxhash64('{text}') AS h").first()
    assert int(np.int64(row.h).view(np.uint64)) == xxhash.xxh64_intdigest(text, 42)


def test_links_equal_brute_force_with_and_without_tiles(spark):
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values)[:25]:
        for _ in range(4):
            near = v
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                near ^= 1 << bit
            values.add(near)
    base = rng.getrandbits(64)  # a crowd that agrees on three of the four parts
    values |= {base ^ rng.getrandbits(16) for _ in range(120)}
    fps = spark.createDataFrame([(v,) for v in signed(values)], "fp long")
    want = {}
    for v, r in brute_components([v for v in values]).items():
        want.setdefault(r, set()).add(v)
    for rows in (simhash.TILE_ROWS, 7):
        got = {}
        for r in components(simhash.links(fps, tile_rows=rows)).collect():
            got.setdefault(r.component, set()).add(int(np.int64(r.node).view(np.uint64)))
        groups = {frozenset(g) for g in want.values() if len(g) > 1}
        assert {frozenset(g) for g in got.values()} == groups


def test_a_link_group_emits_no_more_rows_than_members(spark):
    base = 0x1234_5678_9ABC_DEF0
    crowd = sorted({base ^ (1 << a) ^ (1 << b) for a in range(16) for b in range(16)})
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed(crowd)], "fp long")).collect()
    assert 0 < len(edges) < 4 * len(crowd)


def test_components_of_long_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(5, i) for i in range(1000, 1100)]
    edges = spark.createDataFrame([*chain, *hub, (7, 7), (100, 101)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in [5, *range(1000, 1100)]}}


def test_documents_rows_nulls_blanks_and_repeats(docs):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(4, long), (2, long + " end"), (9, "other words here now"), (3, None), (8, " \n"), (9, "other words here now")]
    found = simhash.near_duplicates(docs(rows)).collect()
    fps = {(r.doc_id, r.fp) for r in found}
    assert len(found) == len(rows) and len(fps) == 5
    by_id = {r.doc_id: r.component_id for r in found}
    assert by_id[8] == by_id[3] == 3 and by_id[9] == 9
    near = bin(plain_fingerprint(long) ^ plain_fingerprint(long + " end")).count("1") <= 3
    assert by_id[4] == (2 if near else 4)


def test_one_row_of_each_component_stays(docs):
    frame = docs([(1, "a b c d"), (2, "a b c d"), (3, "q r s t u"), (3, "q r s t u"), (None, "z z z y"), (5, None)])
    kept = simhash.deduplicated(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [
        (0, "z z z y"),
        (1, "a b c d"),
        (3, "q r s t u"),
        (5, ""),
    ]


def test_no_documents(docs):
    assert simhash.near_duplicates(docs([])).count() == 0
