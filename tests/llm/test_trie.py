from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from civicmart.llm import trie
from civicmart.llm.queries import op12_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(paths):
    """Nodes of {conv_id: [(role, text), ...]} by walking every prefix."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out, below = [], {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        leaves = sum(below[c][0] for c in children[node]) or 1
        saved = own + sum(below[c][1] for c in children[node])
        below[node] = leaves, saved
        said = ",".join(map(str, sorted(ends[node])))
        parent = min(members[node[:-1]]) if node else None
        out.append(
            (min(members[node]), len(node), parent, len(members[node]), len(children[node]), leaves, saved,
             hashlib.sha256(said.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def ordered(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in turns.items()}


def rebuilt(rows):
    own, out = ordered(rows), {}
    for c, path in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + path[h:]
    return out


@pytest.fixture
def stored(spark, tmp_path):
    def build(rows, extra=()):
        df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in extra})
        df.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
        return str(tmp_path)

    return build


def nodes(df):
    columns = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted((tuple(r) for r in df.select(columns).collect()), key=repr)


def random_rows(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randint(1, 14)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "bé", "", "x" * 50])))
    return rows


def test_equals_walking_every_prefix(spark, stored):
    rows = random_rows(1) + [(3, None, "user", "before"), (4, 2, None, None), (4, 2, None, None), (None, 0, "user", "lost")]
    rows = [r for r in rows if r[0] not in (10, 25)]  # absent bases
    clash = ("block", "at", "wide", "narrow", "pos", "prior", "t1", "depth", "h1", "bytes", "one")
    assert nodes(op12_prefix_trie(spark, stored(rows, clash))) == brute(rebuilt(rows))


def test_role_and_text_are_told_apart(spark, stored):
    rows = [(0, 0, "ab", "c"), (5, 0, "a", "bc"), (10, 0, "", "abc"), (15, 0, None, "abc")]
    turns = trie.ordered_turns(spark.createDataFrame(rows, SCHEMA))
    assert nodes(trie.prefix_trie(turns, turns.select("conv_id").distinct())) == brute(ordered(rows))


def test_long_conversations_go_on_in_further_blocks(spark):
    """Two conversations share 2,500 turns; turn numbers reach over several ranges."""
    long = [(c, 1000 * t - 10**6, "user", f"{t if t < 2500 else (c, t)}") for c in (7, 9) for t in range(3000)]
    rows = long + [(11, 0, "user", "0"), (12, 0, "user", "0")]
    turns = trie.ordered_turns(spark.createDataFrame(rows, SCHEMA).repartition(8))
    assert nodes(trie.prefix_trie(turns, turns.select("conv_id").distinct())) == brute(ordered(rows))


@pytest.mark.parametrize("block_turns", [1, 3])
def test_block_size_does_not_show(spark, block_turns):
    rows = random_rows(2, 30)
    turns = trie.ordered_turns(spark.createDataFrame(rows, SCHEMA))
    assert nodes(trie.prefix_trie(turns, turns.select("conv_id").distinct(), block_turns)) == brute(ordered(rows))


def test_many_copies_and_digest_over_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(trie, "ENDS_CHUNK_BITS", 4)
    rows = [(c, t, "user", "same") for c in range(0, 900, 3) for t in range(2)] + [(901, 0, "user", "same")]
    turns = trie.ordered_turns(spark.createDataFrame(rows, SCHEMA))
    assert nodes(trie.prefix_trie(turns, turns.select("conv_id").distinct())) == brute(ordered(rows))


def test_turnless_members_and_empty_table(spark):
    turns = trie.ordered_turns(spark.createDataFrame([], SCHEMA))
    members = spark.createDataFrame([(2,), (10,)], "conv_id long")
    assert nodes(trie.prefix_trie(turns, members)) == brute({2: [], 10: []})
    assert nodes(trie.prefix_trie(turns, members.limit(0))) == []
