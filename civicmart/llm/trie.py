"""Prefix trie of conversations by ROLLUP over positional turn columns.

A node is a distinct sequence of first turns.  Conversations are cut into blocks of
``BLOCK_TURNS`` turns, one row each with a column per position; ``GROUP BY block, node of
the block before, ROLLUP (t1, ..., t8)`` aggregates the members of all prefixes that end
in any block at once, and ``grouping_id`` says how deep a row's prefix is.

The node that a block hangs on is named by its depth and two sums of hashes of (position,
turn), so it is known without a join, and running sums over chunks of blocks give it even
for a conversation that holds a third of all turns.

Sums over subtrees need no walk over the tree.  A node belongs to its smallest member.
The nodes of a conversation c that are its own are those from some depth on, because the
members of a child are among those of its parent.  Let A(c) be the bytes of the turns
before that depth, shared with a smaller conversation.  Then a node X whose parent's path
has P bytes saves the sum of A over its members but the smallest, less (members - 1) * P,
and its leaves are the members that own a childless last node.  So both are sums over
members, taken by the same ROLLUP once A is known.

Defined results: rows without conv_id take no part; a null role or text is empty; turns
are ordered by turn (null first), role and text; repeated rows are turns each; an empty
table gives no nodes, not even a root; further columns are ignored.  Positions in a
conversation are counted by ranges of ``turn``, so one task sorts the rows of a
thousand turn numbers of one conversation, not a whole conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.llm.common import staged

BLOCK_TURNS = 8
ENDS_CHUNK_BITS = 14
_RANGE_BITS = (20, 10)
_KEY = ["depth", "s1", "s2"]


# ---- turns -------------------------------------------------------------------------------


def _running(rows: DataFrame, keys: list[str], place: str, order: list[str], values: list[str]) -> DataFrame:
    """Add ``before_<value>``: sums over the earlier rows of the same keys.

    Rows are summed by ranges of ``place``, which leads ``order``, and ranges by wider ones.
    """
    least = F.lit(-(1 << 63))
    wide, narrow = (F.coalesce(F.shiftright(F.col(place), b), least) for b in _RANGE_BITS)
    rows = rows.withColumns({"wide": wide, "narrow": narrow})

    def add(df: DataFrame, within: list[str], by: list[str], prefix: str) -> DataFrame:
        earlier = Window.partitionBy(*keys, *within).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({f"{prefix}{v}": F.coalesce(F.sum(v).over(earlier), F.lit(0)) for v in values})

    def level(df: DataFrame, within: list[str]) -> DataFrame:
        return df.groupBy(*keys, *within).agg(*[F.sum(v).alias(v) for v in values])

    narrow_sums = level(rows, ["wide", "narrow"])
    wide_sums = add(level(narrow_sums, ["wide"]), [], ["wide"], "w_").drop(*values)
    narrow_sums = add(narrow_sums, ["wide"], ["narrow"], "n_").drop(*values)
    out = add(rows, ["wide", "narrow"], order, "in_")
    out = out.join(narrow_sums, [*keys, "wide", "narrow"]).join(wide_sums, [*keys, "wide"])
    total = {f"before_{v}": F.col(f"in_{v}") + F.col(f"n_{v}") + F.col(f"w_{v}") for v in values}
    return out.withColumns(total).drop("wide", "narrow", *[f"{p}{v}" for p in ("in_", "n_", "w_") for v in values])


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_id, bytes): every conversation's turns in order, counted from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = (
        conversations.where("conv_id IS NOT NULL")
        .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
        .select(
            "conv_id",
            "turn",
            "role",
            "text",
            # 128 bits of the turn; the length says where the role ends.
            F.substring(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 32).alias("turn_id"),
            F.octet_length("text").cast("long").alias("bytes"),
            F.lit(1).alias("one"),
        )
    )
    placed = _running(rows, ["conv_id"], "turn", ["turn", "role", "text"], ["one"])
    return placed.select("conv_id", (F.col("before_one") + 1).alias("pos"), "turn_id", "bytes")


def grafted(turns: DataFrame, bases: DataFrame) -> DataFrame:
    """Conversations whose first turns are those of another one.

    ``bases`` (conv_id, base_id, h) names for each conversation the one whose first h turns
    (all if fewer, none if absent) stand before the conversation's own turns after its first h.
    """
    most = bases.agg(F.max("h")).first()[0] or 0
    first = turns.where(F.col("pos") <= most).select(F.col("conv_id").alias("base_id"), "pos", "turn_id", "bytes")
    lent = bases.join(first, "base_id").where("pos <= h").select("conv_id", "pos", "turn_id", "bytes")
    counts = first.groupBy("base_id").agg(F.max("pos").alias("n_base"))
    moved = bases.join(counts, "base_id", "left").select(
        "conv_id", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("n_lent")
    )
    own = turns.join(moved, "conv_id").where("pos > h")
    return lent.union(own.select("conv_id", F.col("pos") - F.col("h") + F.col("n_lent"), "turn_id", "bytes"))


# ---- the trie ----------------------------------------------------------------------------


def _hashes(pos: Column | str, turn_id: Column | str) -> list[Column]:
    """Two 64-bit hashes of a turn at its position, as numbers whose sums are exact."""
    return [F.xxhash64(F.lit(seed), pos, turn_id).cast("decimal(20,0)") for seed in (1, 2)]


def _blocks(turns: DataFrame, block_turns: int) -> DataFrame:
    """One row per conversation and block: the node before it, its turns, and the bytes of the path before it."""
    cut = turns.select(
        "conv_id",
        F.floor((F.col("pos") - 1) / block_turns).alias("block"),
        F.pmod(F.col("pos") - 1, F.lit(block_turns)).alias("at"),
        "turn_id",
        "bytes",
        *[h.alias(f"h{i}") for i, h in enumerate(_hashes("pos", "turn_id"), 1)],
    )
    position = [
        F.max(F.when(F.col("at") == i, F.struct("turn_id", "bytes"))).alias(f"t{i + 1}") for i in range(block_turns)
    ]
    rows = cut.groupBy("conv_id", "block").agg(
        *position,
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).cast("decimal(38,0)" if c != "bytes" else "long").alias(c) for c in ("h1", "h2", "bytes")],
    )
    placed = _running(rows, ["conv_id"], "block", ["block"], ["h1", "h2", "bytes"])
    number = "decimal(38,0)"
    return placed.withColumn(
        "prior",
        F.struct(
            F.col("before_h1").cast(number).alias("s1"),
            F.col("before_h2").cast(number).alias("s2"),
            F.col("before_bytes").cast("long").alias("path_bytes"),
        ),
    ).drop("before_h1", "before_h2", "before_bytes")


def _rolled_up(blocks: DataFrame, block_turns: int, measures: str) -> DataFrame:
    """All nodes below the root: (depth, s1, s2), the parent's (p_s1, p_s2), bytes, path_bytes and the measures."""
    columns = [f"t{i}" for i in range(1, block_turns + 1)]
    grouped = blocks.sparkSession.sql(
        f"""SELECT block, prior, {", ".join(columns)}, grouping_id() AS missing, {measures}
            FROM {{blocks}} GROUP BY block, prior, ROLLUP ({", ".join(columns)})""",
        blocks=blocks,
    )
    # The last columns are rolled up: 2**k - 1 says that k of them are.
    level = F.lit(block_turns) - F.length(F.regexp_replace(F.bin("missing"), "0", "")).cast("int")
    path = F.array(*columns)
    grouped = grouped.withColumn("level", level).where("level > 0").withColumn("last", F.get(path, F.col("level") - 1))
    # Conversations that end before this level are members of no node of it.
    grouped = grouped.where("last IS NOT NULL")
    sums: dict[str, Column] = {f"p_s{j}": F.col(f"prior.s{j}") for j in (1, 2)}
    sums |= {f"s{j}": F.col(f"prior.s{j}") for j in (1, 2)}
    path_bytes = F.col("prior.path_bytes")
    for i, name in enumerate(columns, 1):
        place = F.col("block") * block_turns + i
        for j, h in enumerate(_hashes(place, F.col(f"{name}.turn_id")), 1):
            sums[f"s{j}"] = sums[f"s{j}"] + F.when(F.col("level") >= i, h).otherwise(F.lit(0))
            sums[f"p_s{j}"] = sums[f"p_s{j}"] + F.when(F.col("level") > i, h).otherwise(F.lit(0))
        path_bytes = path_bytes + F.when(F.col("level") > i, F.col(f"{name}.bytes")).otherwise(F.lit(0))
    kept = [c for c in grouped.columns if c not in {"block", "prior", "missing", "level", "last", *columns}]
    return grouped.select(
        (F.col("block") * block_turns + F.col("level")).cast("long").alias("depth"),
        *[c.cast("decimal(38,0)").alias(n) for n, c in sums.items()],
        F.col("last.bytes").alias("bytes"),
        path_bytes.alias("path_bytes"),
        *kept,
    )


def _ends_sha256(ends: DataFrame) -> DataFrame:
    """(depth, s1, s2, ends_sha256) of (depth, s1, s2, conv_id): the digest of the ids in ascending order.

    Ids are joined by ranges of 2**``ENDS_CHUNK_BITS`` ids; a node's ranges then pass
    through its hash one by one.
    """
    chunk = F.shiftright("conv_id", ENDS_CHUNK_BITS).alias("chunk")
    said = ends.groupBy(*_KEY, chunk).agg(F.concat_ws(",", F.sort_array(F.collect_list("conv_id")).cast("array<string>")).alias("ids"))
    said = said.select(F.to_json(F.struct(*_KEY)).alias("node"), "chunk", "ids")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, running = None, None
        for batch in batches:
            out = []
            for name, ids in zip(batch["node"], batch["ids"]):
                if name != node:
                    if node is not None:
                        out.append((node, running.hexdigest()))
                    node, running = name, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=["node", "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(node, running.hexdigest())], columns=["node", "ends_sha256"])

    sorted_ranges = said.repartition("node").sortWithinPartitions("node", "chunk")
    hashed = sorted_ranges.mapInPandas(digest, "node string, ends_sha256 string")
    kinds = "depth long, s1 decimal(38,0), s2 decimal(38,0)"
    return hashed.select(F.from_json("node", kinds).alias("n"), "ends_sha256").select("n.*", "ends_sha256")


def prefix_trie(turns: DataFrame, members: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """All nodes of the trie of ``turns`` (conv_id, pos, turn_id, bytes) of ``members`` (conv_id, each once).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)
    """
    blocks = staged(_blocks(turns, block_turns), "trie-blocks")
    lengths = blocks.groupBy("conv_id").agg(
        F.sum("n").alias("depth"), *[F.sum(f"h{j}").cast("decimal(38,0)").alias(f"s{j}") for j in (1, 2)], F.sum("bytes").alias("bytes")
    )
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    whole = {c: F.lit(0).cast("long") for c in ("depth", "bytes", "path_bytes")}
    whole |= {f"s{j}": F.lit(0).cast("decimal(38,0)") for j in (1, 2)}
    whole |= {f"p_s{j}": F.lit(None).cast("decimal(38,0)") for j in (1, 2)}
    found = _rolled_up(blocks, block_turns, "min(conv_id) AS conv_id, count(1) AS n_convs")
    nodes = staged(found.unionByName(root.withColumns(whole)), "trie-nodes")

    # What a conversation shares with smaller ones, and whether it owns a leaf.
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p_s1").alias("s1"), F.col("p_s2").alias("s2")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    children = staged(children, "trie-children")
    owned = nodes.groupBy("conv_id").agg(F.min_by("path_bytes", "depth").alias("shared"))
    leaves = nodes.join(children, _KEY, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    facts = members.select("conv_id").join(lengths, "conv_id", "left").join(owned, "conv_id", "left").join(leaves, "conv_id", "left")
    facts = facts.select(
        "conv_id",
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        *[F.coalesce(f"s{j}", F.lit(0)).cast("decimal(38,0)").alias(f"s{j}") for j in (1, 2)],
        F.coalesce("shared", "bytes", F.lit(0)).alias("shared"),
        F.coalesce("leaf", F.lit(0)).alias("leaf"),
    )
    facts = staged(facts, "trie-members")

    measures = ["min(struct(conv_id, shared)) AS first", "count(1) AS n_convs", "sum(shared) AS shared", "sum(leaf) AS n_leaves"]
    with_facts = blocks.join(facts.select("conv_id", "shared", "leaf"), "conv_id")
    at_root = facts.agg(*map(F.expr, measures)).where("n_convs > 0").withColumns(whole)
    summed = _rolled_up(with_facts, block_turns, ", ".join(measures)).unionByName(at_root)
    saved = F.col("shared") - F.col("first.shared") - (F.col("n_convs") - 1) * F.col("path_bytes")
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("s1").alias("p_s1"), F.col("s2").alias("p_s2"), F.col("conv_id").alias("parent_conv_id")
    )
    ends = _ends_sha256(facts.select(*_KEY, "conv_id"))
    out = summed.join(children, _KEY, "left").join(ends, _KEY, "left").join(parents, ["depth", "p_s1", "p_s2"], "left")
    return out.select(
        F.col("first.conv_id").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"),
        saved.cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
