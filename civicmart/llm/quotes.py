"""Conversations without quotations, in reply order, in DataFrame functions only.

Lines that begin with ``>`` signs are quoted, as deep as there are signs; consecutive
lines of one depth are a passage.  Passages and their lines are normalised (small letters,
single spaces) and hashed, and joined with the hashes of what other messages say in their
own words.  Per hash only the first message of a conversation, and the first of all, come
to the join, so a passage that a third of all messages hold links each quotation once.

A passage is linked to the message of its own conversation, else of any, that said all
of it, else to the one that said most of its lines.  A message replies to the latest
earlier message of its conversation that it quotes directly (the least depth); its thread
is the first message of that chain.  Conversations are ordered by thread, then by turn,
and the position is counted in chunks, so a hot conversation is never in one task.

Defined results: a null text is empty; a message without a linked quotation begins a
thread; a message never replies to itself or a later one; ties between messages go to
the later turn for replies and to the earlier message for sources; lines of one word or
none link nothing alone; repeated rows each have a position; rows with a null
conversation or turn are ordered but not linked; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.llm.common import running_before, staged

LEAST_WORDS = 2
CHUNK_TURNS = 256
_MARKS = r"^(?:[ \t]*>)+"
# How mail programs announce a quotation.
_ANNOUNCED = r"(?i)(wrote|writes|schrieb|a écrit|escribió)\s*:\s*$"


def _quoted(line: Column) -> Column:
    return line.rlike(_MARKS)


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _hash(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def _words(text: Column) -> Column:
    return F.size(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "))


def own_text(text: Column) -> Column:
    """The text without quoted lines and the lines that announce them."""
    lines = F.split(text, "\r?\n")
    kept = F.filter(
        lines,
        lambda x, i: ~_quoted(x) & ~(x.rlike(_ANNOUNCED) & F.coalesce(_quoted(F.get(lines, i + 1)), F.lit(False))),
    )
    return F.when(text.contains(">"), F.regexp_replace(F.array_join(kept, "\n"), r"^\s+|\s+$", "")).otherwise(text)


def passages(messages: DataFrame) -> DataFrame:
    """(row_id, conv_id, turn, passage, depth, lines): runs of lines of one depth."""
    lines = messages.where(F.col("text").contains(">")).select(
        "row_id", "conv_id", "turn", F.posexplode(F.split("text", "\r?\n")).alias("no", "line")
    )
    marks = F.regexp_extract("line", _MARKS, 0)
    lines = lines.select(
        "row_id",
        "conv_id",
        "turn",
        "no",
        F.char_length(F.regexp_replace(marks, "[^>]", "")).alias("depth"),
        F.trim(F.regexp_replace("line", _MARKS, "")).alias("said"),
    )
    within = Window.partitionBy("row_id").orderBy("no")
    change = (F.col("depth") != F.coalesce(F.lag("depth").over(within), F.lit(-1))).cast("int")
    lines = lines.withColumn("change", change).withColumn("passage", F.sum("change").over(within)).where("depth > 0")
    said = F.array_sort(F.collect_list(F.struct("no", "said")))
    runs = lines.groupBy("row_id", "conv_id", "turn", "passage", "depth").agg(said.alias("said"))
    return runs.select("row_id", "conv_id", "turn", "passage", "depth", F.col("said.said").alias("lines"))


def _units(whole: Column, lines: Column) -> Column:
    """Hashes of a text (weight: its lines and one more) and of its longer lines (weight 1 each)."""
    long = F.filter(lines, lambda x: _words(x) >= LEAST_WORDS)
    each = F.transform(F.array_distinct(F.transform(long, _hash)), lambda h: F.struct(h.alias("hash"), F.lit(1).alias("weight")))
    full = F.array(F.struct(_hash(whole).alias("hash"), (F.size(long) + 1).alias("weight")))
    return F.when(normalised(whole) != "", F.concat(full, each)).otherwise(F.slice(each, 1, 0))


def links(messages: DataFrame) -> DataFrame:
    """(row_id, conv_id, turn, passage, depth, from_conv, from_turn): the source of each passage; null if none."""
    quoted = staged(passages(messages), "passages")
    asked = quoted.select(
        "row_id", "conv_id", "turn", "passage",
        F.explode(_units(F.array_join("lines", "\n"), F.col("lines"))).alias("u"),
    ).select("row_id", "conv_id", "turn", "passage", "u.hash", F.col("u.weight").alias("asked"))
    asked = staged(asked, "quoted-units")
    own = own_text(F.col("text"))
    said = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", own.alias("own"))
    said = said.select("conv_id", "turn", F.explode(_units(F.col("own"), F.split("own", "\r?\n"))).alias("u"))
    said = said.select("conv_id", "turn", "u.hash").join(asked.select("hash").distinct(), "hash", "left_semi")
    first_here = said.groupBy("conv_id", "hash").agg(F.min("turn").alias("from_turn"))
    first = said.groupBy("hash").agg(F.min(F.struct("conv_id", "turn")).alias("f"))
    first = first.select("hash", F.col("f.conv_id").alias("from_conv"), F.col("f.turn").alias("from_turn"))

    here = asked.join(first_here, ["conv_id", "hash"]).where("from_turn < turn").withColumn("from_conv", F.col("conv_id"))
    there = asked.join(first, "hash").where("from_conv <> conv_id")
    columns = ["row_id", "passage", "from_conv", "from_turn", "asked"]
    found = here.select(*columns, F.lit(1).alias("same")).unionByName(there.select(*columns, F.lit(0).alias("same")))
    found = found.groupBy("row_id", "passage", "from_conv", "from_turn", "same").agg(F.sum("asked").alias("weight"))
    best = F.max(F.struct("same", "weight", (-F.col("from_conv")).alias("c"), (-F.col("from_turn")).alias("t")))
    best = found.groupBy("row_id", "passage").agg(best.alias("b"))
    best = best.select("row_id", "passage", (-F.col("b.c")).alias("from_conv"), (-F.col("b.t")).alias("from_turn"))
    return quoted.drop("lines").join(best, ["row_id", "passage"], "left")


def _threads(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, thread, depth) for messages that reply: the chain's first turn, and its length.

    Every round doubles how far each message looks ahead, so rounds grow as the
    logarithm of the longest chain.
    """
    state = staged(replies.select("conv_id", "turn", F.col("reply_to").alias("thread"), F.lit(1).alias("depth")), "chains")
    while True:
        ahead = state.select(
            "conv_id", F.col("turn").alias("thread"), F.col("thread").alias("next"), F.col("depth").alias("more")
        )
        joined = state.join(ahead, ["conv_id", "thread"], "left")
        if joined.where("next IS NOT NULL").isEmpty():
            return state
        state = staged(
            joined.select(
                "conv_id",
                "turn",
                F.coalesce("next", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            ),
            "chains",
        )


def reply_ordered(messages: DataFrame) -> DataFrame:
    """Every message of (conv_id, turn, role, text) in its place.

    (conv_id, position, turn, role, thread, depth, reply_to, source_conv, source_turn,
    n_quoted, n_linked, text): positions count from 0; ``reply_to`` is a turn of the same
    conversation, the source the first message that a passage was taken from elsewhere.
    """
    rows = messages.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text")
    )
    rows = staged(rows.withColumn("row_id", F.monotonically_increasing_id()), "messages")
    linked = staged(links(rows), "links")
    here = F.col("from_conv") == F.col("conv_id")
    direct = F.struct((-F.col("depth")).alias("d"), F.col("from_turn").alias("t"))
    per_row = linked.groupBy("row_id").agg(
        F.count(F.lit(1)).alias("n_quoted"),
        F.count("from_turn").alias("n_linked"),
        F.max(F.when(here, direct)).alias("reply"),
        F.min(F.when(~here, F.struct("from_conv", "from_turn"))).alias("source"),
    )
    placed = rows.drop("text").join(per_row, "row_id", "left").select(
        "row_id",
        "conv_id",
        "turn",
        "role",
        F.col("reply.t").alias("reply_to"),
        F.col("source.from_conv").alias("source_conv"),
        F.col("source.from_turn").alias("source_turn"),
        F.coalesce("n_quoted", F.lit(0).cast("long")).alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
    )
    placed = staged(placed, "placed")
    replies = placed.where("reply_to IS NOT NULL").groupBy("conv_id", "turn").agg(F.max("reply_to").alias("reply_to"))
    placed = placed.join(_threads(replies), ["conv_id", "turn"], "left").withColumns(
        {"thread": F.coalesce("thread", "turn"), "depth": F.coalesce("depth", F.lit(0))}
    )
    # A null key would match nothing when counts are joined.
    keyed = placed.withColumns(
        {
            "c": F.coalesce("conv_id", F.lit(-(1 << 63))),
            "t": F.coalesce("thread", F.lit(-(1 << 63))),
            "u": F.coalesce("turn", F.lit(-(1 << 63))),
            "one": F.lit(1),
        }
    )
    keyed = keyed.withColumns({"t1": F.floor(F.col("t") / CHUNK_TURNS), "u1": F.floor(F.col("u") / CHUNK_TURNS)})
    ordered = running_before(keyed, ["c"], ["t1", "t", "u1"], ["u", "row_id"], "one")
    columns = "conv_id position turn role thread depth reply_to source_conv source_turn n_quoted n_linked text".split()
    texts = rows.select("row_id", own_text(F.col("text")).alias("text"))
    return ordered.withColumn("position", F.col("before").cast("long")).join(texts, "row_id").select(columns)
