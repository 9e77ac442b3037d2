"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

An item is cut into windows of ``window`` consecutive words; an item with fewer words is
one window.  A window's shingles of five words (all its words, if it has fewer) are its
set.  A document holds a window only if it holds every shingle of it, so one shingle, the
rarest in the corpus, is the prefix that has to be joined; a window with a shingle that no
document has is dropped at once.  Occurrences are joined with windows on that shingle;
the length and positional bounds ask that the window fits in the document around it; then
the words of the occurrence and of the window are compared one by one.

Documents are read once.  A bit set of the benchmark's shingles of a fixed size, sent to
all tasks, keeps nearly all other positions of the corpus from being exploded; it only
skips work, every decision is made by the joins.  The positions that are left go with the
words around them to the shared folder, so texts are never shuffled or read again.

Defined results: a null or wordless text has no words and no hits; repeated documents each
give a row; repeated items count by their ids; an item with a null id marks words but is
not counted as an item; an empty benchmark marks nothing; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicmart.llm.common import ascii_lower, shielded, staged

WINDOW_WORDS = 13
SHINGLE_WORDS = 5
# Fixed value: everything but digits, small letters and what is not ASCII parts words.
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SLOTS_PER_SHINGLE = 64
_FEWEST_SLOTS, _MOST_SLOTS = 1 << 16, 1 << 26


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BREAKS), "")


def item_windows(benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """(window_id, item_id, words): one row per item and distinct window of it."""
    words = benchmark.select("item_id", words_of(F.col("text")).alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - window + 1, F.lit(1)))
    return (
        words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("all", i, window))).alias("words"))
        .distinct()
        .select(F.sha2(F.concat_ws(" ", "words"), 256).alias("window_id"), "item_id", "words")
    )


def window_shingles(windows: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """(window_id, words, size, place, shingle): every shingle of every distinct window."""
    distinct = windows.select("window_id", "words").distinct().withColumn("size", F.size("words"))
    places = F.sequence(F.lit(1), F.greatest(F.col("size") - width + 1, F.lit(1)))
    return distinct.withColumn("place", F.explode(places)).withColumn(
        "shingle", F.xxhash64(F.slice("words", F.col("place"), width))
    )


def _slots(shingle: Column, slots: int) -> tuple[Column, Column]:
    """Two bits of a shingle in the bit set."""
    return shingle.bitwiseAND(slots - 1), F.shiftrightunsigned(shingle, 32).bitwiseAND(slots - 1)


def _bit_set(shingles: DataFrame, slots: int) -> Column:
    """An array of ``slots / 64`` longs with the bits of all shingles, as a scalar subquery."""
    first, second = _slots(F.col("shingle"), slots)
    cells = (
        shingles.select(F.explode(F.array(first, second)).alias("slot"))
        .distinct()
        .groupBy(F.shiftright("slot", 6).alias("cell"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("bits"))
    )
    every = shingles.sparkSession.range(slots // 64).select(F.col("id").alias("cell"))
    dense = every.join(cells, "cell", "left").select("cell", F.coalesce("bits", F.lit(0)).alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("cell", "bits")))
    return dense.agg(ordered.alias("c")).select(F.col("c.bits")).scalar()


def marked_positions(
    docs: DataFrame, shingles: DataFrame, window: int = WINDOW_WORDS, width: int = SHINGLE_WORDS
) -> DataFrame:
    """(doc_id, text_hash, n_words, at, shingle, from, around), in one pass over the texts.

    A row with ``at`` 0 stands for the document; the others say where it may hold a shingle
    and which words are around.
    """
    count = shingles.select("shingle").distinct().count()
    slots = _FEWEST_SLOTS
    while slots < min(_MOST_SLOTS, count * _SLOTS_PER_SHINGLE):
        slots *= 2
    # At most ``width`` lengths: windows shorter than a shingle are shingles themselves.
    lengths = sorted(r[0] for r in shingles.select(F.least("size", F.lit(width))).distinct().collect())
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    last = F.size("words") if lengths else F.lit(0)
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    rows = rows.withColumn("length", F.explode(F.array(*map(F.lit, lengths))) if len(lengths) > 1 else F.lit((lengths or [1])[0]))

    at, length, n_words = F.col("at"), F.col("length"), F.size("words")
    shingle = F.xxhash64(F.slice("words", F.greatest(at, F.lit(1)), length))
    wanted = (at == 0) & (length == (lengths or [1])[0])
    if lengths:
        bit_set = _bit_set(shingles, slots)
        wanted |= (at >= 1) & (at + length - 1 <= n_words)
        for slot in _slots(shingle, slots):
            cell, bit = F.shiftright(slot, 6).cast("int"), slot.bitwiseAND(63).cast("int")
            wanted &= (at == 0) | (F.getbit(F.get(bit_set, cell), bit) == 1)
    start = F.greatest(at - (window - length), F.lit(1))
    around = F.slice("words", start, at - start + length + (window - length))
    return rows.where(wanted).select(
        "doc_id",
        "text_hash",
        n_words.cast("long").alias("n_words"),
        "at",
        shingle.alias("shingle"),
        start.alias("from"),
        F.when(at > 0, around).alias("around"),
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, width: int = SHINGLE_WORDS
) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, n_items, item_ids) for every row of (doc_id, text).

    A word is hit if it lies in an occurrence of a window of the benchmark.
    """
    windows = staged(item_windows(benchmark, window), "windows")
    shingles = staged(window_shingles(windows, width), "window-shingles")
    marked = staged(marked_positions(docs, shingles, window, width), "marked")
    # Equal ids with equal texts have equal hits, so this pair is key enough for repeated rows.
    key = ["id", "text_hash"]
    marks = marked.where("at > 0").withColumn("id", F.coalesce("doc_id", F.lit(0)))

    # Rarity over all documents; a shingle that never occurs rules its windows out.
    counts = marks.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    counted = shingles.join(counts, "shingle", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = F.min(F.struct("n", "place", "shingle")).alias("prefix")
    prefixes = counted.groupBy("window_id", "words", "size").agg(rarest).where("prefix.n > 0")
    prefixes = prefixes.select("window_id", "words", "size", "prefix.place", "prefix.shingle")

    start = F.col("at") - F.col("place") + 1
    fits = (start >= 1) & (start + F.col("size") - 1 <= F.col("n_words"))
    same = F.slice("around", F.greatest(start - F.col("from") + 1, F.lit(1)), F.col("size")) == F.col("words")
    held = (
        marks.join(prefixes, "shingle")
        .where(fits)
        .where(same)
        .select(*key, "window_id", start.alias("start"), "size")
    )
    held = staged(held, "held")

    spans = F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end"))).alias("spans")
    n_hit = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["end"] - F.greatest(s["start"], acc["to"]), F.lit(0))).alias("n"),
            F.greatest(acc["to"], s["end"]).alias("to"),
        ),
        lambda acc: acc["n"],
    )
    covered = held.groupBy(key).agg(spans).select(*key, n_hit.alias("n_hit"))
    items = (
        held.select(*key, "window_id")
        .distinct()
        .join(windows.select("window_id", F.col("item_id").cast("string").alias("item")), "window_id")
        .groupBy(key)
        .agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    )
    rows = marked.where("at = 0").select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash", "n_words")
    return (
        rows.join(covered.join(items, key, "left"), key, "left")
        .withColumns(
            {
                "n_hit": F.coalesce("n_hit", F.lit(0).cast("long")),
                "item_ids": F.coalesce("item_ids", F.array().cast("array<string>")),
            }
        )
        .select("doc_id", "text_hash", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), "item_ids")
    )


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least a twentieth of the words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


@shielded("doc_id", "text")
def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    found = contamination(docs, benchmark).where(is_contaminated(F.col("n_hit"), F.col("n_words")))
    bad = found.select(F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    keyed = docs.withColumns({"__id": F.coalesce("doc_id", F.lit(0)), "__hash": F.xxhash64("text")})
    return keyed.join(bad, ["__id", "__hash"], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
