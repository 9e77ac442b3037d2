"""Repeated passages: MinHash banding over paragraphs, exact Jaccard, components.

A document's lines are cut into paragraphs of ``LEAST_WORDS`` words or more, after
sentences that a hash of the sentence picks, so that the cuts of a passage soon agree
wherever it stands; what is left of a line after its last cut goes with the paragraph
before.  Paragraphs with equal words are one text.  Lines of fewer words are texts too,
compared by their equality only.

``tuned_bands`` chooses the bands: the fewest that reach a stated recall at the wanted
similarity, and for those the most minima a band.  For a recall of 0.99 at a Jaccard
similarity of 0.8 over five-word shingles these are 5 bands of 2 minima, with
1 - (1 - 0.8**2)**5 = 0.994; pairs that are more alike are missed less often.  Texts that
share a band are compared by their exact shingle sets, and the links' components are the
classes.  In every class the first occurrence stays; others are removed where they make up
at least ``least_run`` words in a row, so short common lines stay.  A passage that begins and
ends inside sentences may hold one short paragraph only: that counts too if, with the words
just before or just after it, ``least_run`` words in a row stand in another document.

A crowded band value is cut into tiles and each pair of tiles is compared on its own; a
comparison gives a spanning forest of its links, never all pairs.  Copies are counted
once by their text before any of this, so no group of copies is ever gathered.

Defined results: null and empty texts have no paragraphs; repeated rows are copies of each
other, as are repeats inside one document; ties go to the smaller id, then to the earlier
paragraph; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicmart.llm.common import staged
from civicmart.llm.components import components, forest

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RECALL = 0.99
LEAST_WORDS = 8
LEAST_RUN = 20
TILE_ROWS = 256
SLOTS = 1 << 20
_MOST_BANDS, _MOST_ROWS = 64, 8
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_MULTIPLIERS = np.random.default_rng(7).integers(1, 1 << 63, _MOST_BANDS * _MOST_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tuned_bands(similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[int, int]:
    """(bands, minima a band) for the wanted recall at this similarity.

    One minimum a band needs the fewest bands but meets unlike texts too: two minima are the
    least.  Of those, the fewest bands; with them, the most minima that keep the recall.
    """

    def reached(bands: int, rows: int) -> bool:
        return 1 - (1 - similarity**rows) ** bands >= recall

    bands = next(b for b in range(1, _MOST_BANDS + 1) if reached(b, 2) or b == _MOST_BANDS)
    return bands, max(r for r in range(2, _MOST_ROWS + 1) if r == 2 or reached(bands, r))


def paragraphs(text: str | None, least_words: int = LEAST_WORDS) -> Iterator[tuple[int, list[str]]]:
    """(number, words in small letters) of the paragraphs; together they hold every word."""
    number = 0
    for line in (text or "").split("\n"):
        held: list[str] = []  # cut off, but given only when more than a rest follows
        words: list[str] = []
        for sentence in _SENTENCE.split(line):
            words += sentence.lower().split()
            if len(words) >= least_words and zlib.crc32(sentence.encode()) & 1:
                if held:
                    yield number, held
                    number += 1
                held, words = words, []
        if held and len(words) >= least_words:
            yield number, held
            number, held = number + 1, []
        if held or words:
            yield number, held + words
            number += 1


def shingles(words: list[str]) -> frozenset[str]:
    return frozenset(" ".join(words[i : i + SHINGLE_WORDS]) for i in range(max(1, len(words) - SHINGLE_WORDS + 1)))


def _bands(word_hashes: np.ndarray, lengths: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A row of band values for each paragraph, from the hashes of all their words in a row.

    The number of the band is part of its value.
    """
    mixed = np.zeros(len(word_hashes), np.uint64)
    for i in range(SHINGLE_WORDS):
        shifted = word_hashes if i == 0 else np.concatenate([word_hashes[i:], np.zeros(i, np.uint64)])
        mixed = (mixed ^ shifted) * _MIX
        mixed ^= mixed >> np.uint64(29)
    # Shingles of a paragraph begin at its words, the last of them at its fifth word from the end.
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    counts = lengths - SHINGLE_WORDS + 1
    first = np.r_[0, np.cumsum(counts)[:-1]]
    at = np.repeat(starts - first, counts) + np.arange(counts.sum())
    mixed = mixed[at]
    minima = np.stack([np.minimum.reduceat(mixed * m, first) for m in _MULTIPLIERS[: bands * rows]], axis=1)
    out = np.arange(bands, dtype=np.uint64) * _MIX
    for r in range(rows):
        out = (out ^ minima[:, r::rows]) * _MIX
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def _contexts(cut: list[list[str]], least_run: int) -> Iterator[list[int] | None]:
    """For each paragraph of fewer words, hashes of the ``least_run`` words that end with it and that begin with it."""
    import xxhash

    words = [w for said in cut for w in said]
    end = 0
    for said in cut:
        start, end = end, end + len(said)
        if len(said) >= least_run:
            yield None
        else:
            sides = [(low, low + least_run) for low in (end - least_run, start) if low >= 0 and low + least_run <= len(words)]
            yield [xxhash.xxh3_64_intdigest(" ".join(words[low:high]).encode()) - (1 << 63) for low, high in sides]


def occurrences(
    docs: DataFrame,
    least_words: int = LEAST_WORDS,
    bands: int | None = None,
    rows: int | None = None,
    least_run: int = LEAST_RUN,
) -> DataFrame:
    """(row_id, doc_id, paragraph, n_words, text_id, said, contexts, bands), written once; short lines have no bands."""
    import xxhash

    if bands is None or rows is None:
        bands, rows = tuned_bands()
    # A text with bands has a shingle of whole length.
    banded = max(least_words, SHINGLE_WORDS)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low in range(0, len(batch), 512):
                part = batch.iloc[low : low + 512]
                found, words = [], []
                for row, doc, text in zip(part["row_id"], part["doc"], part["text"]):
                    numbered = list(paragraphs(text, least_words))
                    around = _contexts([said for _, said in numbered], least_run)
                    for (number, said), contexts in zip(numbered, around):
                        joined = " ".join(said)
                        text_id = xxhash.xxh3_64_intdigest(joined.encode())
                        found.append((row, doc, number, len(said), text_id, joined, contexts))
                        if len(said) >= banded:
                            words += said
                if not found:
                    continue
                out = pd.DataFrame(found, columns=["row_id", "doc", "paragraph", "n_words", "text_id", "said", "contexts"])
                out["text_id"] = out["text_id"].to_numpy(np.uint64).view(np.int64)
                lengths = out["n_words"].to_numpy()
                long = lengths >= banded
                known = {w: xxhash.xxh3_64_intdigest(w.encode()) for w in set(words)}
                hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
                banded_rows = iter(_bands(hashes, lengths[long], bands, rows) if long.any() else ())
                out["bands"] = [next(banded_rows) if has else None for has in long.tolist()]
                yield out

    # Ids go as text, because a null would turn a batch's ids into floating point numbers.
    texts = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("string").alias("doc"), "text")
    schema = "row_id long, doc string, paragraph int, n_words int, text_id long, said string, contexts array<long>, bands array<long>"
    found = texts.mapInPandas(cut, schema).withColumn("doc_id", F.col("doc").cast("long")).drop("doc")
    return staged(found, "paragraphs")


def _collisions(texts: DataFrame) -> DataFrame:
    """(value, text_id) of the band values that two or more texts share."""
    entries = texts.select("text_id", F.explode("bands").alias("value"))
    sizes = entries.groupBy("value").agg(F.min("text_id").alias("low"), F.max("text_id").alias("high"))
    shared = sizes.where("low < high").select("value")
    return staged(entries.join(shared, "value", "left_semi"), "collisions")


def _likely(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose ``text_id`` may be among ``ids``, told by one of ``SLOTS`` slots.

    Spares the exact join after it the shuffle of most rows.  At most ``SLOTS`` small
    numbers are broadcast, however many ids there are.
    """
    slot = F.pmod(F.xxhash64("text_id"), F.lit(SLOTS)).cast("int")
    slots = ids.select(slot.alias("slot")).distinct()
    return rows.join(F.broadcast(slots), slot == F.col("slot"), "left_semi")


def links(texts: DataFrame, similarity: float = SIMILARITY, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges (a, b) that connect the texts (text_id, said, bands) of at least this Jaccard similarity."""
    return _linked(_collisions(texts), texts, similarity, tile_rows)


def _linked(met: DataFrame, wording: DataFrame, similarity: float, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``links`` of texts that met in a band; ``wording`` has the words (text_id, said) of each of them."""
    key = ["value"]
    cuts = met.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("cuts"))
    placed = met.join(cuts, key).withColumn("tile", F.pmod(F.xxhash64("text_id"), F.col("cuts")).cast("int"))
    placed = placed.join(wording.select("text_id", "said"), "text_id")
    each = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    each = each.select(
        *key, F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "text_id", "said"
    )
    order = [*key, "a", "b"]
    dealt = each.repartition(*order).sortWithinPartitions(*order)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = (batch[order] == batch[order].iloc[-1]).all(axis=1)
            rest = batch[last]
            yield _compared(batch[~last], order, similarity)
        if rest is not None:
            yield _compared(rest, order, similarity)

    return dealt.mapInPandas(compare, "a long, b long")


def _compared(rows: pd.DataFrame, order: list[str], similarity: float) -> pd.DataFrame:
    out: list[tuple[int, int]] = []
    for (_, a, b), group in rows.groupby(order, sort=False):
        sets = [shingles(s.split(" ")) for s in group["said"]]
        ids, tiles = group["text_id"].tolist(), group["tile"].tolist()
        if a == b:
            pairs = combinations(range(len(ids)), 2)
        else:
            pairs = product([i for i, t in enumerate(tiles) if t == a], [i for i, t in enumerate(tiles) if t == b])
        part = list(range(len(ids)))

        def head(i: int, part: list[int] = part) -> int:
            while part[i] != i:
                part[i] = i = part[part[i]]
            return i

        for i, j in pairs:
            x, y = sets[i], sets[j]
            if min(len(x), len(y)) < similarity * max(len(x), len(y)) or head(i) == head(j):
                continue
            common = len(x & y)
            if common >= similarity * (len(x) + len(y) - common):
                part[head(j)] = head(i)
                out.append((ids[i], ids[j]))
    return pd.DataFrame(np.array(forest(out), dtype=np.int64).reshape(-1, 2), columns=["a", "b"])


def repeated_passages(
    docs: DataFrame, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS, least_run: int = LEAST_RUN, recall: float = RECALL
) -> DataFrame:
    """Paragraphs that occur again, exactly or nearly, in runs of at least ``least_run`` words.

    (row_id, doc_id, paragraph, n_words, said, first_doc_id, first_paragraph, removed, across): the
    first occurrence of the class, whether this one goes, and whether the class occurs in more
    than one row.  Lines of fewer than ``least_words`` words are compared by equality;
    ``recall`` is that of the bands at ``similarity``.
    """
    found = occurrences(docs, least_words, *tuned_bands(similarity, recall), least_run)
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_id", "paragraph")
    texts = found.groupBy("text_id").agg(
        F.min(place).alias("first"),
        F.count(F.lit(1)).alias("n"),
        (F.min("row_id") < F.max("row_id")).alias("across"),
        F.first("bands").alias("bands"),
    )
    texts = staged(texts, "texts")
    met = _collisions(texts)
    ids = staged(met.select("text_id").distinct(), "met")
    # Words move once, from the first occurrence of a text and only if the text met another.
    spoken = _likely(texts.drop("bands"), ids).join(ids, "text_id", "left_semi")
    spoken = staged(spoken, "spoken")
    places = spoken.select("text_id", "first.row_id", "first.paragraph")
    wording = _likely(found, ids).select("text_id", "row_id", "paragraph", "said").join(places, ["text_id", "row_id", "paragraph"])
    parts = components(_linked(met, wording, similarity)).select(F.col("node").alias("text_id"), "component")
    # Texts that occur again as they are, and those that met a near copy.
    columns = ["text_id", "first", "n", "across"]
    again = texts.where("n > 1").select(columns).union(spoken.where("n = 1").select(columns))
    classed = again.join(parts, "text_id", "left").where("n > 1 OR component IS NOT NULL")
    classed = staged(classed.select("text_id", "first", "across", F.coalesce("component", "text_id").alias("component")), "classes")
    many = F.max("across") | (F.min("first.row_id") < F.max("first.row_id"))
    heads = classed.drop("across").join(classed.groupBy("component").agg(F.min("first").alias("head"), many.alias("across")), "component")
    classed = staged(heads.select("text_id", "head", "across"), "heads")
    occurring = _likely(found, classed).select("row_id", "doc_id", "paragraph", "n_words", "said", "contexts", "text_id")
    occurring = occurring.join(classed, "text_id")
    by_place = Window.partitionBy("row_id").orderBy("paragraph")
    occurring = occurring.withColumn("run", F.col("paragraph") - F.row_number().over(by_place))
    occurring = occurring.withColumn("run_words", F.sum("n_words").over(Window.partitionBy("row_id", "run")))
    is_first = (F.col("head.row_id") == F.col("row_id")) & (F.col("head.paragraph") == F.col("paragraph"))
    # Too short a run, but part of a repeated stretch of words that is long enough.
    around = occurring.where(F.col("run_words") < least_run).select("row_id", "paragraph", F.explode("contexts").alias("context"))
    shared = around.groupBy("context").agg(F.min("row_id").alias("low"), F.max("row_id").alias("high"))
    part = staged(
        around.join(shared.where("low < high").select("context"), "context", "left_semi").select("row_id", "paragraph").distinct(),
        "stretches",
    )
    occurring = occurring.join(part.withColumn("stretch", F.lit(True)), ["row_id", "paragraph"], "left")
    return occurring.where((F.col("run_words") >= least_run) | F.col("stretch")).select(
        "row_id",
        "doc_id",
        "paragraph",
        "n_words",
        "said",
        F.col("head.doc_id").alias("first_doc_id"),
        F.col("head.paragraph").alias("first_paragraph"),
        (~is_first).alias("removed"),
        "across",
    )
