"""Mixture-controlled packing of documents into sequences of a fixed length.

Every source is a queue of documents in the order of a hash.  Deficit round-robin serves
the queues: each round adds to a source's deficit its share of one window, and the source
gives tokens while its deficit covers the rest of its head document or at least
``LEAST_PIECE`` tokens.  Windows therefore hold the target token proportions up to the
deficits, which are carried from window to window.

The work is cut into shards that take from every queue its share of ``SHARD_TOKENS``.
Where a queue stands at a shard's start follows from prefix sums, so shards run
independently: the deficit that a shard inherits is what the queue was due by then less
what the earlier shards took.  Shards' places in the stream are prefix sums too, and
windows are cut from the stream without regard to shards.  The last window's rest is cut
into lengths that are powers of two, so no sequence needs padding.

Prefix sums are taken over groups of chunks, chunks and within chunks of about
``CHUNK_ROWS`` documents, so a hot source is never in one task.

Defined results: a null text is empty and gives only the end token; a null source is a
queue of its own together with ''; repeated rows are packed each; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import gc
import math
import re
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.llm.common import held, running_before, staged
from civicmart.llm.pieces import PieceTokens, batched

SEQUENCE_TOKENS = 4096
END_TOKEN = 2
LEAST_PIECE = 512
SHARD_TOKENS = 1 << 20
CHUNK_ROWS = 256
SHARDS_PER_BLOCK = 4096
_CLOSE = 1e-6
WORDS_KEPT = 200_000
RUNS_KEPT = 200_000
_PIECE_BYTES = 8 << 20  # of pieces given out at once, as a batch of long documents is large


# ---- tokens ------------------------------------------------------------------------------


class WordTokens:
    """Token ids of texts, each distinct word of a batch looked up or tokenized once.

    The vocabulary drops white space and never merges across it, and splits words into
    runs of letters, single digits and runs of other signs.  So a text's ids are those
    of its words, and a word's those of its runs.  Runs of plain Latin letters are sent to
    the tokenizer many at a time without its slow text clean-up, which changes nothing
    there; texts with other letters go to the whole tokenizer.
    """

    _LETTERS = "a-zß-öø-ÿĀ-ſªºµ"
    _RUNS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")
    # Latin letters, digits and the signs of ASCII; of white space only what is split on.
    _PLAIN = re.compile(r"[\t\n\x20-\x7e¡-©«¬®-±´¶-¸»¿-ķĺ-ňŊ-ž]*")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.whole.get_vocab()
        self.width = "<u2" if max(vocabulary.values()) < 1 << 16 else "<u4"
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        nothing = {"": np.zeros(0, self.width)}
        self.runs = PieceTokens(self._tokenized, RUNS_KEPT, nothing)
        self.words = PieceTokens(self._cut, WORDS_KEPT, nothing)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned numbers of ``width``."""
        return [ids for part in batched(texts) for ids in self._encoded(part)]

    def _encoded(self, texts: list[str]) -> Iterator[bytes]:
        cleaned = [self._cleaned(t) for t in texts]
        split = pc.split_pattern(pa.array([t for t in cleaned if t is not None], pa.string()), " ")
        ids, counts = self.words.encode(split.flatten())
        data, size = ids.tobytes(), ids.itemsize
        ends = iter((np.r_[0, np.cumsum(counts)][split.offsets.to_numpy()] * size).tolist())
        low = next(ends)
        for text, clean in zip(texts, cleaned):
            if clean is None:
                yield np.array(self.whole.encode(text, add_special_tokens=False).ids, self.width).tobytes()
            else:
                high = next(ends)
                yield data[low:high]
                low = high

    def _cleaned(self, text: str) -> str | None:
        """The text in small letters with spaces as its only white space; None if it has other signs than plain ones."""
        if "<|" in text or not self._PLAIN.fullmatch(text) or not unicodedata.is_normalized("NFC", text):
            return None
        return text.lower().replace("\n", " ").replace("\t", " ")

    def _cut(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = [(w,) if w.isalpha() else self._RUNS.findall(w) for w in words]
        ids, counts = self.runs.encode(pa.array(list(chain.from_iterable(cut)), pa.string()))
        # Where the ids of each word end, by the number of its runs.
        ends = np.r_[0, np.cumsum(counts)][np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))]
        return ids, np.diff(ends, prepend=0)

    def _tokenized(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.bare.encode_batch_fast([" ".join(runs)], add_special_tokens=False)[0].ids, self.width)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(runs):
            raise ValueError("a run of signs gave more or less than one last token")
        return ids, np.diff(ends, prepend=0)


def word_tokens(path: str) -> WordTokens:
    """One per Python worker, until another step's task needs the memory."""
    return held((WordTokens, path), lambda: WordTokens(path))


def tokenized(docs: DataFrame, tokenizer_path: str, end_token: int = END_TOKEN) -> DataFrame:
    """(row_id, doc_id, source, doc_tokens, ids binary), written once; ids hold the end token."""

    @F.pandas_udf("binary")
    def ids(texts: pd.Series) -> pd.Series:
        tokens = word_tokens(tokenizer_path)
        end = np.array([end_token], tokens.width).tobytes()
        gc.disable()  # the cache holds no cycles, and walking it for each batch is slow
        try:
            out = [x + end for x in tokens.encode(texts.fillna("").tolist())]
        finally:
            gc.enable()
        return pd.Series(out, dtype=object)

    width = np.dtype(WordTokens(tokenizer_path).width).itemsize
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), ids("text").alias("ids"))
    rows = rows.withColumn("doc_tokens", (F.octet_length("ids") / width).cast("long"))
    return staged(rows.withColumn("row_id", F.monotonically_increasing_id()), "tokens")


# ---- the stream --------------------------------------------------------------------------


def queue_positions(rows: DataFrame) -> DataFrame:
    """(row_id, source, n, before): where each document stands in its source's queue."""
    bits = max(0, math.ceil(math.log2(max(1, rows.count()) / CHUNK_ROWS)))
    narrow = rows.select("row_id", "doc_id", "source", F.col("doc_tokens").alias("n")).withColumn(
        "h", F.xxhash64("doc_id", "n", "row_id")
    )
    # The hash as an unsigned number gives the order; its upper bits are the chunk.
    narrow = narrow.withColumns(
        {
            "h": F.col("h").bitwiseXOR(F.lit(-(1 << 63))),
            "chunk": F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long"),
        }
    )
    narrow = narrow.withColumn("chunks", F.shiftright("chunk", bits // 2))
    queued = running_before(narrow, ["source"], ["chunks", "chunk"], ["h", "doc_id", "row_id"], "n")
    return queued.select("row_id", "source", "n", "before")


def shares(rows: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """(source, share): the target token proportions; without targets those of the corpus.

    Sources that are not in ``targets`` have the weight of their own tokens.
    """
    totals = rows.groupBy("source").agg(F.sum("doc_tokens").cast("double").alias("weight"))
    if targets:
        given = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
        all_tokens = totals.agg(F.sum("weight")).first()[0] or 1.0
        totals = totals.select("source", F.coalesce(given[F.col("source")], F.col("weight") / all_tokens).alias("weight"))
    whole = totals.agg(F.sum("weight")).first()[0] or 1.0
    return staged(totals.select("source", (F.col("weight") / whole).alias("share")), "shares")


def _due(rest: int) -> int:
    return min(rest, LEAST_PIECE)


def serve(
    shard: int,
    source: np.ndarray,
    row: np.ndarray,
    n: np.ndarray,
    before: np.ndarray,
    quota: np.ndarray,
    window: int,
    shard_tokens: int,
) -> pd.DataFrame:
    """Deficit round-robin over one shard's queues: pieces in the order of the stream."""
    names, code = np.unique(source.astype(str), return_inverse=True)
    order = np.lexsort((row, before, code))
    bounds = np.searchsorted(code[order], np.arange(len(names) + 1))
    queues, deficit, quantum = [], [], []
    for k in range(len(names)):
        at = order[bounds[k] : bounds[k + 1]]
        queues.append(deque(zip(row[at].tolist(), n[at].tolist())))
        deficit.append(shard * float(quota[at[0]]) - float(before[at[0]]))
        quantum.append(float(quota[at[0]]) * window / shard_tokens)
    given = [0] * len(names)  # tokens of the head document that were served
    pieces, place = [], 0
    waiting = [k for k in range(len(names)) if queues[k]]
    while waiting:
        # Rounds in which nobody's deficit suffices are taken at once.
        lacking = ((_due(queues[k][0][1] - given[k]) - deficit[k]) / quantum[k] for k in waiting)
        rounds = max(1, math.ceil(min(lacking) - _CLOSE))
        for k in waiting:
            deficit[k] += rounds * quantum[k]
            while queues[k]:
                head, size = queues[k][0]
                rest = size - given[k]
                if deficit[k] < _due(rest) - _CLOSE * (1 + quantum[k]):
                    break
                take = min(rest, max(_due(rest), int(deficit[k])))
                pieces.append((head, given[k], take, place))
                place += take
                deficit[k] -= take
                given[k] += take
                if given[k] == size:
                    queues[k].popleft()
                    given[k] = 0
        waiting = [k for k in waiting if queues[k]]
    return pd.DataFrame(pieces, columns=["row_id", "start", "length", "place"])


def pieces(rows: DataFrame, shared: DataFrame, window: int, shard_tokens: int) -> DataFrame:
    """(row_id, start, length, at): runs of a document's tokens and their place in the stream."""
    queued = queue_positions(rows).join(shared, "source")
    queued = queued.withColumn("quota", F.col("share") * shard_tokens)
    queued = staged(queued.withColumn("shard", F.floor(F.col("before") / F.col("quota")).cast("long")), "queues")

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        columns = [part[c].to_numpy() for c in ("source", "row_id", "n", "before", "quota")]
        out = serve(int(key[0]), *columns, window, shard_tokens)
        out.insert(0, "shard", key[0])
        return out

    served = queued.select("shard", "source", "row_id", "n", "before", "quota").groupBy("shard").applyInPandas(
        run, "shard long, row_id long, start long, length long, place long"
    )
    starts = queued.groupBy("shard").agg(F.sum("n").alias("n"))
    starts = starts.withColumns({"block": F.floor(F.col("shard") / SHARDS_PER_BLOCK), "all": F.lit(0)})
    starts = running_before(starts, ["all"], ["block"], ["shard"], "n").select("shard", F.col("before").alias("base"))
    return served.join(starts, "shard").select("row_id", "start", "length", (F.col("base") + F.col("place")).alias("at"))


# ---- sequences ---------------------------------------------------------------------------


def tail_lengths(total: int, window: int) -> list[int]:
    """Powers of two that sum to what is left after the whole windows, largest first."""
    rest = total % window
    return [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    targets: dict[str, float] | None = None,
    window: int = SEQUENCE_TOKENS,
    shard_tokens: int = SHARD_TOKENS,
    end_token: int = END_TOKEN,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids) of every piece."""
    rows = tokenized(docs, tokenizer_path, end_token)
    total = int(rows.agg(F.sum("doc_tokens")).first()[0] or 0)
    runs = pieces(rows, shares(rows, targets), window, shard_tokens)
    # The runs of one document are as many as its own tokens give.
    by_row = runs.groupBy("row_id").agg(F.collect_list(F.struct("start", "length", "at")).alias("runs"))
    width = WordTokens(tokenizer_path).width
    lengths = tail_lengths(total, window)
    full = total // window * window
    cuts = np.cumsum([full, *lengths])[:-1] if lengths else np.array([full])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = np.dtype(width).itemsize
        columns = "doc_id start length ids_crc32 doc_tokens sequence_id offset ids".split()
        for batch in batches:
            out, held = [], 0
            for row in batch.itertuples(index=False):
                if held >= _PIECE_BYTES:
                    yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})
                    out, held = [], 0
                for run in row.runs:
                    start, at, end = run["start"], run["at"], run["at"] + run["length"]
                    while at < end:
                        if at < full:
                            sequence, low = at // window, at // window * window
                            high = low + window
                        else:
                            k = int(np.searchsorted(cuts, at, side="right")) - 1
                            sequence, low = full // window + k, int(cuts[k])
                            high = low + lengths[k]
                        n = min(end, high) - at
                        piece = np.frombuffer(row.ids[start * size : (start + n) * size], width).astype("<u4").tobytes()
                        out.append((None if row.unknown else row.doc_id, start, n, zlib.crc32(piece), row.doc_tokens, sequence, at - low, piece))
                        start, at, held = start + n, at + n, held + len(piece)
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    # A null id would turn a batch's ids into floating point numbers.
    known = F.coalesce("doc_id", F.lit(0)).alias("doc_id")
    unknown = F.col("doc_id").isNull().alias("unknown")
    joined = rows.select("row_id", known, unknown, "doc_tokens", "ids").join(by_row, "row_id")
    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    )
    return joined.select("doc_id", "unknown", "doc_tokens", "ids", "runs").mapInPandas(cut, schema)
