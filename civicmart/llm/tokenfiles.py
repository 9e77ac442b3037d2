"""Token ids in binary files with directly addressable codes.

A file holds the ids of a run of documents.  Every id is split into chunks of
``CHUNK_BITS`` bits, lowest first, and level l holds the l-th chunk of the ids that have
one.  Beside the chunks of a level lies a bitmap that says which ids go on to the next
level, and a rank directory: the number of set bits before every ``RANK_BITS`` bits.  So
any id is read by one chunk, one directory entry and a few bitmap words for each level;
nothing else is unpacked (``TokenFile.token``, ``tokens_at``).  A document directory
holds the documents' ids and starts.

Layout, all numbers little-endian and unsigned if not said otherwise: magic, format
version, chunk bits, number of levels, tokens and documents; for each level the chunks,
the bitmap in 64-bit words (not for the last level) and the directory; document ids
(signed), a null flag for each, starts; size of the whole file; magic.

Documents are range-partitioned by id and written in ascending order, files in the order
of their tasks.  File names carry the task attempt; only files named in the committed index
count, so a repeated or speculative task leaves unused files behind, never wrong ones.

Defined results: a null text is empty and has the end token only; a null id is the
smallest and read back as null; rows of one id follow each other by a hash of their text;
repeated rows are written each; an empty table gives an empty index and no file; a
document longer than a file gets a file of its own; further columns are ignored.
"""

from __future__ import annotations

import gc
import struct
import uuid
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicmart.llm.common import create_file, held, open_file, qualified, running_before, staged
from civicmart.llm.pieces import PieceTokens, batched
from civicmart.session import scratch_dir

END_TOKEN = 0
CHUNK_BITS = 8
RANK_BITS = 512
FILE_TOKENS = 1 << 24
CHUNKS_KEPT = 300_000
_TEXTS = 512

_MAGIC = b"TOKENDAC"
_HEAD = struct.Struct("<8sHHIQQ")
_VERSION = 1
_DTYPES = {8: np.dtype("<u1"), 16: np.dtype("<u2")}

_INDEX = "part long, number long, name string, n_tokens long, n_docs long"


# ---- tokens ------------------------------------------------------------------------------


class ChunkTokens:
    """Token ids of texts by a byte-level vocabulary, each distinct stretch of a batch tokenized once.

    The vocabulary's splitting never joins what stands before a space or line end with
    what follows.  So a text is cut there, and its ids are those of its stretches.  Stretches
    that are not known are tokenized many at a time; a token that begins with a space or
    is a line end begins a stretch.  Texts with other white space, with long runs of it or
    with special tokens go to the tokenizer whole.
    """

    # White space other than the space and the line end.
    _ODD = "\t\r\x0b\x0c\x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))
    _RUNS = tuple(a + b + c for a in " \n" for b in " \n" for c in " \n")
    _ENDS = tuple(a + b for a in " \n" for b in " \n")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        vocabulary = self.whole.get_vocab()
        self.width = "<u2" if max(vocabulary.values()) < 1 << 16 else "<u4"
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for t, i in vocabulary.items() if t[0] == "Ġ" or t == "Ċ"]] = True
        self.special = [str(t.content) for t in self.whole.get_added_tokens_decoder().values()]
        # Stretches without a sign after the space or the line end; they never need tokenizing.
        fixed = {"": self._ids(" "), "\n": self._ids("\n")}
        self.newline = len(fixed["\n"])
        self.chunks = PieceTokens(self._tokenized, CHUNKS_KEPT, fixed)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.whole.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.width)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned numbers of ``width``."""
        return [ids for part in batched(texts) for ids in self._encoded(part)]

    def _encoded(self, texts: list[str]) -> Iterator[bytes]:
        plain = self._plain(texts)
        # The sign before the text makes its first stretch one that follows a line end.
        marked = ["\n" + t.replace("\n", " \n") for t in compress(texts, plain)]
        split = pc.split_pattern(pa.array(marked, pa.string()), " ")
        ids, counts = self.chunks.encode(split.flatten())
        data, size = ids.tobytes(), ids.itemsize
        ends = iter((np.r_[0, np.cumsum(counts)][split.offsets.to_numpy()] * size).tolist())
        low = next(ends)
        for text, ok in zip(texts, plain):
            if ok:
                high = next(ends)
                yield data[low + self.newline * size : high]
                low = high
            else:
                yield self._ids(text).tobytes()

    def _plain(self, texts: list[str]) -> list[bool]:
        joined = "|".join(texts)
        unusual = [s for s in (*self._ODD, *self._RUNS, *self.special) if s in joined]
        return [not t.endswith(self._ENDS) and not any(s in t for s in unusual) for t in texts]

    def _tokenized(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self._ids("".join([c if c[0] == "\n" else " " + c for c in chunks]))
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) != len(chunks):
            raise ValueError("a stretch of text gave more or less than one first token")
        return ids, np.diff(starts, append=len(ids))


def chunk_tokens(path: str) -> ChunkTokens:
    """One per Python worker, until another step's task needs the memory."""
    return held((ChunkTokens, path), lambda: ChunkTokens(path))


# ---- one file ----------------------------------------------------------------------------


def packed(ids: np.ndarray, docs: list[int | None], counts: np.ndarray, chunk_bits: int = CHUNK_BITS) -> Iterator[bytes]:
    """The bytes of a file, in parts: ``ids`` of all ``docs`` in a row, ``counts`` ids for each."""
    kind = _DTYPES[chunk_bits]
    levels = max(1, -(-int(ids.max(initial=0)).bit_length() // chunk_bits))
    size = 0

    def counted(part: bytes) -> bytes:
        nonlocal size
        size += len(part)
        return part

    yield counted(_HEAD.pack(_MAGIC, _VERSION, chunk_bits, levels, len(ids), len(docs)))
    rest = ids.astype("<u4")
    for level in range(levels):
        yield counted((rest & ((1 << chunk_bits) - 1)).astype(kind).tobytes())
        if level == levels - 1:
            break
        rest >>= chunk_bits
        goes_on = rest > 0
        blocks = -(-len(rest) // RANK_BITS)
        bits = np.zeros(blocks * RANK_BITS, bool)
        bits[: len(rest)] = goes_on
        yield counted(np.packbits(bits, bitorder="little").tobytes())
        ones = bits.reshape(blocks, RANK_BITS).sum(axis=1)
        yield counted(np.concatenate([[0], np.cumsum(ones)]).astype("<u8").tobytes())
        rest = rest[goes_on]
    yield counted(np.array([d or 0 for d in docs], "<i8").tobytes())
    yield counted(np.array([d is None for d in docs], "<u1").tobytes())
    yield counted(np.concatenate([[0], np.cumsum(counts)]).astype("<u8").tobytes())
    yield struct.pack("<Q", size + 16) + _MAGIC


class TokenFile:
    """An open file: whole documents, or single tokens without unpacking others."""

    def __init__(self, file):
        self.file = file
        head = file.read_at(_HEAD.size, 0) if file.size() >= _HEAD.size + 16 else b""
        tail = file.read_at(16, file.size() - 16) if head else b""
        if head[:8] != _MAGIC or tail[8:] != _MAGIC or struct.unpack("<Q", tail[:8])[0] != file.size():
            raise ValueError("not a whole token file")
        _, version, self.bits, self.n_levels, self.n_tokens, self.n_docs = _HEAD.unpack(head)
        if version != _VERSION or self.bits not in _DTYPES:
            raise ValueError(f"unknown version {version} or chunk size {self.bits}")
        self.kind = _DTYPES[self.bits]
        # (place of the chunks, of the bitmap, of the directory, number of chunks) of each level
        self.levels: list[tuple[int, int, int, int]] = []
        at, n = _HEAD.size, self.n_tokens
        for level in range(self.n_levels):
            bitmap = at + n * self.kind.itemsize
            if level == self.n_levels - 1:
                self.levels.append((at, bitmap, bitmap, n))
                at = bitmap
                break
            blocks = -(-n // RANK_BITS)
            directory = bitmap + blocks * RANK_BITS // 8
            self.levels.append((at, bitmap, directory, n))
            at = directory + 8 * (blocks + 1)
            n = int(np.frombuffer(file.read_at(8, at - 8), "<u8")[0])
        self.docs_at = at

    def token(self, i: int) -> int:
        """The i-th id of the file: a chunk, a directory entry and at most one block of bits a level."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        out = 0
        for level, (chunks, bitmap, directory, _) in enumerate(self.levels):
            chunk = np.frombuffer(self.file.read_at(self.kind.itemsize, chunks + i * self.kind.itemsize), self.kind)[0]
            out |= int(chunk) << (level * self.bits)
            if level == self.n_levels - 1:
                break
            block, inside = divmod(i, RANK_BITS)
            words = self.file.read_at(inside // 8 + 1, bitmap + block * RANK_BITS // 8)
            before = int.from_bytes(words, "little") & ((1 << inside + 1) - 1)
            if not before >> inside & 1:
                break
            i = int(np.frombuffer(self.file.read_at(8, directory + 8 * block), "<u8")[0]) + before.bit_count() - 1
        return out

    def ids(self) -> np.ndarray:
        """All ids in a row."""
        deeper = None
        for chunks, bitmap, directory, n in reversed(self.levels):
            out = np.frombuffer(self.file.read_at(n * self.kind.itemsize, chunks), self.kind).astype("<u4")
            if deeper is not None:
                bits = np.frombuffer(self.file.read_at(directory - bitmap, bitmap), np.uint8)
                goes_on = np.unpackbits(bits, bitorder="little", count=n).view(bool)
                out[goes_on] |= deeper << self.bits
            deeper = out
        return deeper

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """The documents' ids, and where each starts, with the end of the last."""
        at, n = self.docs_at, self.n_docs
        keys = np.frombuffer(self.file.read_at(8 * n, at), "<i8").tolist()
        nulls = self.file.read_at(n, at + 8 * n)
        starts = np.frombuffer(self.file.read_at(8 * (n + 1), at + 9 * n), "<u8").astype(np.int64)
        return [None if null else key for key, null in zip(keys, nulls)], starts


# ---- files of a table --------------------------------------------------------------------


def write_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str | None = None,
    end_token: int = END_TOKEN,
    file_tokens: int = FILE_TOKENS,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """Write the texts of ``docs`` as token files; return the index, one row per file.

    (part, number, name, n_tokens, n_docs, base): files in the order of part and number
    hold the documents in ascending order, ``base`` is the number of tokens before.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder or scratch_dir(spark, "tokens"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        tokens = chunk_tokens(tokenizer_path)
        end = np.array([end_token], tokens.width).tobytes()
        keys: list[int | None] = []
        coded: list[bytes] = []
        files, waiting = 0, 0

        def closed() -> pa.RecordBatch:
            nonlocal files, waiting
            name = f"{folder}/tokens-{context.partitionId()}-{files}-{uuid.uuid4().hex}.bin"
            ids = np.frombuffer(b"".join(coded), tokens.width)
            counts = np.fromiter(map(len, coded), np.int64, len(coded)) // ids.itemsize
            with create_file(name) as file:
                for part in packed(ids, keys, counts, chunk_bits):
                    file.write(part)
            row = {"part": context.partitionId(), "number": files, "name": name, "n_tokens": len(ids), "n_docs": len(keys)}
            files, waiting = files + 1, 0
            keys.clear()
            coded.clear()
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for low in range(0, len(ids), _TEXTS):
                gc.disable()  # the cache holds no cycles, and walking it for each batch is slow
                try:
                    out = tokens.encode([t or "" for t in texts[low : low + _TEXTS]])
                finally:
                    gc.enable()
                for key, one in zip(ids[low : low + _TEXTS], out):
                    if coded and waiting + len(one) // len(end) + 1 > file_tokens:
                        yield closed()
                    keys.append(key)
                    coded.append(one + end)
                    waiting += len(one) // len(end) + 1
        if coded:
            yield closed()

    schema = pa.schema([("part", "int64"), ("number", "int64"), ("name", "string"), ("n_tokens", "int64"), ("n_docs", "int64")])
    # The row number only spreads repeated rows; its value does not show.
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("h"),
        F.monotonically_increasing_id().alias("row"),
        "text",
    )
    ordered = rows.repartitionByRange("doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "row")
    index = staged(ordered.select("doc_id", "text").mapInArrow(write, _INDEX), "token-index")
    numbered = index.withColumns({"all": F.lit(0), "block": F.floor(F.col("part") / 1024)})
    based = running_before(numbered, ["all"], ["block"], ["part", "number"], "n_tokens")
    return based.select(*index.columns, F.col("before").alias("base"))


def _by_file(index: DataFrame) -> DataFrame:
    """The index with one file a partition; a count that is stated, as AQE sees only short rows."""
    return index.repartitionByRange(max(1, index.count()), "base", "name")


def read_documents(index: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) of every document, from the files alone.

    ``start`` counts the tokens of all documents before; ids are 32-bit unsigned numbers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(row["name"]) as file:
                    opened = TokenFile(file)
                    ids, (keys, starts) = opened.ids(), opened.documents()
                for low in range(0, len(keys), _TEXTS):
                    here = keys[low : low + _TEXTS]
                    cuts = starts[low : low + len(here) + 1]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(here, pa.int64()),
                            pa.array(row["base"] + cuts[:-1]),
                            pa.array(np.diff(cuts)),
                            pa.array([ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    files = _by_file(index.select("name", "base"))
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def with_crc32(documents: DataFrame) -> DataFrame:
    """The documents with ``ids_crc32`` of their ids in place of the ids."""
    return documents.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def tokens_at(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """(position, token) for every ``position`` of ``wanted`` that exists, by random access.

    Positions count over all files.  Files meet positions by ranges as wide as the
    longest file, of which a file touches two at most.
    """
    width = int(index.agg(F.max("n_tokens")).first()[0] or 1)
    last = F.col("base") + F.col("n_tokens") - 1
    places = index.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("base") / width), F.floor(last / width))))
    asked = wanted.select("position").where(F.col("position") >= 0).withColumn("bucket", F.floor(F.col("position") / width))
    met = asked.join(places.select("bucket", "name", "base", "n_tokens"), "bucket")
    met = met.where((F.col("position") >= F.col("base")) & (F.col("position") < F.col("base") + F.col("n_tokens")))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for row in rows:
                if row["name"] != name:
                    if file is not None:
                        file.close()
                    name, file = row["name"], open_file(row["name"])
                    opened = TokenFile(file)
                out.append(opened.token(row["position"] - row["base"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["position"] for r in rows], pa.int64()), pa.array(out, pa.int64())], ["position", "token"]
            )
        if file is not None:
            file.close()

    # A file's positions may lie in several tasks, so a hot file is no hot task.
    dealt = met.select("name", "base", "position").repartitionByRange("base", "position")
    return dealt.sortWithinPartitions("base", "position").mapInArrow(look, "position long, token long")


