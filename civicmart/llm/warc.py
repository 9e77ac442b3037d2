"""WARC bundles of independent Zstandard frames with a seek table.

``write_archives`` groups records into frames, appends the seek table of the
seekable Zstandard format to every bundle and returns the index: which bundle and
frame holds a record, and where in the unpacked frame it begins.  ``read_archives``
reads whole bundles back, frame by frame; ``fetch`` reads only the frames that hold
wanted records.

Bundles are binary files, which no Spark writer makes, so tasks write them through
``pyarrow.fs`` (local, HDFS, S3, GCS paths).  A bundle's name carries its task
attempt; only bundles named in the committed index count, so a repeated or
speculative task leaves unused files behind but never a wrong or double record.

Defined results: a null payload is empty; a null key is written and read back as
null and counts as larger than any key; rows that repeat the smallest key of equal
payloads are all responses; an empty table gives an empty index and no bundle; a
record longer than a frame gets a frame of its own; further columns are ignored.  A bundle
that is cut off, and a record whose payload has not the digest that it states, are errors.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicmart.llm.common import create_file, open_file, qualified, staged
from civicmart.session import scratch_dir

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
SMALLEST_SHARED_PAYLOAD = 100

# Fixed values of the seekable Zstandard format.
_SKIPPABLE_MAGIC = 0x184D2A5E
_SEEKABLE_MAGIC = 0x8F92EAB1
_FOOTER = struct.Struct("<IBI")
_ENTRY = struct.Struct("<II")

_INDEX = "record_id string, record_key long, bundle string, frame int, offset long, length long"
_RECORD = (
    "record_key long, url string, record_type string, refers_to long, payload_bytes long,"
    " payload_digest string, payload binary"
)


def with_revisits(records: DataFrame) -> DataFrame:
    """Add ``record_type`` and ``refers_to`` to (record_key, url, payload binary).

    Equal payloads are found by SHA-256.  Only digests that occur twice or more come
    back from the map-side aggregation, and a hot digest is split by the skew join.
    """
    hashed = records.select(
        "record_key",
        "url",
        F.coalesce("payload", F.lit(b"")).alias("payload"),
    ).select(
        "*",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
    )
    shared = (
        hashed.where(F.col("payload_bytes") >= SMALLEST_SHARED_PAYLOAD)
        .groupBy("payload_digest")
        .agg(F.min("record_key").alias("first_key"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 AND first_key IS NOT NULL")
        .drop("copies")
    )
    revisit = F.col("first_key").isNotNull() & ~F.col("record_key").eqNullSafe(F.col("first_key"))
    return hashed.join(shared, "payload_digest", "left").select(
        "record_key",
        "url",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_key")).alias("refers_to"),
        "payload_bytes",
        "payload_digest",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_archives(
    records: DataFrame,
    folder: str | None = None,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write the rows of ``with_revisits`` as bundles; return the index, one row per record."""
    spark = records.sparkSession
    folder = qualified(spark, folder or scratch_dir(spark, "warc"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundle = _Bundle(folder, frame_bytes, bundle_bytes)
        for batch in batches:
            for row in batch.itertuples(index=False):
                bundle.add(row)
            if bundle.index:
                yield bundle.taken()
        bundle.close()
        if bundle.index:
            yield bundle.taken()

    # Keys go as text, because a null would turn a batch's numbers into floating point.
    text = records.withColumns({c: F.col(c).cast("string") for c in ("record_key", "refers_to")})
    return staged(text.mapInPandas(write, _INDEX), "warc-index")


def read_archives(index: DataFrame) -> DataFrame:
    """All records of the bundles that the index names, one task input per bundle."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["bundle"]:
                with open_file(name) as file:
                    for start, packed, size in seek_table(file):
                        yield _records(_frame(file, start, packed, size))

    bundles = staged(index.select("bundle").distinct(), "warc-bundles")
    # By ranges of a stated number: adaptive merging sees only the short names, and a hash deals unevenly.
    return bundles.repartitionByRange(max(1, bundles.count()), "bundle").mapInPandas(read, _RECORD)


def fetch(index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The records with the given ``record_id``; of each bundle only the frames that hold one.

    Frames are dealt by bundle and frame, so a bundle with very many wanted records is shared by tasks.
    """
    wanted = index.join(record_ids.select("record_id").distinct(), "record_id", "left_semi")
    place = ["bundle", "frame", "offset"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, text, bundle, table = None, b"", None, []
        for batch in batches:
            # One frame's records make one data frame: a data frame a record took most of the time.
            found: list[bytes] = []
            for name, number, low, size in batch.itertuples(index=False):
                if held != (name, number):
                    if found:
                        yield _records(b"".join(found))
                        found = []
                    with open_file(name) as file:
                        if bundle != name:
                            bundle, table = name, seek_table(file)
                        held, text = (name, number), _frame(file, *table[number])
                found.append(text[low : low + size])
            if found:
                yield _records(b"".join(found))

    dealt = wanted.select(*place, "length").repartitionByRange(*place[:2]).sortWithinPartitions(*place)
    return dealt.mapInPandas(read, _RECORD)


# ---- one bundle --------------------------------------------------------------------------


class _Bundle:
    """Collects records in a frame, frames in a file, and what the index says of them."""

    def __init__(self, folder: str, frame_bytes: int, bundle_bytes: int):
        import zstandard

        self.folder, self.frame_bytes, self.bundle_bytes = folder, frame_bytes, bundle_bytes
        self.packer = zstandard.ZstdCompressor(level=3)
        self.index: list[tuple] = []
        self.file = None
        self._clear()

    def _clear(self) -> None:
        self.frame, self.table, self.written = bytearray(), [], 0

    def add(self, row) -> None:
        if self.file is None:
            context = TaskContext.get()
            attempt = f"{context.partitionId()}-{context.taskAttemptId()}" if context else "0-0"
            self.name = f"{self.folder}/bundle-{attempt}-{uuid.uuid4().hex}.warc.zst"
            self.file = create_file(self.name)
        record_id, text = _record(row)
        if self.frame and len(self.frame) + len(text) > self.frame_bytes:
            self._end_frame()
        key = None if row.record_key is None else int(row.record_key)
        self.index.append((record_id, key, self.name, len(self.table), len(self.frame), len(text)))
        self.frame += text
        if len(self.frame) >= self.frame_bytes:
            self._end_frame()
        if self.written >= self.bundle_bytes:
            self.close()

    def _end_frame(self) -> None:
        packed = self.packer.compress(bytes(self.frame))
        self.file.write(packed)
        self.table.append((len(packed), len(self.frame)))
        self.written += len(packed)
        self.frame = bytearray()

    def close(self) -> None:
        if self.file is None:
            return
        if self.frame:
            self._end_frame()
        body = b"".join(_ENTRY.pack(*x) for x in self.table) + _FOOTER.pack(len(self.table), 0, _SEEKABLE_MAGIC)
        self.file.write(struct.pack("<II", _SKIPPABLE_MAGIC, len(body)) + body)
        self.file.close()
        self.file = None
        self._clear()

    def taken(self) -> pd.DataFrame:
        columns = ["record_id", "record_key", "bundle", "frame", "offset", "length"]
        out = pd.DataFrame(self.index, columns=columns).astype({"record_key": "Int64"})
        self.index = []
        return out


def seek_table(file) -> list[tuple[int, int, int]]:
    """(start, packed size, unpacked size) of every frame, from the footer alone."""
    end = file.size()
    if end < _FOOTER.size:
        raise ValueError("no seek table at the end of the bundle")
    file.seek(end - _FOOTER.size)
    count, descriptor, magic = _FOOTER.unpack(file.read(_FOOTER.size))
    if magic != _SEEKABLE_MAGIC or descriptor & 0x7C:
        raise ValueError("no seek table at the end of the bundle")
    width = _ENTRY.size + 4 * bool(descriptor & 0x80)
    file.seek(end - _FOOTER.size - count * width)
    body = file.read(count * width)
    out, start = [], 0
    for i in range(count):
        packed, size = _ENTRY.unpack_from(body, i * width)
        out.append((start, packed, size))
        start += packed
    return out


def _frame(file, start: int, packed: int, size: int) -> bytes:
    import zstandard

    file.seek(start)
    return zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=size)


# ---- one record --------------------------------------------------------------------------


def record_id(key: int | None, digest: str) -> str:
    return f"<urn:record:{'' if key is None else key}:{digest[:16]}>"


def identifier(key: Column, digest: Column) -> Column:
    """``record_id`` as an expression."""
    return F.concat(F.lit("<urn:record:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.substring(digest, 1, 16), F.lit(">"))


def _record(row) -> tuple[str, bytes]:
    """Identifier and bytes of a record.  A revisit has headers only."""
    key = None if row.record_key is None else int(row.record_key)
    name = record_id(key, row.payload_digest)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row.record_type}",
        f"WARC-Record-ID: {name}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{row.payload_digest}",
        f"X-Payload-Length: {row.payload_bytes}",
    ]
    if row.url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in row.url))
    block = b""
    if row.record_type == "revisit":
        lines.append(f"WARC-Refers-To: {record_id(int(row.refers_to), row.payload_digest)}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    else:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + bytes(row.payload)
    lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return name, "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _key(name: str | None) -> int | None:
    middle = name.split(":")[2] if name else ""
    return int(middle) if middle else None


def _records(text: bytes) -> pd.DataFrame:
    file, rows = io.BytesIO(text), []
    while line := file.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a record: {line[:40]!r}")
        heads = {}
        while (line := file.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            heads[name] = value
        block = file.read(int(heads["Content-Length"]))
        file.read(4)
        payload = block.partition(b"\r\n\r\n")[2] if heads["WARC-Type"] == "response" else None
        stated = heads["WARC-Payload-Digest"].removeprefix("sha256:")
        digest = stated if payload is None else hashlib.sha256(payload).hexdigest()
        size = int(heads["X-Payload-Length"]) if payload is None else len(payload)
        if digest != stated:
            raise ValueError(f"the payload of {heads['WARC-Record-ID']} has not the stated digest")
        rows.append(
            (
                _key(heads["WARC-Record-ID"]),
                heads.get("WARC-Target-URI"),
                heads["WARC-Type"],
                _key(heads.get("WARC-Refers-To")),
                size,
                digest,
                payload,
            )
        )
    columns = "record_key url record_type refers_to payload_bytes payload_digest payload".split()
    return pd.DataFrame(rows, columns=columns).astype({"record_key": "Int64", "refers_to": "Int64"})
