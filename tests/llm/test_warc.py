from __future__ import annotations

import glob
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from civicmart.llm import warc

SCHEMA = "record_key long, url string, payload binary"


def rows(n=200, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.choice([0, 5, 99, 100, 3000, 200_000 if i == 17 else 700])
        out.append((i, f"https://h{i}.org/ä b", bytes(rng.choices(b"abcdef \r\n", k=size))))
    copies = [(1000 + i, None, rng.choice(out)[2]) for i in range(80)]
    return out + copies + [(None, "x://y", None), (2000, "u", None), (None, "again", out[16][2]), (5, "twice", out[5][2])]


def expected(data):
    first, out = {}, []
    for key, _, payload in data:
        if payload and len(payload) >= 100 and key is not None:
            first[payload] = min(first.get(payload, key), key)
    for key, url, payload in data:
        payload = payload or b""
        head = first.get(payload)
        again = head is not None and key != head
        digest = hashlib.sha256(payload).hexdigest()
        out.append((key, "revisit" if again else "response", head if again else None, len(payload), digest, None if again else payload))
    return sorted(out, key=repr)


def said(df):
    found = df.select("record_key", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload").collect()
    return sorted(((*r[:5], None if r[5] is None else bytes(r[5])) for r in found), key=repr)


@pytest.fixture
def archive(spark, tmp_path):
    def build(data, **sizes):
        records = spark.createDataFrame(data, SCHEMA).withColumns({c: F.lit("x") for c in ("first_key", "bundle", "frame")})
        return warc.write_archives(warc.with_revisits(records.repartition(6)), str(tmp_path / "bundles"), **sizes)

    return build


def test_round_trip_with_small_frames_and_bundles(archive):
    data = rows()
    index = archive(data, frame_bytes=4000, bundle_bytes=1000)
    assert index.select("bundle", "frame").distinct().count() > 50
    assert said(warc.read_archives(index)) == expected(data)


def test_one_task_reads_one_bundle(spark, archive):
    index = archive(rows(), frame_bytes=4000, bundle_bytes=1000)
    bundles = index.select("bundle").distinct().count()
    read = warc.read_archives(index).withColumn("task", F.spark_partition_id())
    keys = index.select("bundle", F.col("record_key"))
    assert bundles > 8
    tasks = read.join(keys, read.record_key.eqNullSafe(keys.record_key)).where(read.record_key.isNotNull() & (read.record_key != 5))
    assert read.select("task").distinct().count() == bundles
    assert tasks.groupBy("task").agg(F.count_distinct("bundle").alias("n")).where("n > 1").count() == 0


def test_fetch_reads_only_wanted_records(spark, archive):
    data = rows()
    index = archive(data, frame_bytes=4000, bundle_bytes=1000)
    wanted = index.where("record_key % 7 = 0").select("record_id").union(index.limit(0).select("record_id"))
    got = said(warc.fetch(index, wanted.union(wanted)))
    assert got == [r for r in expected(data) if r[0] is not None and r[0] % 7 == 0]
    assert warc.fetch(index, wanted.limit(0)).count() == 0


def test_fetch_by_identifier(spark, archive):
    digest = hashlib.sha256(b"").hexdigest()
    index = archive([(None, None, None), (4, None, b"")])
    ids = spark.range(1).select(warc.identifier(F.lit(None).cast("long"), F.lit(digest)).alias("record_id"))
    assert said(warc.fetch(index, ids)) == [(None, "response", None, 0, digest, b"")]


def test_empty_table(archive):
    index = archive([])
    assert index.count() == 0
    assert warc.read_archives(index).count() == 0


def test_plain_folders_get_their_file_system(archive, tmp_path):
    index = archive(rows(20))
    assert index.first().bundle.startswith("file:")
    assert glob.glob(str(tmp_path / "bundles" / "*.warc.zst"))


def test_frames_unpack_on_their_own_and_broken_bundles_are_errors(archive):
    import zstandard

    index = archive(rows(), frame_bytes=4000)
    name = index.first().bundle.removeprefix("file:")
    data = open(name, "rb").read()
    table = warc.seek_table(io_file(data))
    start, packed, size = table[-1]
    assert len(zstandard.ZstdDecompressor().decompress(data[start : start + packed], max_output_size=size)) == size
    # Any decompressor skips the seek table and reads the frames in a row.
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True) as whole:
        assert len(whole.read()) == sum(size for _, _, size in table)
    for broken in (data[:-1], data[:5], b""):
        with pytest.raises(ValueError):
            warc.seek_table(io_file(broken))


def test_a_changed_payload_is_an_error():
    record = warc._record(type("Row", (), dict(record_key="1", url=None, record_type="response", refers_to=None, payload_bytes=3, payload_digest="0" * 64, payload=b"abc")))[1]
    with pytest.raises(ValueError):
        warc._records(record)


def io_file(data):
    import pyarrow as pa

    return pa.BufferReader(data)


def test_records_of_one_frame_are_read_as_one(spark, monkeypatch):
    from unittest.mock import MagicMock

    rows = [(i, None, bytearray(b"%d" % i)) for i in range(50)]
    records = warc.with_revisits(spark.createDataFrame(rows, "record_key long, url string, payload binary").coalesce(1))
    index = warc.write_archives(records.coalesce(1), frame_bytes=4000)
    planned = MagicMock()
    warc.fetch(planned, MagicMock())
    chain = planned.join.return_value.select.return_value.repartitionByRange.return_value.sortWithinPartitions.return_value
    read, places = chain.mapInPandas.call_args[0][0], index.toPandas().sort_values(["bundle", "frame", "offset"])
    parsed, tables, records_of, table_of = [], [], warc._records, warc.seek_table
    monkeypatch.setattr(warc, "_records", lambda text: parsed.append(text) or records_of(text))
    monkeypatch.setattr(warc, "seek_table", lambda file: tables.append(file) or table_of(file))
    out = list(read(iter([places[["bundle", "frame", "offset", "length"]]])))
    assert sorted(k for batch in out for k in batch["record_key"]) == list(range(50))
    frames = len(places[["bundle", "frame"]].drop_duplicates())
    assert 1 < frames == len(parsed) < 50 and len(tables) == places["bundle"].nunique()
