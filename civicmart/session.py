"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SHUFFLE_TARGET_BYTES = 128 * 1024 * 1024

# Of packed columnar files, so that what one task reads sorts in its memory as rows.
_SORTED_SCAN_BYTES = 16 * 1024 * 1024


def session_settings() -> dict[str, str]:
    """Settings every job of this package wants, whatever the cluster."""
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_SHUFFLE_TARGET_BYTES),
    }


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Shuffle partitions for a job that moves about ``input_bytes``.

    Aims at 128 MB per task so that a partition sorts in executor memory, with a
    floor of the core count; AQE merges what turns out too small.
    """
    return max(cores, math.ceil(input_bytes / _SHUFFLE_TARGET_BYTES))


def _bytes(size: str) -> int:
    """A setting such as ``128m``; Spark gives plain sizes as ``134217728b``."""
    units = {"b": 0, "k": 10, "m": 20, "g": 30, "t": 40}
    text = size.strip().lower().removesuffix("b") or "0"
    return int(text[:-1]) << units[text[-1]] if text[-1] in units else int(text)


@contextmanager
def bounded_sorts(spark: SparkSession) -> Iterator[None]:
    """For jobs inside that sort what they read before a shuffle, as the newest row per key does.

    A split of 128 MB of packed columns is gigabytes as rows, and a sort of those spills all
    of them.  Small splits keep a task's rows in memory whatever the size of the table.
    """
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(_bytes(before), _SORTED_SCAN_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def open_session(app: str, master: str | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**session_settings(), **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_scratch: str | None = None


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that ``spark.checkpoint.dir`` names.

    The folder must be visible to every executor, so on a cluster an unset value
    is an error.  Only a local master falls back to a temporary folder.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="civicmart-")
            atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
        base = _local_scratch
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame written once below the shared scratch folder and read from there.

    For a frame that a plan needs more than once and that is costly to compute.  It
    cuts the lineage: a lost executor costs only the tasks that it ran.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
