"""What several operators of this folder share."""

from __future__ import annotations

import functools
import gc
import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicmart.session import scratch_dir

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame written once below the shared folder, and read from there.

    Cuts the lineage: a lost executor costs only the tasks that it ran, because
    the files are in ``spark.checkpoint.dir``.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_held: dict[Any, Any] = {}


def held(key: Any, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task: one thing only, so that of another step is dropped."""
    if key not in _held:
        drop_held()
        _held[key] = make()
    return _held[key]


def drop_held() -> None:
    """For tasks that keep nothing but need memory themselves."""
    if _held:
        _held.clear()
        gc.collect()  # tokenizers hold cycles


def shielded(*used: str) -> Callable:
    """For a step from documents to documents: columns but the ``used`` ones have other names while it works.

    So no column of the caller clashes with one that the step adds, and all come back as they were.
    """

    def wrap(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(step)
        def run(docs: DataFrame, *args, **options) -> DataFrame:
            safe = [c if c in used else f"kept_{i}" for i, c in enumerate(docs.columns)]
            out = step(docs.toDF(*safe), *args, **options)
            return out.select(*[F.col(s).alias(c) for s, c in zip(safe, docs.columns)])

        return run

    return wrap


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system, as Spark resolves it: tasks must not take it for one of their own disks."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _file_system(name: str):
    """File system and path of a qualified name, for binary files that no Spark reader or writer knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri("file://" + name.removeprefix("file:") if re.match("file:/[^/]", name) else name)


def create_file(name: str):
    files, path = _file_system(name)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    return files.open_output_stream(path, compression=None)


def open_file(name: str):
    files, path = _file_system(name)
    return files.open_input_file(path)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character stays (``lower`` would change those too)."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; '' without one."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")


def running_before(rows: DataFrame, keys: list[str], chunks: list[str], order: list[str], value: str) -> DataFrame:
    """Add ``before``: the sum of ``value`` over earlier rows of the same keys.

    ``chunks`` go from coarse to fine and must follow ``order``.  Rows are summed by the
    finest chunk, chunks by the next, so no window holds more than one chunk's rows.
    """
    *coarser, finest = chunks if chunks else [None]
    earlier = Window.partitionBy(*keys, *chunks).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("before", F.coalesce(F.sum(value).over(earlier), F.lit(0)))
    if finest is None:
        return inside
    sums = rows.groupBy(*keys, *chunks).agg(F.sum(value).alias("chunk_sum"))
    sums = running_before(sums, keys, coarser, [finest], "chunk_sum")
    sums = sums.select(*keys, *chunks, F.col("before").alias("chunk_before"))
    joined = inside.join(sums, [*keys, *chunks])
    return joined.withColumn("before", F.col("before") + F.col("chunk_before")).drop("chunk_before")
