"""Table writes with row counts, and layer summaries."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from civicmart.sources.layers import PARQUET, VERSION, file_system, table_path, versions

FILE_FORMATS = ("parquet", "orc")

# Bounds the files of a source that had to be read in one task.
MAX_ROWS_PER_FILE = 20_000_000

# A split reads whole row groups, so these bound what a later task must read at least.
ROW_GROUP_BYTES = 16 * 1024 * 1024


def replace_table(
    df: DataFrame,
    lake_dir: str,
    layer: str,
    table: str,
    fmt: str = PARQUET,
    partition_by: str | None = None,
) -> int:
    """Write ``df`` as the whole new content of a table and return its row count.

    Running it again gives the same table.  Rows are counted while they are
    written.  ``partition_by`` first rebalances by that column: AQE then splits
    the partitions of a frequent value and merges those of rare ones.

    File formats are written to a folder of their own, which one rename publishes as the
    newest version: a write that fails leaves the table as it was.  The version before is
    kept for its readers, older ones go.  Other formats replace their tables themselves.
    """
    spark = df.sparkSession
    path = table_path(lake_dir, layer, table)
    versioned = fmt in FILE_FORMATS
    fresh = f"{path}/_unfinished-{uuid.uuid4().hex}" if versioned else path
    written = Observation()
    if partition_by:
        df = df.hint("rebalance", partition_by)
    writer = (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.format(fmt)
        .mode("overwrite")
        .option("overwriteSchema", "true")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .option("parquet.block.size", ROW_GROUP_BYTES)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    try:
        writer.save(fresh)
    except Exception:
        if versioned:
            files, folder = file_system(spark, fresh)
            files.delete(folder, True)
        raise
    if versioned:
        _publish(spark, path, fresh)
    return written.get["rows"]


def _publish(spark: SparkSession, path: str, fresh: str) -> None:
    files, folder = file_system(spark, path)
    known = versions(spark, path)
    number = int(known[-1].split("-")[1]) + 1 if known else 0
    name = f"{VERSION}{number:08d}-{fresh.rpartition('-')[2][:8]}"
    if not files.rename(file_system(spark, fresh)[1], file_system(spark, f"{path}/{name}")[1]):
        raise OSError(f"{path}/{name} could not be published")
    # Unversioned files of an earlier layout are of no more use either.
    kept = {name, *known[-1:]}
    for status in files.listStatus(folder):
        old = status.getPath()
        if old.getName() not in kept and not old.getName().startswith("_unfinished-"):
            files.delete(old, True)


def export_parquet(df: DataFrame, path: str) -> None:
    """Side copy for readers without the table format, written by the executors."""
    df.write.mode("overwrite").parquet(path)


def layer_summary(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Table name, row count and column count of each frame."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)
