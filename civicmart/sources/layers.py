"""Readers for tables of a layer."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from civicmart.contracts import CLEAN, MART, conform, contract

PARQUET = "parquet"
VERSION = "v-"


class MissingTableError(FileNotFoundError):
    """A table was asked for before it was written."""


def table_path(lake_dir: str, layer: str, table: str) -> str:
    return f"{lake_dir.rstrip('/')}/{layer}/{table}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path object of a path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the published versions of a table, oldest first."""
    files, target = file_system(spark, path)
    if not files.exists(target):
        return []
    return sorted(n for s in files.listStatus(target) if (n := s.getPath().getName()).startswith(VERSION))


def current_path(spark: SparkSession, path: str) -> str:
    """The newest published version of a table; the path itself for a table without versions."""
    names = versions(spark, path)
    return f"{path}/{names[-1]}" if names else path


def read_table(
    spark: SparkSession, lake_dir: str, layer: str, table: str, fmt: str = PARQUET, schema: T.StructType | None = None
) -> DataFrame:
    """A stored table, or a clear error if it was never written."""
    path = table_path(lake_dir, layer, table)
    try:
        reader = spark.read.format(fmt)
        return (reader.schema(schema) if schema else reader).load(current_path(spark, path))
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        raise MissingTableError(f"{layer}.{table} not found at {path}; run the pipeline first") from problem


def read_mart(spark: SparkSession, lake_dir: str, table: str, fmt: str = PARQUET) -> DataFrame:
    """A reporting table under its contract, so that dates are dates."""
    return conform(read_table(spark, lake_dir, MART, table, fmt), contract(MART, table))


def read_clean(spark: SparkSession, lake_dir: str, table: str, fmt: str = PARQUET) -> DataFrame:
    """A cleaned table with the types of its contract, also for the column that names its folders."""
    schema = contract(CLEAN, table)
    return read_table(spark, lake_dir, CLEAN, table, fmt, schema).select(*schema.fieldNames())
