"""Schemas and empty tables in the session catalog, from the contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from civicmart.contracts import CLEAN, DESCRIPTIONS, MART, RAW, conform, contract, tables
from civicmart.sources.layers import PARQUET

# Tables that share the definition of another one.
CLONES = {(RAW, "permits_cleared"): "permits_active"}


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def table_ddl(layer: str, table: str, fmt: str = PARQUET, namespace: str = "") -> str:
    """``CREATE TABLE IF NOT EXISTS`` for one contract."""
    name = f"{namespace}{layer}.{table}"
    comment = DESCRIPTIONS[layer, table].replace("'", "''")
    twin = CLONES.get((layer, table))
    if twin:
        return (
            f"CREATE TABLE IF NOT EXISTS {name} LIKE {namespace}{layer}.{twin} "
            f"USING {fmt} TBLPROPERTIES ('comment' = '{comment}')"
        )
    return f"CREATE TABLE IF NOT EXISTS {name} ({_columns(contract(layer, table))}) USING {fmt} COMMENT '{comment}'"


def create_tables(spark: SparkSession, fmt: str = PARQUET, namespace: str = "") -> list[str]:
    """Create all schemas and tables that do not exist yet; ``namespace`` prefixes the schemas."""
    made = []
    for layer in (RAW, CLEAN, MART):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}{layer}")
        ordered = sorted(tables(layer), key=lambda t: (layer, t) in CLONES)
        for table in ordered:
            spark.sql(table_ddl(layer, table, fmt, namespace))
            made.append(f"{namespace}{layer}.{table}")
    return made


def insert_table(df: DataFrame, layer: str, table: str, namespace: str = "") -> None:
    """``df``, brought to its contract, as the whole new content of a catalog table."""
    conform(df, contract(layer, table)).write.insertInto(f"{namespace}{layer}.{table}", overwrite=True)


def catalog_columns(spark: SparkSession, namespace: str = "") -> list[tuple[str, str, int, str, str]]:
    """(layer, table, position, column, type) of all tables, as the catalog knows them."""
    found = []
    for layer in (RAW, CLEAN, MART):
        for table in tables(layer):
            listed = spark.catalog.listColumns(f"{namespace}{layer}.{table}")
            found += [(layer, table, i, c.name, c.dataType) for i, c in enumerate(listed, 1)]
    return found
