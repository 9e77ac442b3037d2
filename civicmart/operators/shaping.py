"""Filters, roll-ups, dimension lists and top-k over aggregated tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicmart.functions.cells import exact_avg, exact_sum


def contains_any(c: Column, keywords: Iterable[str]) -> Column:
    """True if any keyword occurs in the text."""
    return reduce(lambda a, b: a | b, [c.contains(word) for word in keywords])


def keep_years(df: DataFrame, years: tuple[int, int] | None, column: str = "application_year") -> DataFrame:
    return df if years is None else df.filter(F.col(column).between(*years))


def keep_chosen(df: DataFrame, choices: Mapping[str, Sequence[str] | None]) -> DataFrame:
    """Keep rows whose columns are among the chosen values; an empty choice keeps all."""
    for column, chosen in choices.items():
        if chosen:
            df = df.filter(F.col(column).isin(*chosen))
    return df


def dimension_values(df: DataFrame, column: str, first: int | None = None) -> DataFrame:
    """Distinct non-null values in order, or only the ``first`` few of them."""
    values = df.select(column).na.drop().distinct().orderBy(column)
    return values if first is None else values.limit(first)


def bounds(df: DataFrame, column: str, low: str, high: str) -> DataFrame:
    return df.agg(F.min(column).alias(low), F.max(column).alias(high))


def roll_up(
    df: DataFrame,
    key: str,
    sums: Mapping[str, str],
    means: Mapping[str, str] | None = None,
) -> DataFrame:
    """Second-level totals by ``key``: rows without key are left out, a sum of nothing is 0.

    Doubles are added as decimals, so figures do not depend on how partitions merge.
    """
    kinds = dict(df.dtypes)
    total = {c: exact_sum(c) if kinds[c] == "double" else F.sum(c) for c in sums.values()}
    measures = [F.coalesce(total[source], F.lit(0)).alias(out) for out, source in sums.items()]
    measures += [exact_avg(source).alias(out) for out, source in (means or {}).items()]
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*measures)


def top_k(df: DataFrame, measure: str, k: int, tie: str, ascending: bool = False) -> DataFrame:
    """The ``k`` rows with the greatest ``measure``, shown descending or ascending."""
    best = df.orderBy(F.col(measure).desc_nulls_last(), F.col(tie).asc()).limit(k)
    return best.orderBy(F.col(measure).asc(), F.col(tie).desc()) if ascending else best


def present_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map and keep only the mapped columns that exist."""
    renamed = df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})
    return present_columns(renamed, list(names.values()))
