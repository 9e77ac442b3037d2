"""Running totals, lags and pivots over aggregated rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _added(a: Column, b: Column) -> Column:
    """Sum in which NULL counts as nothing, NULL only if both are."""
    return F.coalesce(a + b, a, b)


def running_total(
    df: DataFrame,
    partition: Sequence[str],
    periods: Sequence[str],
    within: Sequence[str],
    value: str,
    out: str,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Row-wise running sum of ``value`` per partition by ``periods``, then ``within``.

    Done in two steps so that a large partition is not sorted in one task: the
    sum of all earlier periods comes from one row per period, the rest from a
    window inside the period.  NULL sorts first.

    ``totals`` may bring ``value`` by partition and period where that is cheaper
    to compute from the input of ``df`` than from ``df``.
    """
    source = df if totals is None else totals
    # Partition and period travel as one struct, which joins NULL fields as equal and
    # lets the window and the join share one partitioning.
    place = F.struct(*partition, *periods)
    before = (
        Window.partitionBy(*[f"__place.{c}" for c in partition])
        .orderBy(*[F.col(f"__place.{c}").asc_nulls_first() for c in periods])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        source.groupBy(place.alias("__place"))
        .agg(F.sum(value).alias("__total"))
        .select("__place", F.sum("__total").over(before).alias("__before"))
    )
    inside = (
        Window.partitionBy("__place")
        .orderBy(*[F.col(c).asc_nulls_first() for c in within])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        df.withColumn("__place", place)
        .withColumn("__inside", F.sum(value).over(inside))
        .join(offsets, "__place", "left")
        .withColumn(out, _added(F.col("__before"), F.col("__inside")))
        .select(*df.columns, out)
    )


def lagged(
    df: DataFrame, partition: Sequence[str], order: Sequence[str], value: str, rows: int, out: str
) -> DataFrame:
    """``value`` of the row ``rows`` earlier; a gap in the series shifts the base."""
    ordered = Window.partitionBy(*partition).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn(out, F.lag(value, rows).over(ordered))


def months_earlier(
    df: DataFrame, partition: Sequence[str], month: str, value: str, months: int, out: str
) -> DataFrame:
    """``value`` of the row exactly ``months`` calendar months earlier, NULL if there is none.

    A window over the number of the month, whose frame is that one month; the day of the
    month plays no part.  Of several rows in a month the greatest value counts.
    """
    number = F.year(month) * 12 + F.month(month)
    frame = Window.partitionBy(*partition).orderBy(number).rangeBetween(-months, -months)
    # A row without month would be its own frame.
    return df.withColumn(out, F.when(F.col(month).isNotNull(), F.max(value).over(frame)))


def pivot_listed(
    df: DataFrame, keys: Sequence[str], column: str, value: str, names: Mapping[str, str]
) -> DataFrame:
    """One column per listed value of ``column``, holding the greatest ``value``.

    Conditional aggregates need one shuffle where ``pivot`` needs two, and the
    maximum makes repeated measurements deterministic.
    """
    measures = [
        F.max(F.when(F.col(column) == wanted, F.col(value))).alias(name) for wanted, name in names.items()
    ]
    return df.groupBy(*keys).agg(*measures)


def pivot_found(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    value: str,
    naming: Callable[[str], str] = lambda found: found,
) -> DataFrame:
    """One column per value that occurs in ``column``; Spark first lists the values."""
    wide = df.groupBy(*keys).pivot(column).agg(F.max(value))
    found = [c for c in wide.columns if c not in keys]
    return wide.withColumnsRenamed({c: naming(c) for c in found})
