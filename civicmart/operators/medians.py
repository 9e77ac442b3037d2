"""Exact medians per group that never hold a group in one task.

``percentile_approx`` at exact accuracy and ``median`` both merge every value of a group
in one reducer.  Here rows are first counted by group *and* value, and that histogram is
written once.  It may carry other sums, so all measures of a group come from it too and the
input is read once.

The middle rank is then located by narrowing: the values of a group fall into ranges, at
first of equal relative width, and only the range that holds the middle rank is kept.  A
range with more than ``MOST_RANKED`` distinct values is cut into ``SLICES`` slices between
its least and its greatest value, and so on.  Least and greatest value always part, and a
slice is a ``SLICES``-th of the range before, so a few rounds reach any double, however
closely values cluster.  In the end the distinct values of one range are ranked, and no
task ever ranks more than ``MOST_RANKED`` values or ``SLICES`` ranges of one group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicmart.session import staged

MOST_RANKED = 8192
SLICES = 8192

GROUP, VALUE, ROWS = "group_of_value", "value", "rows_of_value"
LOW, HIGH = "low_middle", "high_middle"

# With two steps a factor of e, all doubles have fewer ranges than ``SLICES``.
_STEPS_PER_E = 2
_LEAST, _LEAST_LOG, _GREATEST_LOG = 5e-324, -746.0, 710.0  # infinities end up above
_PART, _RANGE, _BASE, _RANK_LO, _RANK_HI = "__part", "__range", "__base", "__rank_lo", "__rank_hi"


def value_counts(df: DataFrame, keys: Sequence[str], value: str, carried: Mapping[str, Column] | None = None) -> DataFrame:
    """The histogram: one row per group and value with its rows and the ``carried`` aggregates, written once.

    The keys travel as one struct: structs with equal fields join even where a field is NULL.
    """
    group = F.struct(*keys) if keys else F.struct(F.lit(0).alias("__all"))
    counted = df.groupBy(group.alias(GROUP), F.col(value).cast("double").alias(VALUE)).agg(
        F.count(F.lit(1)).alias(ROWS), *[a.alias(name) for name, a in (carried or {}).items()]
    )
    return staged(counted, "histogram")


def _relative(value: Column) -> Column:
    """Number of the value's range: it never decreases as the value grows."""
    log = F.least(F.ln(F.greatest(F.abs(value), F.lit(_LEAST))), F.lit(_GREATEST_LOG))
    return F.floor(F.signum(value) * (log - _LEAST_LOG) * _STEPS_PER_E).cast("bigint")


def _slice(value: Column) -> Column:
    """Number of the equal slice between the least and the greatest value of the range."""
    place = (value - F.col("__min")) / F.nullif(F.col("__max") - F.col("__min"), F.lit(0.0))
    return F.coalesce(F.floor(place * SLICES).cast("bigint"), F.lit(0).cast("bigint"))


def _ranked(counts: DataFrame, within: Sequence[str], order: str, start: Column) -> DataFrame:
    """Rank of the last row of each value or range, counted from ``start``, as ``__end``."""
    upto = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("__end", start + F.sum(ROWS).over(upto))


def _holds_middle() -> Column:
    return (F.col("__end") >= F.col(_RANK_LO)) & (F.col("__end") - F.col(ROWS) < F.col(_RANK_HI))


def candidates(counts: DataFrame, interpolate: bool = False) -> DataFrame:
    """The values of the one or two ranges of each group that hold its middle ranks."""
    total = F.sum(ROWS).over(Window.partitionBy(GROUP))
    low_rank = F.call_function("div", total + 1, F.lit(2))
    high_rank = F.call_function("div", total, F.lit(2)) + 1 if interpolate else low_rank
    rows = (
        counts.filter(F.col(VALUE).isNotNull() & ~F.isnan(VALUE))
        .select(GROUP, VALUE, ROWS, F.lit(0).cast("bigint").alias(_RANGE), _relative(F.col(VALUE)).alias(_PART))
    )
    ranks: list[str] = []
    while True:
        place = [GROUP, _RANGE]
        parts = rows.groupBy(*place, _PART, *ranks).agg(
            F.sum(ROWS).alias(ROWS), F.count(F.lit(1)).alias("__values"), F.min(VALUE).alias("__min"), F.max(VALUE).alias("__max")
        )
        if not ranks:
            parts = parts.withColumns({_RANK_LO: low_rank, _RANK_HI: high_rank, _BASE: F.lit(0).cast("bigint")})
            ranks = [_RANK_LO, _RANK_HI, _BASE]
        middle = _ranked(parts, place, _PART, F.col(_BASE)).filter(_holds_middle())
        middle = middle.withColumn(_BASE, F.col("__end") - F.col(ROWS)).drop("__end", ROWS)
        middle = staged(middle, "middle")
        # One or two ranges a group: Spark broadcasts them if they prove small, and otherwise
        # joins on group and range, which spreads a large group.
        known = rows.select(*place, _PART, VALUE, ROWS)
        rows = known.join(middle, [*place, _PART]).drop(_RANGE).withColumnRenamed(_PART, _RANGE)
        if (middle.agg(F.max("__values")).first()[0] or 0) <= MOST_RANKED:
            return rows.drop("__values", "__min", "__max")
        rows = staged(rows.withColumn(_PART, _slice(F.col(VALUE))).drop("__values", "__min", "__max"), "narrowed")


def middle_values(counts: DataFrame, keys: Sequence[str], interpolate: bool = False) -> DataFrame:
    """One or two rows per group with its middle values in ``low_middle`` and ``high_middle``.

    An even count has two middle values; without ``interpolate`` only the lower
    one is found.  NULL and NaN are missing; a group without values has no row.
    """

    def at(rank: str) -> Column:
        hit = (F.col("__end") >= F.col(rank)) & (F.col("__end") - F.col(ROWS) < F.col(rank))
        return F.when(hit, F.col(VALUE))

    found = _ranked(candidates(counts, interpolate), [GROUP, _RANGE], VALUE, F.col(_BASE)).filter(_holds_middle())
    names = [F.col(GROUP)[k].alias(k) for k in keys]
    return found.select(*names, at(_RANK_LO).alias(LOW), at(_RANK_HI).alias(HIGH))


def median(interpolate: bool = False) -> Column:
    """The median as an aggregate over the rows of ``middle_values``."""
    return F.max(LOW) / 2 + F.max(HIGH) / 2 if interpolate else F.max(LOW)


def with_middle_values(counts: DataFrame, keys: Sequence[str], interpolate: bool = False) -> DataFrame:
    """The rows of the histogram followed by those of ``middle_values``.

    One aggregation by ``keys`` then gives sums and ``median`` together, where a
    join of the two would shuffle both once more.  The other columns of the added
    rows are NULL, so aggregates that skip NULL need no care.
    """
    own = counts.select(*[F.col(GROUP)[k].alias(k) for k in keys], *[c for c in counts.columns if c != GROUP])
    return own.unionByName(middle_values(counts, keys, interpolate), allowMissingColumns=True)


def exact_median(
    df: DataFrame, keys: Sequence[str], value: str, out: str, interpolate: bool = False
) -> DataFrame:
    """Median of ``value`` per group of ``keys``, as a frame of keys and ``out``."""
    found = middle_values(value_counts(df, keys, value), keys, interpolate)
    return found.groupBy(*keys).agg(median(interpolate).alias(out))
