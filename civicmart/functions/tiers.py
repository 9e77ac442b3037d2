"""Threshold classes, closed on the left or on the right."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (lower edge, label) from the top class down; the last label has no edge.
QUALITY_TIERS = ((80, "Excellent"), (60, "Good"), (40, "Fair"))
QUALITY_FLOOR = "Needs Improvement"
INVESTMENT_TIERS = (
    (10_000_000, "Mega (>$10M)"),
    (1_000_000, "Major ($1M-$10M)"),
    (100_000, "Medium ($100K-$1M)"),
)
INVESTMENT_FLOOR = "Small (<$100K)"


def tier(
    value: Column,
    edges: Sequence[tuple[float, str]],
    floor: str,
    null_tier: str | None = "floor",
) -> Column:
    """Label by lower edges, an edge belonging to the class it opens.

    NULL takes the floor label unless ``null_tier`` gives another (or None).
    """
    ladder = sorted(edges, key=lambda e: -e[0])
    labels = F.coalesce(*[F.when(value >= edge, F.lit(label)) for edge, label in ladder], F.lit(floor))
    if null_tier == "floor":
        return labels
    return F.when(value.isNull(), F.lit(null_tier)).otherwise(labels)


def right_closed_bin(value: Column, edges: Sequence[tuple[float, str]], floor: str) -> Column:
    """Label by the same edges, an edge belonging to the class it closes; NULL stays NULL."""
    ladder = sorted(edges, key=lambda e: -e[0])
    labels = F.coalesce(*[F.when(value > edge, F.lit(label)) for edge, label in ladder], F.lit(floor))
    return F.when(value.isNotNull(), labels)


def quality_tier(score: Column, null_tier: str | None = "floor") -> Column:
    return tier(score, QUALITY_TIERS, QUALITY_FLOOR, null_tier)


def investment_category(average: Column) -> Column:
    return tier(average, INVESTMENT_TIERS, INVESTMENT_FLOOR)
