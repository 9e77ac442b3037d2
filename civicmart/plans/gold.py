"""Reporting tables over the cleaned tables.

The functions return unsorted frames: a sort before a window or a write by hash
would only add a shuffle.  ``presented`` applies the reading order of a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicmart.contracts import MART, conform, contract
from civicmart.functions.cells import exact, half_up, percent_change, rounded, rounded_avg, rounded_sum
from civicmart.functions.tiers import investment_category, quality_tier
from civicmart.operators.medians import ROWS, VALUE, median, value_counts, with_middle_values
from civicmart.operators.series import lagged, pivot_listed, running_total
from civicmart.session import staged

FIRST_YEAR = 2017  # fixed value

PERIOD = ["application_year", "application_quarter"]

# Measured index -> column.
INDEX_COLUMNS = {
    "Total (house and land)": "index_total",
    "House only": "index_house",
    "Land only": "index_land",
}

# Sort columns per table; "-" sorts descending.  Keys are added so that rows with
# equal leading columns can still be spread over the range partitions.
READING_ORDER = {
    "permit_trends": [*PERIOD, "ward", "permit_type", "structure_type", "work_type", "status"],
    "construction_investment": [*PERIOD, "ward", "current_use", "proposed_use"],
    "apartment_scorecard": ["-building_count", "ward", "property_type"],
    "housing_development": [*PERIOD, "ward", "structure_type", "proposed_use"],
    "price_index_trends": ["geography", "reference_date", "ref_period"],
    "property_overview": ["-property_count", "feature_type"],
}


def presented(df: DataFrame, table: str) -> DataFrame:
    """``df`` in the reading order of reporting table ``table``."""
    order = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in READING_ORDER[table]]
    return df.orderBy(*order)


def index_column(found: str) -> str:
    """Column name for an index type known only by its wording."""
    if "Total" in found and "land" in found.lower():
        return "index_total"
    for wording in ("House only", "Land only"):
        if wording in found:
            return INDEX_COLUMNS[wording]
    return found


def _mart(df: DataFrame, table: str) -> DataFrame:
    return conform(df, contract(MART, table))


# Of a histogram with the exact sums of its values.


def _known() -> Column:
    return F.sum(F.when(F.col(VALUE).isNotNull(), F.col(ROWS)))


def _fitting(sums: str) -> Column:
    """The exact total, if every value fits in a decimal."""
    return F.when(F.count(sums) == F.count(VALUE), F.sum(sums))


def _total(sums: str, digits: int) -> Column:
    return half_up(_fitting(sums), F.sum(F.col(VALUE) * F.col(ROWS)), digits)


def _mean(sums: str, digits: int) -> Column:
    return half_up(_fitting(sums), F.sum(F.col(VALUE) * F.col(ROWS)) / F.nullif(_known(), F.lit(0)), digits, _known())


def permit_trends(
    permits: DataFrame, first_year: int = FIRST_YEAR, one_row_per_permit: bool = False
) -> DataFrame:
    """Permit activity by period, ward and kind.

    Counting distinct permits shuffles every permit number.  Where the input is
    known to hold one row per permit, as the cleaned table does, a plain count
    gives the same figure from partial sums alone.
    """
    cost = "estimated_construction_cost"
    permit_counter = F.count if one_row_per_permit else F.count_distinct
    keys = [*PERIOD, "ward", "permit_type", "structure_type", "work_type", "status"]
    grouped = permits.filter(F.col("application_year") >= first_year).groupBy(*keys)
    return _mart(
        grouped.agg(
            F.count("*").alias("permit_count"),
            rounded_avg(cost, 2).alias("avg_construction_cost"),
            rounded_sum(cost, 2).alias("total_construction_cost"),
            F.sum("dwelling_units_created").alias("total_units_created"),
            F.sum("dwelling_units_lost").alias("total_units_lost"),
            F.sum("net_dwelling_units").alias("net_dwelling_units"),
            permit_counter("permit_number").alias("unique_permits"),
        ),
        "permit_trends",
    )


def construction_investment(
    permits: DataFrame, first_year: int = FIRST_YEAR, interpolate: bool = False
) -> DataFrame:
    cost = "estimated_construction_cost"
    keys = [*PERIOD, "ward", "current_use", "proposed_use"]
    costed = permits.filter((F.col(cost) > 0) & (F.col("application_year") >= first_year))
    counts = value_counts(costed, keys, cost, {"cost": F.sum(exact(cost)), "units": F.sum("dwelling_units_created")})
    summary = with_middle_values(counts, keys, interpolate).groupBy(*keys).agg(
        F.sum(ROWS).alias("project_count"),
        _total("cost", 2).alias("total_investment"),
        _mean("cost", 2).alias("avg_investment"),
        rounded(median(interpolate), 2).alias("median_investment"),
        F.max(VALUE).alias("max_investment"),
        F.sum("units").alias("units_created"),
    )
    return _mart(
        summary.withColumn("investment_category", investment_category(F.col("avg_investment"))),
        "construction_investment",
    )


def apartment_scorecard(buildings: DataFrame, null_tier: str | None = "floor") -> DataFrame:
    grouped = buildings.groupBy("ward", "property_type").agg(
        F.count("*").alias("building_count"),
        *[rounded_avg(c, 1).alias(f"avg_{c}") for c in ("eval_score", "proactive_score", "reactive_score")],
        *[rounded_avg(c, 0).alias(f"avg_{c}") for c in ("units", "storeys", "building_age", "year_built")],
        *[F.sum(c).alias(f"total_{c}") for c in ("units", "elevators")],
        F.min("year_built").alias("oldest_building"),
        F.max("year_built").alias("newest_building"),
    )
    return _mart(
        grouped.withColumn("quality_tier", quality_tier(F.col("avg_eval_score"), null_tier)),
        "apartment_scorecard",
    )


def housing_development(permits: DataFrame, first_year: int = FIRST_YEAR) -> DataFrame:
    created, lost = F.col("dwelling_units_created"), F.col("dwelling_units_lost")
    detail = ["structure_type", "proposed_use"]
    changed = permits.filter(
        (F.col("application_year") >= first_year) & (created.isNotNull() | lost.isNotNull())
    )
    grouped = changed.groupBy(*PERIOD, "ward", *detail).agg(
        F.count("*").alias("permit_count"),
        F.sum(created).alias("units_created"),
        F.sum(lost).alias("units_lost"),
        F.sum("net_dwelling_units").alias("net_units"),
        rounded_sum("estimated_construction_cost", 2).alias("total_cost"),
    )
    # Written once: the running total reads the groups twice, the permits need reading only once.
    return _mart(
        running_total(staged(grouped, "housing"), ["ward"], PERIOD, detail, "net_units", "cumulative_net_units"),
        "housing_development",
    )


def price_index_trends(index: DataFrame) -> DataFrame:
    keys = ["reference_date", "ref_period", "geography", "ref_year", "ref_month", "ref_quarter"]
    wide = pivot_listed(index, keys, "index_type", "index_value", INDEX_COLUMNS)
    ago = lagged(wide, ["geography"], ["reference_date", "ref_period"], "index_total", 12, "index_total_12m_ago")
    return _mart(
        ago.withColumn("yoy_change_pct", percent_change("index_total", "index_total_12m_ago")),
        "price_index_trends",
    )


def property_overview(parcels: DataFrame, interpolate: bool = False) -> DataFrame:
    sqm, sqft = "stated_area_sqm", "stated_area_sqft"
    keys = ["feature_type"]
    carried = {"sqm": F.sum(exact(sqm)), "sqft": F.sum(exact(sqft)), "sqft_plain": F.sum(sqft), "sqft_rows": F.count(sqft)}
    summary = with_middle_values(value_counts(parcels, keys, sqm, carried), keys, interpolate).groupBy(*keys).agg(
        F.sum(ROWS).alias("property_count"),
        _mean("sqm", 2).alias("avg_area_sqm"),
        half_up(F.sum("sqft"), F.sum("sqft_plain") / F.nullif(F.sum("sqft_rows"), F.lit(0)), 2, F.sum("sqft_rows")).alias("avg_area_sqft"),
        rounded(median(interpolate), 2).alias("median_area_sqm"),
        F.min(VALUE).alias("min_area_sqm"),
        F.max(VALUE).alias("max_area_sqm"),
        _total("sqm", 2).alias("total_area_sqm"),
    )
    return _mart(summary, "property_overview")
