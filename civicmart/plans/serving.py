"""Parameterised queries over the reporting tables.

Roll-ups leave rows without a key out and count missing measures as 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicmart.functions import display
from civicmart.functions.cells import exact_avg, exact_sum
from civicmart.operators.shaping import (
    bounds,
    dimension_values,
    keep_chosen,
    keep_years,
    present_columns,
    roll_up,
    top_k,
)

Years = tuple[int, int] | None
Chosen = Sequence[str] | None

# Fixed value: columns of the scorecard listing.
SCORECARD_COLUMNS = (
    "ward", "property_type", "building_count", "avg_eval_score", "avg_proactive_score",
    "avg_reactive_score", "total_units", "avg_building_age", "quality_tier",
)
DEFAULT_GEOGRAPHIES = 5  # fixed value


def filtered_permits(
    trends: DataFrame, years: Years = None, wards: Chosen = None, permit_types: Chosen = None
) -> DataFrame:
    return keep_chosen(keep_years(trends, years), {"ward": wards, "permit_type": permit_types})


def filtered_by_ward(df: DataFrame, years: Years = None, wards: Chosen = None) -> DataFrame:
    """Investment or housing rows of the chosen years and wards."""
    return keep_chosen(keep_years(df, years), {"ward": wards})


def key_figures(
    trends: DataFrame, investment: DataFrame, housing: DataFrame, scorecard: DataFrame, overview: DataFrame
) -> DataFrame:
    """One row of five figures and their display text.

    Each table is reduced to one row; the rows are stacked and folded, so no
    frames have to be multiplied.  The score is the mean of the group means.
    """
    parts = [
        trends.agg(F.coalesce(F.sum("permit_count"), F.lit(0)).alias("total_permits")),
        investment.agg(F.coalesce(exact_sum("total_investment"), F.lit(0.0)).alias("total_investment")),
        housing.agg(F.coalesce(F.sum("net_units"), F.lit(0)).alias("net_units")),
        scorecard.agg(F.coalesce(exact_avg("avg_eval_score"), F.lit(0.0)).alias("avg_score")),
        overview.agg(F.coalesce(F.sum("property_count"), F.lit(0)).alias("total_properties")),
    ]
    names = [part.columns[0] for part in parts]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    figures = stacked.agg(*[F.max(name).alias(name) for name in names])
    return figures.select(
        *names,
        display.count_text(F.col("total_permits")).alias("total_permits_text"),
        display.currency_text(F.col("total_investment")).alias("total_investment_text"),
        display.count_text(F.col("net_units")).alias("net_units_text"),
        F.concat(display.fixed_text(F.col("avg_score"), 1), F.lit("/100")).alias("avg_score_text"),
        display.count_text(F.col("total_properties")).alias("total_properties_text"),
    )


def permits_by_year(trends: DataFrame) -> DataFrame:
    sums = {"permit_count": "permit_count", "unique_permits": "unique_permits"}
    return roll_up(trends, "application_year", sums)


def permits_by_type(trends: DataFrame) -> DataFrame:
    counts = roll_up(trends, "permit_type", {"permit_count": "permit_count"})
    return counts.orderBy(F.desc("permit_count"), "permit_type")


def top_structures(trends: DataFrame, k: int = 10) -> DataFrame:
    counts = roll_up(trends, "structure_type", {"permit_count": "permit_count"})
    return top_k(counts, "permit_count", k, "structure_type")


def top_wards(trends: DataFrame, k: int = 15) -> DataFrame:
    counts = roll_up(trends, "ward", {"permit_count": "permit_count"})
    return top_k(counts, "permit_count", k, "ward", ascending=True)


def investment_by_year(investment: DataFrame) -> DataFrame:
    sums = {"total_investment": "total_investment", "project_count": "project_count"}
    return roll_up(investment, "application_year", sums, {"avg_investment": "avg_investment"})


def investment_by_category(investment: DataFrame) -> DataFrame:
    sums = {"project_count": "project_count", "total_investment": "total_investment"}
    return roll_up(investment, "investment_category", sums)


def top_uses(investment: DataFrame, k: int = 10) -> DataFrame:
    totals = roll_up(investment, "current_use", {"total_investment": "total_investment"}).na.drop()
    return top_k(totals, "total_investment", k, "current_use", ascending=True)


def units_by_year(housing: DataFrame) -> DataFrame:
    sums = {"units_created": "units_created", "units_lost": "units_lost", "net_units": "net_units"}
    totals = roll_up(housing, "application_year", sums)
    return totals.withColumn("units_lost", display.as_loss(F.col("units_lost")))


def top_structures_net(housing: DataFrame, k: int = 10) -> DataFrame:
    totals = roll_up(housing, "structure_type", {"net_units": "net_units"}).na.drop()
    return top_k(totals, "net_units", k, "structure_type", ascending=True)


def top_wards_net(housing: DataFrame, k: int = 15) -> DataFrame:
    totals = roll_up(housing, "ward", {"net_units": "net_units"})
    return top_k(totals, "net_units", k, "ward", ascending=True)


def scorecard_table(scorecard: DataFrame) -> DataFrame:
    shown = present_columns(scorecard, SCORECARD_COLUMNS)
    return shown.orderBy(F.desc("building_count"), "ward", "property_type")


def tier_distribution(scorecard: DataFrame) -> DataFrame:
    return roll_up(scorecard, "quality_tier", {"building_count": "building_count"})


def score_vs_age(scorecard: DataFrame) -> DataFrame:
    plotted = scorecard.na.drop(subset=["avg_eval_score", "avg_building_age"])
    return plotted.select("avg_building_age", "avg_eval_score", "total_units", "quality_tier")


def _chosen_geographies(index: DataFrame, geographies: Chosen) -> DataFrame:
    """None selects the first few geographies by name, an empty list all of them."""
    if geographies is not None:
        return keep_chosen(index, {"geography": geographies})
    first = dimension_values(index, "geography", DEFAULT_GEOGRAPHIES)
    # The hinted side is cut to five names above.
    return index.join(F.broadcast(first), "geography", "left_semi")


def index_series(index: DataFrame, measure: str = "index_total", geographies: Chosen = None) -> DataFrame:
    """One measure (total, house, land or yearly change) over time per geography."""
    chosen = _chosen_geographies(index, geographies)
    return chosen.na.drop(subset=[measure]).select("reference_date", "geography", measure)


def yoy_series(index: DataFrame, geographies: Chosen = None) -> DataFrame:
    return index_series(index, "yoy_change_pct", geographies)


def properties_by(overview: DataFrame, measure: str) -> DataFrame:
    """Feature types by one measure, smallest first."""
    return overview.select("feature_type", measure).orderBy(F.asc(measure), "feature_type")


def year_bounds(trends: DataFrame) -> DataFrame:
    return bounds(trends, "application_year", "first_year", "last_year")


def _option(name: str) -> Column:
    return F.struct(F.lit(name).alias("dimension"), F.col(name).cast("string").alias("option"))


def filter_options(trends: DataFrame, index: DataFrame) -> DataFrame:
    """Every value a reader can filter by, as (dimension, option) rows."""
    lists = [(trends, ["application_year", "ward", "permit_type"]), (index, ["geography"])]
    # One scan per table: each row gives one row per dimension, most of which fall to the map-side distinct.
    options = [
        df.select(F.explode(F.array(*[_option(name) for name in names])).alias("o")).select("o.*").na.drop().distinct()
        for df, names in lists
    ]
    return reduce(DataFrame.unionByName, options).orderBy("dimension", "option")
