"""The registered queries: library functions applied to whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicmart.contracts import CLEAN, MART, conform, contract
from civicmart.functions import cells, display, tiers
from civicmart.operators.medians import exact_median
from civicmart.operators.series import months_earlier, pivot_found
from civicmart.operators.shaping import contains_any, dimension_values, rename_present
from civicmart.plans import gold, pipeline, serving, silver
from civicmart.session import bounded_sorts, scratch_dir, staged
from civicmart.sinks.catalog import catalog_columns, create_tables, insert_table
from civicmart.sinks.tables import export_parquet, layer_summary, replace_table
from civicmart.sources.extracts import EXTRACTS, profile, read_csv, read_extract, read_present
from civicmart.sources.layers import MissingTableError, read_mart, read_table
from civicmart.workload import standins as raw

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

SERVED_YEARS = (1998, 2000)
SERVED_WARDS = ("3", "7", "11", "19")
SERVED_TYPES = ("A", "R")
OVERVIEW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Display figures; sums of doubles are exact, so rounding them gives the same on every run."""
    return df.withColumns({c: cells.rounded(c, digits) for c in columns})


# ---- cleaned and reporting tables over the stand-ins ------------------------------------


def _permits(spark: SparkSession, sf: str) -> DataFrame:
    return silver.building_permits(*raw.permit_extracts(spark, sf))


def _parcels(spark: SparkSession, sf: str) -> DataFrame:
    return silver.properties(raw.parcel_extract(spark, sf))


def _buildings(spark: SparkSession, sf: str) -> DataFrame:
    return silver.apartment_buildings(raw.registration_extract(spark, sf), raw.evaluation_extract(spark, sf))


def _index(spark: SparkSession, sf: str) -> DataFrame:
    return silver.housing_price_index(raw.index_extract(spark, sf))


CLEAN_BUILDERS = {
    "building_permits": _permits,
    "properties": _parcels,
    "apartment_buildings": _buildings,
    "housing_price_index": _index,
}
MART_BUILDERS = {
    "permit_trends": (lambda df: gold.permit_trends(df, raw.FIRST_YEAR, one_row_per_permit=True), "building_permits"),
    "construction_investment": (lambda df: gold.construction_investment(df, raw.FIRST_YEAR), "building_permits"),
    "housing_development": (lambda df: gold.housing_development(df, raw.FIRST_YEAR), "building_permits"),
    "apartment_scorecard": (gold.apartment_scorecard, "apartment_buildings"),
    "price_index_trends": (gold.price_index_trends, "housing_price_index"),
    "property_overview": (gold.property_overview, "properties"),
}

_lakes: dict[tuple[str, str], str] = {}
_stored: set[tuple[str, str, str]] = set()


def mart(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """A reporting table computed from its stored cleaned table."""
    build, source = MART_BUILDERS[table]
    return build(stored(spark, sf, CLEAN, source))


def stored(spark: SparkSession, sf: str, layer: str, table: str) -> DataFrame:
    """A layer table as the pipeline leaves it: written once per session, then read."""
    lake = _lakes.setdefault((spark.sparkContext.applicationId, sf), scratch_dir(spark, "lake"))
    if (lake, layer, table) in _stored:
        try:
            return read_table(spark, lake, layer, table)
        except MissingTableError:  # the shared folder was cleared meanwhile
            pass
    df = CLEAN_BUILDERS[table](spark, sf) if layer == CLEAN else mart(spark, sf, table)
    with bounded_sorts(spark):
        replace_table(df, lake, layer, table)
    _stored.add((lake, layer, table))
    return read_table(spark, lake, layer, table)


def _trends(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, MART, "permit_trends")


def _investment(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, MART, "construction_investment")


def _scorecard(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, MART, "apartment_scorecard")


def _housing(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, MART, "housing_development")


def _index_trends(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, MART, "price_index_trends")


def _overview(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, MART, "property_overview")


def _computed(df: DataFrame, label: str) -> DataFrame:
    """The result of a plan that sorts what it reads, computed from small splits."""
    with bounded_sorts(df.sparkSession):
        return staged(df, label)


def _flagged(df: DataFrame, stamp: str) -> DataFrame:
    """The load time differs by run, so only its presence is compared."""
    return df.withColumn("stamped", F.col(stamp).isNotNull().cast("int")).drop(stamp)


# A packed file is read by one task, so its rows are bounded.
PACKED_ROWS = 500_000


def _csv(df: DataFrame, path: str, packed: bool = False) -> None:
    """Write a raw extract: header, quotes where needed, quotes doubled, blanks kept; on request in packed part files."""
    writer = df.write.option("compression", "gzip").option("maxRecordsPerFile", PACKED_ROWS) if packed else df.write
    (
        writer.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


# ---- sources and sinks ------------------------------------------------------------------


@registered
def bronze_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The price index written as CSV with a byte order mark, then landed."""
    raw_dir = scratch_dir(spark, "raw")
    extract = EXTRACTS["housing_price_index"]
    marked = raw.index_extract(spark, sf).withColumnRenamed("REF_DATE", "﻿REF_DATE")
    _csv(marked, f"{raw_dir}/{extract.file}")
    landed = read_extract(spark, extract, raw_dir)
    return landed.select(
        *[F.col(f"`{c}`").alias(c.replace(" ", "_")) for c in raw.index_extract(spark, sf).columns],
        F.col("_source").alias("source"),
        F.col("_source_file").contains("18100205").cast("int").alias("has_file"),
        F.col("_ingestion_timestamp").isNotNull().cast("int").alias("stamped"),
    )


def _text_cells(spark: SparkSession, sf: str, **options) -> DataFrame:
    path = scratch_dir(spark, "texts")
    documents = raw.table(spark, sf, "documents")
    _csv(documents.select("doc_id", "lang", "source", "text"), path)
    return read_csv(spark, path, **options).select(
        cells.as_long("doc_id").alias("doc_id"), "lang", "source", F.md5("text").alias("text_md5")
    )


@registered
def csv_multiline_text(spark: SparkSession, sf: str) -> DataFrame:
    """Whole document texts through CSV cells with quotes and line breaks, a file a task."""
    return _text_cells(spark, sf, multi_line=True)


@registered
def csv_stitched_text(spark: SparkSession, sf: str) -> DataFrame:
    """The same file read in splits, its records joined from physical lines."""
    return _text_cells(spark, sf)


@registered
def csv_stray_quotes(spark: SparkSession, sf: str) -> DataFrame:
    """Part files of lines with quotes inside unquoted cells, beside one with line breaks in quoted cells."""
    path = scratch_dir(spark, "quotes")
    line = F.concat_ws(",", "p_partkey", F.concat("p_size", F.lit('" pipe')), "p_brand", F.concat("p_size", F.lit('"')))
    part = raw.table(spark, sf, "part")
    lines = part.filter("p_partkey % 2 = 0").select(line.alias("id,size,brand,inch"))
    lines.write.option("header", True).option("quote", "").option("sep", "\u0001").csv(path)
    quoted = part.filter("p_partkey % 2 = 1").select(
        F.col("p_partkey").alias("id"),
        F.concat("p_size", F.lit('" pipe')).alias("size"),
        F.concat("p_brand", F.lit('\n"x", y')).alias("brand"),
        F.concat("p_size", F.lit('"')).alias("inch"),
    )
    quoted.write.mode("append").option("header", True).option("escape", '"').csv(path)
    return read_csv(spark, path).withColumn("id", cells.as_long("id"))


@registered
def kpi_row_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """The key figures of the chosen years, wards and kinds of permit."""
    figures = serving.key_figures(
        filtered_permits(spark, sf), filtered_investment(spark, sf), filtered_housing(spark, sf),
        _scorecard(spark, sf), _overview(spark, sf),
    )
    return _rounded(_rounded(figures, 2, "total_investment"), 4, "avg_score")


@registered
def permits_by_type_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return serving.permits_by_type(filtered_permits(spark, sf))


@registered
def investment_by_category_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(serving.investment_by_category(filtered_investment(spark, sf)), 2, "total_investment")


@registered
def units_by_year_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return serving.units_by_year(filtered_housing(spark, sf))


@registered
def bronze_missing_source(spark: SparkSession, sf: str) -> DataFrame:
    """Two of eight extracts exist; the others are left out."""
    raw_dir = scratch_dir(spark, "raw")
    active, cleared = raw.permit_extracts(spark, sf)
    _csv(active, f"{raw_dir}/{EXTRACTS['permits_active'].file}", packed=True)
    _csv(cleared, f"{raw_dir}/{EXTRACTS['permits_cleared'].file}", packed=True)
    return layer_summary(read_present(spark, raw_dir))


@registered
def source_profile(spark: SparkSession, sf: str) -> DataFrame:
    raw_dir = scratch_dir(spark, "raw")
    _csv(raw.registration_extract(spark, sf), f"{raw_dir}/{EXTRACTS['apartment_registration'].file}")
    _csv(raw.evaluation_extract(spark, sf), f"{raw_dir}/{EXTRACTS['apartment_evaluations'].file}")
    sized = profile(spark, raw_dir)
    return sized.select("table_name", "rows", (F.col("bytes") > 0).cast("int").alias("has_bytes"))


@registered
def layer_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A reporting table written twice, read under its contract, copied and read again."""
    lake = scratch_dir(spark, "lake")
    overview = _overview(spark, sf)
    replace_table(overview, lake, MART, "property_overview")
    rows = replace_table(gold.presented(overview, "property_overview"), lake, MART, "property_overview")
    stored = read_mart(spark, lake, "property_overview")
    export_parquet(stored, f"{lake}/export/property_overview.parquet")
    copied = read_table(spark, lake, "export", "property_overview.parquet")
    return copied.withColumn("rows_written", F.lit(rows).cast("bigint"))


@registered
def catalog_layers(spark: SparkSession, sf: str) -> DataFrame:
    """All catalog tables, the cleaned and reporting ones filled: every column with its known cells, read by name."""
    namespace = f"made_{uuid.uuid4().hex[:12]}_"
    create_tables(spark, namespace=namespace)
    filled = []
    for layer, names in ((CLEAN, CLEAN_BUILDERS), (MART, MART_BUILDERS)):
        for table in names:
            insert_table(stored(spark, sf, layer, table), layer, table, namespace)
            df = spark.table(f"{namespace}{layer}.{table}")
            known = df.agg(*[F.count(f"`{c}`").alias(c) for c in df.columns])
            cells_ = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("filled")) for c in df.columns])
            filled.append(known.select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), F.explode(cells_).alias("c")))
    counted = reduce(DataFrame.unionByName, filled).select("layer", "table_name", "c.column", "c.filled")
    listed = spark.createDataFrame(
        catalog_columns(spark, namespace), "layer string, table_name string, position int, column string, type string"
    )
    return listed.join(counted, ["layer", "table_name", "column"], "left").na.fill(0, ["filled"])


@registered
def rejected_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells with text that did not parse, per typed column, counted while the cleaned tables are computed."""
    rejections = silver.Rejections()
    cleaned = [
        silver.building_permits(*raw.permit_extracts(spark, sf), watch=rejections),
        silver.properties(raw.parcel_extract(spark, sf), watch=rejections),
        silver.apartment_buildings(raw.registration_extract(spark, sf), raw.evaluation_extract(spark, sf), watch=rejections),
        silver.housing_price_index(raw.index_extract(spark, sf), watch=rejections),
    ]
    for df in cleaned:
        with bounded_sorts(spark):
            df.write.format("noop").mode("overwrite").save()
    return rejections.frame(spark)


@registered
def pipeline_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files to raw, cleaned and reporting tables; the rows that each write reported, and that are read back."""
    raw_dir, lake = scratch_dir(spark, "raw"), scratch_dir(spark, "lake")
    active, cleared = raw.permit_extracts(spark, sf)
    extracts = {
        "permits_active": active,
        "permits_cleared": cleared,
        "property_boundaries": raw.parcel_extract(spark, sf),
        "building_assets": raw.asset_extract(spark, sf),
        "apartment_registration": raw.registration_extract(spark, sf),
        "apartment_evaluations": raw.evaluation_extract(spark, sf),
        "housing_price_index": raw.index_extract(spark, sf),
    }
    for name, df in extracts.items():
        _csv(df, f"{raw_dir}/{EXTRACTS[name].file}", packed=True)
    written = [
        (layer, table, rows)
        for layer, counts in pipeline.run(spark, raw_dir, lake, first_year=raw.FIRST_YEAR).items()
        for table, rows in counts.items()
    ]
    reported = spark.createDataFrame(written, "layer string, table_name string, written long")
    read = [
        read_table(spark, lake, layer, table).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "rows"
        )
        for layer, table, _ in written
    ]
    return reported.join(reduce(DataFrame.unionByName, read), ["layer", "table_name"])


@registered
def layer_table_summary(spark: SparkSession, sf: str) -> DataFrame:
    return layer_summary({name: raw.table(spark, sf, name) for name in OVERVIEW_TABLES})


@registered
def contract_conform(spark: SparkSession, sf: str) -> DataFrame:
    """Columns out of order, narrower types, one optional column missing, one too many."""
    loose = raw.table(spark, sf, "part").select(
        F.lit("spare").alias("not_in_contract"),
        F.col("p_size").alias("object_id"),
        F.col("p_name").alias("street_name"),
        F.col("p_retailprice").alias("stated_area_sqm"),
        F.col("p_partkey").cast("string").alias("parcel_id"),
        F.col("p_type").alias("feature_type"),
        F.col("p_size").alias("stated_area_sqft"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("p_size")).alias("date_effective"),
        F.col("p_brand").alias("full_address"),
    )
    return conform(loose, contract(CLEAN, "properties"), ("address_number", "_silver_timestamp")).drop(
        "_silver_timestamp"
    )


# ---- scalar functions -------------------------------------------------------------------


@registered
def safe_casts(spark: SparkSession, sf: str) -> DataFrame:
    moment = F.col("ts").cast("date").cast("string")
    value = F.col("value").cast("string")
    return raw.table(spark, sf, "events").select(
        "event_id",
        cells.as_int(value).alias("value_int"),
        cells.as_int("props").alias("props_int"),
        cells.as_int(F.concat(F.col("event_id").cast("string"), F.lit("9999999"))).alias("wide_int"),
        cells.as_long(F.concat(F.lit("900719925474099"), F.col("user_id").cast("string"))).alias("wide_long"),
        cells.as_double(F.when(F.col("event_id") % 3 == 0, F.lit("NaN")).otherwise(value)).alias("value_double"),
        cells.as_double(F.concat(value, F.lit(",5"))).alias("comma_double"),
        cells.as_date(moment).alias("day"),
        cells.as_date(F.replace(moment, F.lit("-"), F.lit("/")), "yyyy/MM/dd").alias("slashed_day"),
        cells.as_date("event_type").alias("junk_day"),
        cells.month_start(F.substring(moment, 1, 7)).alias("month"),
    )


@registered
def string_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    part = raw.table(spark, sf, "part")
    unit = F.when(F.col("p_size") % 3 == 0, F.col("p_brand"))
    chosen = rename_present(part, {"p_partkey": "part_id", "p_name": "name", "p_brand": "brand", "absent": "absent"})
    shaped = part.select(
        F.col("p_partkey").alias("part_id"),
        cells.tidy(F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).alias("tidied"),
        cells.unquoted(F.concat(F.lit('" '), F.col("p_type"), F.lit('"'))).alias("unquoted"),
        cells.prefix("p_brand").alias("prefix"),
        cells.spaced("p_name", unit, "p_type").alias("joined"),
        F.coalesce(unit, F.col("p_type")).alias("first_known"),
        cells.or_zero(F.when(F.col("p_size") % 2 == 0, F.col("p_size"))).alias("size_or_zero"),
        cells.has_text(F.when(F.col("p_size") % 4 == 0, F.lit("  ")).otherwise(F.col("p_name")))
        .cast("int").alias("has_text"),
    )
    return chosen.join(shaped, "part_id")


@registered
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    return raw.table(spark, sf, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("year"),
        F.quarter("o_orderdate").alias("quarter"),
        F.month("o_orderdate").alias("month"),
        F.current_timestamp().isNotNull().cast("int").alias("stamped"),
    )


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores from 0 to 100 that hit every edge, some missing."""
    score = F.when(F.col("l_partkey") % 17 != 0, F.round(F.abs("l_discount") * 1000))
    return raw.table(spark, sf, "lineitem").select(
        score.alias("score"), (F.col("l_extendedprice") * F.pow(F.lit(10.0), F.col("l_linenumber") - 4)).alias("cost")
    )


@registered
def tier_left_closed(spark: SparkSession, sf: str) -> DataFrame:
    tiered = _scores(spark, sf).select(
        "score",
        tiers.quality_tier(F.col("score")).alias("tier"),
        tiers.quality_tier(F.col("score"), None).alias("tier_or_null"),
        tiers.investment_category(F.col("cost")).alias("category"),
    )
    return tiered.groupBy(*tiered.columns).agg(F.count("*").alias("rows"))


@registered
def bin_right_closed(spark: SparkSession, sf: str) -> DataFrame:
    binned = _scores(spark, sf).select(
        "score",
        tiers.right_closed_bin(F.col("score"), tiers.QUALITY_TIERS, tiers.QUALITY_FLOOR).alias("bin"),
        tiers.right_closed_bin(F.col("cost"), tiers.INVESTMENT_TIERS, tiers.INVESTMENT_FLOOR).alias("category"),
    )
    return binned.groupBy(*binned.columns).agg(F.count("*").alias("rows"))


@registered
def abbreviate_numbers(spark: SparkSession, sf: str) -> DataFrame:
    factor = F.element_at(
        F.array(*[F.lit(x) for x in (0.001, 1.0, -10.0, 1000.0, 100000.0)]), (F.col("o_custkey") % 5 + 1).cast("int")
    )
    amount = F.when(F.col("o_custkey") % 11 != 0, F.col("o_totalprice") * factor)
    orders = raw.table(spark, sf, "orders").select("o_orderkey", amount.alias("amount"))
    return orders.select(
        "o_orderkey",
        display.currency_text(F.col("amount")).alias("currency_text"),
        display.count_text(F.col("amount")).alias("count_text"),
        display.as_loss(F.col("amount")).alias("as_loss"),
    )


# ---- cleaned tables ---------------------------------------------------------------------


@registered
def silver_properties(spark: SparkSession, sf: str) -> DataFrame:
    return _computed(_flagged(_parcels(spark, sf), silver.STAMP), "properties")


@registered
def silver_building_assets(spark: SparkSession, sf: str) -> DataFrame:
    return silver.building_assets(raw.asset_extract(spark, sf))


@registered
def silver_permits(spark: SparkSession, sf: str) -> DataFrame:
    return _computed(_flagged(_permits(spark, sf), silver.STAMP), "permits")


@registered
def silver_permits_filled(spark: SparkSession, sf: str) -> DataFrame:
    """Net units with an unknown side counted as 0."""
    filled = silver.building_permits(*raw.permit_extracts(spark, sf), fill_null=True)
    return _computed(filled.select("permit_number", "net_dwelling_units"), "filled")


@registered
def silver_apartments(spark: SparkSession, sf: str) -> DataFrame:
    return _computed(_flagged(_buildings(spark, sf), silver.STAMP), "buildings")


@registered
def silver_price_index(spark: SparkSession, sf: str) -> DataFrame:
    return _flagged(_index(spark, sf), silver.STAMP)


@registered
def keyword_filter(spark: SparkSession, sf: str) -> DataFrame:
    index = raw.index_extract(spark, sf)
    kept = index.filter(silver.in_province_by_keyword(F.col("GEO")))
    return kept.groupBy("GEO").agg(F.count("*").alias("rows")).withColumnRenamed("GEO", "geography")


@registered
def keyword_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose whole text holds any of a few words."""
    documents = raw.table(spark, sf, "documents")
    return documents.filter(contains_any(F.col("text"), ("the", "license", "und"))).select("doc_id", "lang")


# ---- reporting tables -------------------------------------------------------------------


@registered
def flagship_permit_trends(spark: SparkSession, sf: str) -> DataFrame:
    """From raw permit cells to the reporting table in one plan, nothing stored between; the result is."""
    return _computed(gold.permit_trends(_permits(spark, sf), raw.FIRST_YEAR), "trends")


@registered
def gold_permit_trends(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf, "permit_trends")


@registered
def gold_construction_investment(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf, "construction_investment")


@registered
def gold_apartment_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf, "apartment_scorecard")


@registered
def gold_housing_development(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf, "housing_development")


@registered
def gold_price_index_trends(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf, "price_index_trends")


@registered
def gold_property_overview(spark: SparkSession, sf: str) -> DataFrame:
    return mart(spark, sf, "property_overview")


@registered
def pivot_discovered(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["reference_date", "ref_period", "geography"]
    return pivot_found(stored(spark, sf, CLEAN, "housing_price_index"), keys, "index_type", "index_value", gold.index_column)


@registered
def calendar_year_ago(spark: SparkSession, sf: str) -> DataFrame:
    """Change against the same month a year before, whatever rows are missing between."""
    trends = _index_trends(spark, sf).select("reference_date", "geography", "index_total")
    ago = months_earlier(trends, ["geography"], "reference_date", "index_total", 12, "index_year_ago")
    return ago.withColumn("yoy_change_pct", cells.percent_change("index_total", "index_year_ago"))


@registered
def exact_median_by_group(spark: SparkSession, sf: str) -> DataFrame:
    lines = raw.table(spark, sf, "lineitem")
    keys = ["l_returnflag", "l_linenumber"]
    return _rounded(exact_median(lines, keys, "l_extendedprice", "median_price", interpolate=True), 4, "median_price")


@registered
def exact_median_overall(spark: SparkSession, sf: str) -> DataFrame:
    """One group that holds every row."""
    orders = raw.table(spark, sf, "orders")
    return exact_median(orders, [], "o_totalprice", "lower_median")


# ---- serving queries --------------------------------------------------------------------


@registered
def kpi_row(spark: SparkSession, sf: str) -> DataFrame:
    figures = serving.key_figures(
        _trends(spark, sf), _investment(spark, sf), _housing(spark, sf), _scorecard(spark, sf), _overview(spark, sf)
    )
    return _rounded(_rounded(figures, 2, "total_investment"), 4, "avg_score")


@registered
def year_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return serving.year_bounds(_trends(spark, sf))


@registered
def filter_options(spark: SparkSession, sf: str) -> DataFrame:
    return serving.filter_options(_trends(spark, sf), _index_trends(spark, sf))


@registered
def default_geographies(spark: SparkSession, sf: str) -> DataFrame:
    return dimension_values(_index_trends(spark, sf), "geography", serving.DEFAULT_GEOGRAPHIES)


@registered
def filtered_permits(spark: SparkSession, sf: str) -> DataFrame:
    return serving.filtered_permits(_trends(spark, sf), SERVED_YEARS, SERVED_WARDS, SERVED_TYPES)


@registered
def filtered_investment(spark: SparkSession, sf: str) -> DataFrame:
    return serving.filtered_by_ward(_investment(spark, sf), SERVED_YEARS, SERVED_WARDS)


@registered
def filtered_housing(spark: SparkSession, sf: str) -> DataFrame:
    return serving.filtered_by_ward(_housing(spark, sf), SERVED_YEARS, [])


@registered
def permits_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return serving.permits_by_year(_trends(spark, sf))


@registered
def permits_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return serving.permits_by_type(_trends(spark, sf))


@registered
def top_structures(spark: SparkSession, sf: str) -> DataFrame:
    return serving.top_structures(_trends(spark, sf), 3)


@registered
def top_wards(spark: SparkSession, sf: str) -> DataFrame:
    return serving.top_wards(_trends(spark, sf))


@registered
def investment_by_year(spark: SparkSession, sf: str) -> DataFrame:
    by_year = serving.investment_by_year(_investment(spark, sf))
    return _rounded(by_year, 2, "total_investment", "avg_investment")


@registered
def investment_by_category(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(serving.investment_by_category(_investment(spark, sf)), 2, "total_investment")


@registered
def top_uses(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(serving.top_uses(_investment(spark, sf), 5), 2, "total_investment")


@registered
def units_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return serving.units_by_year(_housing(spark, sf))


@registered
def top_structures_net(spark: SparkSession, sf: str) -> DataFrame:
    return serving.top_structures_net(_housing(spark, sf), 3)


@registered
def top_wards_net(spark: SparkSession, sf: str) -> DataFrame:
    return serving.top_wards_net(_housing(spark, sf))


@registered
def scorecard_table(spark: SparkSession, sf: str) -> DataFrame:
    return serving.scorecard_table(_scorecard(spark, sf))


@registered
def tier_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return serving.tier_distribution(_scorecard(spark, sf))


@registered
def score_vs_age(spark: SparkSession, sf: str) -> DataFrame:
    return serving.score_vs_age(_scorecard(spark, sf))


@registered
def index_series(spark: SparkSession, sf: str) -> DataFrame:
    """Total index of the default geographies."""
    return serving.index_series(_index_trends(spark, sf))


@registered
def index_series_house(spark: SparkSession, sf: str) -> DataFrame:
    return serving.index_series(_index_trends(spark, sf), "index_house", ["Toronto", "Windsor"])


@registered
def index_series_land(spark: SparkSession, sf: str) -> DataFrame:
    return serving.index_series(_index_trends(spark, sf), "index_land", [])


@registered
def yoy_series(spark: SparkSession, sf: str) -> DataFrame:
    return serving.yoy_series(_index_trends(spark, sf), [])


@registered
def properties_by_count(spark: SparkSession, sf: str) -> DataFrame:
    return serving.properties_by(_overview(spark, sf), "property_count")


@registered
def properties_by_area(spark: SparkSession, sf: str) -> DataFrame:
    return serving.properties_by(_overview(spark, sf), "avg_area_sqft")
