"""Table contracts of the three layers and the check that a frame meets them."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RAW, CLEAN, MART = "bronze", "silver", "gold"

AUDIT_COLUMNS = ("_ingestion_timestamp", "_source", "_source_file")

# The column names of the raw extracts.  Every cell lands as text.
_RAW_COLUMNS = {
    "property_boundaries": (
        "PARCELID, FEATURE_TYPE, DATE_EFFECTIVE, DATE_EXPIRY, STATEDAREA, ADDRESS_NUMBER, "
        "LINEAR_NAME_FULL, OBJECTID, TRANS_ID_CREATE, TRANS_ID_EXPIRE, geometry"
    ),
    "permits_active": (
        "PERMIT_NUM, REVISION_NUM, PERMIT_TYPE, STRUCTURE_TYPE, WORK, STREET_NUM, STREET_NAME, "
        "STREET_TYPE, STREET_DIRECTION, POSTAL, GEO_ID, WARD_GRID, APPLICATION_DATE, ISSUED_DATE, "
        "COMPLETED_DATE, STATUS, DESCRIPTION, CURRENT_USE, PROPOSED_USE, DWELLING_UNITS_CREATED, "
        "DWELLING_UNITS_LOST, EST_CONST_COST, ASSEMBLY, INSTITUTIONAL, RESIDENTIAL, "
        "BUSINESS_AND_PERSONAL_SERVICES, MERCANTILE, INDUSTRIAL, INTERIOR_ALTERATIONS, DEMOLITION, "
        "BUILDER_NAME"
    ),
    "building_assets": (
        "FLOC_ID, Building Description, Address, City, Ward Name, Former Municipality, District, "
        "City Cluster, Building Type, Building Status, Jurisdiction, Management, Owner, "
        "Gross Floor Area (M2), Gross Floor Area (FT2), Year Built, WARD, geometry"
    ),
    "land_assets": (
        "FLOC_ID, Property Description, Address, City, Ward Name, Former Municipality, District, "
        "Property Type, Property Status, Area (M2), Area (FT2), Frontage (M), Depth (M), OBJECTID, "
        "geometry"
    ),
    "apartment_registration": (
        "RSN, SITE_ADDRESS, PROPERTY_TYPE, WARD, YEAR_BUILT, YEAR_REGISTERED, CONFIRMED_UNITS, "
        "CONFIRMED_STOREYS, HEATING_TYPE, AIR_CONDITIONING_TYPE, PCODE, NO_OF_STOREYS, NO_OF_UNITS, "
        "PARKING_TYPE, NO_OF_ELEVATORS, PETS_ALLOWED, LAUNDRY_ROOM, BIKE_PARKING"
    ),
    "apartment_evaluations": (
        "RSN, YEAR EVALUATED, CURRENT BUILDING EVAL SCORE, PROACTIVE BUILDING SCORE, "
        "CURRENT REACTIVE SCORE, NO OF AREAS EVALUATED, LATITUDE, LONGITUDE, CONFIRMED STOREYS, "
        "CONFIRMED UNITS"
    ),
    "housing_price_index": "REF_DATE, GEO, DGUID, New housing price indexes, UOM, VALUE, STATUS",
}
_RAW_COLUMNS["permits_cleared"] = _RAW_COLUMNS["permits_active"]

# Names and types of the cleaned and the reporting tables.
_TYPED = {
    (CLEAN, "properties"): """
        parcel_id STRING, feature_type STRING, date_effective DATE, stated_area_sqm DOUBLE,
        address_number STRING, street_name STRING, full_address STRING, object_id BIGINT,
        stated_area_sqft DOUBLE, _silver_timestamp TIMESTAMP""",
    (CLEAN, "building_permits"): """
        permit_number STRING, revision_number INT, permit_type STRING, structure_type STRING,
        work_type STRING, street_number STRING, street_name STRING, street_type STRING,
        street_direction STRING, postal_code STRING, geo_id BIGINT, ward STRING,
        application_date DATE, issued_date DATE, completed_date DATE, status STRING,
        description STRING, current_use STRING, proposed_use STRING, dwelling_units_created INT,
        dwelling_units_lost INT, estimated_construction_cost DOUBLE, full_address STRING,
        application_year INT, application_quarter INT, net_dwelling_units INT,
        postal_prefix STRING, _permit_source STRING, _silver_timestamp TIMESTAMP""",
    (CLEAN, "apartment_buildings"): """
        rsn BIGINT, address STRING, property_type STRING, ward STRING, year_built INT,
        year_registered INT, storeys INT, units INT, heating_type STRING, ac_type STRING,
        parking_type STRING, elevators INT, pets_allowed STRING, has_laundry STRING,
        has_bike_parking STRING, postal_code STRING, year_evaluated INT, eval_score DOUBLE,
        proactive_score DOUBLE, reactive_score DOUBLE, areas_evaluated INT, latitude DOUBLE,
        longitude DOUBLE, building_age INT, units_per_storey DOUBLE, postal_prefix STRING,
        _silver_timestamp TIMESTAMP""",
    (CLEAN, "housing_price_index"): """
        reference_date DATE, ref_period STRING, geography STRING, index_type STRING,
        index_value DOUBLE, data_quality_flag STRING, ref_year INT, ref_month INT,
        ref_quarter INT, _silver_timestamp TIMESTAMP""",
    (MART, "permit_trends"): """
        application_year INT, application_quarter INT, ward STRING, permit_type STRING,
        structure_type STRING, work_type STRING, status STRING, permit_count BIGINT,
        avg_construction_cost DOUBLE, total_construction_cost DOUBLE, total_units_created BIGINT,
        total_units_lost BIGINT, net_dwelling_units BIGINT, unique_permits BIGINT""",
    (MART, "construction_investment"): """
        application_year INT, application_quarter INT, ward STRING, current_use STRING,
        proposed_use STRING, project_count BIGINT, total_investment DOUBLE,
        avg_investment DOUBLE, median_investment DOUBLE, max_investment DOUBLE,
        units_created BIGINT, investment_category STRING""",
    (MART, "apartment_scorecard"): """
        ward STRING, property_type STRING, building_count BIGINT, avg_eval_score DOUBLE,
        avg_proactive_score DOUBLE, avg_reactive_score DOUBLE, avg_units DOUBLE,
        avg_storeys DOUBLE, avg_building_age DOUBLE, total_units BIGINT, total_elevators BIGINT,
        avg_year_built DOUBLE, oldest_building INT, newest_building INT, quality_tier STRING""",
    (MART, "housing_development"): """
        application_year INT, application_quarter INT, ward STRING, structure_type STRING,
        proposed_use STRING, permit_count BIGINT, units_created BIGINT, units_lost BIGINT,
        net_units BIGINT, total_cost DOUBLE, cumulative_net_units BIGINT""",
    (MART, "price_index_trends"): """
        reference_date DATE, ref_period STRING, geography STRING, ref_year INT, ref_month INT,
        ref_quarter INT, index_total DOUBLE, index_house DOUBLE, index_land DOUBLE,
        index_total_12m_ago DOUBLE, yoy_change_pct DOUBLE""",
    (MART, "property_overview"): """
        feature_type STRING, property_count BIGINT, avg_area_sqm DOUBLE, avg_area_sqft DOUBLE,
        median_area_sqm DOUBLE, min_area_sqm DOUBLE, max_area_sqm DOUBLE,
        total_area_sqm DOUBLE""",
}

# One line of documentation per table.
DESCRIPTIONS = {
    (RAW, "property_boundaries"): "Parcel boundaries as delivered",
    (RAW, "permits_active"): "Active building permits as delivered",
    (RAW, "permits_cleared"): "Cleared building permits as delivered",
    (RAW, "building_assets"): "City-owned buildings as delivered",
    (RAW, "land_assets"): "City-owned land as delivered",
    (RAW, "apartment_registration"): "Apartment registrations as delivered",
    (RAW, "apartment_evaluations"): "Apartment evaluations as delivered",
    (RAW, "housing_price_index"): "Monthly housing price index as delivered",
    (CLEAN, "properties"): "One row per parcel, latest effective date",
    (CLEAN, "building_permits"): "One row per permit, highest revision, both extracts",
    (CLEAN, "apartment_buildings"): "Registrations with their latest evaluation",
    (CLEAN, "housing_price_index"): "Typed price index of the province",
    (MART, "permit_trends"): "Permit activity by period, ward and kind",
    (MART, "construction_investment"): "Declared construction cost by period, ward and use",
    (MART, "apartment_scorecard"): "Apartment quality by ward and ownership",
    (MART, "housing_development"): "Dwelling units created and lost, with running total",
    (MART, "price_index_trends"): "Price index by month with change over twelve months",
    (MART, "property_overview"): "Parcel areas by feature type",
}


_TYPES = {
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
}


class ContractError(ValueError):
    """A frame lacks columns that its table contract names."""


@lru_cache(maxsize=None)
def contract(layer: str, table: str) -> T.StructType:
    """The schema of ``layer.table``; raw tables are text plus the audit columns."""
    if layer == RAW:
        if table not in _RAW_COLUMNS:
            raise KeyError(f"no contract for {layer}.{table}")
        fields = [T.StructField(name.strip(), T.StringType()) for name in _RAW_COLUMNS[table].split(",")]
        stamp, *rest = AUDIT_COLUMNS
        fields.append(T.StructField(stamp, T.TimestampType()))
        fields.extend(T.StructField(name, T.StringType()) for name in rest)
        return T.StructType(fields)
    if (layer, table) not in _TYPED:
        raise KeyError(f"no contract for {layer}.{table}")
    columns = [column.split() for column in _TYPED[layer, table].split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


def source_columns(table: str) -> list[str]:
    """Columns a raw extract brings itself, without the audit columns."""
    return [f.name for f in contract(RAW, table) if f.name not in AUDIT_COLUMNS]


def tables(layer: str) -> list[str]:
    return [table for (lay, table) in DESCRIPTIONS if lay == layer]


def conform(df: DataFrame, schema: T.StructType, optional: tuple[str, ...] = ()) -> DataFrame:
    """Reorder and cast ``df`` to ``schema``; missing columns are an error unless optional.

    Optional columns that are absent become NULL, columns outside the contract
    are dropped, and a type that cannot be cast safely is rejected by Spark.
    """
    present = {name.lower() for name in df.columns}
    spare = {name.lower() for name in optional}
    missing = [f.name for f in schema if f.name.lower() not in present | spare]
    if missing:
        raise ContractError(f"missing columns: {', '.join(missing)}")
    return df.to(schema)
