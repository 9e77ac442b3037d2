"""Cleaned tables: typed, trimmed, one row per entity.

Each table is described by the raw column behind every contract column; the
cleaning rule follows from the contract type.  Text is trimmed, numbers and
dates are parsed leniently.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicmart.contracts import CLEAN, conform, contract
from civicmart.functions import cells
from civicmart.operators.dedup import join_latest, latest_per_key, union_tagged
from civicmart.operators.shaping import contains_any

AS_OF_YEAR = 2025  # fixed value
STAMP = "_silver_timestamp"

# Contract column <- raw column.
PROPERTY_CELLS = {
    "parcel_id": "PARCELID",
    "feature_type": "FEATURE_TYPE",
    "date_effective": "DATE_EFFECTIVE",
    "stated_area_sqm": "STATEDAREA",
    "address_number": "ADDRESS_NUMBER",
    "street_name": "LINEAR_NAME_FULL",
    "object_id": "OBJECTID",
}
BUILDING_CELLS = {
    "floc_id": "FLOC_ID",
    "building_description": "Building Description",
    "building_address": "Address",
    "ward_name": "Ward Name",
    "former_municipality": "Former Municipality",
    "district": "District",
    "building_type": "Building Type",
    "building_status": "Building Status",
    "gross_floor_area_sqm": "Gross Floor Area (M2)",
    "gross_floor_area_sqft": "Gross Floor Area (FT2)",
    "year_built": "Year Built",
    "ward_number": "WARD",
}
PERMIT_CELLS = {
    "permit_number": "PERMIT_NUM",
    "revision_number": "REVISION_NUM",
    "permit_type": "PERMIT_TYPE",
    "structure_type": "STRUCTURE_TYPE",
    "work_type": "WORK",
    "street_number": "STREET_NUM",
    "street_name": "STREET_NAME",
    "street_type": "STREET_TYPE",
    "street_direction": "STREET_DIRECTION",
    "postal_code": "POSTAL",
    "geo_id": "GEO_ID",
    "ward": "WARD_GRID",
    "application_date": "APPLICATION_DATE",
    "issued_date": "ISSUED_DATE",
    "completed_date": "COMPLETED_DATE",
    "status": "STATUS",
    "description": "DESCRIPTION",
    "current_use": "CURRENT_USE",
    "proposed_use": "PROPOSED_USE",
    "dwelling_units_created": "DWELLING_UNITS_CREATED",
    "dwelling_units_lost": "DWELLING_UNITS_LOST",
    "estimated_construction_cost": "EST_CONST_COST",
}
REGISTRATION_CELLS = {
    "rsn": "RSN",
    "address": "SITE_ADDRESS",
    "property_type": "PROPERTY_TYPE",
    "ward": "WARD",
    "year_built": "YEAR_BUILT",
    "year_registered": "YEAR_REGISTERED",
    "heating_type": "HEATING_TYPE",
    "ac_type": "AIR_CONDITIONING_TYPE",
    "parking_type": "PARKING_TYPE",
    "elevators": "NO_OF_ELEVATORS",
    "pets_allowed": "PETS_ALLOWED",
    "has_laundry": "LAUNDRY_ROOM",
    "has_bike_parking": "BIKE_PARKING",
    "postal_code": "PCODE",
}
EVALUATION_CELLS = {
    "rsn": "RSN",
    "year_evaluated": "YEAR EVALUATED",
    "eval_score": "CURRENT BUILDING EVAL SCORE",
    "proactive_score": "PROACTIVE BUILDING SCORE",
    "reactive_score": "CURRENT REACTIVE SCORE",
    "areas_evaluated": "NO OF AREAS EVALUATED",
    "latitude": "LATITUDE",
    "longitude": "LONGITUDE",
}

# Places counted as part of the province.
PROVINCE = "Ontario"
PROVINCE_PLACES = (
    "Ontario", "Toronto", "Ottawa", "Hamilton", "Oshawa", "Kitchener", "St. Catharines", "Windsor",
    "Greater Sudbury", "Thunder Bay", "Guelph", "London", "Barrie", "Brantford", "Peterborough",
    "Belleville", "Ottawa-Gatineau, Ontario part", "Toronto, Ontario",
)
# Places whose name anywhere in the text counts.
PROVINCE_KEYWORDS = (
    "Ontario", "Toronto", "Ottawa", "Hamilton", "Oshawa", "Kitchener", "St. Catharines", "Windsor",
    "Greater Sudbury", "Thunder Bay", "Guelph", "London", "Barrie", "Brantford", "Peterborough",
    "Belleville",
)

_BUILDING_TYPES = {
    "gross_floor_area_sqm": T.DoubleType(),
    "gross_floor_area_sqft": T.DoubleType(),
    "year_built": T.IntegerType(),
}


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _parsed(cell: Column, kind: T.DataType, date_pattern: str) -> Column:
    if isinstance(kind, T.IntegerType):
        return cells.as_int(cell)
    if isinstance(kind, T.LongType):
        return cells.as_long(cell)
    if isinstance(kind, T.DoubleType):
        return cells.as_double(cell)
    if isinstance(kind, T.DateType):
        return cells.as_date(cell, date_pattern)
    return cells.tidy(cell)


def _cleaned(
    df: DataFrame,
    mapping: Mapping[str, str],
    kinds: Mapping[str, T.DataType],
    untouched: tuple[str, ...] = (),
    date_pattern: str = "yyyy-MM-dd",
) -> list[Column]:
    """Select list for ``mapping``; columns in ``untouched`` pass through as they are."""
    return [
        (_quoted(raw) if name in untouched else _parsed(_quoted(raw), kinds[name], date_pattern)).alias(name)
        for name, raw in mapping.items()
    ]


class Rejections:
    """Counts of cells with text that became NULL, taken while a table is written.

    Handed to a builder as ``watch``; ``counts`` waits for the write.
    """

    def __init__(self) -> None:
        self._watched: dict[str, Observation] = {}

    def __call__(self, source: str) -> Observation:
        self._watched[source] = Observation()
        return self._watched[source]

    def counts(self) -> dict[tuple[str, str], int]:
        return {(source, column): n for source, seen in self._watched.items() for column, n in seen.get.items()}

    def frame(self, spark: SparkSession) -> DataFrame:
        """(source, column, rejected): one row per typed column."""
        rows = [(source, column, n) for (source, column), n in self.counts().items()]
        return spark.createDataFrame(rows, "source string, column string, rejected long")


Watch = Callable[[str], Observation]


def _watched(df: DataFrame, source: str, typed: Mapping[str, tuple[Column, Column]], watch: Watch | None) -> DataFrame:
    """``df``, whose rows are counted on their way by column (name -> raw cell, parsed cell)."""
    if watch is None:
        return df
    lost = [F.count_if(cells.has_text(cell) & parsed.isNull()).alias(name) for name, (cell, parsed) in typed.items()]
    return df.observe(watch(source), *lost)


def _typed(
    mapping: Mapping[str, str],
    kinds: Mapping[str, T.DataType],
    untouched: tuple[str, ...] = (),
    date_pattern: str = "yyyy-MM-dd",
) -> dict[str, tuple[Column, Column]]:
    """Raw and parsed cell of the columns of ``mapping`` that are not text."""
    return {
        name: (_quoted(raw), _parsed(_quoted(raw), kinds[name], date_pattern))
        for name, raw in mapping.items()
        if name not in untouched and not isinstance(kinds[name], T.StringType)
    }


def _kinds(table: str) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in contract(CLEAN, table)}


def _finished(df: DataFrame, table: str) -> DataFrame:
    return conform(df.withColumn(STAMP, F.current_timestamp()), contract(CLEAN, table))


def properties(boundaries: DataFrame, watch: Watch | None = None) -> DataFrame:
    """Parcels by their latest effective date, with address and area in square feet."""
    passed = ("parcel_id", "feature_type", "address_number")
    typed = _typed(PROPERTY_CELLS, _kinds("properties"), passed, "yyyy/MM/dd")
    parcels = _watched(boundaries, "property_boundaries", typed, watch).select(
        *_cleaned(boundaries, PROPERTY_CELLS, _kinds("properties"), passed, "yyyy/MM/dd")
    ).filter(F.col("parcel_id").isNotNull())
    current = latest_per_key(parcels, ["parcel_id"], "date_effective")
    return _finished(
        current.withColumns(
            {
                "full_address": cells.spaced("address_number", "street_name"),
                "stated_area_sqft": cells.square_feet("stated_area_sqm"),
            }
        ),
        "properties",
    )


def building_assets(assets: DataFrame) -> DataFrame:
    """City-owned buildings, typed; no later table reads it."""
    kinds = {name: _BUILDING_TYPES.get(name, T.StringType()) for name in BUILDING_CELLS}
    return assets.select(*_cleaned(assets, BUILDING_CELLS, kinds, ("floc_id",)))


def building_permits(
    active: DataFrame, cleared: DataFrame, fill_null: bool = False, watch: Watch | None = None
) -> DataFrame:
    """Permits of both extracts, highest revision each; blank permit numbers are left out."""
    origin = "_permit_source"
    both = union_tagged({"active": active, "cleared": cleared}, origin)
    both = _watched(both, "permits", _typed(PERMIT_CELLS, _kinds("building_permits")), watch)
    permits = both.select(*_cleaned(both, PERMIT_CELLS, _kinds("building_permits")), origin).filter(
        cells.has_text("permit_number")
    )
    current = latest_per_key(permits, ["permit_number"], "revision_number")
    street = ("street_number", "street_name", "street_type", "street_direction")
    return _finished(
        current.withColumns(
            {
                "full_address": cells.spaced(*street),
                "application_year": F.year("application_date"),
                "application_quarter": F.quarter("application_date"),
                "net_dwelling_units": cells.net_change(
                    "dwelling_units_created", "dwelling_units_lost", fill_null
                ),
                "postal_prefix": cells.prefix("postal_code"),
            }
        ),
        "building_permits",
    )


def registrations(raw: DataFrame, watch: Watch | None = None) -> DataFrame:
    """Typed apartment registrations; a confirmed cell wins over the declared one, junk or not.

    Without either column the figure is NULL.
    """

    def confirmed(what: str) -> tuple[Column, Column]:
        known = [F.col(c) for c in (f"CONFIRMED_{what}", f"NO_OF_{what}") if c in raw.columns]
        cell = F.coalesce(*known, F.lit(None).cast("string"))
        return cell, cells.as_int(cell)

    figures = {"storeys": confirmed("STOREYS"), "units": confirmed("UNITS")}
    kinds = _kinds("apartment_buildings")
    return _watched(raw, "apartment_registration", _typed(REGISTRATION_CELLS, kinds) | figures, watch).select(
        *_cleaned(raw, REGISTRATION_CELLS, kinds), *[parsed.alias(name) for name, (_, parsed) in figures.items()]
    )


def evaluations(raw: DataFrame, watch: Watch | None = None) -> DataFrame:
    kinds = _kinds("apartment_buildings")
    raw = _watched(raw, "apartment_evaluations", _typed(EVALUATION_CELLS, kinds), watch)
    return raw.select(*_cleaned(raw, EVALUATION_CELLS, kinds))


def apartment_buildings(
    registration: DataFrame, evaluation: DataFrame, as_of_year: int = AS_OF_YEAR, watch: Watch | None = None
) -> DataFrame:
    """Every registration with the latest evaluation of its building, if any."""
    joined = join_latest(
        registrations(registration, watch), evaluations(evaluation, watch), "rsn", "year_evaluated"
    )
    return _finished(
        joined.withColumns(
            {
                "building_age": F.lit(as_of_year) - F.col("year_built"),
                "units_per_storey": cells.rounded(cells.ratio("units", "storeys"), 1),
                "postal_prefix": cells.prefix("postal_code"),
            }
        ),
        "apartment_buildings",
    )


def in_province(place: Column) -> Column:
    return place.isin(*PROVINCE_PLACES) | place.contains(PROVINCE)


def in_province_by_keyword(place: Column) -> Column:
    """Wider rule: any known place name anywhere in the text."""
    return contains_any(place, PROVINCE_KEYWORDS)


def housing_price_index(raw: DataFrame, watch: Watch | None = None) -> DataFrame:
    """Index values of the province by month; rows without a value are left out."""
    parsed = {
        "reference_date": (F.col("REF_DATE"), cells.month_start("REF_DATE")),
        "index_value": (F.col("VALUE"), cells.as_double("VALUE")),
    }
    typed = (
        _watched(raw.filter(in_province(F.col("GEO"))), "housing_price_index", parsed, watch)
        .select(
            cells.month_start("REF_DATE").alias("reference_date"),
            F.col("REF_DATE").alias("ref_period"),
            cells.tidy("GEO").alias("geography"),
            cells.unquoted(_quoted("New housing price indexes")).alias("index_type"),
            cells.as_double("VALUE").alias("index_value"),
            cells.tidy("STATUS").alias("data_quality_flag"),
        )
        .filter(F.col("index_value").isNotNull())
    )
    return _finished(
        typed.withColumns(
            {
                "ref_year": F.year("reference_date"),
                "ref_month": F.month("reference_date"),
                "ref_quarter": F.quarter("reference_date"),
            }
        ),
        "housing_price_index",
    )
