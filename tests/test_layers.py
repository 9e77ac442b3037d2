"""Cleaned, reporting and serving functions on small frames with known answers."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicmart.contracts import CLEAN, MART, RAW, ContractError, conform, contract, source_columns, tables
from civicmart.plans import gold, serving, silver


def raw_frame(spark, table, rows):
    """Raw rows given as dicts; columns not named are NULL."""
    names = source_columns(table)
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def permit(number, revision="0", **cells):
    base = {
        "PERMIT_NUM": number, "REVISION_NUM": revision, "APPLICATION_DATE": "2020-05-17", "WARD_GRID": "1",
        "EST_CONST_COST": "1000", "DWELLING_UNITS_CREATED": "2", "DWELLING_UNITS_LOST": "1", "POSTAL": "M5V 2H1",
    }
    return {**base, **cells}


@pytest.fixture(scope="module")
def permits(spark):
    active = raw_frame(spark, "permits_active", [
        permit(" P1 ", "0"), permit("P1", "2", EST_CONST_COST="2500.50"), permit("P1", "10", WARD_GRID=" 7 "),
        permit("", "1"), permit(None, "1"), permit("  ", "1"),
        permit("P4", "0", DWELLING_UNITS_CREATED=None, DWELLING_UNITS_LOST="5", EST_CONST_COST="abc"),
    ]).drop("BUILDER_NAME")
    cleared = raw_frame(spark, "permits_cleared", [
        permit("P2", "1.0", APPLICATION_DATE="2016-12-31"), permit("P3", "x", APPLICATION_DATE="soon", STREET_NUM=" 5 ",
               STREET_NAME="King", STREET_TYPE=None, STREET_DIRECTION="W"),
    ])
    return silver.building_permits(active, cleared)


def test_permits_are_typed_and_unique(permits):
    by_number = {r["permit_number"]: r for r in permits.collect()}
    assert permits.schema.simpleString() == contract(CLEAN, "building_permits").simpleString()
    assert set(by_number) == {"P1", "P2", "P3", "P4"} and permits.count() == 4
    assert by_number["P1"]["revision_number"] == 10 and by_number["P1"]["ward"] == "7"
    assert by_number["P1"]["net_dwelling_units"] == 1 and by_number["P1"]["postal_prefix"] == "M5V"
    assert by_number["P2"]["_permit_source"] == "cleared" and by_number["P2"]["application_quarter"] == 4
    assert by_number["P3"]["application_date"] is None and by_number["P3"]["full_address"] == "5 King W"
    assert by_number["P4"]["net_dwelling_units"] is None and by_number["P4"]["estimated_construction_cost"] is None
    assert by_number["P4"]["_silver_timestamp"] is not None


def test_properties(spark):
    raw = raw_frame(spark, "property_boundaries", [
        {"PARCELID": "A", "DATE_EFFECTIVE": "2023/01/01", "STATEDAREA": "500", "OBJECTID": "1"},
        {"PARCELID": "A", "DATE_EFFECTIVE": "2024/01/01", "STATEDAREA": "100", "ADDRESS_NUMBER": "12", "LINEAR_NAME_FULL": " Bay St "},
        {"PARCELID": "B", "DATE_EFFECTIVE": "2023-06-01", "STATEDAREA": "big"},
        {"PARCELID": None, "DATE_EFFECTIVE": "2023/06/01"},
    ])
    got = {r["parcel_id"]: r for r in silver.properties(raw).collect()}
    assert set(got) == {"A", "B"}
    assert got["A"]["date_effective"] == date(2024, 1, 1) and got["A"]["stated_area_sqft"] == 1076.39
    assert got["A"]["full_address"] == "12 Bay St"
    assert got["B"]["date_effective"] is None and got["B"]["stated_area_sqm"] is None and got["B"]["full_address"] == ""


def test_building_assets(spark):
    raw = raw_frame(spark, "building_assets", [
        {"FLOC_ID": " F1 ", "Ward Name": " W ", "Gross Floor Area (M2)": "12.5", "Year Built": "1950.0", "WARD": " 3"}
    ])
    row = silver.building_assets(raw).first()
    assert (row["floc_id"], row["ward_name"], row["gross_floor_area_sqm"], row["year_built"], row["ward_number"]) == (
        " F1 ", "W", 12.5, 1950, "3",
    )


def test_apartments(spark):
    registered = raw_frame(spark, "apartment_registration", [
        {"RSN": "1", "YEAR_BUILT": "1970", "CONFIRMED_STOREYS": "10", "NO_OF_STOREYS": "99", "CONFIRMED_UNITS": "100", "PCODE": "M4B1B3"},
        {"RSN": "2", "YEAR_BUILT": "2020", "NO_OF_STOREYS": "0", "NO_OF_UNITS": "24"},
        {"RSN": "?", "YEAR_BUILT": ""}, {"RSN": None}, {"RSN": "1", "SITE_ADDRESS": "twice"},
    ])
    evaluated = raw_frame(spark, "apartment_evaluations", [
        {"RSN": "1", "YEAR EVALUATED": "2022", "CURRENT BUILDING EVAL SCORE": "60"},
        {"RSN": "1", "YEAR EVALUATED": "2023", "CURRENT BUILDING EVAL SCORE": "75"},
        {"RSN": None, "YEAR EVALUATED": "2023", "CURRENT BUILDING EVAL SCORE": "1"},
    ])
    df = silver.apartment_buildings(registered, evaluated)
    assert df.schema.simpleString() == contract(CLEAN, "apartment_buildings").simpleString() and df.count() == 5
    rows = df.orderBy("rsn", "year_built").collect()
    assert [r["eval_score"] for r in rows] == [None, None, 75.0, 75.0, None]
    known = [r for r in rows if r["year_built"] == 1970][0]
    assert (known["building_age"], known["units_per_storey"], known["postal_prefix"]) == (55, 10.0, "M4B")
    assert rows[-1]["building_age"] == 5 and rows[-1]["units_per_storey"] is None
    older = silver.apartment_buildings(registered, evaluated, as_of_year=2030)
    assert older.filter("year_built = 1970").first()["building_age"] == 60


def test_registrations_without_confirmed_columns(spark):
    raw = raw_frame(spark, "apartment_registration", [{"RSN": "1", "NO_OF_STOREYS": "7"}]).drop("CONFIRMED_STOREYS")
    assert silver.registrations(raw).first()["storeys"] == 7


@pytest.fixture(scope="module")
def index(spark):
    def row(month, place, kind, value, **more):
        return {"REF_DATE": month, "GEO": place, "New housing price indexes": kind, "VALUE": value, **more}

    months = [f"{y}-{m:02d}" for y in (2020, 2021) for m in range(1, 13)]
    raw = raw_frame(spark, "housing_price_index", [
        *[row(m, "Toronto", '"Total (house and land)"', str(100 + i)) for i, m in enumerate(months)],
        row("2020-01", "Toronto", "House only", "55", STATUS=" E "), row("2020-01", "Toronto", "Land only", None),
        row("2020-01", "Toronto", "Land only", "NaN"), row("2020-01", " Ontario part", "Land only", "9"),
        row("2020-01", "Alberta", "House only", "1"), row("2020-01", "Ottawa-Gatineau, Quebec part", "House only", "1"),
        row("never", "Ontario", "House only", "3"),
    ])
    return silver.housing_price_index(raw)


def test_price_index(index):
    assert index.schema.simpleString() == contract(CLEAN, "housing_price_index").simpleString()
    assert index.count() == 24 + 3
    assert {r[0] for r in index.select("geography").distinct().collect()} == {"Toronto", "Ontario part", "Ontario"}
    row = index.filter("index_type = 'House only' and geography = 'Toronto'").first()
    assert (row["reference_date"], row["ref_quarter"], row["data_quality_flag"]) == (date(2020, 1, 1), 1, "E")
    assert index.filter("ref_period = 'never'").first()["reference_date"] is None


def test_province_rules(column):
    places = ["Ontario", "Toronto", "British Columbia", "Alberta", "Ottawa-Gatineau, Ontario part", "Ottawa-Gatineau, Quebec part"]
    assert column(lambda c: silver.in_province(F.col(c)), places) == [True, True, False, False, True, False]
    assert column(lambda c: silver.in_province_by_keyword(F.col(c)), places) == [True, True, False, False, True, True]


def test_permit_trends(permits):
    trends = gold.permit_trends(permits)
    assert trends.schema.simpleString() == contract(MART, "permit_trends").simpleString()
    got = {r["ward"]: r for r in trends.collect()}
    assert set(got) == {"7", "1"}  # the 2016 permit and the one without a date are left out
    assert got["7"]["permit_count"] == got["7"]["unique_permits"] == 1
    assert got["1"]["total_construction_cost"] is None and got["1"]["total_units_lost"] == 5
    plain = gold.permit_trends(permits, one_row_per_permit=True)
    assert sorted(plain.collect(), key=str) == sorted(trends.collect(), key=str)


def permit_rows(spark, rows):
    """Cleaned permits with (ward, cost, created, lost) and otherwise equal cells."""
    df = spark.createDataFrame(rows, "ward string, estimated_construction_cost double, dwelling_units_created int, dwelling_units_lost int")
    filled = df.withColumns({
        "permit_number": F.concat(F.lit("P"), F.row_number().over(Window.orderBy("ward", "estimated_construction_cost"))),
        "application_year": F.lit(2020), "application_quarter": F.lit(1), "current_use": F.lit("u"),
        "proposed_use": F.lit(None).cast("string"), "structure_type": F.lit("s"),
        "net_dwelling_units": F.col("dwelling_units_created") - F.col("dwelling_units_lost"),
    })
    optional = tuple(f.name for f in contract(CLEAN, "building_permits"))
    return conform(filled, contract(CLEAN, "building_permits"), optional)


def test_construction_investment(spark):
    permits = permit_rows(spark, [
        ("1", 100.0, 1, None), ("1", 300.0, None, None), ("1", 200.0, 2, 1), ("1", 400.0, 1, 1), ("1", 0.0, 9, 9),
        ("1", None, 9, 9), (None, 10_000_000.0, None, None),
    ])
    got = {r["ward"]: r for r in gold.construction_investment(permits).collect()}
    assert got["1"].asDict() | {"current_use": "u"} == {
        "application_year": 2020, "application_quarter": 1, "ward": "1", "current_use": "u", "proposed_use": None,
        "project_count": 4, "total_investment": 1000.0, "avg_investment": 250.0, "median_investment": 200.0,
        "max_investment": 400.0, "units_created": 4, "investment_category": "Small (<$100K)",
    }
    assert got[None]["investment_category"] == "Mega (>$10M)" and got[None]["median_investment"] == 10_000_000.0
    middle = gold.construction_investment(permits, interpolate=True).filter("ward = '1'").first()
    assert middle["median_investment"] == 250.0


def test_housing_development(spark):
    permits = permit_rows(spark, [("1", 5.0, 4, 1), ("1", 6.0, None, 2), ("1", 7.0, None, None), ("2", 1.0, 3, None)])
    got = {r["ward"]: r for r in gold.housing_development(permits).collect()}
    assert (got["1"]["permit_count"], got["1"]["units_created"], got["1"]["units_lost"], got["1"]["net_units"]) == (2, 4, 3, 3)
    assert got["1"]["total_cost"] == 11.0 and got["1"]["cumulative_net_units"] == 3
    assert got["2"]["net_units"] is None and got["2"]["cumulative_net_units"] is None


@pytest.fixture(scope="module")
def scorecard(spark):
    df = spark.createDataFrame(
        [("1", "TCHC", 80.0, 10, 1970), ("1", "TCHC", 80.0, 20, 1990), ("2", "PRIVATE", None, None, None), (None, "TCHC", 59.96, 5, 2000)],
        "ward string, property_type string, eval_score double, units int, year_built int",
    ).withColumn("building_age", 2025 - F.col("year_built"))
    schema = contract(CLEAN, "apartment_buildings")
    return gold.apartment_scorecard(conform(df, schema, tuple(schema.names)))


def test_apartment_scorecard(scorecard):
    assert scorecard.schema.simpleString() == contract(MART, "apartment_scorecard").simpleString()
    got = {(r["ward"], r["property_type"]): r for r in scorecard.collect()}
    first = got["1", "TCHC"]
    assert (first["building_count"], first["avg_units"], first["total_units"], first["avg_building_age"]) == (2, 15.0, 30, 45.0)
    assert (first["oldest_building"], first["newest_building"], first["quality_tier"]) == (1970, 1990, "Excellent")
    assert got["2", "PRIVATE"]["quality_tier"] == "Needs Improvement" and got["2", "PRIVATE"]["total_units"] is None
    assert got[None, "TCHC"]["avg_eval_score"] == 60.0 and got[None, "TCHC"]["quality_tier"] == "Good"


def test_price_index_trends(index):
    trends = gold.price_index_trends(index)
    assert trends.schema.simpleString() == contract(MART, "price_index_trends").simpleString()
    rows = {r["ref_period"]: r for r in trends.filter("geography = 'Toronto'").collect()}
    assert len(rows) == 24
    assert (rows["2020-01"]["index_total"], rows["2020-01"]["index_house"], rows["2020-01"]["index_land"]) == (100.0, 55.0, None)
    assert rows["2021-01"]["index_total_12m_ago"] == 100.0 and rows["2021-01"]["yoy_change_pct"] == 12.0
    assert rows["2020-12"]["yoy_change_pct"] is None


def test_index_columns_by_wording():
    assert gold.index_column("Total (house and land)") == "index_total"
    assert gold.index_column(" House only") == "index_house" and gold.index_column("Land only ") == "index_land"
    assert gold.index_column("Other") == "Other"


def test_property_overview(spark):
    df = spark.createDataFrame(
        [("LOT", 10.0, 107.64), ("LOT", 30.0, 322.92), ("LOT", 20.0, 215.28), ("ROAD", None, None), (None, 5.0, 53.82)],
        "feature_type string, stated_area_sqm double, stated_area_sqft double",
    )
    got = {r["feature_type"]: r.asDict() for r in gold.property_overview(df).collect()}
    assert got["LOT"] == {
        "feature_type": "LOT", "property_count": 3, "avg_area_sqm": 20.0, "avg_area_sqft": 215.28, "median_area_sqm": 20.0,
        "min_area_sqm": 10.0, "max_area_sqm": 30.0, "total_area_sqm": 60.0,
    }
    assert got["ROAD"]["property_count"] == 1 and got["ROAD"]["avg_area_sqm"] is None and got["ROAD"]["median_area_sqm"] is None
    assert got[None]["median_area_sqm"] == 5.0


def test_reading_order(scorecard):
    shown = [(r["building_count"], r["ward"]) for r in gold.presented(scorecard, "apartment_scorecard").collect()]
    assert shown == [(2, "1"), (1, None), (1, "2")]
    assert set(gold.READING_ORDER) == set(tables(MART))


def test_scorecard_queries(scorecard):
    assert serving.scorecard_table(scorecard).columns == list(serving.SCORECARD_COLUMNS)
    assert serving.scorecard_table(scorecard.drop("quality_tier")).columns == list(serving.SCORECARD_COLUMNS[:-1])
    tiers = {r[0]: r[1] for r in serving.tier_distribution(scorecard).collect()}
    assert tiers == {"Excellent": 2, "Good": 1, "Needs Improvement": 1}
    assert serving.score_vs_age(scorecard).count() == 2


def test_key_figures_of_empty_tables(spark):
    empty = [spark.createDataFrame([], contract(MART, t)) for t in (
        "permit_trends", "construction_investment", "housing_development", "apartment_scorecard", "property_overview")]
    row = serving.key_figures(*empty).first()
    assert tuple(row) == (0, 0.0, 0, 0.0, 0, "0", "$0", "0", "0.0/100", "0")


def test_index_queries(index):
    trends = gold.price_index_trends(index)
    assert serving.index_series(trends).count() == 24
    assert serving.index_series(trends, "index_house", []).count() == 2
    assert serving.index_series(trends, "index_total", ["Ontario"]).count() == 0
    assert serving.yoy_series(trends, ["Toronto"]).count() == 12


def test_conform_rejects_missing_and_unsafe_columns(spark):
    schema = contract(MART, "property_overview")
    with pytest.raises(ContractError, match="property_count"):
        conform(spark.createDataFrame([("x",)], "feature_type string"), schema)
    loose = spark.createDataFrame([("1", "x")], "property_count string, feature_type string")
    with pytest.raises(Exception):
        conform(loose.withColumn("property_count", F.array("property_count")), schema, tuple(schema.names)).collect()


def test_contracts_cover_all_tables():
    assert [len(tables(layer)) for layer in (RAW, CLEAN, MART)] == [8, 4, 6]
    widths = {t: len(contract(CLEAN, t)) for t in tables(CLEAN)}
    assert widths == {"properties": 10, "building_permits": 29, "apartment_buildings": 27, "housing_price_index": 10}
    assert [len(contract(MART, t)) for t in tables(MART)] == [14, 12, 15, 11, 11, 8]
    assert contract(RAW, "permits_cleared") == contract(RAW, "permits_active")
    with pytest.raises(KeyError):
        contract(MART, "unknown")


def test_tables_that_sort_what_they_read_are_computed_from_small_splits(spark, tmp_path, monkeypatch):
    from civicmart.plans import pipeline
    from civicmart.session import bounded_sorts

    key = "spark.sql.files.maxPartitionBytes"
    before, seen = spark.conf.get(key), []
    raw = spark.createDataFrame([("A", "1")], "PARCELID string, OBJECTID string")
    pipeline.replace_table(raw, str(tmp_path), "bronze", "property_boundaries")

    def build(df, watch=None):
        seen.append(int(spark.conf.get(key)))
        return df

    monkeypatch.setattr(pipeline, "RAW", "bronze")
    monkeypatch.setattr(pipeline, "PARTITIONED", {})
    monkeypatch.setattr(pipeline, "CLEAN_PLANS", {"properties": (build, ("property_boundaries",))})
    assert pipeline.clean(spark, str(tmp_path)) == {"properties": 1}
    assert seen == [16 << 20] and spark.conf.get(key) == before
    spark.conf.set(key, "2k")
    try:
        with bounded_sorts(spark):
            assert spark.conf.get(key) == "2048"  # a smaller bound of the caller stays
        assert spark.conf.get(key) == "2k"
    finally:
        spark.conf.set(key, before)
