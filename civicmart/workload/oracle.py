"""The same results in SQL for DuckDB, written against the test tables.

The cleaned tables are computed from the typed columns, not from text cells, so
that the lenient parsing is checked as well.
"""

from __future__ import annotations

from civicmart.contracts import CLEAN, MART, RAW, contract, tables
from civicmart.workload.standins import FIRST_YEAR, PLACE_SQL

YEARS = "application_year BETWEEN 1998 AND 2000"
WARDS = "ward IN ('3', '7', '11', '19')"


def _r(expression: str, digits: int) -> str:
    """Half-up rounding of a number as it is written in decimals."""
    return f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)"


def _s(column: str, digits: int) -> str:
    """Sum of decimals, rounded once."""
    return f"CAST(round(sum(CAST(CAST({column} AS VARCHAR) AS DECIMAL(28,9))), {digits}) AS DOUBLE)"


def _a(column: str, digits: int) -> str:
    """Mean of decimals, rounded once: whole numbers of billionths, divided by twice their count."""
    whole = f"sum(CAST(CAST(CAST({column} AS VARCHAR) AS DECIMAL(28,9)) * 1000000000 AS HUGEINT))::HUGEINT"
    n = f"(count({column}) * 1000000000)::HUGEINT"
    half_up = f"(abs({whole}) * {2 * 10**digits} + {n}) // nullif(2 * {n}, 0)"
    return f"CAST({half_up} AS DOUBLE) * sign({whole}) / {10**digits}"


PERMITS = f"""permit_cells AS (
  SELECT CASE WHEN l_orderkey % 97 <> 0 THEN 'P' || l_orderkey END AS permit_number,
    CASE WHEN l_suppkey % 13 <> 0 THEN l_linenumber END AS revision_number,
    l_returnflag AS permit_type, 'S' || (l_partkey % 5) AS structure_type,
    'W' || (l_suppkey % 3) AS work_type, CAST(l_suppkey AS VARCHAR) AS street_number,
    'Street ' || (l_partkey % 50) AS street_name,
    CASE WHEN l_partkey % 4 <> 0 THEN 'AVE' END AS street_type,
    CASE WHEN l_suppkey % 2 = 0 THEN 'N' END AS street_direction,
    'M' || (l_suppkey % 10) || 'V ' || (l_partkey % 7) AS postal_code,
    CAST(l_partkey * 1000003 AS BIGINT) AS geo_id,
    CASE WHEN l_partkey % 41 <> 0 THEN CAST(l_suppkey % 25 AS VARCHAR) END AS ward,
    CASE WHEN l_partkey % 53 <> 0 THEN CAST(l_shipdate AS DATE) END AS application_date,
    CAST(CAST(l_shipdate AS DATE) + 30 AS DATE) AS issued_date,
    CASE WHEN l_linestatus <> 'O' THEN CAST(CAST(l_shipdate AS DATE) + 90 AS DATE) END AS completed_date,
    CASE WHEN l_linestatus = 'O' THEN 'Permit Issued' ELSE 'Closed' END AS status,
    'line ' || l_linenumber || ' says "go"' || chr(10) || 'and more' AS description,
    'U' || (l_partkey % 7) AS current_use, 'P' || (l_suppkey % 4) AS proposed_use,
    CAST(nullif(CAST(l_quantity AS INTEGER) % 7, 0) AS INTEGER) AS dwelling_units_created,
    CAST(nullif(CAST(l_quantity AS INTEGER) % 5, 0) AS INTEGER) AS dwelling_units_lost,
    CASE WHEN l_partkey % 31 = 0 THEN NULL WHEN l_partkey % 29 = 0 THEN 0.0
      WHEN l_suppkey % 11 = 0 THEN l_extendedprice * CAST(100 AS DOUBLE)
      ELSE l_extendedprice END AS estimated_construction_cost,
    CASE WHEN l_linestatus = 'O' THEN 'active' ELSE 'cleared' END AS _permit_source
  FROM lineitem),
permit_ranks AS (
  SELECT *, row_number() OVER (PARTITION BY permit_number ORDER BY revision_number DESC NULLS LAST,
    permit_type NULLS LAST, structure_type NULLS LAST, work_type NULLS LAST, street_number NULLS LAST,
    street_name NULLS LAST, street_type NULLS LAST, street_direction NULLS LAST, postal_code NULLS LAST,
    geo_id NULLS LAST, ward NULLS LAST, application_date NULLS LAST, issued_date NULLS LAST,
    completed_date NULLS LAST, status NULLS LAST, description NULLS LAST, current_use NULLS LAST,
    proposed_use NULLS LAST, dwelling_units_created NULLS LAST, dwelling_units_lost NULLS LAST,
    estimated_construction_cost NULLS LAST, _permit_source NULLS LAST) AS rank_no
  FROM permit_cells WHERE permit_number IS NOT NULL),
permits AS (
  SELECT * EXCLUDE (rank_no),
    concat_ws(' ', street_number, street_name, street_type, street_direction) AS full_address,
    CAST(year(application_date) AS INTEGER) AS application_year,
    CAST(quarter(application_date) AS INTEGER) AS application_quarter,
    dwelling_units_created - dwelling_units_lost AS net_dwelling_units,
    substr(postal_code, 1, 3) AS postal_prefix
  FROM permit_ranks WHERE rank_no = 1)"""

PARCELS = f"""parcel_cells AS (
  SELECT CASE WHEN p_partkey % 61 <> 0 THEN 'PC' || (p_partkey // 2) END AS parcel_id, p_type AS feature_type,
    CASE WHEN p_size % 7 <> 0 THEN CAST(DATE '2000-01-01' + CAST(p_size * 30 AS INTEGER) AS DATE) END
      AS date_effective,
    CASE WHEN p_partkey % 23 <> 0 THEN p_retailprice END AS stated_area_sqm,
    CASE WHEN p_size % 5 <> 0 THEN CAST(p_size AS VARCHAR) END AS address_number,
    p_brand AS street_name, CAST(p_partkey * 4294967296 AS BIGINT) AS object_id
  FROM part),
parcel_ranks AS (
  SELECT *, row_number() OVER (PARTITION BY parcel_id ORDER BY date_effective DESC NULLS LAST,
    feature_type NULLS LAST, stated_area_sqm NULLS LAST, address_number NULLS LAST, street_name NULLS LAST,
    object_id NULLS LAST) AS rank_no
  FROM parcel_cells WHERE parcel_id IS NOT NULL),
parcels AS (
  SELECT * EXCLUDE (rank_no), concat_ws(' ', address_number, street_name) AS full_address,
    {_r("stated_area_sqm * CAST(10.7639 AS DOUBLE)", 2)} AS stated_area_sqft
  FROM parcel_ranks WHERE rank_no = 1)"""

BUILDINGS = f"""registrations AS (
  SELECT CASE WHEN s_suppkey % 17 <> 0 THEN s_suppkey END AS rsn, s_name AS address,
    ['PRIVATE', 'TCHC', 'SOCIAL HOUSING'][s_suppkey % 3 + 1] AS property_type,
    CAST(s_nationkey AS VARCHAR) AS ward,
    CASE WHEN s_suppkey % 19 <> 0 THEN CAST(1950 + s_suppkey % 70 AS INTEGER) END AS year_built,
    2017 AS year_registered,
    TRY_CAST(coalesce(CASE WHEN s_suppkey % 29 = 5 THEN 'unk' WHEN s_suppkey % 4 <> 0
      THEN CAST(s_suppkey % 12 AS VARCHAR) END, CAST(s_suppkey % 6 AS VARCHAR)) AS INTEGER) AS storeys,
    CAST(coalesce(CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey % 200 + 10 END, s_suppkey % 90 + 5) AS INTEGER)
      AS units,
    CASE WHEN s_suppkey % 2 = 0 THEN 'GAS' ELSE 'ELECTRIC' END AS heating_type, 'NONE' AS ac_type,
    'Surface' AS parking_type, CAST(s_suppkey % 4 AS INTEGER) AS elevators,
    CASE WHEN s_suppkey % 5 = 0 THEN 'NO' ELSE 'YES' END AS pets_allowed, 'YES' AS has_laundry,
    CASE WHEN s_suppkey % 7 = 0 THEN 'YES' END AS has_bike_parking,
    'M' || (s_suppkey % 9) || 'A 1B' || (s_suppkey % 5) AS postal_code
  FROM supplier),
evaluation_cells AS (
  SELECT CASE WHEN l_suppkey % 10 <> 3 THEN l_suppkey END AS rsn,
    CAST(year(l_shipdate) AS INTEGER) AS year_evaluated,
    CASE WHEN l_suppkey % 25 <> 6 THEN CAST((l_suppkey * 20) % 120
      - CASE WHEN (l_suppkey * 20) % 120 > 100 THEN 15 ELSE 0 END + l_linenumber % 2 AS DOUBLE) END AS eval_score,
    round(abs(l_tax) * 1000) AS proactive_score,
    CASE WHEN l_partkey % 3 <> 0 THEN l_quantity END AS reactive_score,
    CAST(l_linenumber AS INTEGER) AS areas_evaluated,
    CAST(43 + l_partkey % 100 AS DOUBLE) AS latitude, CAST(-79 - l_suppkey % 100 AS DOUBLE) AS longitude
  FROM lineitem),
evaluation_ranks AS (
  SELECT *, row_number() OVER (PARTITION BY rsn ORDER BY year_evaluated DESC NULLS LAST, eval_score NULLS LAST,
    proactive_score NULLS LAST, reactive_score NULLS LAST, areas_evaluated NULLS LAST, latitude NULLS LAST,
    longitude NULLS LAST) AS rank_no
  FROM evaluation_cells),
buildings AS (
  SELECT r.*, e.* EXCLUDE (rsn, rank_no), 2025 - year_built AS building_age,
    {_r("CASE WHEN storeys <> 0 THEN CAST(units AS DOUBLE) / storeys END", 1)} AS units_per_storey,
    substr(postal_code, 1, 3) AS postal_prefix
  FROM registrations r LEFT JOIN evaluation_ranks e ON r.rsn = e.rsn AND e.rank_no = 1)"""

INDEX = f"""index_cells AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS reference_date,
    strftime(o_orderdate, '%Y-%m') AS ref_period, {PLACE_SQL} AS place,
    CASE o_orderstatus WHEN 'F' THEN 'House only' WHEN 'O' THEN 'Land only'
      ELSE 'Total (house and land)' END AS index_type,
    CASE WHEN o_custkey % 37 <> 0 THEN o_totalprice END AS index_value,
    CASE WHEN o_custkey % 5 = 0 THEN 'E' END AS data_quality_flag
  FROM orders),
price_index AS (
  SELECT reference_date, ref_period, trim(place) AS geography, index_type, index_value, data_quality_flag,
    CAST(year(reference_date) AS INTEGER) AS ref_year, CAST(month(reference_date) AS INTEGER) AS ref_month,
    CAST(quarter(reference_date) AS INTEGER) AS ref_quarter
  FROM index_cells
  WHERE (place IN ('Toronto', 'London', 'Windsor', 'Guelph', 'Hamilton') OR contains(place, 'Ontario'))
    AND index_value IS NOT NULL)"""

TRENDS = f"""{PERMITS}, trends AS (
  SELECT application_year, application_quarter, ward, permit_type, structure_type, work_type, status,
    count(*) AS permit_count, {_a("estimated_construction_cost", 2)} AS avg_construction_cost,
    {_s("estimated_construction_cost", 2)} AS total_construction_cost,
    CAST(sum(dwelling_units_created) AS BIGINT) AS total_units_created,
    CAST(sum(dwelling_units_lost) AS BIGINT) AS total_units_lost,
    CAST(sum(net_dwelling_units) AS BIGINT) AS net_dwelling_units,
    count(DISTINCT permit_number) AS unique_permits
  FROM permits WHERE application_year >= {FIRST_YEAR} GROUP BY ALL)"""

INVESTMENT = f"""{PERMITS}, investment_groups AS (
  SELECT application_year, application_quarter, ward, current_use, proposed_use, count(*) AS project_count,
    {_s("estimated_construction_cost", 2)} AS total_investment,
    {_a("estimated_construction_cost", 2)} AS avg_investment,
    {_r("quantile_disc(estimated_construction_cost, 0.5)", 2)} AS median_investment,
    max(estimated_construction_cost) AS max_investment,
    CAST(sum(dwelling_units_created) AS BIGINT) AS units_created
  FROM permits WHERE estimated_construction_cost > 0 AND application_year >= {FIRST_YEAR} GROUP BY ALL),
investment AS (
  SELECT *, CASE WHEN avg_investment >= 10000000 THEN 'Mega (>$10M)'
    WHEN avg_investment >= 1000000 THEN 'Major ($1M-$10M)'
    WHEN avg_investment >= 100000 THEN 'Medium ($100K-$1M)' ELSE 'Small (<$100K)' END AS investment_category
  FROM investment_groups)"""

SCORECARD = f"""{BUILDINGS}, score_groups AS (
  SELECT ward, property_type, count(*) AS building_count,
    {_a("eval_score", 1)} AS avg_eval_score, {_a("proactive_score", 1)} AS avg_proactive_score,
    {_a("reactive_score", 1)} AS avg_reactive_score, {_a("units", 0)} AS avg_units,
    {_a("storeys", 0)} AS avg_storeys, {_a("building_age", 0)} AS avg_building_age,
    CAST(sum(units) AS BIGINT) AS total_units, CAST(sum(elevators) AS BIGINT) AS total_elevators,
    {_a("year_built", 0)} AS avg_year_built, min(year_built) AS oldest_building,
    max(year_built) AS newest_building
  FROM buildings GROUP BY ALL),
scorecard AS (
  SELECT *, CASE WHEN avg_eval_score >= 80 THEN 'Excellent' WHEN avg_eval_score >= 60 THEN 'Good'
    WHEN avg_eval_score >= 40 THEN 'Fair' ELSE 'Needs Improvement' END AS quality_tier
  FROM score_groups)"""

HOUSING = f"""{PERMITS}, housing_groups AS (
  SELECT application_year, application_quarter, ward, structure_type, proposed_use, count(*) AS permit_count,
    CAST(sum(dwelling_units_created) AS BIGINT) AS units_created,
    CAST(sum(dwelling_units_lost) AS BIGINT) AS units_lost,
    CAST(sum(net_dwelling_units) AS BIGINT) AS net_units,
    {_s("estimated_construction_cost", 2)} AS total_cost
  FROM permits
  WHERE application_year >= {FIRST_YEAR}
    AND (dwelling_units_created IS NOT NULL OR dwelling_units_lost IS NOT NULL)
  GROUP BY ALL),
housing AS (
  SELECT *, CAST(sum(net_units) OVER (PARTITION BY ward ORDER BY application_year NULLS FIRST,
    application_quarter NULLS FIRST, structure_type NULLS FIRST, proposed_use NULLS FIRST
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_net_units
  FROM housing_groups)"""

INDEX_TRENDS = f"""{INDEX}, index_wide AS (
  SELECT reference_date, ref_period, geography, ref_year, ref_month, ref_quarter,
    max(CASE WHEN index_type = 'Total (house and land)' THEN index_value END) AS index_total,
    max(CASE WHEN index_type = 'House only' THEN index_value END) AS index_house,
    max(CASE WHEN index_type = 'Land only' THEN index_value END) AS index_land
  FROM price_index GROUP BY ALL),
index_lagged AS (
  SELECT *, lag(index_total, 12) OVER (PARTITION BY geography ORDER BY reference_date, ref_period)
    AS index_total_12m_ago
  FROM index_wide),
index_trends AS (
  SELECT *, {_r("(index_total - index_total_12m_ago) / index_total_12m_ago * 100", 2)} AS yoy_change_pct
  FROM index_lagged)"""

OVERVIEW = f"""{PARCELS}, overview AS (
  SELECT feature_type, count(*) AS property_count, {_a("stated_area_sqm", 2)} AS avg_area_sqm,
    {_a("stated_area_sqft", 2)} AS avg_area_sqft,
    {_r("quantile_disc(stated_area_sqm, 0.5)", 2)} AS median_area_sqm,
    min(stated_area_sqm) AS min_area_sqm, max(stated_area_sqm) AS max_area_sqm,
    {_s("stated_area_sqm", 2)} AS total_area_sqm
  FROM parcels GROUP BY ALL)"""


def _currency(v: str) -> str:
    return f"""CASE WHEN {v} IS NULL THEN 'N/A'
      WHEN abs({v}) >= 1e9 THEN printf('$%.2fB', CAST({v} AS DOUBLE) / 1e9)
      WHEN abs({v}) >= 1e6 THEN printf('$%.1fM', CAST({v} AS DOUBLE) / 1e6)
      WHEN abs({v}) >= 1e3 THEN printf('$%.0fK', CAST({v} AS DOUBLE) / 1e3)
      ELSE format('${{:,.0f}}', CAST({v} AS DOUBLE)) END"""


def _count(v: str) -> str:
    return f"""CASE WHEN {v} IS NULL THEN 'N/A'
      WHEN abs({v}) >= 1e6 THEN printf('%.1fM', CAST({v} AS DOUBLE) / 1e6)
      WHEN abs({v}) >= 1e3 THEN printf('%.1fK', CAST({v} AS DOUBLE) / 1e3)
      ELSE format('{{:,.0f}}', CAST({v} AS DOUBLE)) END"""


def _total(table: str, key: str, measures: str, tail: str = "") -> str:
    return f"SELECT {key}, {measures} FROM {table} WHERE {key} IS NOT NULL GROUP BY {key} {tail}"


def _sum(column: str) -> str:
    return f"CAST(coalesce(sum({column}), 0) AS BIGINT) AS {column}"


def _key_figures(permits: str, money: str, units: str) -> str:
    """The key figures, each table cut by a condition."""
    return f"""WITH {TRENDS}, {INVESTMENT[len(PERMITS) + 2:]}, {HOUSING[len(PERMITS) + 2:]}, {SCORECARD}, {OVERVIEW},
    figures AS (SELECT (SELECT CAST(sum(permit_count) AS BIGINT) FROM trends {permits}) AS total_permits,
      (SELECT CAST(sum(CAST(CAST(total_investment AS VARCHAR) AS DECIMAL(28,9))) AS DOUBLE) FROM investment {money}) AS total_investment,
      (SELECT CAST(sum(net_units) AS BIGINT) FROM housing {units}) AS net_units,
      (SELECT {_a("avg_eval_score", 4)} FROM scorecard) AS avg_score,
      (SELECT CAST(sum(CAST(CAST(avg_eval_score AS VARCHAR) AS DECIMAL(28,9))) AS DOUBLE) / count(avg_eval_score)
        FROM scorecard) AS plain_score,
      (SELECT CAST(sum(property_count) AS BIGINT) FROM overview) AS total_properties)
    SELECT total_permits, {_r("total_investment", 2)} AS total_investment, net_units,
      avg_score, total_properties, {_count("total_permits")} AS total_permits_text,
      {_currency("total_investment")} AS total_investment_text, {_count("net_units")} AS net_units_text,
      printf('%.1f/100', plain_score) AS avg_score_text, {_count("total_properties")} AS total_properties_text
    FROM figures"""


SCORES = """SELECT CASE WHEN l_partkey % 17 <> 0 THEN round(abs(l_discount) * 1000) END AS score,
    l_extendedprice * pow(CAST(10 AS DOUBLE), l_linenumber - 4) AS cost FROM lineitem"""

_AMOUNTS = """SELECT o_orderkey, CASE WHEN o_custkey % 11 <> 0 THEN o_totalprice *
    CAST([0.001, 1.0, -10.0, 1000.0, 100000.0][o_custkey % 5 + 1] AS DOUBLE) END AS amount FROM orders"""

_TABLES = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6,
}

ORACLE: dict[str, str] = {
    "bronze_csv_roundtrip": f"""
        SELECT strftime(o_orderdate, '%Y-%m') AS "REF_DATE", {PLACE_SQL} AS "GEO", 'D' || (o_custkey % 9) AS "DGUID",
          CASE o_orderstatus WHEN 'F' THEN '"House only"' WHEN 'O' THEN ' Land only'
            ELSE 'Total (house and land)' END AS "New_housing_price_indexes", 'Index' AS "UOM",
          CASE WHEN o_custkey % 37 = 0 THEN '..' ELSE CAST(o_totalprice AS VARCHAR) END AS "VALUE",
          CASE WHEN o_custkey % 5 = 0 THEN ' E ' END AS "STATUS",
          'Statistics Canada — New Housing Price Index (18-10-0205-01)' AS source,
          CAST(1 AS INTEGER) AS has_file, CAST(1 AS INTEGER) AS stamped FROM orders""",
    "csv_multiline_text": "SELECT doc_id, lang, source, md5(text) AS text_md5 FROM documents",
    "csv_stitched_text": "SELECT doc_id, lang, source, md5(text) AS text_md5 FROM documents",
    "csv_stray_quotes": """
        SELECT p_partkey AS id, p_size || '" pipe' AS size,
          p_brand || CASE WHEN p_partkey % 2 = 1 THEN chr(10) || '"x", y' ELSE '' END AS brand, p_size || '"' AS inch
        FROM part""",
    "bronze_missing_source": """
        SELECT CASE WHEN l_linestatus = 'O' THEN 'permits_active' ELSE 'permits_cleared' END AS table_name,
          count(*) AS rows, CAST(34 AS INTEGER) AS columns FROM lineitem GROUP BY 1""",
    "source_profile": """
        SELECT 'apartment_registration' AS table_name, count(*) AS rows, CAST(1 AS INTEGER) AS has_bytes FROM supplier
        UNION ALL SELECT 'apartment_evaluations', count(*), 1 FROM lineitem
        UNION ALL SELECT 'TOTAL', (SELECT count(*) FROM supplier) + (SELECT count(*) FROM lineitem), 1""",
    "layer_roundtrip": f"""WITH {OVERVIEW}
        SELECT *, (SELECT count(*) FROM overview) AS rows_written FROM overview""",
    "layer_table_summary": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, CAST({n} AS INTEGER) AS columns FROM {t}"
        for t, n in _TABLES.items()
    ),
    "contract_conform": """
        SELECT CAST(p_partkey AS VARCHAR) AS parcel_id, p_type AS feature_type,
          CAST(DATE '2000-01-01' + CAST(p_size AS INTEGER) AS DATE) AS date_effective,
          p_retailprice AS stated_area_sqm, CAST(NULL AS VARCHAR) AS address_number, p_name AS street_name,
          p_brand AS full_address, CAST(p_size AS BIGINT) AS object_id, CAST(p_size AS DOUBLE) AS stated_area_sqft
        FROM part""",
    "safe_casts": """
        SELECT event_id, CAST(trunc(value) AS INTEGER) AS value_int, TRY_CAST(props AS INTEGER) AS props_int,
          TRY_CAST(CAST(event_id AS VARCHAR) || '9999999' AS INTEGER) AS wide_int,
          TRY_CAST('900719925474099' || user_id AS BIGINT) AS wide_long,
          CASE WHEN event_id % 3 <> 0 THEN value END AS value_double,
          TRY_CAST(CAST(value AS VARCHAR) || ',5' AS DOUBLE) AS comma_double,
          CAST(try_strptime(strftime(ts, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS day,
          CAST(try_strptime(strftime(ts, '%Y/%m/%d'), '%Y/%m/%d') AS DATE) AS slashed_day,
          CAST(try_strptime(event_type, '%Y-%m-%d') AS DATE) AS junk_day,
          CAST(date_trunc('month', ts) AS DATE) AS month
        FROM events""",
    "string_cleanup": """
        SELECT p_partkey AS part_id, p_name AS name, p_brand AS brand, trim('  ' || p_name || ' ') AS tidied,
          trim(replace('" ' || p_type || '"', '"', '')) AS unquoted, substr(p_brand, 1, 3) AS prefix,
          concat_ws(' ', p_name, CASE WHEN p_size % 3 = 0 THEN p_brand END, p_type) AS joined,
          coalesce(CASE WHEN p_size % 3 = 0 THEN p_brand END, p_type) AS first_known,
          CAST(CASE WHEN p_size % 2 = 0 THEN p_size ELSE 0 END AS INTEGER) AS size_or_zero,
          CAST(CASE WHEN p_size % 4 = 0 THEN 0 ELSE 1 END AS INTEGER) AS has_text
        FROM part""",
    "date_parts": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
          CAST(month(o_orderdate) AS INTEGER) AS month, CAST(1 AS INTEGER) AS stamped FROM orders""",
    "tier_left_closed": f"""
        WITH s AS ({SCORES}), t AS (SELECT score,
          CASE WHEN score >= 80 THEN 'Excellent' WHEN score >= 60 THEN 'Good' WHEN score >= 40 THEN 'Fair'
            ELSE 'Needs Improvement' END AS tier,
          CASE WHEN score >= 80 THEN 'Excellent' WHEN score >= 60 THEN 'Good' WHEN score >= 40 THEN 'Fair'
            WHEN score IS NOT NULL THEN 'Needs Improvement' END AS tier_or_null,
          CASE WHEN cost >= 10000000 THEN 'Mega (>$10M)' WHEN cost >= 1000000 THEN 'Major ($1M-$10M)'
            WHEN cost >= 100000 THEN 'Medium ($100K-$1M)' ELSE 'Small (<$100K)' END AS category FROM s)
        SELECT score, tier, tier_or_null, category, count(*) AS rows FROM t GROUP BY ALL""",
    "bin_right_closed": f"""
        WITH s AS ({SCORES}), t AS (SELECT score,
          CASE WHEN score IS NULL THEN NULL WHEN score <= 40 THEN 'Needs Improvement' WHEN score <= 60 THEN 'Fair'
            WHEN score <= 80 THEN 'Good' ELSE 'Excellent' END AS bin,
          CASE WHEN cost <= 100000 THEN 'Small (<$100K)' WHEN cost <= 1000000 THEN 'Medium ($100K-$1M)'
            WHEN cost <= 10000000 THEN 'Major ($1M-$10M)' ELSE 'Mega (>$10M)' END AS category FROM s)
        SELECT score, bin, category, count(*) AS rows FROM t GROUP BY ALL""",
    "abbreviate_numbers": f"""
        WITH a AS ({_AMOUNTS}) SELECT o_orderkey, {_currency("amount")} AS currency_text,
          {_count("amount")} AS count_text, -abs(amount) AS as_loss FROM a""",
    "silver_properties": f"WITH {PARCELS} SELECT *, CAST(1 AS INTEGER) AS stamped FROM parcels",
    "silver_building_assets": """
        SELECT 'F-' || p_partkey AS floc_id, p_name AS building_description, p_brand AS building_address,
          'Ward ' || (p_partkey % 25) AS ward_name, CASE WHEN p_partkey % 6 <> 0 THEN 'Old Town' END
            AS former_municipality, p_type AS district, p_type || ' HALL' AS building_type,
          CASE WHEN p_partkey % 2 = 0 THEN 'Open' ELSE 'Shut' END AS building_status,
          p_retailprice AS gross_floor_area_sqm,
          CASE WHEN p_partkey % 9 <> 0 THEN CAST(p_size AS DOUBLE) END AS gross_floor_area_sqft,
          CASE WHEN p_partkey % 8 <> 0 THEN CAST(1900 + p_size AS INTEGER) END AS year_built,
          CAST(p_partkey % 25 AS VARCHAR) AS ward_number FROM part""",
    "silver_permits": f"WITH {PERMITS} SELECT *, CAST(1 AS INTEGER) AS stamped FROM permits",
    "silver_permits_filled": f"""WITH {PERMITS} SELECT permit_number,
        CAST(coalesce(dwelling_units_created, 0) - coalesce(dwelling_units_lost, 0) AS INTEGER) AS net_dwelling_units
        FROM permits""",
    "silver_apartments": f"WITH {BUILDINGS} SELECT *, CAST(1 AS INTEGER) AS stamped FROM buildings",
    "silver_price_index": f"WITH {INDEX} SELECT *, CAST(1 AS INTEGER) AS stamped FROM price_index",
    "keyword_filter": f"""
        WITH places AS (SELECT {PLACE_SQL} AS geography FROM orders)
        SELECT geography, count(*) AS rows FROM places WHERE contains(geography, 'Ontario')
          OR contains(geography, 'Toronto') OR contains(geography, 'Ottawa') OR contains(geography, 'Hamilton')
          OR contains(geography, 'Windsor') OR contains(geography, 'London') OR contains(geography, 'Guelph')
        GROUP BY geography""",
    "keyword_documents": """SELECT doc_id, lang FROM documents
        WHERE contains(text, 'the') OR contains(text, 'license') OR contains(text, 'und')""",
    "flagship_permit_trends": f"WITH {TRENDS} SELECT * FROM trends",
    "gold_permit_trends": f"WITH {TRENDS} SELECT * FROM trends",
    "gold_construction_investment": f"WITH {INVESTMENT} SELECT * FROM investment",
    "gold_apartment_scorecard": f"WITH {SCORECARD} SELECT * FROM scorecard",
    "gold_housing_development": f"WITH {HOUSING} SELECT * FROM housing",
    "gold_price_index_trends": f"WITH {INDEX_TRENDS} SELECT * FROM index_trends",
    "gold_property_overview": f"WITH {OVERVIEW} SELECT * FROM overview",
    "pivot_discovered": f"""WITH {INDEX_TRENDS}
        SELECT reference_date, ref_period, geography, index_total, index_house, index_land FROM index_wide""",
    "calendar_year_ago": f"""WITH {INDEX_TRENDS}
        SELECT t.reference_date, t.geography, t.index_total, b.index_total AS index_year_ago,
          {_r("(t.index_total - b.index_total) / b.index_total * 100", 2)} AS yoy_change_pct
        FROM index_trends t LEFT JOIN index_trends b
          ON t.geography = b.geography AND t.reference_date = b.reference_date + INTERVAL 12 MONTH""",
    "exact_median_by_group": f"""
        SELECT l_returnflag, l_linenumber, {_r("median(l_extendedprice)", 4)} AS median_price
        FROM lineitem GROUP BY ALL""",
    "exact_median_overall": "SELECT quantile_disc(o_totalprice, 0.5) AS lower_median FROM orders",
    "kpi_row": _key_figures("", "", ""),
    "kpi_row_filtered": _key_figures(
        f"WHERE {YEARS} AND {WARDS} AND permit_type IN ('A', 'R')", f"WHERE {YEARS} AND {WARDS}", f"WHERE {YEARS}"),
    "permits_by_type_filtered": f"WITH {TRENDS} " + _total(
        f"(SELECT * FROM trends WHERE {YEARS} AND {WARDS} AND permit_type IN ('A', 'R'))", "permit_type",
        _sum("permit_count")),
    "investment_by_category_filtered": f"WITH {INVESTMENT} " + _total(
        f"(SELECT * FROM investment WHERE {YEARS} AND {WARDS})", "investment_category",
        f"{_sum('project_count')}, {_s('total_investment', 2)} AS total_investment"),
    "units_by_year_filtered": f"WITH {HOUSING} " + _total(
        f"(SELECT * FROM housing WHERE {YEARS})", "application_year",
        f"{_sum('units_created')}, -abs(CAST(coalesce(sum(units_lost), 0) AS BIGINT)) AS units_lost, "
        f"{_sum('net_units')}"),
    "year_bounds": f"""WITH {TRENDS}
        SELECT min(application_year) AS first_year, max(application_year) AS last_year FROM trends""",
    "filter_options": f"""WITH {TRENDS}, {INDEX_TRENDS}
        SELECT DISTINCT 'application_year' AS dimension, CAST(application_year AS VARCHAR) AS option FROM trends
        UNION ALL SELECT DISTINCT 'ward', ward FROM trends WHERE ward IS NOT NULL
        UNION ALL SELECT DISTINCT 'permit_type', permit_type FROM trends
        UNION ALL SELECT DISTINCT 'geography', geography FROM index_trends""",
    "default_geographies": f"""WITH {INDEX_TRENDS}
        SELECT DISTINCT geography FROM index_trends ORDER BY geography LIMIT 5""",
    "filtered_permits": f"""WITH {TRENDS}
        SELECT * FROM trends WHERE {YEARS} AND {WARDS} AND permit_type IN ('A', 'R')""",
    "filtered_investment": f"WITH {INVESTMENT} SELECT * FROM investment WHERE {YEARS} AND {WARDS}",
    "filtered_housing": f"WITH {HOUSING} SELECT * FROM housing WHERE {YEARS}",
    "permits_by_year": f"WITH {TRENDS} "
    + _total("trends", "application_year", f"{_sum('permit_count')}, {_sum('unique_permits')}"),
    "permits_by_type": f"WITH {TRENDS} " + _total("trends", "permit_type", _sum("permit_count")),
    "top_structures": f"WITH {TRENDS} " + _total(
        "trends", "structure_type", _sum("permit_count"), "ORDER BY permit_count DESC, structure_type LIMIT 3"),
    "top_wards": f"WITH {TRENDS} " + _total(
        "trends", "ward", _sum("permit_count"), "ORDER BY permit_count DESC, ward LIMIT 15"),
    "investment_by_year": f"WITH {INVESTMENT} " + _total(
        "investment", "application_year",
        f"{_s('total_investment', 2)} AS total_investment, {_sum('project_count')}, "
        f"{_a('avg_investment', 2)} AS avg_investment"),
    "investment_by_category": f"WITH {INVESTMENT} " + _total(
        "investment", "investment_category",
        f"{_sum('project_count')}, {_s('total_investment', 2)} AS total_investment"),
    "top_uses": f"WITH {INVESTMENT} " + _total(
        "investment", "current_use", f"{_s('total_investment', 2)} AS total_investment",
        "ORDER BY total_investment DESC, current_use LIMIT 5"),
    "units_by_year": f"WITH {HOUSING} " + _total(
        "housing", "application_year",
        f"{_sum('units_created')}, -abs(CAST(coalesce(sum(units_lost), 0) AS BIGINT)) AS units_lost, "
        f"{_sum('net_units')}"),
    "top_structures_net": f"WITH {HOUSING} " + _total(
        "housing", "structure_type", _sum("net_units"), "ORDER BY net_units DESC, structure_type LIMIT 3"),
    "top_wards_net": f"WITH {HOUSING} " + _total(
        "housing", "ward", _sum("net_units"), "ORDER BY net_units DESC, ward LIMIT 15"),
    "scorecard_table": f"""WITH {SCORECARD}
        SELECT ward, property_type, building_count, avg_eval_score, avg_proactive_score, avg_reactive_score,
          total_units, avg_building_age, quality_tier FROM scorecard""",
    "tier_distribution": f"WITH {SCORECARD} " + _total("scorecard", "quality_tier", _sum("building_count")),
    "score_vs_age": f"""WITH {SCORECARD}
        SELECT avg_building_age, avg_eval_score, total_units, quality_tier FROM scorecard
        WHERE avg_eval_score IS NOT NULL AND avg_building_age IS NOT NULL""",
    "index_series": f"""WITH {INDEX_TRENDS}
        SELECT reference_date, geography, index_total FROM index_trends
        WHERE index_total IS NOT NULL AND geography IN
          (SELECT DISTINCT geography FROM index_trends ORDER BY geography LIMIT 5)""",
    "index_series_house": f"""WITH {INDEX_TRENDS}
        SELECT reference_date, geography, index_house FROM index_trends
        WHERE index_house IS NOT NULL AND geography IN ('Toronto', 'Windsor')""",
    "index_series_land": f"""WITH {INDEX_TRENDS}
        SELECT reference_date, geography, index_land FROM index_trends WHERE index_land IS NOT NULL""",
    "yoy_series": f"""WITH {INDEX_TRENDS}
        SELECT reference_date, geography, yoy_change_pct FROM index_trends WHERE yoy_change_pct IS NOT NULL""",
    "properties_by_count": f"WITH {OVERVIEW} SELECT feature_type, property_count FROM overview",
    "properties_by_area": f"WITH {OVERVIEW} SELECT feature_type, avg_area_sqft FROM overview",
}

# Layer table -> the query that has it as its last table, and that table's name.
_CTES = {
    (CLEAN, "building_permits"): (PERMITS, "permits"),
    (CLEAN, "properties"): (PARCELS, "parcels"),
    (CLEAN, "apartment_buildings"): (BUILDINGS, "buildings"),
    (CLEAN, "housing_price_index"): (INDEX, "price_index"),
    (MART, "permit_trends"): (TRENDS, "trends"),
    (MART, "construction_investment"): (INVESTMENT, "investment"),
    (MART, "apartment_scorecard"): (SCORECARD, "scorecard"),
    (MART, "housing_development"): (HOUSING, "housing"),
    (MART, "price_index_trends"): (INDEX_TRENDS, "index_trends"),
    (MART, "property_overview"): (OVERVIEW, "overview"),
}


def _catalog_rows(layer: str, table: str) -> str:
    """One row per column: the cells that are known, none in the raw tables."""
    fields = contract(layer, table)
    rows = []
    for i, field in enumerate(fields, 1):
        counted = "0" if layer == RAW else "count(*)" if field.name == "_silver_timestamp" else f'count("{field.name}")'
        rows.append(
            f"{{'layer': '{layer}', 'table_name': '{table}', 'position': CAST({i} AS INTEGER), 'column': '{field.name}', "
            f"'type': '{field.dataType.simpleString()}', 'filled': CAST({counted} AS BIGINT)}}"
        )
    if layer == RAW:
        return f"SELECT unnest([{', '.join(rows)}], recursive := true)"
    cte, name = _CTES[layer, table]
    return f"SELECT unnest(l, recursive := true) FROM (WITH {cte} SELECT [{', '.join(rows)}] AS l FROM {name})"


ORACLE["catalog_layers"] = " UNION ALL ".join(
    _catalog_rows(layer, table) for layer in (RAW, CLEAN, MART) for table in tables(layer)
)

# Source -> column -> the rows of the stand-in whose cell is junk; other typed columns parse everywhere.
_JUNK = {
    "permits": ("lineitem", {
        "revision_number": "l_suppkey % 13 = 0", "geo_id": "false", "application_date": "l_partkey % 53 = 0",
        "issued_date": "false", "completed_date": "false", "dwelling_units_created": "false",
        "dwelling_units_lost": "false", "estimated_construction_cost": "l_partkey % 31 = 0"}),
    "property_boundaries": ("part", {
        "date_effective": "p_size % 7 = 0", "stated_area_sqm": "false", "object_id": "false"}),
    "apartment_registration": ("supplier", {
        "rsn": "s_suppkey % 17 = 0", "year_built": "false", "year_registered": "false", "elevators": "false",
        "storeys": "s_suppkey % 29 = 5", "units": "false"}),
    "apartment_evaluations": ("lineitem", {
        "rsn": "l_suppkey % 10 = 3", "year_evaluated": "false", "eval_score": "l_suppkey % 25 = 6",
        "proactive_score": "false", "reactive_score": "false", "areas_evaluated": "false", "latitude": "false",
        "longitude": "false"}),
    "housing_price_index": (f"""(SELECT o_custkey, {PLACE_SQL} AS place FROM orders)
        WHERE place IN ('Toronto', 'London', 'Windsor', 'Guelph', 'Hamilton') OR contains(place, 'Ontario')""", {
        "reference_date": "false", "index_value": "o_custkey % 37 = 0"}),
}
ORACLE["rejected_cells"] = " UNION ALL ".join(
    f"SELECT '{source}' AS source, '{column}' AS \"column\", count_if({junk})::BIGINT AS rejected FROM {rows}"
    for source, (rows, columns) in _JUNK.items()
    for column, junk in columns.items()
)

_LANDED = {
    "permits_active": "(SELECT 1 FROM lineitem WHERE l_linestatus = 'O')",
    "permits_cleared": "(SELECT 1 FROM lineitem WHERE l_linestatus <> 'O')",
    "property_boundaries": "part", "building_assets": "part", "apartment_registration": "supplier",
    "apartment_evaluations": "lineitem", "housing_price_index": "orders",
}
ORACLE["pipeline_end_to_end"] = " UNION ALL ".join(
    [f"SELECT '{RAW}' AS layer, '{t}' AS table_name, count(*) AS written, count(*) AS rows FROM {q}" for t, q in _LANDED.items()]
    + [
        f"SELECT '{layer}', '{table}', n, n FROM (WITH {cte} SELECT count(*) AS n FROM {name})"
        for (layer, table), (cte, name) in _CTES.items()
    ]
)
