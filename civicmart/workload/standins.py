"""Raw extracts derived from the test tables, every cell as text.

Each function covers its whole table.  Junk cells, blanks and NULLs are mixed in
by key arithmetic so that the cleaning rules have something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FIRST_YEAR = 1997  # year bound on the test dates


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(column: str, plus: int = 0) -> str:
    return f"cast(date_add(cast({column} as date), {plus}) as string)"


def permit_extracts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(active, cleared) permits from lineitem; the active file has no completion date."""
    lines = table(spark, sf_dir, "lineitem")
    cells = [
        "case when l_orderkey % 97 = 0 then '  ' else concat(' P', l_orderkey, ' ') end as PERMIT_NUM",
        "case when l_suppkey % 13 = 0 then 'n/a' else cast(l_linenumber as string) end as REVISION_NUM",
        "l_returnflag as PERMIT_TYPE",
        "concat('S', l_partkey % 5) as STRUCTURE_TYPE",
        "concat('W', l_suppkey % 3, ' ') as WORK",
        "cast(l_suppkey as string) as STREET_NUM",
        "concat(' Street ', l_partkey % 50, ' ') as STREET_NAME",
        "case when l_partkey % 4 <> 0 then 'AVE' end as STREET_TYPE",
        "case when l_suppkey % 2 = 0 then 'N' end as STREET_DIRECTION",
        "concat('M', l_suppkey % 10, 'V ', l_partkey % 7) as POSTAL",
        "cast(l_partkey * 1000003 as string) as GEO_ID",
        "case when l_partkey % 41 <> 0 then cast(l_suppkey % 25 as string) end as WARD_GRID",
        f"case when l_partkey % 53 = 0 then 'unknown' else {_day('l_shipdate')} end as APPLICATION_DATE",
        f"{_day('l_shipdate', 30)} as ISSUED_DATE",
        f"{_day('l_shipdate', 90)} as COMPLETED_DATE",
        "case when l_linestatus = 'O' then 'Permit Issued' else 'Closed' end as STATUS",
        "concat('line ', l_linenumber, ' says \"go\"\\nand more') as DESCRIPTION",
        "concat('U', l_partkey % 7) as CURRENT_USE",
        "concat('P', l_suppkey % 4) as PROPOSED_USE",
        "concat(nullif(cast(l_quantity as int) % 7, 0), '.0') as DWELLING_UNITS_CREATED",
        "cast(nullif(cast(l_quantity as int) % 5, 0) as string) as DWELLING_UNITS_LOST",
        "case when l_partkey % 31 = 0 then 'N/A' when l_partkey % 29 = 0 then '0'"
        " when l_suppkey % 11 = 0 then cast(l_extendedprice * 100.0D as string)"
        " else cast(l_extendedprice as string) end as EST_CONST_COST",
    ]
    active = lines.filter("l_linestatus = 'O'").selectExpr(*cells).drop("COMPLETED_DATE")
    cleared = lines.filter("l_linestatus <> 'O'").selectExpr(*cells)
    return active, cleared


def parcel_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcels from part: two revisions per parcel, some with the same or a bad date."""
    return table(spark, sf_dir, "part").selectExpr(
        "case when p_partkey % 61 <> 0 then concat('PC', p_partkey div 2) end as PARCELID",
        "p_type as FEATURE_TYPE",
        "case when p_size % 7 = 0 then '2000/99/01'"
        " else replace(cast(date_add(date'2000-01-01', p_size * 30) as string), '-', '/') end as DATE_EFFECTIVE",
        "case when p_partkey % 23 = 0 then '' else cast(p_retailprice as string) end as STATEDAREA",
        "case when p_size % 5 <> 0 then cast(p_size as string) end as ADDRESS_NUMBER",
        "concat(' ', p_brand, ' ') as LINEAR_NAME_FULL",
        "cast(p_partkey * 4294967296 as string) as OBJECTID",
    )


def asset_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City-owned buildings from part."""
    return table(spark, sf_dir, "part").selectExpr(
        "concat('F-', p_partkey) as FLOC_ID",
        "concat(' ', p_name) as `Building Description`",
        "concat(p_brand, ' ') as `Address`",
        "concat(' Ward ', p_partkey % 25) as `Ward Name`",
        "case when p_partkey % 6 <> 0 then ' Old Town ' end as `Former Municipality`",
        "p_type as `District`",
        "concat(p_type, ' HALL') as `Building Type`",
        "case when p_partkey % 2 = 0 then 'Open ' else 'Shut' end as `Building Status`",
        "cast(p_retailprice as string) as `Gross Floor Area (M2)`",
        "case when p_partkey % 9 = 0 then 'NaN' else cast(p_size as string) end as `Gross Floor Area (FT2)`",
        "case when p_partkey % 8 = 0 then 'c. 1900' else concat(1900 + p_size, '.5') end as `Year Built`",
        "cast(p_partkey % 25 as string) as WARD",
    )


def registration_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apartment registrations from supplier."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "case when s_suppkey % 17 = 0 then 'x' else cast(s_suppkey as string) end as RSN",
        "concat(' ', s_name) as SITE_ADDRESS",
        "element_at(array('PRIVATE', 'TCHC', 'SOCIAL HOUSING'), cast(s_suppkey % 3 as int) + 1) as PROPERTY_TYPE",
        "cast(s_nationkey as string) as WARD",
        "case when s_suppkey % 19 = 0 then '' else cast(1950 + s_suppkey % 70 as string) end as YEAR_BUILT",
        "'2017' as YEAR_REGISTERED",
        "case when s_suppkey % 3 <> 0 then cast(s_suppkey % 200 + 10 as string) end as CONFIRMED_UNITS",
        "case when s_suppkey % 29 = 5 then 'unk' when s_suppkey % 4 <> 0 then cast(s_suppkey % 12 as string)"
        " end as CONFIRMED_STOREYS",
        "case when s_suppkey % 2 = 0 then 'GAS' else 'ELECTRIC ' end as HEATING_TYPE",
        "'NONE' as AIR_CONDITIONING_TYPE",
        "concat('M', s_suppkey % 9, 'A 1B', s_suppkey % 5) as PCODE",
        "cast(s_suppkey % 6 as string) as NO_OF_STOREYS",
        "cast(s_suppkey % 90 + 5 as string) as NO_OF_UNITS",
        "'Surface' as PARKING_TYPE",
        "cast(s_suppkey % 4 as string) as NO_OF_ELEVATORS",
        "case when s_suppkey % 5 = 0 then 'NO' else ' YES' end as PETS_ALLOWED",
        "'YES' as LAUNDRY_ROOM",
        "case when s_suppkey % 7 = 0 then 'YES ' end as BIKE_PARKING",
    )


# Whole scores by building, so that groups reach every tier, its edges and no score at all.
SCORE_SQL = """case when l_suppkey % 25 = 6 then 'n/a'
    else cast((l_suppkey * 20) % 120 - if((l_suppkey * 20) % 120 > 100, 15, 0) + l_linenumber % 2 as string) end"""


def evaluation_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Building evaluations from lineitem, many per building and year."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "case when l_suppkey % 10 = 3 then '?' else cast(l_suppkey as string) end as RSN",
        "cast(year(l_shipdate) as string) as `YEAR EVALUATED`",
        f"{SCORE_SQL} as `CURRENT BUILDING EVAL SCORE`",
        "cast(round(abs(l_tax) * 1000) as string) as `PROACTIVE BUILDING SCORE`",
        "case when l_partkey % 3 <> 0 then cast(l_quantity as string) end as `CURRENT REACTIVE SCORE`",
        "cast(l_linenumber as string) as `NO OF AREAS EVALUATED`",
        "cast(43 + l_partkey % 100 as string) as LATITUDE",
        "cast(-79 - l_suppkey % 100 as string) as LONGITUDE",
    )


# Shared by both engines: place name by order priority and customer.
PLACE_SQL = """case o_orderpriority
    when '1-URGENT' then case o_custkey % 3 when 0 then 'Toronto' when 1 then 'London' else 'Windsor' end
    when '2-HIGH' then case o_custkey % 2 when 0 then 'Guelph' else 'Ottawa-Gatineau, Ontario part' end
    when '3-MEDIUM' then case o_custkey % 2 when 0 then 'Quebec' else 'Ottawa-Gatineau, Quebec part' end
    when '4-NOT SPECIFIED' then ' Northern Ontario '
    else 'Hamilton' end"""


def index_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly price index from orders, several measurements per month, place and type."""
    return table(spark, sf_dir, "orders").selectExpr(
        "substr(cast(cast(o_orderdate as date) as string), 1, 7) as REF_DATE",
        f"{PLACE_SQL} as GEO",
        "concat('D', o_custkey % 9) as DGUID",
        "case o_orderstatus when 'F' then '\"House only\"' when 'O' then ' Land only'"
        " else 'Total (house and land)' end as `New housing price indexes`",
        "'Index' as UOM",
        "case when o_custkey % 37 = 0 then '..' else cast(o_totalprice as string) end as VALUE",
        "case when o_custkey % 5 = 0 then ' E ' end as STATUS",
    )
