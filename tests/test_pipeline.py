"""CSV files to reporting tables, catalog definitions, and the shape of the plans."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from civicmart.contracts import AUDIT_COLUMNS, CLEAN, MART, RAW, contract, source_columns, tables
from civicmart.operators.dedup import latest_per_key
from civicmart.operators.medians import exact_median
from civicmart.plans import gold, pipeline
from civicmart.session import scratch_dir, shuffle_partitions, staged
from civicmart.sinks.catalog import create_tables
from civicmart.sinks.tables import layer_summary, replace_table
from civicmart.sources.extracts import EXTRACTS, profile, read_csv, read_extract, read_present, reading_plan
from civicmart.sources.layers import MissingTableError, read_clean, read_mart, read_table


def write_csv(folder, table, rows, bom=False, columns=None):
    names = columns or source_columns(table)
    text = io.StringIO()
    writer = csv.DictWriter(text, names, lineterminator="\n", extrasaction="ignore")
    writer.writeheader()
    writer.writerows(rows)
    path = folder / EXTRACTS[table].file
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.getvalue().encode())
    return path


@pytest.fixture(scope="module")
def raw_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    write_csv(folder, "permits_active", [
        {"PERMIT_NUM": "P1", "REVISION_NUM": "0", "APPLICATION_DATE": "2020-02-01", "EST_CONST_COST": "100", "WARD_GRID": "1",
         "DESCRIPTION": 'two\nlines, "quoted" and a comma', "DWELLING_UNITS_CREATED": "3", "DWELLING_UNITS_LOST": "1"},
        {"PERMIT_NUM": "P1", "REVISION_NUM": "1", "APPLICATION_DATE": "2020-02-01", "EST_CONST_COST": "200.5", "WARD_GRID": "1",
         "DESCRIPTION": "second\n\nrevision", "DWELLING_UNITS_CREATED": "4", "DWELLING_UNITS_LOST": "1"},
    ])
    shuffled = ["EXTRA", *reversed(source_columns("permits_cleared"))]
    write_csv(folder, "permits_cleared", [
        {"PERMIT_NUM": "P2", "REVISION_NUM": "0", "APPLICATION_DATE": "2019-02-01", "EST_CONST_COST": "N/A", "WARD_GRID": "1",
         "DWELLING_UNITS_LOST": "2", "EXTRA": "kept"},
    ], columns=shuffled)
    write_csv(folder, "property_boundaries", [{"PARCELID": "A", "FEATURE_TYPE": "LOT", "DATE_EFFECTIVE": "2024/01/01", "STATEDAREA": "100"}])
    write_csv(folder, "building_assets", [{"FLOC_ID": "F1", "Gross Floor Area (M2)": "7"}])
    write_csv(folder, "land_assets", [{"FLOC_ID": "L1", "Area (M2)": "7"}])
    write_csv(folder, "apartment_registration", [{"RSN": "1", "WARD": "1", "PROPERTY_TYPE": "TCHC", "YEAR_BUILT": "1970"}])
    write_csv(folder, "apartment_evaluations", [{"RSN": "1", "YEAR EVALUATED": "2023", "CURRENT BUILDING EVAL SCORE": "81"}])
    write_csv(folder, "housing_price_index", [
        {"REF_DATE": "1981-01", "GEO": "Ottawa-Gatineau, Ontario part", "New housing price indexes": "House only", "VALUE": "38.2"},
    ], bom=True)
    return folder


@pytest.fixture(scope="module")
def lake(spark, raw_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("lake"))
    written = pipeline.run(spark, str(raw_dir), folder, export_dir=f"{folder}/export")
    return folder, written


def test_rows_written_per_layer(lake):
    _, written = lake
    assert written[RAW] == {t: 2 if t == "permits_active" else 1 for t in EXTRACTS}
    assert written[CLEAN] == {"properties": 1, "building_permits": 2, "apartment_buildings": 1, "housing_price_index": 1}
    assert written[MART] == {
        "permit_trends": 2, "construction_investment": 1, "apartment_scorecard": 1, "housing_development": 2,
        "price_index_trends": 1, "property_overview": 1,
    }


def test_landed_tables_are_text_with_audit(spark, lake):
    folder, _ = lake
    landed = read_table(spark, folder, RAW, "permits_active")
    assert [f.name for f in landed.schema] == [f.name for f in contract(RAW, "permits_active")]
    row = landed.filter("REVISION_NUM = '0'").first()
    assert row["DESCRIPTION"] == 'two\nlines, "quoted" and a comma'
    stamp, source, file = AUDIT_COLUMNS
    assert row[stamp] is not None and row[source] == EXTRACTS["permits_active"].label
    assert row[file].endswith("toronto_permits_active.csv")
    assert read_table(spark, folder, RAW, "permits_cleared").first()["EXTRA"] == "kept"
    assert read_table(spark, folder, RAW, "housing_price_index").first()["REF_DATE"] == "1981-01"
    assert "Gross Floor Area (M2)" in read_table(spark, folder, RAW, "building_assets").columns


def test_reporting_tables_and_export(spark, lake):
    folder, _ = lake
    housing = {r["application_year"]: r for r in read_mart(spark, folder, "housing_development").collect()}
    assert housing[2019]["net_units"] is None and housing[2020]["cumulative_net_units"] == 3
    assert housing[2020]["total_cost"] == 200.5
    exported = spark.read.parquet(f"{folder}/export/permit_trends.parquet")
    assert sorted(exported.collect(), key=str) == sorted(read_mart(spark, folder, "permit_trends").collect(), key=str)
    shown = pipeline.summary(spark, folder, MART, tables(MART)).collect()
    assert {(r["table_name"], r["columns"]) for r in shown} == {(t, len(contract(MART, t))) for t in tables(MART)}


def test_running_again_gives_the_same_tables(spark, lake, raw_dir):
    folder, written = lake
    before = {t: sorted(read_mart(spark, folder, t).collect(), key=str) for t in tables(MART)}
    assert pipeline.run(spark, str(raw_dir), folder, multi_line=True) == written
    assert before == {t: sorted(read_mart(spark, folder, t).collect(), key=str) for t in tables(MART)}


def test_missing_files_are_left_out(spark, tmp_path):
    write_csv(tmp_path, "land_assets", [{"FLOC_ID": "L1"}])
    assert list(read_present(spark, str(tmp_path))) == ["land_assets"]
    assert [(r["table_name"], r["rows"]) for r in profile(spark, str(tmp_path)).orderBy("table_name").collect()] == [
        ("TOTAL", 1), ("land_assets", 1),
    ]
    assert profile(spark, str(tmp_path / "none")).count() == 0


def test_profile_counts_records_not_lines(spark, raw_dir):
    got = {r["table_name"]: r for r in profile(spark, str(raw_dir)).collect()}
    assert got["permits_active"]["rows"] == 2 and got["TOTAL"]["rows"] == 9
    assert got["permits_active"]["bytes"] == (raw_dir / EXTRACTS["permits_active"].file).stat().st_size
    assert got["TOTAL"]["bytes"] == sum((raw_dir / e.file).stat().st_size for e in EXTRACTS.values())


def test_missing_table_is_named(spark, tmp_path):
    with pytest.raises(MissingTableError, match="gold.permit_trends"):
        read_mart(spark, str(tmp_path), "permit_trends")


def test_absent_columns_are_null(spark, tmp_path):
    write_csv(tmp_path, "land_assets", [{"FLOC_ID": "L1"}], columns=["FLOC_ID", "Address"])
    df = read_extract(spark, EXTRACTS["land_assets"], str(tmp_path))
    assert set(source_columns("land_assets")) <= set(df.columns) and df.first()["Area (M2)"] is None


def test_part_files_with_another_header_are_rejected(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n")
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path)).collect()


def test_split_reading_only_where_records_end_with_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"a\nb"\n2,c\n')
    (tmp_path / "b.csv").write_text('x,y\n3,"d ""q"""\n4,e\n')
    expected = [("1", "a\nb"), ("2", "c"), ("3", 'd "q"'), ("4", "e")]
    for mode in (True, "auto"):
        df = read_csv(spark, str(tmp_path), multi_line=mode, file_column="f")
        assert [tuple(r)[:2] for r in df.orderBy("x").collect()] == expected
        assert df.filter("f like '%a.csv'").count() == 2


def test_stitched_records_equal_the_whole_file_reader(spark, tmp_path):
    draw = random.Random(11)
    pieces = ["a", "b c", '"', ",", "\n", "\r\n", "é", " ", "''", "\\", "\n\n"]
    for name in ("one", "two"):
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8-sig") as out:
            writer = csv.writer(out, lineterminator="\n" if name == "one" else "\r\n")
            writer.writerow(["id", "Text (raw)", "note"])
            for i in range(400):
                cell = "".join(draw.choice(pieces) for _ in range(draw.randrange(0, 60)))
                writer.writerow([f"{name}{i}", cell, "x" if i % 3 else ""])
    whole = read_csv(spark, str(tmp_path), multi_line=True, file_column="f")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        stitched = read_csv(spark, str(tmp_path), file_column="f")
        assert stitched.columns == whole.columns
        got = sorted(map(tuple, stitched.collect()), key=repr)
        blocks = spark.read.text(str(tmp_path)).select("_metadata.file_block_start").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert blocks > 10 and len(got) == 800
    assert got == sorted(map(tuple, whole.collect()), key=repr)


def test_reading_plan(spark, tmp_path):
    (tmp_path / "plain.csv").write_text('x,y\n3,"d ""q"""\n4,""\n')
    (tmp_path / "open.csv").write_text('x,y\n1,"a\n""b"" c"\n')
    (tmp_path / "inch.csv").write_text('x,y\n1,5" pipe\n2,6"\n')
    (tmp_path / "stray.csv").write_text('x,y\n1,5" pipe\n2,"a\nb"\n')
    (tmp_path / "even.csv").write_text('x,y,z\n1,5","a\nb"\n')
    plan = reading_plan(spark, str(tmp_path))
    names = {way: sorted(f.rsplit("/", 1)[1] for f in files) for way, files in plan.items()}
    assert names == {"split": ["inch.csv", "plain.csv"], "whole": ["even.csv", "stray.csv"], "stitch": ["open.csv"]}


def test_stray_quotes_give_the_records_of_the_whole_file_reader(spark, tmp_path):
    (tmp_path / "a.csv").write_text('w,x,y,z\n1,5" pipe,"multi\nline",6" pipe\n2,b,c,d\n')
    (tmp_path / "b.csv").write_text('w,x,y,z\n3,5","multi\nline",6\n4,"p\nq",,\n')
    whole, auto = (rows(read_csv(spark, str(tmp_path), multi_line=m)) for m in (True, "auto"))
    assert auto == whole and len(auto) == 4


def test_stitched_files_with_another_header_are_rejected(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"a\nb"\n')
    (tmp_path / "b.csv").write_text('y,x\n"c\nd",2\n')
    with pytest.raises(Exception, match="header differs"):
        read_csv(spark, str(tmp_path)).collect()
    (tmp_path / "b.csv").write_text('y,x\nc,2\n')
    with pytest.raises(ValueError, match="differ in their headers"):
        read_csv(spark, str(tmp_path))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_overwrite_replaces_rows_and_schema(spark, tmp_path, fmt):
    lake = str(tmp_path)
    assert replace_table(spark.range(5), lake, "x", "t", fmt) == 5
    assert replace_table(spark.range(3).withColumn("b", F.lit("z")), lake, "x", "t", fmt) == 3
    assert replace_table(spark.range(3).withColumn("b", F.lit("z")), lake, "x", "t", fmt, partition_by="b") == 3
    assert read_table(spark, lake, "x", "t", fmt).columns == ["id", "b"]
    assert [tuple(r) for r in layer_summary({"t": read_table(spark, lake, "x", "t", fmt)}).collect()] == [("t", 3, 2)]


def test_catalog(spark):
    made = create_tables(spark, namespace="cat_")
    assert len(made) == 18 and create_tables(spark, namespace="cat_") == made
    twin = spark.table("cat_bronze.permits_cleared").schema
    assert twin == spark.table("cat_bronze.permits_active").schema
    for layer in (RAW, CLEAN, MART):
        for t in tables(layer):
            assert spark.table(f"cat_{layer}.{t}").schema == contract(layer, t)
    notes = spark.sql("DESCRIBE TABLE EXTENDED cat_gold.permit_trends").collect()
    assert any(r["col_name"] == "Comment" and "Permit activity" in r["data_type"] for r in notes)


# ---- plans ------------------------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_row_is_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as r", "cast(id as string) as t")
    plan = plan_of(latest_per_key(df, ["k"], "r"))
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_reporting_scan_is_pruned_and_filtered(spark, lake):
    folder, _ = lake
    permits = read_table(spark, folder, CLEAN, "building_permits")
    plan = plan_of(gold.permit_trends(permits, one_row_per_permit=True))
    # The year names folders, so the filter reaches the listing of files.
    assert ">= 2017)" in plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "description" not in plan and plan.count("Exchange") == 1


def test_no_plan_multiplies_frames_or_gathers_rows(spark, lake):
    folder, _ = lake
    for table, (build, inputs) in pipeline.MART_PLANS.items():
        plan = plan_of(build(*[read_clean(spark, folder, t) for t in inputs]))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, table
        assert "SinglePartition" not in plan, table


def test_reporting_tables_read_their_input_once(spark, lake, monkeypatch):
    from civicmart.operators import medians

    folder, _ = lake
    built = []

    def noted(df, label):
        built.append(df)
        return staged(df, label)

    monkeypatch.setattr(medians, "staged", noted)
    monkeypatch.setattr(gold, "staged", noted)
    for table, source in (("construction_investment", "building_permits"), ("housing_development", "building_permits"), ("property_overview", "properties")):
        built.clear()
        df = pipeline.MART_PLANS[table][0](read_clean(spark, folder, source))
        df.collect()
        frames = [*built, df]
        reading = [f for f in frames if any(f"/{source}/" in name for name in f.inputFiles())]
        assert len(reading) == 1 and plan_of(reading[0]).count("FileScan") == 1, table


def test_recent_years_leave_other_folders_unread(spark, lake):
    folder, _ = lake
    permits = read_clean(spark, folder, "building_permits")
    plan = plan_of(gold.permit_trends(permits, 2020, one_row_per_permit=True))
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "application_year" in filters and "2020" in filters
    years = {r[0] for r in permits.select("application_year").collect()}
    assert years == {2019, 2020} and permits.columns == contract(CLEAN, "building_permits").fieldNames()


def test_shuffles_follow_the_bytes_of_their_input(spark, lake, monkeypatch):
    folder, _ = lake
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr("civicmart.session._SHUFFLE_TARGET_BYTES", 100)
    with pipeline.sized_shuffles(spark, f"{folder}/{RAW}/permits_active", f"{folder}/none") as n:
        assert n > 20 and spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    folder = str(tmp_path)
    assert replace_table(spark.range(10), folder, MART, "t") == 10
    opened = read_table(spark, folder, MART, "t")
    broken = spark.range(1000, numPartitions=8).withColumn("id", F.when(F.col("id") == 900, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="half-way"):
        replace_table(broken, folder, MART, "t")
    assert read_table(spark, folder, MART, "t").count() == 10
    assert replace_table(spark.range(5), folder, MART, "t") == 5
    assert read_table(spark, folder, MART, "t").count() == 5
    assert opened.count() == 10  # its version is still there for who reads it
    replace_table(spark.range(3), folder, MART, "t")
    replace_table(read_table(spark, folder, MART, "t").where("id > 0"), folder, MART, "t")
    assert read_table(spark, folder, MART, "t").count() == 2
    assert len([p for p in (tmp_path / MART / "t").iterdir()]) == 2


def test_median_counts_before_it_ranks(spark):
    df = spark.range(1000).selectExpr("id % 2 as k", "cast(id as double) as v")
    plan = plan_of(exact_median(df, ["k"], "v", "m"))
    assert "percentile" not in plan and "collect" not in plan


def test_scratch_is_below_the_configured_folder(spark):
    path = scratch_dir(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir")) and path != scratch_dir(spark, "x")


def test_shuffle_partitions_follow_the_data():
    assert shuffle_partitions(10, 8) == 8
    assert shuffle_partitions(100 * 1024**4, 1000) == 819200


def test_an_open_quote_over_whole_blocks_is_an_error(spark, tmp_path):
    """Blocks of 2 kB: a record of one block and a half is read, one that never ends names its file."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        good = tmp_path / "good.csv"
        lines = "\n".join(f"line {i}" for i in range(350))
        good.write_text("a,b\n" + "".join(f"{i},x\n" for i in range(300)) + f'1000,"{lines}"\n' + "".join(f"{i},y\n" for i in range(2000, 2300)))
        got = read_csv(spark, str(good)).collect()
        assert len(got) == 601 and {r.b for r in got} == {"x", "y", lines}
        bad = tmp_path / "bad.csv"
        bad.write_text('a,b\n1,"open\n' + "".join(f"{i},x\n" for i in range(3000)))
        with pytest.raises(Exception, match=r"a record reaches over two blocks.*bad.csv at byte"):
            read_csv(spark, str(bad)).collect()
    finally:
        for key in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
            spark.conf.unset(f"spark.sql.files.{key}")


def test_rejected_cells_are_counted_in_the_write(spark, lake):
    folder, written = lake
    rejections = pipeline.silver.Rejections()
    assert pipeline.clean(spark, folder, rejections=rejections) == written[CLEAN]
    assert {k: n for k, n in rejections.counts().items() if n} == {("permits", "estimated_construction_cost"): 1}
    shown = {(r.source, r.column) for r in rejections.frame(spark).collect()}
    assert ("apartment_registration", "storeys") in shown and ("housing_price_index", "index_value") in shown


def test_catalog_tables_are_filled_from_the_lake(spark, lake):
    folder, written = lake
    names = pipeline.fill_catalog(spark, folder, "filled_")
    assert len(names) == 18
    for layer in (RAW, CLEAN, MART):
        for table in tables(layer):
            df = spark.table(f"filled_{layer}.{table}")
            assert df.count() == written[layer].get(table, 0), table
            assert df.columns == contract(layer, table).fieldNames()
    assert spark.table(f"filled_{CLEAN}.building_permits").select(F.max("application_year")).first()[0] == 2020


def test_lines_are_joined_as_they_are_read():
    """Without a shuffle: batches of two blocks, a record over the end of a batch and one over the end of a block."""
    import pyarrow as pa

    from civicmart.sources.extracts import _END, _START, _line_joiner

    def batch(*rows):
        return pa.RecordBatch.from_arrays([pa.array([u for u, _ in rows]), pa.array([t for _, t in rows])], names=["unit", "line"])

    batches = [
        batch((7, "a,b"), (7, '1,"x')),
        batch((7, 'y"'), (7, '2,"z')),
        batch((9, "z"), (9, 'z"'), (9, "3,c"), (9, '4,"p'), (9, 'q"'), (9, "5,d")),
    ]
    made = [tuple(r.values()) for b in _line_joiner({7: (0, 0), 9: (64, 1)})(iter(batches)) for r in b.to_pylist()]
    assert made == [
        (7, True, 0, "a,b", None),
        (7, False, 0, '1,"x\ny"', None),
        (7, False, _END, None, '2,"z'),
        (9, False, _START, None, 'z\nz"'),
        (9, False, 0, "3,c", None),
        (9, False, 0, '4,"p\nq"', None),
        (9, False, 0, "5,d", None),
    ]
