"""De-duplication, joins, medians, running totals, pivots and shaping, against plain Python."""

import math
import random
import statistics
from collections import defaultdict
from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civicmart.operators import dedup, medians, series, shaping

quick = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- newest row per key -----------------------------------------------------------------


def test_highest_revision_wins(spark):
    df = spark.createDataFrame(
        [("x7", 4, 12.5), ("x7", 9, 3.25), ("x8", 2, 8.0), ("x7", 6, 99.0)], "n string, r int, cost double"
    )
    assert rows(dedup.latest_per_key(df, ["n"], "r")) == [("x7", 9, 3.25), ("x8", 2, 8.0)]


def test_latest_date_and_latest_year_win(spark):
    parcels = spark.createDataFrame(
        [("lot-q", date(1998, 7, 31), 11.0), ("lot-q", date(1998, 8, 1), 12.0), ("lot-r", date(2011, 2, 3), 13.0)],
        "p string, d date, a double",
    )
    assert [r[2] for r in rows(dedup.latest_per_key(parcels, ["p"], "d"))] == [12.0, 13.0]
    scores = spark.createDataFrame([(5, 1990, 7.0), (6, 1991, 8.0), (5, 1989, 70.0)], "k long, y int, s double")
    assert rows(dedup.latest_per_key(scores, ["k"], "y")) == [(5, 1990, 7.0), (6, 1991, 8.0)]


def test_missing_revision_is_oldest_and_ties_are_settled(spark):
    data = [("a", None, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "q"), (None, 3, "n")]
    expected = [("a", 1, "y"), ("b", None, "q"), (None, 3, "n")]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, r int, t string").repartition(seed + 1)
        assert rows(dedup.latest_per_key(df, ["k"], "r")) == sorted(expected, key=repr)


@quick
@given(st.lists(st.tuples(st.integers(0, 5), st.none() | st.integers(0, 3), st.integers(0, 9)), max_size=60))
def test_one_row_per_key_whatever_the_partitioning(spark, data):
    best = {}
    for row in data:
        order = (row[1] is None, -(row[1] or 0), row[2])
        if row[0] not in best or order < best[row[0]][0]:
            best[row[0]] = (order, row)
    df = spark.createDataFrame(data, "k int, r int, v int")
    for parts in (1, 5):
        got = rows(dedup.latest_per_key(df.repartition(parts), ["k"], "r"))
        assert got == sorted((b[1] for b in best.values()), key=repr)


def test_union_keeps_all_rows_and_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "i int, only_a string")
    b = spark.createDataFrame([(2,), (3,)], "i int")
    both = dedup.union_tagged({"left": a, "right": b}, "origin")
    assert rows(both.select("i", "only_a", "origin")) == [(1, "x", "left"), (2, None, "right"), (3, None, "right")]


def test_join_keeps_every_left_row(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k long, n string")
    right = spark.createDataFrame(
        [(1, 2020, 5.0), (1, 2021, 6.0), (None, 2022, 9.0), (3, 2020, 1.0)], "k long, y int, s double"
    )
    got = rows(dedup.join_latest(left, right, "k", "y"))
    assert got == sorted(
        [(1, "a", 2021, 6.0), (1, "b", 2021, 6.0), (2, "c", None, None), (None, "d", None, None), (None, "e", None, None)],
        key=repr,
    )


def test_rows_without_key_are_spread_over_tasks(spark):
    # A key that the optimizer cannot know to be missing everywhere.
    left = spark.range(4000).selectExpr("if(id % 400 = 0, id, null) as k", "cast(id as string) as n")
    right = spark.createDataFrame([(400, 2020)], "k long, y int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = dedup.join_latest(left, right, "k", "y")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        plan = joined._jdf.queryExecution().executedPlan().toString()
        matched = joined.filter("y IS NOT NULL").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4000 and max(sizes) < 2000 and matched == 1
    assert "Exchange hashpartitioning(__place" in plan


# ---- medians ----------------------------------------------------------------------------


def expected_medians(data, interpolate):
    groups = defaultdict(list)
    for key, value in data:
        if value is not None and not math.isnan(value):
            groups[key].append(value)
    pick = (lambda v: sorted(v)[len(v) // 2] / 2 + sorted(v)[(len(v) - 1) // 2] / 2) if interpolate else statistics.median_low
    return {k: pick(v) for k, v in groups.items()}


def check_medians(spark, data):
    df = spark.createDataFrame(data, "k string, v double").repartition(3)
    for interpolate in (False, True):
        got = dict(rows(medians.exact_median(df, ["k"], "v", "m", interpolate)))
        assert got == expected_medians(data, interpolate)


values = st.none() | st.floats(allow_nan=True, allow_infinity=False, width=64) | st.integers(-20, 20).map(float)


@quick
@given(st.lists(st.tuples(st.none() | st.sampled_from("ab"), values), min_size=1, max_size=60))
def test_medians_by_brute_force(spark, data):
    check_medians(spark, data)


def test_median_of_one_large_group_and_small_ones(spark):
    draw = random.Random(5)
    data = [("hot", round(draw.lognormvariate(10, 2), 2)) for _ in range(6000)]
    data += [(None, float(i)) for i in range(10)] + [("one", -3.5), ("hot2", 7.0), ("hot2", 7.0), ("none", None)]
    check_medians(spark, data)


def test_median_of_values_in_a_narrow_band(spark):
    data = [("k", 1e9 + i / 1000) for i in range(3000)]
    check_medians(spark, data)


def test_median_with_infinities_and_tiny_values(spark):
    inf = float("inf")
    check_medians(spark, [("a", inf), ("a", inf), ("a", 1.0), ("b", -inf), ("b", 1e-40), ("b", 2e-40), ("c", 5e-324)])


def test_median_ranks_a_bounded_number_of_values(spark):
    """Values that cluster in a sliver of their range, beside an outlier, and a group of everything."""
    data = [("k", 1.0 + 1e-7 * i / 100_000) for i in range(100_000)] + [("k", 2.0**40)]
    data += [("wide", math.exp(i / 50)) for i in range(-30_000, 30_000)]
    df = spark.createDataFrame(data, "k string, v double").repartition(4)
    for interpolate in (False, True):
        counts = medians.value_counts(df, ["k"], "v")
        ranked = medians.candidates(counts, interpolate).groupBy(medians.GROUP, "__range").count()
        assert ranked.agg(F.max("count")).first()[0] <= medians.MOST_RANKED
        got = dict(rows(medians.exact_median(df, ["k"], "v", "m", interpolate)))
        assert got == expected_medians(data, interpolate)


def test_median_of_neighbouring_doubles(spark):
    """Distinct values whose distances are single steps of the last bit, and denormal ones."""
    near = [1.0]
    for _ in range(20_000):
        near.append(math.nextafter(near[-1], 2.0))
    data = [("a", v) for v in near] + [("a", 1.9)] + [("b", i * 5e-324) for i in range(1, 20_000)] + [("b", 3e-310)]
    check_medians(spark, data)


def test_calendar_lag_reads_once_and_skips_gaps(spark):
    import datetime

    data = [("a", datetime.date(2020, m, 1), float(m)) for m in (1, 2, 4)] + [("a", datetime.date(2021, m, 1), 0.0) for m in (1, 3, 4)]
    data += [(None, datetime.date(2020, 1, 1), 9.0), (None, datetime.date(2021, 1, 1), 1.0), ("a", None, 5.0)]
    df = spark.createDataFrame(data, "g string, d date, v double")
    got = {(r.g, r.d): r.ago for r in series.months_earlier(df, ["g"], "d", "v", 12, "ago").collect()}
    day = datetime.date
    assert {k: v for k, v in got.items() if v is not None} == {
        ("a", day(2021, 1, 1)): 1.0, ("a", day(2021, 4, 1)): 4.0, (None, day(2021, 1, 1)): 9.0,
    }


def test_median_without_keys(spark):
    df = spark.createDataFrame([(4.0,), (1.0,), (3.0,), (2.0,), (None,)], "v double")
    assert rows(medians.exact_median(df, [], "v", "m")) == [(2.0,)]
    assert rows(medians.exact_median(df, [], "v", "m", interpolate=True)) == [(2.5,)]


# ---- series -----------------------------------------------------------------------------


def test_running_total_with_ties_and_missing_values(spark):
    data = [
        ("w", 2020, 1, "a", None), ("w", 2020, 1, "b", 3), ("w", 2020, 2, "a", -1), ("w", 2021, 1, "a", None),
        ("w", None, 1, "a", None), (None, 2020, 1, "a", 7), ("v", 2020, 1, "a", None),
    ]
    df = spark.createDataFrame(data, "ward string, y int, q int, s string, n long")
    got = series.running_total(df, ["ward"], ["y", "q"], ["s"], "n", "total")
    assert got.columns == ["ward", "y", "q", "s", "n", "total"]
    assert {tuple(r)[:4]: r["total"] for r in got.collect()} == {
        ("w", None, 1, "a"): None, ("w", 2020, 1, "a"): None, ("w", 2020, 1, "b"): 3, ("w", 2020, 2, "a"): 2,
        ("w", 2021, 1, "a"): 2, (None, 2020, 1, "a"): 7, ("v", 2020, 1, "a"): None,
    }


@quick
@given(st.lists(st.tuples(st.sampled_from("xy"), st.integers(0, 3), st.integers(0, 4), st.integers(-9, 9)),
                min_size=1, max_size=50, unique_by=lambda r: r[:3]))
def test_running_total_by_brute_force(spark, data):
    df = spark.createDataFrame(data, "p string, t int, d int, n long").repartition(3)
    got = rows(series.running_total(df, ["p"], ["t"], ["d"], "n", "total"))
    expected = []
    for p, t, d, n in data:
        expected.append((p, t, d, n, sum(r[3] for r in data if r[0] == p and r[1:3] <= (t, d))))
    assert got == sorted(expected, key=repr)


def test_lag_counts_rows_and_calendar_counts_months(spark):
    months = [date(2020 + m // 12, m % 12 + 1, 1) for m in range(14) if m != 5]
    df = spark.createDataFrame([("g", d, float(i)) for i, d in enumerate(months)], "g string, d date, v double")
    by_row = {r["d"]: r["ago"] for r in series.lagged(df, ["g"], ["d"], "v", 12, "ago").collect()}
    assert by_row[date(2021, 2, 1)] == 0.0 and by_row[date(2021, 1, 1)] is None
    by_month = {r["d"]: r["ago"] for r in series.months_earlier(df, ["g"], "d", "v", 12, "ago").collect()}
    assert by_month[date(2021, 1, 1)] == 0.0 and by_month[date(2021, 2, 1)] == 1.0 and by_month[date(2020, 3, 1)] is None


def test_pivots(spark):
    df = spark.createDataFrame(
        [("m1", "Total (house and land)", 1.0), ("m1", "Total (house and land)", 2.0), ("m1", "House only", 3.0), ("m2", "Land only", 4.0)],
        "m string, kind string, v double",
    )
    names = {"Total (house and land)": "t", "House only": "h", "Land only": "l"}
    assert rows(series.pivot_listed(df, ["m"], "kind", "v", names)) == [("m1", 2.0, 3.0, None), ("m2", None, None, 4.0)]
    found = series.pivot_found(df, ["m"], "kind", "v", lambda n: names[n])
    assert rows(found.select("m", "t", "h", "l")) == [("m1", 2.0, 3.0, None), ("m2", None, None, 4.0)]


# ---- shaping ----------------------------------------------------------------------------


def test_filters(spark):
    df = spark.createDataFrame([(2019, "a"), (2020, "b"), (None, "c"), (2021, None)], "application_year int, w string")
    assert rows(shaping.keep_years(df, (2020, 2021))) == rows(df.filter("application_year >= 2020"))
    assert shaping.keep_years(df, None) is df
    assert shaping.keep_chosen(df, {"w": []}).count() == 4
    assert rows(shaping.keep_chosen(df, {"w": ["a", "c"]})) == [(2019, "a"), (None, "c")]


def test_keywords(column):
    places = ["Lakeside", "Old Harbour", "Hill", "", "North Lakeside, east part", None]
    got = column(lambda c: shaping.contains_any(F.col(c), ("Lakeside", "Harbour")), places)
    assert got == [True, True, False, False, True, None]


def test_roll_up_drops_missing_keys_and_counts_nothing_as_zero(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", None, 3.0), (None, 5, 1.0), ("b", 2, None)], "k string, n long, m double")
    got = shaping.roll_up(df, "k", {"total": "n"}, {"mean": "m"})
    assert rows(got) == [("a", 0, 2.0), ("b", 2, None)]


def test_top_k(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3), ("d", None), ("e", 2)], "k string, n int")
    assert [r[0] for r in shaping.top_k(df, "n", 3, "k").collect()] == ["b", "c", "e"]
    assert [r[0] for r in shaping.top_k(df, "n", 3, "k", ascending=True).collect()] == ["e", "c", "b"]


def test_dimension_values_and_bounds(spark):
    df = spark.createDataFrame([("b", 1), ("a", 5), (None, 3), ("b", None)], "k string, n int")
    assert [r[0] for r in shaping.dimension_values(df, "k").collect()] == ["a", "b"]
    assert [r[0] for r in shaping.dimension_values(df, "k", 1).collect()] == ["a"]
    assert rows(shaping.bounds(df, "n", "low", "high")) == [(1, 5)]


def test_rename_present(spark):
    df = spark.createDataFrame([(1, 2)], "A int, other int")
    assert shaping.rename_present(df, {"A": "a", "B": "b"}).columns == ["a"]
