"""Parsing, arithmetic, tiers and display text."""

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civicmart.functions import cells, display, tiers

quick = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def test_int_cells(column):
    given_cells = ["12", "12.5", "-3.9", " 7 ", "abc", "", None, "1,200", "NaN", "9999999999", "1e3", "12.9999999999"]
    assert column(cells.as_int, given_cells) == [12, 12, -3, 7, None, None, None, None, None, None, 1000, 12]


def test_long_cells_keep_all_digits(column):
    assert column(cells.as_long, ["9007199254740993", "9223372036854775807", "9223372036854775808", "x"]) == [
        9007199254740993, 9223372036854775807, None, None,
    ]


def test_double_cells(column):
    got = column(cells.as_double, ["1.5", "NaN", "nan", "abc", "", None, "1,200", ".5", "-2e3", "inf"])
    assert got == [1.5, None, None, None, None, None, None, 0.5, -2000.0, float("inf")]


def test_date_cells(column):
    got = column(cells.as_date, ["2024-02-29", "2023-02-29", "2024/01/05", "2024-1-5", "", None, "2024-01-05T00", "x"])
    assert got == [date(2024, 2, 29)] + [None] * 7
    slashed = column(lambda c: cells.as_date(c, "yyyy/MM/dd"), ["2024/01/05", "2024-01-05", "2024/13/01"])
    assert slashed == [date(2024, 1, 5), None, None]
    assert column(lambda c: cells.as_date(c, "dd.MM.yyyy"), ["05.01.2024", "2024-01-05"]) == [date(2024, 1, 5), None]


def test_month_start(column):
    assert column(cells.month_start, ["1981-01", "1981-13", "1981", None]) == [date(1981, 1, 1), None, None, None]


def test_text_cells(column):
    assert column(cells.tidy, ["  a b ", "", None]) == ["a b", "", None]
    assert column(cells.unquoted, ['"Total" ', None]) == ["Total", None]
    assert column(cells.prefix, ["M5V 2H1", "K1A 0B1", None, "L4M"]) == ["M5V", "K1A", None, "L4M"]
    assert column(cells.has_text, ["P001", None, "P003", "", "P005", "  "]) == [True, False, True, False, True, False]


def test_spaced_skips_missing_parts(spark):
    df = spark.createDataFrame([("1", None, "Main"), (None, None, None)], "a string, b string, c string")
    assert [r[0] for r in df.select(cells.spaced("a", "b", "c")).collect()] == ["1 Main", ""]


def test_net_units(spark):
    df = spark.createDataFrame([(10, 2), (0, 3), (5, 0), (None, None), (4, None)], "made int, lost int")
    assert [r[0] for r in df.select(cells.net_change("made", "lost")).collect()] == [8, -3, 5, None, None]
    assert [r[0] for r in df.select(cells.net_change("made", "lost", True)).collect()] == [8, -3, 5, 0, 4]


def test_area_change_and_ratio(spark, column):
    assert column(cells.square_feet, [100.0], "double") == [1076.39]
    df = spark.createDataFrame([(120.5, 110.0), (1.0, 0.0), (1.0, None)], "now double, ago double")
    assert [r[0] for r in df.select(cells.percent_change("now", "ago")).collect()] == [9.55, None, None]
    units = spark.createDataFrame([(100, 10), (24, 3), (0, 5), (5, 0)], "u int, s int")
    assert [r[0] for r in units.select(cells.rounded(cells.ratio("u", "s"), 1)).collect()] == [10.0, 8.0, 0.0, None]


def test_rounding_is_half_up_and_total(column):
    got = column(lambda c: cells.rounded(c, 2), [1.005, 2.675, -1.005, 1e300, None], "double")
    assert got == [1.01, 2.68, -1.01, 1e300, None]


def test_quality_tiers(column):
    scores = [85.0, 65.0, 45.0, 25.0, 80.0, 60.0, 40.0, None]
    floor = "Needs Improvement"
    left = column(lambda c: tiers.quality_tier(F.col(c)), scores, "double")
    assert left == ["Excellent", "Good", "Fair", floor, "Excellent", "Good", "Fair", floor]
    assert column(lambda c: tiers.quality_tier(F.col(c), None), [None, 10.0], "double") == [None, floor]
    right = column(
        lambda c: tiers.right_closed_bin(F.col(c), tiers.QUALITY_TIERS, tiers.QUALITY_FLOOR), scores, "double"
    )
    assert right == ["Excellent", "Good", "Fair", floor, "Good", "Fair", floor, None]


def test_investment_categories(column):
    amounts = [10_000_000.0, 9_999_999.99, 1_000_000.0, 100_000.0, 99_999.0, None]
    assert column(lambda c: tiers.investment_category(F.col(c)), amounts, "double") == [
        "Mega (>$10M)", "Major ($1M-$10M)", "Major ($1M-$10M)", "Medium ($100K-$1M)", "Small (<$100K)",
        "Small (<$100K)",
    ]


def python_currency(v):
    if v is None or v != v:
        return "N/A"
    for bound, suffix, digits in ((1e9, "B", 2), (1e6, "M", 1), (1e3, "K", 0)):
        if abs(v) >= bound:
            return f"${v / bound:.{digits}f}{suffix}"
    return f"${v:,.0f}"


def python_count(v):
    if v is None or v != v:
        return "N/A"
    for bound, suffix in ((1e6, "M"), (1e3, "K")):
        if abs(v) >= bound:
            return f"{v / bound:.1f}{suffix}"
    return f"{v:,.0f}"


TIES = [
    None, float("nan"), 0.0, -0.0, 0.5, 1.5, 2.5, 999.4, 999.5, 999.7, -0.3, -999.6, 1000.0, 1450.0, 1250.0, 1350.0, 1500.0,
    2500.0, 12250.0, 1_050_000.0, 1_150_000.0, 1_250_000.0, 1_650_000.0, -2_550_000.0, 999_999.9, 1.005e9, 1.015e9,
    2.675e9, 1.125e9, 3.14159e12, -7.5e10, 123456789012.0, 1e20, float("inf"),
]


def test_display_text_of_ties(column):
    assert column(lambda c: display.currency_text(F.col(c)), TIES, "double") == [python_currency(v) for v in TIES]
    assert column(lambda c: display.count_text(F.col(c)), TIES, "double") == [python_count(v) for v in TIES]


@quick
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e15, max_value=1e15)
                | st.integers(-10**11, 10**11).map(lambda n: n / 20), min_size=1, max_size=300))
def test_display_text_as_printf(column, values):
    values = [float(v) for v in values]
    assert column(lambda c: display.currency_text(F.col(c)), values, "double") == [python_currency(v) for v in values]
    assert column(lambda c: display.count_text(F.col(c)), values, "double") == [python_count(v) for v in values]
    small = [v for v in values if abs(v) < 9e13] or [0.0]
    assert column(lambda c: display.fixed_text(F.col(c), 2), small, "double") == [f"{v:.2f}" for v in small]


def test_loss_is_drawn_below_zero(column):
    assert column(lambda c: display.as_loss(F.col(c)), [3, -3, 0], "int") == [-3, -3, 0]


@quick
@given(st.lists(st.text(max_size=12) | st.from_regex(r"\s?[+-]?[0-9]{0,12}[.]?[0-9]{0,4}\s?", fullmatch=True),
                min_size=1, max_size=200))
def test_no_cell_raises(column, texts):
    for parse in (cells.as_int, cells.as_long, cells.as_double, cells.as_date, cells.month_start):
        column(parse, texts)
    parsed = column(cells.as_long, texts)
    for text, number in zip(texts, parsed):
        if text.isascii() and text.isdigit() and len(text) < 19:
            assert number == int(Decimal(text))


@pytest.mark.parametrize("kind", ["as_int", "as_long", "as_double"])
def test_blank_is_missing(column, kind):
    assert column(getattr(cells, kind), ["", " ", None]) == [None, None, None]


def test_sums_and_means_are_rounded_once(spark):
    def figures(cells_, digits=1):
        df = spark.createDataFrame([(c,) for c in cells_], "c double").repartition(4)
        return tuple(df.agg(cells.rounded_avg("c", digits), cells.rounded_sum("c", digits)).first())

    assert figures([79.94999996]) == (79.9, 79.9)
    assert figures([-79.94999996]) == (-79.9, -79.9)
    assert figures([0.05, 0.05]) == (0.1, 0.1)
    assert figures([0.04, 0.05, 0.06, None]) == (0.1, 0.2)
    assert figures([-0.05, -0.05]) == (-0.1, -0.1)
    assert figures([1.005], 2) == (1.01, 1.01)
    assert figures([0.1] * 10, 4) == (0.1, 1.0)
    assert figures([None]) == (None, None)
    assert figures([1e25, 1.0]) == (5e24, 1e25)
    assert figures([9e17, 9e17], 2) == (9e17, 1.8e18)


def test_sums_do_not_depend_on_order(spark):
    values = [0.1, 1e15, -1e15, 0.2, 0.3] * 50
    df = spark.createDataFrame([(v,) for v in values], "c double")
    got = {df.repartition(n).agg(cells.exact_sum("c")).first()[0] for n in (1, 2, 3, 5, 7)}
    assert got == {30.0}


def test_means_equal_fractions(spark):
    import random
    from fractions import Fraction

    draw = random.Random(11)
    rows = [(k, round(draw.uniform(-50, 50), draw.choice([0, 1, 2, 3]))) for k in range(300) for _ in range(draw.choice([1, 2, 4, 8, 16]))]
    df = spark.createDataFrame(rows, "k int, c double")
    got = dict(df.groupBy("k").agg(cells.rounded_avg("c", 2)).collect())
    for k in range(300):
        group = [Fraction(str(c)) for i, c in rows if i == k]
        mean = sum(group) / len(group)
        whole = (2 * abs(mean) * 100 + 1) // 2
        assert got[k] == (whole if mean >= 0 else -whole) / 100
