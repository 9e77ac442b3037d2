"""Lenient parsing of text cells.

A cell that does not parse becomes NULL; nothing here raises under ANSI mode.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

SQFT_PER_SQM = 10.7639  # fixed value

_EXACT = "decimal(28,9)"
_MOST_EXACT = 1e13  # beyond it a quotient with four places no longer fits in a long


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Shapes tried before a cast: a cast that fails inside Spark costs a Java exception per cell.
_NUMBER = r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
_DECIMAL_SHAPE = rf"^\s*{_NUMBER}\s*$"
_DOUBLE_SHAPE = rf"(?i)^\s*({_NUMBER}|[+-]?inf(inity)?)\s*$"


def _whole(cell: Column, kind: str) -> Column:
    """DECIMAL keeps every digit and lets the last cast cut the fraction off."""
    return F.when(cell.rlike(_DECIMAL_SHAPE), cell).try_cast("decimal(38,18)").try_cast(kind)


def as_int(c: Column | str) -> Column:
    """Text to INT: fractions are cut off, out-of-range and junk give NULL."""
    return _whole(_col(c), "int")


def as_long(c: Column | str) -> Column:
    """Text to BIGINT without passing through DOUBLE, so all 19 digits survive."""
    return _whole(_col(c), "bigint")


def as_double(c: Column | str) -> Column:
    """Text to DOUBLE; the spelling ``NaN`` counts as a missing value."""
    cell = _col(c)
    return F.when(cell.rlike(_DOUBLE_SHAPE), cell).try_cast("double")


def as_date(c: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    """Text to DATE; the whole cell must have the pattern.

    For year, month and day in full the shape is checked first and the cast does
    the parsing, which costs a fraction of a pattern parse per cell.
    """
    cell = _col(c)
    separator = pattern[4:5]
    if pattern != separator.join(("yyyy", "MM", "dd")):
        return F.try_to_date(cell, pattern)
    shaped = cell.rlike(rf"^[0-9]{{4}}{separator}[0-9]{{2}}{separator}[0-9]{{2}}$")
    iso = cell if separator == "-" else F.replace(cell, F.lit(separator), F.lit("-"))
    return F.when(shaped, iso.try_cast("date"))


def month_start(c: Column | str) -> Column:
    """``yyyy-MM`` to the first day of that month."""
    return as_date(F.concat(_col(c), F.lit("-01")))


def tidy(c: Column | str) -> Column:
    return F.trim(_col(c))


def unquoted(c: Column | str) -> Column:
    """Text without any double quotes, trimmed."""
    return F.trim(F.regexp_replace(_col(c), '"', ""))


def has_text(c: Column | str) -> Column:
    """True for a cell that is neither NULL nor blank."""
    return _col(c).isNotNull() & (F.trim(_col(c)) != "")


def prefix(c: Column | str, length: int = 3) -> Column:
    return F.substring(_col(c), 1, length)


def spaced(*parts: Column | str) -> Column:
    """Parts joined with one space; NULL parts leave no gap."""
    return F.concat_ws(" ", *[_col(p) for p in parts])


def or_zero(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def rounded(c: Column | str, digits: int) -> Column:
    """Half-up rounding of a number as it is written in decimals."""
    return F.round(_col(c).cast("double"), digits)


def exact(c: Column | str) -> Column:
    """The cell as a decimal of nine places; NULL beyond 19 digits before the point."""
    return _col(c).try_cast(_EXACT)


def _exact_total(c: Column | str) -> Column:
    """The sum of cells in decimals, which no order of merging changes; NULL if a cell does not fit."""
    return F.when(F.count(exact(c)) == F.count(_col(c)), F.sum(exact(c)))


def half_up(total: Column, plain: Column, digits: int, count: Column | None = None) -> Column:
    """An exact ``total``, or its quotient by ``count``, rounded once; ``plain`` rounded where there is no total.

    The quotient is taken in whole numbers: floor((2 * |total| * 10**digits + count) / (2 * count)).
    """
    if count is None:
        figure = F.round(total, digits).cast("double")
    else:
        times = F.lit(Decimal(2 * 10**digits))
        n = F.nullif(count, F.lit(0)).cast("decimal(20,0)")
        quotient = F.call_function("div", F.abs(total).try_cast("decimal(31,9)") * times + n, n * F.lit(Decimal(2)))
        figure = F.when(F.abs(plain) < _MOST_EXACT, quotient) * F.signum(total) / 10**digits
    return F.coalesce(figure, F.round(plain, digits))


def rounded_sum(c: Column | str, digits: int) -> Column:
    return half_up(_exact_total(c), F.sum(_col(c).cast("double")), digits)


def rounded_avg(c: Column | str, digits: int) -> Column:
    return half_up(_exact_total(c), F.avg(_col(c).cast("double")), digits, F.count(_col(c)))


def exact_sum(c: Column | str) -> Column:
    """Sum of doubles that no order of merging changes."""
    return F.coalesce(_exact_total(c).cast("double"), F.sum(_col(c).cast("double")))


def exact_avg(c: Column | str) -> Column:
    return exact_sum(c) / F.nullif(F.count(_col(c)), F.lit(0))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient that is NULL for a zero denominator."""
    return F.try_divide(_col(numerator), _col(denominator))


def percent_change(current: Column | str, base: Column | str, digits: int = 2) -> Column:
    return rounded(ratio(_col(current) - _col(base), base) * 100, digits)


def net_change(gained: Column | str, lost: Column | str, fill_null: bool = False) -> Column:
    """Difference that is NULL when a side is unknown, or counts it as 0 on request."""
    if fill_null:
        return or_zero(gained) - or_zero(lost)
    return _col(gained) - _col(lost)


def square_feet(c: Column | str) -> Column:
    return rounded(_col(c) * SQFT_PER_SQM, 2)
