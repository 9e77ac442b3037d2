"""Short display text for amounts and counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (lower bound of |v|, divisor, decimals, format), largest first; the last is the base.
CURRENCY_STEPS = (
    (1e9, 1e9, 2, "$%.2fB"),
    (1e6, 1e6, 1, "$%.1fM"),
    (1e3, 1e3, 0, "$%.0fK"),
    (0.0, 1.0, 0, "$%,.0f"),
)
COUNT_STEPS = (
    (1e6, 1e6, 1, "%.1fM"),
    (1e3, 1e3, 1, "%.1fK"),
    (0.0, 1.0, 0, "%,.0f"),
)
MISSING = "N/A"


def _printf_rounded(value: Column, power: Column) -> Column:
    """``value`` in units of ``1 / power``, rounded as C and Python print it.

    They round the exact binary value, ties to even, while Java formats round the
    shortest decimal spelling half up.  Where the product looks like a tie, the
    part it lost decides: both halves of the value split at 24 bits multiply
    without loss, so that part is known exactly.  ``power`` is at most 100.  From
    9e13 on, Java may pad the last decimal with a zero instead of the exact digit.
    """
    product = value * power
    head = value.cast("float").cast("double")
    lost = (value - head) * power - (product - head * power)
    decided = F.when(F.abs(product - F.rint(product)) == 0.5, product + F.signum(lost) / 4)
    return F.rint(F.coalesce(decided, product))


def _formatted(value: Column, power: Column, pattern: Column) -> Column:
    text = F.call_function("format_string", pattern, _printf_rounded(value, power) / power)
    return F.replace(text, F.lit("Infinity"), F.lit("inf"))


def fixed_text(value: Column, digits: int) -> Column:
    """``value`` with ``digits`` decimals (0 to 2), rounded as C and Python print it."""
    return _formatted(value.cast("double"), F.lit(10.0**digits), F.lit(f"%.{digits}f"))


def _abbreviated(value: Column, steps: Sequence[tuple[float, float, int, str]]) -> Column:
    number = value.cast("double")
    size = F.abs(number)

    def by_step(field: Callable[[tuple], object]) -> Column:
        return F.coalesce(*[F.when(size >= step[0], F.lit(field(step))) for step in steps])

    shown = _formatted(number / by_step(lambda s: s[1]), by_step(lambda s: 10.0 ** s[2]), by_step(lambda s: s[3]))
    return F.when(number.isNull() | F.isnan(number), F.lit(MISSING)).otherwise(shown)


def currency_text(value: Column) -> Column:
    """Dollar amount as ``$x.xxB``, ``$x.xM``, ``$xK`` or whole dollars."""
    return _abbreviated(value, CURRENCY_STEPS)


def count_text(value: Column) -> Column:
    """Count as ``x.xM``, ``x.xK`` or a whole number."""
    return _abbreviated(value, COUNT_STEPS)


def as_loss(value: Column) -> Column:
    """The value drawn below the axis, whatever its sign."""
    return -F.abs(value)
