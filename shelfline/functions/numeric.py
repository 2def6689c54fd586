"""Exact rounding on integers and decimals.

Rates and averages are kept as a numerator and a denominator until the last step and are then
rounded in decimal arithmetic, so a result does not depend on the order in which partitions
were summed.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(38,0)"


def wide(value: Column | str) -> Column:
    """A whole number with room for 38 digits."""
    return (F.col(value) if isinstance(value, str) else value).cast(WIDE)


def _halves(num: Column, den: Column, digits: int) -> tuple[Column, Column]:
    """Numerator and (never zero) denominator of the quotient counted in units of the last digit."""
    return wide(num) * 10**digits, F.nullif(wide(den), F.lit(0).cast(WIDE))


def _as_decimal(units: Column, digits: int) -> Column:
    return units.cast("decimal(30,0)") * F.lit(Decimal(1).scaleb(-digits))


def quotient(num: Column | str, den: Column | str, digits: int, scale: int = 0) -> Column:
    """``num / den`` rounded half away from zero; NULL when ``den`` is 0 or NULL.

    ``scale`` is the number of decimal places ``num`` carries, 0 for whole numbers.
    """
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    n, d = _halves(num * 10**scale if scale else num, wide(den) * 10**scale, digits)
    doubled, twice = F.abs(n) * 2 + F.abs(d), F.abs(d) * 2
    # Exact division of a multiple: the div operator would return 64 bits and wrap around.
    units = (doubled - doubled % twice) / twice
    return _as_decimal(F.when((n < 0) != (d < 0), -units).otherwise(units), digits)


def even_quotient(num: Column, den: Column, digits: int, scale: int = 0) -> Column:
    """``num / den`` rounded half to even, exactly; NULL when ``den`` is 0 or NULL. ``scale`` as above."""
    n, d = _halves(num * 10**scale if scale else num, wide(den) * 10**scale, digits)
    size, unit = F.abs(n), F.abs(d)
    rest = size % unit
    whole = (size - rest) / unit
    up = (rest * 2 > unit) | ((rest * 2 == unit) & (whole % 2 == 1))
    units = whole + F.when(up, 1).otherwise(0)
    return _as_decimal(F.when((n < 0) != (d < 0), -units).otherwise(units), digits)


def percent(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """``100 * num / den`` rounded half away from zero."""
    return quotient(wide(num) * 100, den, digits)


def half_even(num: Column, den: Column, precision: int, digits: int) -> Column:
    """``num / den`` of non-negative longs rounded half to even, as ``decimal(precision, digits)``.

    Meant for row-level columns: it stays in 64-bit arithmetic.
    """
    n, d = num.cast("long") * 10**digits, F.nullif(den.cast("long"), F.lit(0).cast("long"))
    whole = F.call_function("div", n, d)
    twice_rest = (n - whole * d) * 2
    up = (twice_rest > d) | ((twice_rest == d) & (whole % 2 == 1))
    units = whole + F.when(up, 1).otherwise(0)
    short = units.cast(f"decimal({precision},0)") * F.lit(Decimal(1).scaleb(-digits))
    return short.cast(f"decimal({precision},{digits})")


def mean(total: Column | str, count: Column | str) -> Column:
    """Unrounded mean as a double; NULL for an empty group."""
    return F.try_divide(F.col(total).cast("double") if isinstance(total, str) else total.cast("double"),
                        F.col(count).cast("double") if isinstance(count, str) else count.cast("double"))


def moments(column: str, name: str) -> list[Column]:
    """Exact sum, count and sum of squares of a whole-number column."""
    value = F.col(column)
    square = value.cast("decimal(18,0)") * value.cast("decimal(18,0)")
    return [
        F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n"), F.sum(square).alias(f"{name}_squares"),
    ]


def sample_deviation(total: str, squares: str, count: str) -> Column:
    """Sample standard deviation from exact whole-number sums; NULL below two values."""
    n, s = wide(count), wide(total)
    spread = (n * wide(squares) - s * s).cast("double")
    return F.when(F.col(count) > 1, F.sqrt(spread / (n * (n - 1)).cast("double")))


def flag_count(flag: Column | str) -> Column:
    """Number of rows on which a boolean is true (0, never NULL, for a non-empty group)."""
    return F.count_if(F.col(flag) if isinstance(flag, str) else flag)
