"""Typed column expressions: money, exact ratios, calendar arithmetic.

All of them are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TAX_RATE = T.DecimalType(6, 4)
RATIO = T.DecimalType(18, 4)
TENTHS = T.DecimalType(18, 1)
WHOLE = T.DecimalType(18, 0)

ColumnLike = Column | str


def _col(column: ColumnLike) -> Column:
    return F.col(column) if isinstance(column, str) else column


def money(column: ColumnLike) -> Column:
    """Fixed-point money. Raw amounts are doubles and must not be summed before this cast."""
    return _col(column).cast(MONEY)


def cents(column: ColumnLike) -> Column:
    """Whole cents of a double, rounded as ``money`` rounds it.

    A double that is the one next to some whole number of cents is that number; up to 1e13 its digits say so, and no
    decimal has to be made of them. All others go by way of ``money``.
    """
    amount = _col(column)
    whole = F.rint(amount * 100)
    plain = (F.abs(amount) < 1e13) & (whole / 100 == amount)
    return F.when(plain, whole.cast("long")).otherwise((money(amount) * 100).cast("long"))


def zero_money() -> Column:
    return F.lit(0).cast(MONEY)


def sum_money(column: ColumnLike) -> Column:
    """Decimal sums widen by ten digits; bring them back so later divisions keep their scale."""
    return F.sum(_col(column)).cast(MONEY)


def sum_money_if(condition: Column, column: ColumnLike) -> Column:
    return F.sum(F.when(condition, _col(column)).otherwise(zero_money())).cast(MONEY)


def ratio(numerator: ColumnLike, denominator: ColumnLike, scale: int = 4) -> Column:
    """``numerator / denominator`` rounded half away from zero; NULL unless the denominator is positive."""
    num, den = _col(numerator), _col(denominator)
    quotient = F.round(num.cast(MONEY) / den.cast(MONEY), scale).cast(T.DecimalType(18, scale))
    return F.when(den > 0, quotient)


def month_of(column: ColumnLike) -> Column:
    return F.trunc(_col(column), "MM")


def calendar_months_between(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Difference of calendar months, ignoring the day of month."""
    a, b = _col(later), _col(earlier)
    return ((F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)).cast("int")


def elapsed_days(start: ColumnLike, end: ColumnLike) -> Column:
    """Fractional days between two timestamps (microsecond resolution)."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(86_400_000_000.0)


def padded_name(column: ColumnLike, pattern: str) -> Column:
    """Day or month name, blank-padded to nine characters."""
    return F.rpad(F.date_format(_col(column), pattern), 9, " ")
