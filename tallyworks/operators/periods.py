"""Accounting periods: assignment of dates, overlap of intervals, late adjustments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.columns import month_of, zero_money
from tallyworks.operators.spine import steps

PERIOD_COLUMNS = ["period_id", "period_start_date", "period_end_date", "closed_at"]


def make_accounting_periods(bounds: DataFrame, close_days: int = 10, open_last: int = 2) -> DataFrame:
    """Monthly periods between ``first_month`` and ``last_month`` of a one-row frame.

    A period closes ``close_days`` after its last day; the newest ``open_last`` are still open.
    """
    months = bounds.select(
        "last_month",
        F.posexplode(steps(F.col("first_month"), F.col("last_month"), "INTERVAL 1 MONTH")).alias("_i", "_start"),
    )
    end = F.last_day("_start")
    is_open = F.col("_start") > F.add_months("last_month", -open_last)
    return months.select(
        (F.col("_i") + 1).cast("int").alias("period_id"),
        F.col("_start").alias("period_start_date"),
        end.alias("period_end_date"),
        F.when(~is_open, F.date_add(end, close_days)).alias("closed_at"),
    )


def period_days(periods: DataFrame, *columns: str) -> DataFrame:
    """The calendar as one row per (day, period).

    Size bound: a calendar of non-overlapping periods has one row per day whatever the facts
    hold (365 a year, at most 3.7 million for the whole range of the DATE type), which is why
    this is the one table the operators broadcast by hand.
    """
    days = F.sequence("period_start_date", "period_end_date")
    return periods.select(*columns, F.explode(days).alias("_day"))


def assign_period(
    df: DataFrame,
    date_col: str,
    periods: DataFrame,
    columns: tuple[str, ...] = ("period_id",),
    prefix: str = "",
    how: str = "inner",
) -> DataFrame:
    """Add the columns of the period that contains ``date_col`` (both ends inclusive).

    A between-join would be a nested loop over the calendar. Expanding the calendar to days
    turns it into a hash equi-join whose build side is the broadcast calendar, so the facts are
    not shuffled and a hot date is no skew.
    """
    days = period_days(periods, *[F.col(c).alias(f"{prefix}{c}") for c in columns])
    joined = df.join(F.broadcast(days), F.col(date_col).cast("date") == F.col("_day"), how)
    return joined.drop("_day")


def overlap_period(
    df: DataFrame,
    start: str,
    end: str,
    periods: DataFrame,
    columns: tuple[str, ...] = ("period_id",),
) -> DataFrame:
    """One row per (input row, period) whose closed intervals overlap; a NULL end never ends.

    Both sides are cut into calendar months and hash-joined on the month. A pair meets in every
    month both touch, so it is kept only in the first of them; the calendar may have gaps or
    overlapping periods. Intervals are first clamped to the calendar, so an input row expands
    to at most the calendar's months.
    """
    first_day = periods.agg(F.min("period_start_date")).scalar()
    last_day = periods.agg(F.max("period_end_date")).scalar()
    clamped = df.select(
        "*",
        F.greatest(F.col(start), first_day).alias("_from"),
        F.least(F.coalesce(F.col(end), last_day), last_day).alias("_to"),
    )
    months = steps(month_of("_from"), month_of("_to"), "INTERVAL 1 MONTH")
    left = clamped.select("*", F.explode(months).alias("_month"))
    right = periods.select(
        *columns,
        F.col("period_start_date").alias("_p_start"),
        F.col("period_end_date").alias("_p_end"),
        F.explode(
            steps(month_of("period_start_date"), month_of("period_end_date"), "INTERVAL 1 MONTH")
        ).alias("_p_month"),
    )
    meets = (
        (F.col("_month") == F.col("_p_month"))
        & (F.col("_from") <= F.col("_p_end"))
        & (F.col("_to") >= F.col("_p_start"))
        & (F.col("_month") == F.greatest(month_of("_from"), month_of("_p_start")))
    )
    # The calendar again, as (period, month) pairs: bounded like ``period_days``, and far smaller.
    joined = left.join(F.broadcast(right), meets, "inner")
    return joined.drop("_from", "_to", "_month", "_p_start", "_p_end", "_p_month")


def with_tax(
    df: DataFrame, amount: str, rates: DataFrame, region: str = "region", name: str = "tax_amount"
) -> DataFrame:
    """``round(amount * tax_rate, 2)``; a region without a rate is taxed at 0, never dropped."""
    rated = df.join(rates.select(F.col("region").alias("_region"), "tax_rate"), F.col(region) == F.col("_region"), "left")
    tax = F.round(F.col(amount) * F.coalesce(F.col("tax_rate"), F.lit(0).cast("decimal(6,4)")), 2)
    return rated.select(*df.columns, tax.cast("decimal(18,2)").alias(name))


def cash_by_period(df: DataFrame, date_col: str, periods: DataFrame, aggregates: dict) -> DataFrame:
    """Money totals per period of ``date_col``; the calendar join is map-side, then partial sums."""
    return assign_period(df, date_col, periods).groupBy("period_id").agg(
        *[expr.alias(name) for name, expr in aggregates.items()]
    )


def fill_periods(periods: DataFrame, columns: list[str], *totals: DataFrame) -> DataFrame:
    """Every period with the given per-period totals; absent ones are 0."""
    out = periods.select("period_id", "period_start_date", "period_end_date", "is_closed")
    for total in totals:
        out = out.join(total, "period_id", "left")
    return out.select(
        "period_id",
        "period_start_date",
        "period_end_date",
        "is_closed",
        *[F.coalesce(F.col(c), zero_money()).alias(c) for c in columns],
    )
