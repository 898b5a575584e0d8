"""Calendars and gap-free series built with ``sequence`` + ``explode``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions.columns import month_of, padded_name

_DAY = "INTERVAL 1 DAY"
_MONTH = "INTERVAL 1 MONTH"


def steps(first: Column, last: Column, step: str) -> Column:
    """``sequence`` that is NULL, not an error, when it would be empty (``explode`` drops NULL)."""
    return F.when(first <= last, F.sequence(first, last, F.expr(step)))


def one_row(spark: SparkSession) -> DataFrame:
    return spark.range(1)


def date_attributes(days: DataFrame, day: str = "date_day") -> DataFrame:
    d = F.col(day)
    weekday = F.dayofweek(d) - 1
    return days.select(
        d,
        F.year(d).alias("year_number"),
        F.quarter(d).alias("quarter_number"),
        F.month(d).alias("month_number"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        padded_name(d, "EEEE").alias("day_name"),
        padded_name(d, "MMMM").alias("month_name"),
        weekday.isin(0, 6).alias("is_weekend"),
    )


def date_spine(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row per day from a one-row frame holding the two bounds."""
    series = steps(F.col(start), F.col(end), _DAY)
    return date_attributes(bounds.select(F.explode(series).alias("date_day")))


def date_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day between two fixed ISO dates."""
    return date_spine(
        one_row(spark).select(
            F.lit(start).cast("date").alias("start_date"), F.lit(end).cast("date").alias("end_date")
        )
    )


def month_spine(df: DataFrame, keep: list[str], first: Column, last: Column, name: str) -> DataFrame:
    """One row per input row and calendar month in ``[first, last]``; no months when first > last."""
    series = steps(month_of(first), month_of(last), _MONTH)
    return df.select(*keep, F.explode(series).alias(name))


def explode_months(
    df: DataFrame, keep: list[str], start: str, end: str, open_end: Column, name: str
) -> DataFrame:
    """Months touched by ``[start, end)``; a NULL end runs up to ``open_end``."""
    last_day = F.date_sub(F.coalesce(F.col(end), open_end), 1)
    return month_spine(df, keep, F.col(start), last_day, name)


def zero_fill(
    volume: DataFrame,
    periods: DataFrame,
    group: str = "source_name",
    period: str = "period_id",
    value: str = "row_count",
    until: str = "source",
) -> DataFrame:
    """Every period between a group's first and last one, missing values as 0.

    ``until="source"`` stops at the group's own last period; ``"latest"`` runs every group up to
    the last period seen in any group, so a source that went silent keeps producing zeros.
    The inputs have one row per (group, period), so all of this is period-sized.
    """
    bounds = volume.groupBy(group).agg(F.min(period).alias("_lo"), F.max(period).alias("_hi"))
    if until == "latest":
        bounds = bounds.withColumn("_hi", volume.agg(F.max(period)).scalar())
    elif until != "source":
        raise ValueError(f"until must be 'source' or 'latest', not {until!r}")
    grid = bounds.select(group, F.explode(F.sequence("_lo", "_hi")).alias(period))
    grid = grid.join(periods.select(period), period, "left_semi")
    return grid.join(volume, [group, period], "left").select(
        group, period, F.coalesce(F.col(value), F.lit(0)).cast("long").alias(value)
    )
