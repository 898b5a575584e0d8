"""Row-volume monitoring per source and accounting period."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.functions.columns import TENTHS, WHOLE
from tallyworks.operators.periods import assign_period


def volume_by_period(source: str, df: DataFrame, date_col: str, periods: DataFrame) -> DataFrame:
    """Rows of ``df`` per period, tagged with the source's name.

    ``df`` may already hold one row per day with a ``row_count``; plain rows count 1 each.
    """
    counted = F.sum("row_count") if "row_count" in df.columns else F.count("*")
    return (
        assign_period(df, date_col, periods)
        .groupBy("period_id")
        .agg(counted.alias("row_count"))
        .select("period_id", F.lit(source).alias("source_name"), "row_count")
    )


def trailing_change(
    filled: DataFrame, group: str = "source_name", period: str = "period_id", value: str = "row_count", n: int = 3
) -> DataFrame:
    """Average of the ``n`` periods before each one, and the change against it in percent.

    The percentage comes from the exact average (sum and count), not from the rounded one shown.
    One row per (source, period): the window is calendar-sized.
    """
    before = Window.partitionBy(group).orderBy(period).rowsBetween(-n, -1)
    total = F.sum(value).over(before).cast(WHOLE)
    count = F.count(value).over(before).cast(WHOLE)
    framed = filled.withColumn("_total", total).withColumn("_count", count)
    change = (F.col(value).cast(WHOLE) * F.col("_count") - F.col("_total")) * 100
    return framed.select(
        "*",
        F.when(F.col("_count") > 0, F.round(F.col("_total") / F.col("_count"), 1))
        .cast(TENTHS)
        .alias("trailing_avg_row_count"),
        F.when(F.col("_total") > 0, F.round(change.cast(WHOLE) / F.col("_total"), 1))
        .cast(TENTHS)
        .alias("pct_change_vs_trailing_avg"),
    ).drop("_total", "_count")


def flag_anomalies(df: DataFrame, floor: int = 10, drop_pct: int = -40) -> DataFrame:
    """Eligibility and anomaly flags on the rounded columns; NULL where there is no average yet."""
    eligible = F.col("trailing_avg_row_count") >= floor
    return df.withColumn("is_eligible_for_check", eligible).withColumn(
        "is_anomaly", F.col("is_closed") & eligible & (F.col("pct_change_vs_trailing_avg") <= drop_pct)
    )
