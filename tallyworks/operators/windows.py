"""``lead`` over an ordered group that may be arbitrarily large."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lead_date(df: DataFrame, group: str, date_col: str, tie: str, name: str) -> DataFrame:
    """The group's next ``date_col`` in (date, tie) order, without sorting the group's rows.

    Rows sharing a date follow each other, so each but the last (highest ``tie``) has its own
    date as the next one. What remains is the next *distinct* date, found by a window over one
    row per (group, date): bounded by days of history, and built with partial aggregation.
    """
    points = df.groupBy(group, date_col).agg(F.max(tie).alias("_last_tie"))
    points = points.withColumn("_next", F.lead(date_col).over(Window.partitionBy(group).orderBy(date_col)))
    following = F.when(F.col(tie) < F.col("_last_tie"), F.col(date_col)).otherwise(F.col("_next"))
    return df.join(points, [group, date_col], "left").withColumn(name, following).drop("_last_tie", "_next")
