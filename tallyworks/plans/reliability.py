"""Volume monitoring models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tallyworks.operators.events import count_distinct_events
from tallyworks.operators.spine import zero_fill
from tallyworks.operators.volume import flag_anomalies, trailing_change, volume_by_period


def int_volume_by_period(orders: DataFrame, invoices: DataFrame, events: DataFrame, periods: DataFrame) -> DataFrame:
    """Rows per source and period. Staged tables have the facts' row counts, events once de-duplicated."""
    branches = [
        volume_by_period("orders", orders, "order_date", periods),
        volume_by_period("invoices", invoices, "invoice_date", periods),
        volume_by_period("events", count_distinct_events(events), "event_date", periods),
    ]
    return reduce(DataFrame.unionByName, branches)


def int_volume_anomaly_by_period(volume: DataFrame, periods: DataFrame, until: str = "source") -> DataFrame:
    filled = zero_fill(volume, periods, until=until)
    calendar = periods.select("period_id", "period_start_date", "is_closed")
    return trailing_change(filled).join(calendar, "period_id").select(
        "source_name",
        "period_id",
        "period_start_date",
        "is_closed",
        "row_count",
        "trailing_avg_row_count",
        "pct_change_vs_trailing_avg",
    )


def mart_volume_anomalies(anomaly: DataFrame) -> DataFrame:
    return flag_anomalies(anomaly)
