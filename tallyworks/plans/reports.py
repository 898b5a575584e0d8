"""The datasets behind the scorecard, the dashboard, the alert and the health report."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.columns import RATIO
from tallyworks.operators.checks import summarize
from tallyworks.operators.contracts import Contract, contract_status
from tallyworks.operators.metrics import Registry, metric_query

Tables = Mapping[str, DataFrame]
MONTH = "metric_time__month"
CLOSED = "period_id__is_closed"
SINCE_START = "retention_cohort__months_since_cohort_start"


def _latest(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(F.desc(key)).limit(1)


def scorecard(registry: Registry, t: Tables) -> DataFrame:
    """One row of headline figures.

    Revenue and cash come from the latest closed month; active customers are those of the same
    month, or of their own latest month if that one has none; MRR and churn come from the latest
    month that has either.
    """
    revenue = metric_query(
        registry, t, ["net_booked_revenue", "cash_collected_against_bookings"], [MONTH, CLOSED]
    )
    closed = _latest(revenue.filter(F.col(CLOSED)), MONTH)
    active = metric_query(registry, t, ["active_customers"], [MONTH])
    # One row over the months, so that the customers are counted once for both uses.
    by_month = F.map_from_entries(F.collect_list(F.struct(MONTH, "active_customers")))
    counts = active.filter(F.col(MONTH).isNotNull()).agg(
        by_month.alias("_by_month"), F.max_by("active_customers", MONTH).alias("_newest")
    )
    mrr = metric_query(registry, t, ["mrr", "churn_rate"], [MONTH])
    known = mrr.filter(F.col("mrr").isNotNull() | F.col("churn_rate").isNotNull())
    latest_mrr = known.agg(F.max_by(F.struct(MONTH, "mrr", "churn_rate"), MONTH)).scalar()
    curve = metric_query(registry, t, ["retention_rate"], [SINCE_START])
    first_month = curve.filter(F.col(SINCE_START) == 1).agg(F.max("retention_rate")).scalar()
    return closed.crossJoin(counts).select(
        F.col(MONTH).alias("as_of_month"),
        "net_booked_revenue",
        "cash_collected_against_bookings",
        F.coalesce(F.element_at("_by_month", F.col(MONTH)), F.col("_newest")).alias("active_customers"),
        latest_mrr[MONTH].alias("mrr_month"),
        latest_mrr["mrr"].alias("mrr"),
        F.round(latest_mrr["churn_rate"], 4).cast(RATIO).alias("churn_rate"),
        first_month.alias("month_1_retention"),
    )


def booked_revenue_trend(registry: Registry, t: Tables, months: int = 18) -> DataFrame:
    """Closed months only: the open ones are still filling up."""
    revenue = metric_query(registry, t, ["net_booked_revenue"], [MONTH, CLOSED]).filter(F.col(CLOSED))
    newest = revenue.orderBy(F.desc(MONTH)).limit(months)
    return newest.select(MONTH, "net_booked_revenue").orderBy(MONTH)


def mrr_trend(registry: Registry, t: Tables, months: int = 18) -> DataFrame:
    newest = metric_query(registry, t, ["mrr"], [MONTH]).orderBy(F.desc(MONTH)).limit(months)
    return newest.filter(F.col("mrr") > 0).orderBy(MONTH)


def revenue_by_channel(registry: Registry, t: Tables) -> DataFrame:
    return metric_query(
        registry,
        t,
        ["order_revenue"],
        ["order_id__order_channel"],
        where={"order_id__order_status": lambda c: c == "completed"},
    ).orderBy(F.desc("order_revenue"), "order_id__order_channel")


def top_regions(registry: Registry, t: Tables, n: int = 10) -> DataFrame:
    by_region = metric_query(registry, t, ["active_customers"], ["customer_id__region"])
    return by_region.orderBy(F.desc("active_customers"), "customer_id__region").limit(n)


def funnel_totals(registry: Registry, t: Tables) -> DataFrame:
    return metric_query(registry, t, ["viewers", "carters", "checkout_starters", "purchasers"])


def retention_curve(registry: Registry, t: Tables) -> DataFrame:
    return metric_query(registry, t, ["retention_rate"], [SINCE_START]).orderBy(SINCE_START)


def late_adjustments(t: Tables) -> DataFrame:
    """Informational: refunds that fell after the close of the period they correct."""
    return (
        t["fct_period_close_adjustments"]
        .filter("is_late_adjustment")
        .select("refund_id", "original_period_id", "adjustment_period_id", "days_after_close")
        .orderBy(F.desc("days_after_close"), "refund_id")
    )


def volume_anomalies(t: Tables) -> DataFrame:
    return (
        t["mart_volume_anomalies"]
        .filter("is_anomaly")
        .select("source_name", "period_id", "period_start_date", "pct_change_vs_trailing_avg")
        .orderBy(F.desc("period_id"), "source_name")
    )


def _section(df: DataFrame, section: str, item: Column, status: Column, value: Column) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"),
        item.cast("string").alias("item"),
        status.cast("string").alias("status"),
        value.cast("decimal(18,1)").alias("value"),
    )


def alert(results: DataFrame, t: Tables) -> DataFrame:
    """Failing checks with their rows, and open late adjustments with their days."""
    failing = results.filter(F.col("status") == "fail")
    return _section(failing, "failing check", F.col("check"), F.col("status"), F.col("failing_rows")).unionByName(
        _section(
            late_adjustments(t), "late adjustment", F.col("refund_id"), F.lit("informational"), F.col("days_after_close")
        )
    )


def health(results: DataFrame, sources: DataFrame, contracts: Mapping[str, Contract], t: Tables) -> DataFrame:
    """Check counts by status, stale sources, contracts as they are kept, anomalies and late adjustments."""
    counts = _section(summarize(results), "checks", F.col("status"), F.col("status"), F.col("checks"))
    stale = sources.filter(F.col("status") != "pass")
    stale = _section(stale, "source freshness", F.col("source_name"), F.col("status"), F.lit(None))
    kept = [contract_status(t[name], contract, name) for name, contract in sorted(contracts.items())]
    contracted = _section(
        reduce(DataFrame.unionByName, kept), "contract", F.col("table_name"), F.col("status"), F.lit(None)
    )
    odd = _section(
        volume_anomalies(t),
        "volume anomaly",
        F.concat_ws("/", "source_name", F.col("period_id").cast("string")),
        F.lit("anomaly"),
        F.col("pct_change_vs_trailing_avg"),
    )
    late = _section(
        late_adjustments(t), "late adjustment", F.col("refund_id"), F.lit("informational"), F.col("days_after_close")
    )
    return counts.unionByName(stale).unionByName(contracted).unionByName(odd).unionByName(late)
