"""Subscription operators: active months, authoritative phase, MRR movements, bridge, cohorts, CLV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.functions.columns import (
    MONEY,
    RATIO,
    calendar_months_between,
    money,
    month_of,
    ratio,
    sum_money,
    zero_money,
)

MOVEMENTS = ["new_mrr", "reactivation_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr"]


def monthly_price(price: Column, interval: Column, is_trial: Column | None = None) -> Column:
    """Monthly recurring value of a plan: a twelfth of an annual price, nothing during a trial."""
    monthly = F.when(interval == "annual", F.round(price / 12, 2)).otherwise(F.round(price, 2))
    value = monthly if is_trial is None else F.when(is_trial, zero_money()).otherwise(monthly)
    return value.cast(MONEY)


def authoritative(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str]) -> DataFrame:
    """The last row by ``order_desc`` of every key (group-limited before the shuffle, like ``dedup_exact``)."""
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order_desc])
    return df.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") == 1).drop("_rn")


def movements(
    monthly: DataFrame,
    chain: str = "subscription_chain_id",
    month: str = "activity_month",
    value: str = "mrr_amount",
) -> DataFrame:
    """Split each month's change of value into new, reactivation, expansion, contraction and churn.

    ``monthly`` has one row per (chain, month) without gaps, so a window partition is at most
    the calendar's months long.
    """
    by_month = Window.partitionBy(chain).orderBy(month)
    before = by_month.rowsBetween(Window.unboundedPreceding, -1)
    history = monthly.withColumn("_prev", F.lag(value).over(by_month)).withColumn(
        "_paid_before", F.coalesce(F.bool_or(F.col(value) > 0).over(before), F.lit(False))
    )
    now = F.col(value)
    prev = F.coalesce(F.col("_prev"), zero_money())
    returned = F.col("_paid_before")

    def only_if(condition: Column, amount: Column) -> Column:
        return F.when(condition, amount).otherwise(zero_money()).cast(MONEY)

    began = (prev == 0) & (now > 0)
    parts = {
        "new_mrr": only_if(began & ~returned, now),
        "reactivation_mrr": only_if(began & returned, now),
        "expansion_mrr": only_if((prev > 0) & (now > prev), now - prev),
        "contraction_mrr": only_if((prev > 0) & (now > 0) & (now < prev), prev - now),
        "churned_mrr": only_if((prev > 0) & (now == 0), prev),
    }
    return history.select(
        chain,
        "customer_id",
        month,
        value,
        prev.alias("prev_mrr_amount"),
        *[parts[name].alias(name) for name in MOVEMENTS],
    )


def bridge(moves: DataFrame, month: str = "activity_month") -> DataFrame:
    """Month bridge from opening to closing value, with gross and net retention."""
    flows = ["new_mrr", "expansion_mrr", "reactivation_mrr", "contraction_mrr", "churned_mrr"]
    totals = moves.groupBy(month).agg(
        sum_money("prev_mrr_amount").alias("opening_mrr"),
        *[sum_money(c).alias(c) for c in flows],
        sum_money("mrr_amount").alias("closing_mrr"),
    )
    opening = F.col("opening_mrr")
    gained = F.col("new_mrr") + F.col("expansion_mrr") + F.col("reactivation_mrr")
    lost = F.col("contraction_mrr") + F.col("churned_mrr")
    return totals.select(
        month,
        "opening_mrr",
        *flows,
        "closing_mrr",
        money(opening + gained - lost).alias("computed_closing_mrr"),
        ratio(opening - lost, opening).alias("gross_revenue_retention"),
        ratio(opening - lost + F.col("expansion_mrr"), opening).alias("net_revenue_retention"),
    )


def recurring_revenue(monthly: DataFrame, month: str = "activity_month") -> DataFrame:
    """Totals by month. ``monthly`` has one row per chain and month, so paying chains are counted, not told apart.

    Only customers that pay are told apart: all other rows of a month fold into one before the shuffle.
    """
    paying = F.col("mrr_amount") > 0
    by_payer = monthly.groupBy(month, F.when(paying, F.col("customer_id")).alias("_payer")).agg(
        sum_money("mrr_amount").alias("_mrr"), F.count_if(paying).alias("_paying")
    )
    return by_payer.groupBy(month).agg(
        sum_money("_mrr").alias("total_mrr"),
        F.sum("_paying").alias("paying_subscription_count"),
        F.count("_payer").alias("paying_customer_count"),
    )


def cohorts(
    phases: DataFrame,
    monthly: DataFrame,
    chain: str = "subscription_chain_id",
    first_types: Sequence[str] = ("trial", "new"),
) -> DataFrame:
    """Chains by start month, followed month by month; months with nobody paying stay as 0.

    ``monthly`` has one row per chain and month, so counting rows counts chains.
    """
    start = (
        phases.filter(F.col("phase_type").isin(*first_types))
        .groupBy(chain)
        .agg(month_of(F.min("phase_start_date")).alias("cohort_month"))
    )
    sizes = start.groupBy("cohort_month").agg(F.count("*").alias("cohort_size"))
    age = calendar_months_between("activity_month", "cohort_month")
    followed = start.join(monthly.select(chain, "activity_month", "mrr_amount"), chain).filter(
        F.col("activity_month") >= F.col("cohort_month")
    )
    active = followed.groupBy("cohort_month", age.alias("months_since_cohort_start")).agg(
        F.count_if(F.col("mrr_amount") > 0).alias("active_chain_count")
    )
    return active.join(sizes, "cohort_month").select(
        "cohort_month",
        "months_since_cohort_start",
        "cohort_size",
        "active_chain_count",
        ratio("active_chain_count", "cohort_size").alias("retention_rate"),
    )


def lifetime_value(moves: DataFrame, monthly: DataFrame, month: str = "activity_month") -> DataFrame:
    """One row: average MRR of paying chains in the latest month over the mean monthly churn rate."""
    churned = F.count_if(F.col("churned_mrr") > 0)  # one row per chain and month
    opening = F.count_if(F.col("prev_mrr_amount") > 0)
    by_month = moves.groupBy(month).agg(churned.alias("_churned"), opening.alias("_opening"))
    exact = F.col("_churned").cast("decimal(18,0)") / F.col("_opening").cast("decimal(18,0)")
    churn = by_month.agg(F.avg(F.when(F.col("_opening") > 0, exact.cast("decimal(24,12)"))).alias("_churn"))

    latest = monthly.agg(F.max(month)).scalar()
    paying = monthly.filter((F.col(month) == latest) & (F.col("mrr_amount") > 0))
    mrr = paying.agg((F.sum("mrr_amount").cast(MONEY) / F.count("*").cast("decimal(18,0)")).alias("_mrr"))
    rate = F.nullif(churn.scalar().cast("decimal(24,12)"), F.lit(0).cast("decimal(24,12)"))
    return mrr.select(
        latest.alias("as_of_month"),
        F.round("_mrr", 2).cast(MONEY).alias("avg_mrr_per_active_customer"),
        F.round(churn.scalar(), 4).cast(RATIO).alias("monthly_churn_rate"),
        F.round(F.col("_mrr").cast("decimal(24,8)") / rate, 2).cast(MONEY).alias("estimated_clv"),
    )
