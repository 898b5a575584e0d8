"""Subscription billing models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.columns import (
    calendar_months_between,
    money,
    month_of,
    sum_money,
    sum_money_if,
    zero_money,
)
from tallyworks.operators.netting import net_children
from tallyworks.operators.spine import explode_months, month_spine
from tallyworks.operators.subscriptions import authoritative, monthly_price

def _succeeded() -> Column:
    return F.col("payment_status") == "succeeded"


def data_max_date(invoices: DataFrame) -> Column:
    """Last billed day: an open phase earns no months beyond the billing data (scalar subquery)."""
    return invoices.agg(F.max("period_end")).scalar()


def int_payment_refund_netting(payments: DataFrame, refunds: DataFrame) -> DataFrame:
    netted = net_children(
        payments,
        refunds,
        "payment_id",
        {"refunded_amount": sum_money("refund_amount")},
        {"refunded_amount": zero_money()},
    )
    return netted.select(
        "payment_id",
        "invoice_id",
        "payment_date",
        "payment_status",
        "payment_method",
        "is_retry",
        "payment_amount",
        "refunded_amount",
        money(F.col("payment_amount") - F.col("refunded_amount")).alias("net_collected_amount"),
    )


def int_invoice_payment_status(invoices: DataFrame, netting: DataFrame) -> DataFrame:
    """Invoices with what was collected; refunds raise the balance, refunds on failed payments do not count."""
    paid = net_children(
        invoices,
        netting,
        "invoice_id",
        {
            "payment_attempt_count": F.count("*"),
            "has_succeeded_payment": F.bool_or(_succeeded()),
            "has_failed_attempt": F.bool_or(F.col("payment_status") == "failed"),
            "net_collected_amount": sum_money_if(_succeeded(), "net_collected_amount"),
            "refunded_amount": sum_money_if(_succeeded(), "refunded_amount"),
            "last_payment_date": F.max("payment_date"),
        },
        {
            "payment_attempt_count": F.lit(0).cast("long"),
            "has_succeeded_payment": F.lit(False),
            "has_failed_attempt": F.lit(False),
            "net_collected_amount": zero_money(),
            "refunded_amount": zero_money(),
        },
    )
    return paid.select(
        "invoice_id",
        "subscription_id",
        "customer_id",
        "invoice_date",
        "invoice_amount",
        "last_payment_date",
        "payment_attempt_count",
        "has_succeeded_payment",
        "has_failed_attempt",
        "net_collected_amount",
        "refunded_amount",
        money(F.col("invoice_amount") - F.col("net_collected_amount")).alias("outstanding_balance"),
    )


def int_subscription_periods(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    return subscriptions.join(plans, "plan_id").select(
        "subscription_id",
        "subscription_chain_id",
        "customer_id",
        "plan_id",
        "plan_name",
        "billing_interval",
        "phase_start_date",
        "phase_end_date",
        "phase_type",
        "is_trial",
        "ended_reason",
        monthly_price(F.col("price"), F.col("billing_interval"), F.col("is_trial")).alias("mrr_amount"),
    )


def int_subscription_active_phase_months(phases: DataFrame, invoices: DataFrame) -> DataFrame:
    keep = ["subscription_id", "subscription_chain_id", "customer_id", "plan_id", "mrr_amount", "phase_start_date"]
    return explode_months(
        phases, keep, "phase_start_date", "phase_end_date", data_max_date(invoices), "activity_month"
    )


def int_subscription_chain_month_spine(phases: DataFrame, invoices: DataFrame) -> DataFrame:
    keys = ["subscription_chain_id", "customer_id"]
    chains = phases.groupBy(*keys).agg(F.min("phase_start_date").alias("_first"))
    return month_spine(chains, keys, F.col("_first"), data_max_date(invoices), "activity_month")


def int_subscription_mrr_by_chain_month(spine: DataFrame, active_months: DataFrame) -> DataFrame:
    """MRR of the latest-starting phase that touches each month, 0 in months without one.

    Spark sizes exploded months like the phases they come from, many times too small, and would broadcast them;
    the merge join uses the order that the choice of the latest phase leaves.
    """
    keys = ["subscription_chain_id", "activity_month"]
    latest = authoritative(active_months, keys, ["phase_start_date", "subscription_id"])
    return spine.join(latest.select(*keys, "plan_id", "mrr_amount").hint("merge"), keys, "left").select(
        "subscription_chain_id",
        "customer_id",
        "activity_month",
        "plan_id",
        F.coalesce("mrr_amount", zero_money()).alias("mrr_amount"),
    )


def dim_plans(plans: DataFrame) -> DataFrame:
    return plans.select(
        "plan_id",
        "plan_name",
        "billing_interval",
        "currency",
        F.col("price").alias("list_price"),
        monthly_price(F.col("price"), F.col("billing_interval")).alias("monthly_equivalent_price"),
    )


def fct_subscriptions(phases: DataFrame) -> DataFrame:
    return phases


def fct_invoices(status: DataFrame) -> DataFrame:
    return status.select(
        "invoice_id",
        "subscription_id",
        "customer_id",
        "invoice_date",
        "invoice_amount",
        "payment_attempt_count",
        "has_succeeded_payment",
        "has_failed_attempt",
        "net_collected_amount",
        "refunded_amount",
        "last_payment_date",
        "outstanding_balance",
    )


def fct_payments(netting: DataFrame) -> DataFrame:
    return netting


def mart_customer_metrics(phases: DataFrame, invoice_status: DataFrame, invoices: DataFrame) -> DataFrame:
    subscribers = phases.groupBy("customer_id").agg(
        F.min("phase_start_date").alias("first_subscription_date"),
        F.bool_or(F.col("phase_end_date").isNull()).alias("is_currently_active"),
    )
    lifetime = {
        "lifetime_invoiced_amount": "invoice_amount",
        "lifetime_collected_amount": "net_collected_amount",
        "lifetime_refunded_amount": "refunded_amount",
    }
    billed = net_children(
        subscribers,
        invoice_status,
        "customer_id",
        {name: sum_money(source) for name, source in lifetime.items()},
        {name: zero_money() for name in lifetime},
    )
    tenure = calendar_months_between(data_max_date(invoices), "first_subscription_date")
    return billed.select(
        "customer_id",
        "first_subscription_date",
        "is_currently_active",
        tenure.alias("tenure_months"),
        *lifetime,
    )


def mart_invoice_reconciliation(invoice_status: DataFrame) -> DataFrame:
    return invoice_status.groupBy(month_of("invoice_date").alias("activity_month")).agg(
        F.count("*").alias("invoice_count"),
        sum_money("invoice_amount").alias("invoiced_amount"),
        sum_money("net_collected_amount").alias("collected_amount"),
        sum_money("refunded_amount").alias("refunded_amount"),
        sum_money("outstanding_balance").alias("outstanding_amount"),
    )
