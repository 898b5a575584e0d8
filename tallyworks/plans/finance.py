"""Accounting-period models: booking-date revenue, cash-date movements, late adjustments.

Booking attribution (order or invoice date) and cash attribution (payment or refund date) look
at the same money and must not share intermediates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.columns import money, sum_money, sum_money_if, zero_money
from tallyworks.operators.joins import join_hot
from tallyworks.operators.periods import assign_period, cash_by_period, fill_periods, overlap_period, with_tax


def dim_accounting_periods(periods: DataFrame) -> DataFrame:
    return periods.select(
        "period_id",
        "period_start_date",
        "period_end_date",
        "closed_at",
        F.col("closed_at").isNotNull().alias("is_closed"),
    )


def int_revenue_by_period_retail(
    orders: DataFrame, customers: DataFrame, tax_rates: DataFrame, periods: DataFrame
) -> DataFrame:
    completed = orders.filter(F.col("order_status") == "completed")
    located = join_hot(completed, customers.select("customer_id", "region"), "customer_id")
    taxed = with_tax(located, "order_amount", tax_rates)
    return assign_period(taxed, "order_date", periods).select(
        "order_id",
        "customer_id",
        "order_date",
        "period_id",
        F.col("order_amount").alias("booked_revenue"),
        F.col("amount_collected").alias("collected_amount"),
        "tax_amount",
    )


def int_revenue_by_period_billing(
    invoices: DataFrame, customers: DataFrame, tax_rates: DataFrame, periods: DataFrame
) -> DataFrame:
    located = join_hot(invoices, customers.select("customer_id", "region"), "customer_id")
    taxed = with_tax(located, "invoice_amount", tax_rates)
    return assign_period(taxed, "invoice_date", periods).select(
        "invoice_id",
        "customer_id",
        "invoice_date",
        "period_id",
        F.col("invoice_amount").alias("booked_revenue"),
        F.col("net_collected_amount").alias("collected_amount"),
        F.col("refunded_amount").alias("refunded_amount_against_bookings"),
        "tax_amount",
    )


def int_cash_movements_retail(payments: DataFrame, periods: DataFrame) -> DataFrame:
    """A refunded payment came in and went out again on its one known date."""
    status = F.col("payment_status")
    return cash_by_period(
        payments,
        "payment_date",
        periods,
        {
            "cash_in": sum_money_if(status.isin("succeeded", "refunded"), "amount"),
            "cash_out": sum_money_if(status == "refunded", "amount"),
        },
    )


def int_cash_movements_billing(payments: DataFrame, refunds: DataFrame, periods: DataFrame) -> DataFrame:
    came_in = cash_by_period(
        payments,
        "payment_date",
        periods,
        {"cash_in": sum_money_if(F.col("payment_status") == "succeeded", "payment_amount")},
    )
    went_out = cash_by_period(refunds, "refund_date", periods, {"cash_out": sum_money("refund_amount")})
    return came_in.join(went_out, "period_id", "full").select(
        "period_id",
        F.coalesce("cash_in", zero_money()).alias("cash_in"),
        F.coalesce("cash_out", zero_money()).alias("cash_out"),
    )


def int_period_close_adjustments(
    refunds: DataFrame, payments: DataFrame, invoices: DataFrame, periods: DataFrame
) -> DataFrame:
    """Refunds with the period they correct and the period they fall in; late = after the close."""
    context = (
        refunds.select("refund_id", "payment_id", "refund_date", "refund_amount")
        .join(payments.select("payment_id", "invoice_id"), "payment_id")
        .join(invoices.select("invoice_id", "invoice_date"), "invoice_id")
    )
    placed = assign_period(context, "invoice_date", periods, ("period_id", "closed_at"), prefix="original_")
    placed = assign_period(placed, "refund_date", periods, ("period_id",), prefix="adjustment_")
    closed_at = F.col("original_closed_at")
    late = closed_at.isNotNull() & (F.col("refund_date") > closed_at)
    return placed.select(
        "refund_id",
        "invoice_id",
        "invoice_date",
        "refund_date",
        "refund_amount",
        "original_period_id",
        "adjustment_period_id",
        closed_at.alias("original_period_closed_at"),
        late.alias("is_late_adjustment"),
        F.when(late, F.datediff("refund_date", closed_at)).alias("days_after_close"),
    )


def fct_period_close_adjustments(adjustments: DataFrame) -> DataFrame:
    return adjustments


def int_active_customers_by_period(orders: DataFrame, subscriptions: DataFrame, periods: DataFrame) -> DataFrame:
    """Customers with a completed order in the period or a phase overlapping it, once each."""
    keys = ("period_id", "period_start_date")
    ordered = assign_period(
        orders.filter(F.col("order_status") == "completed").select("customer_id", "order_date"),
        "order_date",
        periods,
        keys,
    )
    subscribed = overlap_period(
        subscriptions.select("customer_id", "phase_start_date", "phase_end_date"),
        "phase_start_date",
        "phase_end_date",
        periods,
        keys,
    )
    columns = ["period_id", "customer_id", "period_start_date"]
    return ordered.select(*columns).unionByName(subscribed.select(*columns)).distinct()


def mart_revenue_reconciliation_by_period(periods: DataFrame, retail: DataFrame, billing: DataFrame) -> DataFrame:
    retail_totals = retail.groupBy("period_id").agg(
        sum_money("booked_revenue").alias("retail_net_booked_revenue"),
        sum_money("collected_amount").alias("retail_collected_against_bookings"),
        sum_money("tax_amount").alias("_retail_tax"),
    )
    billing_totals = billing.groupBy("period_id").agg(
        sum_money("booked_revenue").alias("billing_net_booked_revenue"),
        sum_money("collected_amount").alias("billing_collected_against_bookings"),
        sum_money("refunded_amount_against_bookings").alias("billing_refunded_amount_against_bookings"),
        sum_money("tax_amount").alias("_billing_tax"),
    )
    lines = [
        "retail_net_booked_revenue",
        "billing_net_booked_revenue",
        "retail_collected_against_bookings",
        "billing_collected_against_bookings",
        "billing_refunded_amount_against_bookings",
    ]
    filled = fill_periods(periods, [*lines, "_retail_tax", "_billing_tax"], retail_totals, billing_totals)
    booked = F.col("retail_net_booked_revenue") + F.col("billing_net_booked_revenue")
    collected = F.col("retail_collected_against_bookings") + F.col("billing_collected_against_bookings")
    return filled.select(
        "period_id",
        "period_start_date",
        "period_end_date",
        "is_closed",
        *lines,
        money(booked).alias("total_net_booked_revenue"),
        money(F.col("_retail_tax") + F.col("_billing_tax")).alias("total_tax_amount"),
        money(collected).alias("total_collected_against_bookings"),
        money(booked - collected).alias("variance"),
    )


def mart_cash_movements_by_period(periods: DataFrame, retail: DataFrame, billing: DataFrame) -> DataFrame:
    sides = ["retail_cash_in", "retail_cash_out", "billing_cash_in", "billing_cash_out"]
    renamed = [
        side.select(
            "period_id", F.col("cash_in").alias(f"{name}_cash_in"), F.col("cash_out").alias(f"{name}_cash_out")
        )
        for name, side in (("retail", retail), ("billing", billing))
    ]
    filled = fill_periods(periods, sides, *renamed)
    retail_in, retail_out, billing_in, billing_out = [F.col(c) for c in sides]
    return filled.select(
        "period_id",
        "period_start_date",
        "period_end_date",
        "is_closed",
        *sides,
        money(retail_in - retail_out).alias("retail_net_cash_movement"),
        money(billing_in - billing_out).alias("billing_net_cash_movement"),
        money(retail_in + billing_in).alias("total_cash_in"),
        money(retail_out + billing_out).alias("total_cash_out"),
        money(retail_in + billing_in - retail_out - billing_out).alias("total_net_cash_movement"),
    )
