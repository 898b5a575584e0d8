"""The metric catalogue: semantic models over warehouse tables and the metrics on them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyworks.operators.metrics import Dimension, Entity, Measure, Metric, Registry, SemanticModel


def _sums(*names: str) -> tuple[Measure, ...]:
    return tuple(Measure(n, "sum") for n in names)


MODELS = (
    SemanticModel(
        "sm_customers",
        "dim_customers",
        (Entity("customer_id", "primary"),),
        (Dimension("signup_date", grain="day"), Dimension("region"), Dimension("country")),
        time_dimension="signup_date",
    ),
    SemanticModel(
        "sm_products",
        "dim_products",
        (Entity("product_id", "primary"),),
        (Dimension("category"), Dimension("is_active")),
    ),
    SemanticModel(
        "sm_plans",
        "dim_plans",
        (Entity("plan_id", "primary"),),
        (Dimension("plan_name"), Dimension("billing_interval")),
    ),
    SemanticModel(
        "sm_orders",
        "fct_orders",
        (Entity("order_id", "primary"), Entity("customer_id", "foreign")),
        (Dimension("order_date", grain="day"), Dimension("order_status"), Dimension("order_channel")),
        _sums("order_amount", "amount_collected"),
        "order_date",
    ),
    SemanticModel(
        "sm_invoices",
        "fct_invoices",
        (
            Entity("invoice_id", "primary"),
            Entity("customer_id", "foreign"),
            Entity("subscription_id", "foreign"),
        ),
        (Dimension("invoice_date", grain="day"),),
        _sums("invoice_amount", "net_collected_amount"),
        "invoice_date",
    ),
    SemanticModel(
        "sm_mrr_movements",
        "mart_mrr_movements",
        (Entity("mrr_movements_month", "primary", "activity_month"),),
        (Dimension("activity_month", grain="month"),),
        _sums(
            "opening_mrr",
            "new_mrr",
            "expansion_mrr",
            "reactivation_mrr",
            "contraction_mrr",
            "churned_mrr",
            "closing_mrr",
        ),
        "activity_month",
    ),
    SemanticModel(
        "sm_retention_cohorts",
        "mart_retention_cohorts",
        (Entity("retention_cohort", "primary", "concat(cohort_month, '-', months_since_cohort_start)"),),
        (Dimension("cohort_month", grain="month"), Dimension("months_since_cohort_start")),
        _sums("cohort_size", "active_chain_count"),
        "cohort_month",
    ),
    SemanticModel(
        "sm_funnel_conversion",
        "mart_funnel_conversion",
        (Entity("funnel_activity_date", "primary", "activity_date"),),
        (Dimension("activity_date", grain="day"),),
        _sums("viewers", "carters", "checkout_starters", "purchasers"),
        "activity_date",
    ),
    SemanticModel(
        "sm_activation",
        "mart_activation",
        (Entity("customer_id", "primary"),),
        (
            Dimension("first_signup_date", "to_date(first_signup_at)", "day"),
            Dimension("is_activated"),
        ),
        (Measure("signup_customer_count", "count_distinct", "customer_id"),),
        "first_signup_date",
    ),
    SemanticModel(
        "sm_active_customers",
        "int_active_customers_by_period",
        (Entity("customer_id", "foreign"),),
        (Dimension("period_start_date", grain="month"),),
        (Measure("active_customer_count", "count_distinct", "customer_id"),),
        "period_start_date",
        primary_entity="customer_id",
    ),
    SemanticModel(
        "sm_revenue_reconciliation",
        "mart_revenue_reconciliation_by_period",
        (Entity("period_id", "primary"),),
        (Dimension("period_start_date", grain="month"), Dimension("is_closed")),
        _sums("total_net_booked_revenue", "total_collected_against_bookings", "total_tax_amount", "variance"),
        "period_start_date",
    ),
    SemanticModel(
        "sm_cash_movements",
        "mart_cash_movements_by_period",
        (Entity("cash_movement_period", "primary", "period_id"), Entity("period_id", "foreign")),
        (Dimension("period_start_date", grain="month"),),
        _sums("total_cash_in", "total_cash_out", "total_net_cash_movement"),
        "period_start_date",
    ),
)


def _over(numerator: Column, denominator: Column) -> Column:
    """A ratio of aggregates; NULL unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator)


def _share(numerator: Column, denominator: Column) -> Column:
    """The same for money: an exact decimal, rounded to ten places."""
    return F.when(denominator > 0, F.round(numerator / denominator, 10).cast("decimal(38,10)"))


def _kept(m: Mapping[str, Column]) -> Column:
    return m["opening_mrr"] - m["contraction_mrr"] - m["churned_mrr"]


SIMPLE = {
    "order_revenue": "order_amount",
    "order_amount_collected": "amount_collected",
    "net_booked_revenue": "total_net_booked_revenue",
    "cash_collected_against_bookings": "total_collected_against_bookings",
    "booking_variance": "variance",
    "cash_in": "total_cash_in",
    "cash_out": "total_cash_out",
    "net_cash_movement": "total_net_cash_movement",
    "active_customers": "active_customer_count",
    "mrr": "closing_mrr",
    "opening_mrr": "opening_mrr",
    "churned_mrr": "churned_mrr",
    "contraction_mrr": "contraction_mrr",
    "expansion_mrr": "expansion_mrr",
    "cohort_size": "cohort_size",
    "active_chain_count": "active_chain_count",
    "viewers": "viewers",
    "carters": "carters",
    "checkout_starters": "checkout_starters",
    "purchasers": "purchasers",
    "signups": "signup_customer_count",
}

METRICS = (
    *[Metric(name, measure) for name, measure in SIMPLE.items()],
    Metric("activated_customers", "signup_customer_count", {"customer_id__is_activated": lambda c: c}),
    Metric("arr", inputs=("mrr",), formula=lambda m: (m["mrr"] * 12).cast("decimal(20,2)")),
    Metric(
        "churn_rate",
        inputs=("churned_mrr", "opening_mrr"),
        formula=lambda m: _share(m["churned_mrr"], m["opening_mrr"]),
    ),
    Metric(
        "gross_revenue_retention",
        inputs=("opening_mrr", "contraction_mrr", "churned_mrr"),
        formula=lambda m: _share(_kept(m), m["opening_mrr"]),
    ),
    Metric(
        "net_revenue_retention",
        inputs=("opening_mrr", "contraction_mrr", "churned_mrr", "expansion_mrr"),
        formula=lambda m: _share(_kept(m) + m["expansion_mrr"], m["opening_mrr"]),
    ),
    Metric(
        "retention_rate",
        inputs=("active_chain_count", "cohort_size"),
        formula=lambda m: _over(m["active_chain_count"], m["cohort_size"]),
    ),
    Metric(
        "view_to_purchase_rate",
        inputs=("purchasers", "viewers"),
        formula=lambda m: _over(m["purchasers"], m["viewers"]),
    ),
    Metric(
        "activation_rate",
        inputs=("activated_customers", "signups"),
        formula=lambda m: _over(m["activated_customers"], m["signups"]),
    ),
)


def registry() -> Registry:
    return Registry(MODELS, METRICS)
