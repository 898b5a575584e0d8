"""The declared checks of every table, as data."""

from __future__ import annotations

from pyspark.sql import Column

from tallyworks.operators.checks import (
    AcceptedRange,
    AcceptedValues,
    Check,
    Held,
    NotImplausiblyLarge,
    NotNegative,
    NotNull,
    Relationships,
    RowsExpectedEmpty,
    Unique,
    row_counts,
)
from tallyworks.plans.named_checks import NAMED_CHECKS
from tallyworks.plans.warehouse import SAME_ROWS

# Keys that are both unique and required.
KEYS: dict[str, tuple[str, ...]] = {
    "stg_customers": ("customer_id", "email"),
    "stg_products": ("product_id",),
    "stg_orders": ("order_id",),
    "stg_order_items": ("order_item_id",),
    "stg_payments": ("payment_id",),
    "stg_billing__plans": ("plan_id",),
    "stg_billing__subscriptions": ("subscription_id",),
    "stg_billing__invoices": ("invoice_id",),
    "stg_billing__invoice_lines": ("invoice_line_id",),
    "stg_billing__payments": ("payment_id",),
    "stg_billing__refunds": ("refund_id",),
    "stg_events__events": ("event_id",),
    "int_order_items_enriched": ("order_item_id",),
    "int_order_payment_summary": ("order_id",),
    "int_payment_refund_netting": ("payment_id",),
    "int_invoice_payment_status": ("invoice_id",),
    "int_subscription_periods": ("subscription_id",),
    "int_identity_resolution": ("anonymous_id",),
    "int_events_resolved": ("event_id",),
    "int_events_deduplicated": ("event_id",),
    "int_sessions": ("event_id",),
    "int_revenue_by_period_retail": ("order_id",),
    "int_revenue_by_period_billing": ("invoice_id",),
    "int_period_close_adjustments": ("refund_id",),
    "dim_customers": ("customer_id",),
    "dim_products": ("product_id",),
    "dim_date": ("date_day",),
    "fct_orders": ("order_id",),
    "fct_order_items": ("order_item_id",),
    "dim_plans": ("plan_id",),
    "fct_subscriptions": ("subscription_id",),
    "fct_invoices": ("invoice_id",),
    "fct_payments": ("payment_id",),
    "mart_monthly_recurring_revenue": ("activity_month",),
    "mart_mrr_movements": ("activity_month",),
    "mart_invoice_reconciliation": ("activity_month",),
    "mart_customer_metrics": ("customer_id",),
    "fct_events": ("event_id",),
    "fct_sessions": ("session_id",),
    "mart_funnel_conversion": ("activity_date",),
    "mart_activation": ("customer_id",),
    "dim_accounting_periods": ("period_id",),
    "fct_period_close_adjustments": ("refund_id",),
    "mart_revenue_reconciliation_by_period": ("period_id",),
    "mart_cash_movements_by_period": ("period_id",),
    "accounting_periods": ("period_id",),
    "tax_rates": ("region",),
}

# Unique without being declared required, and required without being unique.
UNIQUE_ONLY: dict[str, tuple[str, ...]] = {
    "int_cash_movements_retail": ("period_id",),
    "int_cash_movements_billing": ("period_id",),
}
REQUIRED_ONLY: dict[str, tuple[str, ...]] = {
    "stg_products": ("unit_price",),
    "stg_orders": ("customer_id",),
    "stg_order_items": ("order_id", "product_id"),
    "stg_payments": ("order_id",),
    "stg_billing__subscriptions": ("customer_id", "plan_id"),
    "stg_billing__invoices": ("subscription_id",),
    "stg_billing__invoice_lines": ("invoice_id",),
    "stg_billing__payments": ("invoice_id",),
    "stg_billing__refunds": ("payment_id",),
    "stg_events__events": ("anonymous_id",),
    "int_subscription_chain_month_spine": ("subscription_chain_id",),
    "int_sessions": ("session_id",),
    "int_period_close_adjustments": ("refund_date",),
    "int_volume_by_period": ("source_name",),
    "int_volume_anomaly_by_period": ("source_name",),
    "int_active_customers_by_period": ("period_id", "customer_id"),
    "fct_orders": ("customer_id",),
    "fct_subscriptions": ("customer_id",),
    "mart_volume_anomalies": ("period_id",),
    "accounting_periods": ("period_start_date", "period_end_date"),
}

# Amounts and counts that are never negative.
NOT_NEGATIVE: dict[str, tuple[str, ...]] = {
    "stg_billing__invoices": ("invoice_amount",),
    "stg_billing__invoice_lines": ("line_amount",),
    "stg_billing__payments": ("payment_amount",),
    "stg_billing__refunds": ("refund_amount",),
    "int_subscription_periods": ("mrr_amount",),
    "int_subscription_mrr_by_chain_month": ("mrr_amount",),
    "int_subscription_mrr_movements": (
        "new_mrr",
        "reactivation_mrr",
        "expansion_mrr",
        "contraction_mrr",
        "churned_mrr",
    ),
    "int_payment_refund_netting": ("net_collected_amount",),
    "int_revenue_by_period_retail": ("booked_revenue",),
    "int_revenue_by_period_billing": ("booked_revenue",),
    "int_cash_movements_retail": ("cash_in", "cash_out"),
    "int_cash_movements_billing": ("cash_in", "cash_out"),
    "int_volume_by_period": ("row_count",),
    "int_volume_anomaly_by_period": ("row_count",),
    "fct_subscriptions": ("mrr_amount",),
    "fct_invoices": ("invoice_amount",),
    "mart_monthly_recurring_revenue": ("total_mrr",),
    "fct_orders": ("order_amount", "amount_collected"),
    "fct_sessions": ("event_count",),
    "mart_activation": ("days_to_first_purchase",),
    "mart_revenue_reconciliation_by_period": ("total_net_booked_revenue",),
    "mart_cash_movements_by_period": ("total_cash_in", "total_cash_out"),
}

# The accepted words of coded columns.
ACCEPTED_VALUES = (
    AcceptedValues("stg_orders", "order_status", ("completed", "cancelled", "refunded")),
    AcceptedValues("stg_payments", "payment_status", ("succeeded", "failed", "refunded")),
    AcceptedValues("stg_billing__payments", "payment_status", ("succeeded", "failed")),
    AcceptedValues("stg_billing__plans", "billing_interval", ("monthly", "annual")),
    AcceptedValues(
        "stg_billing__subscriptions", "phase_type", ("trial", "new", "upgrade", "downgrade", "reactivation")
    ),
    AcceptedValues(
        "stg_billing__subscriptions", "ended_reason", ("cancelled", "paused", "upgraded", "downgraded")
    ),
    AcceptedValues(
        "stg_events__events",
        "event_type",
        (
            "page_view",
            "search",
            "product_view",
            "add_to_cart",
            "remove_from_cart",
            "checkout_start",
            "purchase",
            "signup",
            "login",
        ),
    ),
    AcceptedValues("mart_volume_anomalies", "source_name", ("orders", "invoices", "events")),
)

RELATIONSHIPS = (
    Relationships("stg_orders", "customer_id", "stg_customers", "customer_id"),
    Relationships("stg_order_items", "order_id", "stg_orders", "order_id"),
    Relationships("stg_order_items", "product_id", "stg_products", "product_id"),
    Relationships("stg_payments", "order_id", "stg_orders", "order_id"),
    Relationships("stg_billing__subscriptions", "customer_id", "stg_customers", "customer_id"),
    Relationships("stg_billing__subscriptions", "plan_id", "stg_billing__plans", "plan_id"),
    Relationships("stg_billing__invoices", "subscription_id", "stg_billing__subscriptions", "subscription_id"),
    Relationships("stg_billing__invoice_lines", "invoice_id", "stg_billing__invoices", "invoice_id"),
    Relationships("stg_billing__payments", "invoice_id", "stg_billing__invoices", "invoice_id"),
    Relationships("stg_billing__refunds", "payment_id", "stg_billing__payments", "payment_id"),
    Relationships("stg_events__events", "customer_id", "stg_customers", "customer_id"),
    Relationships("stg_events__events", "product_id", "stg_products", "product_id"),
    Relationships("stg_events__events", "order_id", "stg_orders", "order_id"),
    Relationships("fct_orders", "customer_id", "dim_customers", "customer_id"),
    Relationships("fct_subscriptions", "customer_id", "dim_customers", "customer_id"),
)

RANGES = (
    AcceptedRange("stg_order_items", "line_amount", min_value=0),
    AcceptedRange("mart_retention_cohorts", "retention_rate", min_value=0, max_value=1),
    AcceptedRange("tax_rates", "tax_rate", min_value=0, max_value=0.15),
)

CEILINGS = (
    NotImplausiblyLarge("fct_orders", "order_amount", 10_000),
    NotImplausiblyLarge("fct_invoices", "invoice_amount", 2_000),
)

COMBINATIONS = (
    Unique("int_active_customers_by_period", ("period_id", "customer_id")),
    Unique("mart_volume_anomalies", ("source_name", "period_id")),
)


def generic_checks() -> list[Check]:
    """All declared checks, table by table."""
    checks: list[Check] = []
    for declared in (KEYS, UNIQUE_ONLY):
        checks += [Unique(table, (c,)) for table, columns in declared.items() for c in columns]
    for declared in (KEYS, REQUIRED_ONLY):
        checks += [NotNull(table, c) for table, columns in declared.items() for c in columns]
    checks += [NotNegative(table, c) for table, columns in NOT_NEGATIVE.items() for c in columns]
    return [*checks, *ACCEPTED_VALUES, *RELATIONSHIPS, *RANGES, *CEILINGS, *COMBINATIONS]


def write_counts(same_rows: Held = SAME_ROWS) -> dict[str, dict[str, Column]]:
    """What the write of each table counts for the row checks: its own, and those of an intermediate it holds."""
    checks = generic_checks()
    counting = row_counts(checks)
    for name, (mart, renamed) in same_rows.items():
        held = {c.name for c in checks if c.table == name and getattr(c, "column", None) not in renamed.values()}
        own = counting.get(name, {})
        counting.setdefault(mart, {}).update({n: own.pop(n) for n in list(own) if n in held})
    return counting


def named_checks(tables) -> tuple[dict, list[Check]]:
    """The hand-written checks as results to count: ``(tables, checks)`` for ``run_checks``."""
    results = {name: make(tables) for name, make in NAMED_CHECKS.items()}
    return results, [RowsExpectedEmpty(name, name) for name in results]
