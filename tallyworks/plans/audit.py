"""All checks of a warehouse that is made for them: each table is passed once, and only what is read again is written.

Most of what a warehouse holds is one row a fact, and most of its columns are passed on without being looked at. Here
tables are made from those before them as in a build, but

- a table that is a projection of its source, or that no other table reads, is not written: its rows and its key are
  counted in one pass, without a shuffle where the table comes out of a join or an aggregation by that key;
- a table that is read again is written with the columns that are read (``KEPT``); reading another one is an error;
- phases are dealt once by chain or by customer, and what is cut into months then meets without another shuffle
  (``follow_chains``, ``meet_customers``);
- every pass is a job of its own whose shuffle files go when it ends.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame

from tallyworks.operators.checks import Check, Unique, count_checks, count_table, held_domains, run_checks
from tallyworks.plans.checkbook import generic_checks, named_checks, write_counts
from tallyworks.plans.warehouse import MODELS, SAME_ROWS, Warehouse
from tallyworks.session import DROP_SHUFFLES, JOIN_AS_DEALT, scratch_root, settings
from tallyworks.sources.tables import with_columns_of

MONTHLY = "int_subscription_mrr_by_chain_month"
MOVEMENTS = "int_subscription_mrr_movements"
PLANS = "stg_billing__plans"
PHASES, CHAIN = "int_subscription_periods", "subscription_chain_id"

CUSTOMERS, ORDERS = "int_active_customers_by_period", "stg_orders"
#: Of a few rows, and read while others are made.
SMALL = ("accounting_periods", "tax_rates", PLANS)

#: ``SAME_ROWS``, and the monthly values of chains, which their movements pass on.
HELD = {**SAME_ROWS, MONTHLY: (MOVEMENTS, {})}

#: Read again by nothing, or made by a projection and joins with a few rows: not written.
PASSED = (
    "stg_customers",
    "stg_products",
    "stg_orders",
    "stg_order_items",
    "stg_payments",
    "stg_billing__subscriptions",
    "stg_billing__invoices",
    "stg_billing__invoice_lines",
    "stg_billing__payments",
    "int_order_payment_summary",
    "int_subscription_active_phase_months",
    "int_subscription_chain_month_spine",
    "int_identity_resolution",
    "int_events_deduplicated",
    "int_active_customers_by_period",
    "dim_products",
    "fct_order_items",
    "fct_subscriptions",
    "fct_payments",
    "mart_customer_metrics",
    "fct_sessions",
)

#: The columns that other tables, checks and reports read, of written tables with one row a fact. Others are written whole.
KEPT: dict[str, tuple[str, ...]] = {
    "stg_billing__refunds": ("refund_id", "payment_id", "refund_date", "refund_amount"),
    "stg_events__events": ("event_id", "anonymous_id", "customer_id", "event_type", "event_timestamp", "product_id", "order_id"),
    "int_events_resolved": ("event_id", "anonymous_id", "resolved_customer_id", "event_type", "event_timestamp"),
    "int_revenue_by_period_retail": ("order_id", "period_id", "booked_revenue", "collected_amount", "tax_amount"),
    "int_revenue_by_period_billing": (
        "invoice_id",
        "period_id",
        "booked_revenue",
        "collected_amount",
        "refunded_amount_against_bookings",
        "tax_amount",
    ),
    "dim_customers": ("customer_id",),
    "fct_orders": ("order_id", "customer_id", "order_date", "order_status", "order_amount", "amount_collected"),
    "fct_invoices": (
        "invoice_id",
        "customer_id",
        "invoice_date",
        "invoice_amount",
        "net_collected_amount",
        "refunded_amount",
        "outstanding_balance",
    ),
    "fct_events": ("event_id", "anonymous_id", "customer_id", "session_id", "event_type", "event_timestamp", "product_id"),
    "fct_period_close_adjustments": (
        "refund_id",
        "refund_amount",
        "original_period_id",
        "adjustment_period_id",
        "is_late_adjustment",
        "days_after_close",
    ),
}

#: Tables at a time: enough to fill the cores while one of them ends, few enough to keep few shuffles on disk. The
#: checks that are left are many small jobs.
AT_ONCE, CHECKS_AT_ONCE = 3, 4

TABLES = tuple(m for m in MODELS if m not in (*SAME_ROWS, *SMALL, MONTHLY, MOVEMENTS))


def follow_chains(w: Warehouse, counting: Mapping[str, Mapping[str, Column]]) -> dict[str, int]:
    """Write the monthly movements of all chains and read the monthly values from them.

    The phases are dealt by chain before they are cut into months, so the months meet where they are and their
    window needs neither shuffle nor sort.
    """
    phases = w[PHASES]
    dealt = w.beside({PHASES: phases.repartition(CHAIN)})
    monthly = dealt[MONTHLY].schema
    with settings(phases.sparkSession, JOIN_AS_DEALT):
        counted = dealt.share(MOVEMENTS, counting=counting)
    w.use(MOVEMENTS, dealt[MOVEMENTS])
    w.use(MONTHLY, with_columns_of(w[MOVEMENTS], monthly))
    return counted


def meet_customers(w: Warehouse) -> DataFrame:
    """The active customers of each period, from phases and days with orders that are both dealt by customer.

    What is dealt is one row a phase and one a customer, day and status, so a customer with very many orders is no skew.
    """
    days = w[ORDERS].select("customer_id", "order_date", "order_status").distinct()
    dealt = {PHASES: w[PHASES].repartition("customer_id"), ORDERS: days.repartition("customer_id")}
    return w.beside(dealt)[CUSTOMERS]


def pass_tables(w: Warehouse, also: Mapping[str, Collection[str]]) -> dict[str, int]:
    """Make all tables in turn; returns the failing rows of the checks that were counted on the way."""
    counting = write_counts(HELD)
    keeping = {name: tuple(dict.fromkeys((*columns, *also.get(name, ())))) for name, columns in KEPT.items()}
    # A key that other tables refer to is counted with its children, and one of several keys of a table by itself.
    keys: dict[str, list[tuple[tuple[str, ...], list[Check]]]] = {}
    for (table, columns), checks in held_domains(generic_checks(), HELD).items():
        keys.setdefault(table, []).append((columns, checks))
    alone = {t: k[0] for t, k in keys.items() if t in PASSED and len(k) == 1 and all(isinstance(c, Unique) for c in k[0][1])}

    def count(name: str, df: DataFrame) -> dict[str, int]:
        columns, checks = alone.get(name, ((), ()))
        counts, repeated = count_table(df, counting.get(name, {}), columns)
        return counts | {c.name: repeated for c in checks}

    counted = w.share(*SMALL, counting=counting)
    counted |= follow_chains(w, counting)
    w.use(CUSTOMERS, meet_customers(w))
    counted |= w.share(*TABLES, counting=counting, keeping=keeping, passing=dict.fromkeys(PASSED, count), at_once=AT_ONCE)
    return counted


def all_results(w: Warehouse, also: Mapping[str, Collection[str]] | None = None) -> DataFrame:
    """All declared and all hand-written checks. ``also`` names columns that are read afterwards, by table."""
    spark = w["accounting_periods"].sparkSession
    if not scratch_root(spark):
        named, rows = named_checks(w)
        return run_checks(ChainMap(named, w), [*generic_checks(), *rows], held=SAME_ROWS)
    with settings(spark, DROP_SHUFFLES):
        counted = pass_tables(w, also or {})
        named, rows = named_checks(w)
        tables, checks = ChainMap(named, w), [*generic_checks(), *rows]
        counted |= count_checks(tables, checks, counted, SAME_ROWS, CHECKS_AT_ONCE)
    return run_checks(tables, checks, counted, SAME_ROWS)
