"""All models by name: lazy DataFrames over named sources, and their materialisation."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Iterator, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait

from pyspark.sql import Column, DataFrame, SparkSession

from tallyworks.operators.contracts import Contract
from tallyworks.operators.spine import date_spine
from tallyworks.operators.subscriptions import bridge, cohorts, lifetime_value, movements, recurring_revenue
from tallyworks.plans import billing, events, finance, reliability, retail, staging
from tallyworks.sources.tables import Layout, Staged, publish_table, read_table, stage_table, write_scratch_counted

#: Models that are written at the same time.
AT_ONCE = 8

# Each model names what it reads; a source is written "source.table".
_Model = tuple[Callable[..., DataFrame], tuple[str, ...]]

STAGING: dict[str, _Model] = {
    "stg_customers": (staging.stg_customers, ("raw.customers",)),
    "stg_products": (staging.stg_products, ("raw.products",)),
    "stg_orders": (staging.stg_orders, ("raw.orders",)),
    "stg_order_items": (staging.stg_order_items, ("raw.order_items",)),
    "stg_payments": (staging.stg_payments, ("raw.payments",)),
    "stg_billing__plans": (staging.stg_billing__plans, ("raw_billing.plans",)),
    "stg_billing__subscriptions": (staging.stg_billing__subscriptions, ("raw_billing.subscriptions",)),
    "stg_billing__invoices": (staging.stg_billing__invoices, ("raw_billing.invoices",)),
    "stg_billing__invoice_lines": (staging.stg_billing__invoice_lines, ("raw_billing.invoice_lines",)),
    "stg_billing__payments": (staging.stg_billing__payments, ("raw_billing.payments",)),
    "stg_billing__refunds": (staging.stg_billing__refunds, ("raw_billing.refunds",)),
    "stg_events__events": (staging.stg_events__events, ("raw_events.events",)),
}

INTERMEDIATE: dict[str, _Model] = {
    "int_order_items_enriched": (
        retail.int_order_items_enriched,
        ("stg_order_items", "stg_orders", "stg_products"),
    ),
    "int_order_payment_summary": (retail.int_order_payment_summary, ("stg_payments",)),
    "int_payment_refund_netting": (
        billing.int_payment_refund_netting,
        ("stg_billing__payments", "stg_billing__refunds"),
    ),
    "int_invoice_payment_status": (
        billing.int_invoice_payment_status,
        ("stg_billing__invoices", "int_payment_refund_netting"),
    ),
    "int_subscription_periods": (
        billing.int_subscription_periods,
        ("stg_billing__subscriptions", "stg_billing__plans"),
    ),
    "int_subscription_active_phase_months": (
        billing.int_subscription_active_phase_months,
        ("int_subscription_periods", "stg_billing__invoices"),
    ),
    "int_subscription_chain_month_spine": (
        billing.int_subscription_chain_month_spine,
        ("int_subscription_periods", "stg_billing__invoices"),
    ),
    "int_subscription_mrr_by_chain_month": (
        billing.int_subscription_mrr_by_chain_month,
        ("int_subscription_chain_month_spine", "int_subscription_active_phase_months"),
    ),
    "int_subscription_mrr_movements": (movements, ("int_subscription_mrr_by_chain_month",)),
    "int_identity_resolution": (events.int_identity_resolution, ("stg_events__events",)),
    "int_events_resolved": (events.int_events_resolved, ("stg_events__events",)),
    "int_events_deduplicated": (events.int_events_deduplicated, ("stg_events__events",)),
    "int_sessions": (events.int_sessions, ("stg_events__events",)),
    "int_revenue_by_period_retail": (
        finance.int_revenue_by_period_retail,
        ("fct_orders", "stg_customers", "tax_rates", "accounting_periods"),
    ),
    "int_revenue_by_period_billing": (
        finance.int_revenue_by_period_billing,
        ("fct_invoices", "stg_customers", "tax_rates", "accounting_periods"),
    ),
    "int_cash_movements_retail": (finance.int_cash_movements_retail, ("stg_payments", "accounting_periods")),
    "int_cash_movements_billing": (
        finance.int_cash_movements_billing,
        ("stg_billing__payments", "stg_billing__refunds", "accounting_periods"),
    ),
    "int_period_close_adjustments": (
        finance.int_period_close_adjustments,
        ("stg_billing__refunds", "stg_billing__payments", "stg_billing__invoices", "accounting_periods"),
    ),
    "int_active_customers_by_period": (
        finance.int_active_customers_by_period,
        ("stg_orders", "int_subscription_periods", "accounting_periods"),
    ),
    "int_volume_by_period": (
        reliability.int_volume_by_period,
        ("stg_orders", "stg_billing__invoices", "stg_events__events", "accounting_periods"),
    ),
    "int_volume_anomaly_by_period": (
        reliability.int_volume_anomaly_by_period,
        ("int_volume_by_period", "dim_accounting_periods"),
    ),
}

MARTS: dict[str, _Model] = {
    "dim_customers": (retail.dim_customers, ("stg_customers", "stg_orders")),
    "dim_products": (retail.dim_products, ("stg_products",)),
    "dim_date": (date_spine, ("calendar_bounds",)),
    "fct_orders": (retail.fct_orders, ("stg_orders", "stg_order_items", "int_order_payment_summary")),
    "fct_order_items": (retail.fct_order_items, ("int_order_items_enriched",)),
    "dim_plans": (billing.dim_plans, ("stg_billing__plans",)),
    "fct_subscriptions": (billing.fct_subscriptions, ("int_subscription_periods",)),
    "fct_invoices": (billing.fct_invoices, ("int_invoice_payment_status",)),
    "fct_payments": (billing.fct_payments, ("int_payment_refund_netting",)),
    "mart_monthly_recurring_revenue": (recurring_revenue, ("int_subscription_mrr_by_chain_month",)),
    "mart_mrr_movements": (bridge, ("int_subscription_mrr_movements",)),
    "mart_retention_cohorts": (
        cohorts,
        ("int_subscription_periods", "int_subscription_mrr_by_chain_month"),
    ),
    "mart_customer_lifetime_value": (
        lifetime_value,
        ("int_subscription_mrr_movements", "int_subscription_mrr_by_chain_month"),
    ),
    "mart_customer_metrics": (
        billing.mart_customer_metrics,
        ("int_subscription_periods", "int_invoice_payment_status", "stg_billing__invoices"),
    ),
    "mart_invoice_reconciliation": (billing.mart_invoice_reconciliation, ("int_invoice_payment_status",)),
    "fct_events": (events.fct_events, ("int_sessions",)),
    "fct_sessions": (events.fct_sessions, ("stg_events__events",)),
    "mart_funnel_conversion": (events.mart_funnel_conversion, ("int_events_resolved",)),
    "mart_activation": (events.mart_activation, ("int_events_resolved",)),
    "dim_accounting_periods": (finance.dim_accounting_periods, ("accounting_periods",)),
    "fct_period_close_adjustments": (finance.fct_period_close_adjustments, ("int_period_close_adjustments",)),
    "mart_revenue_reconciliation_by_period": (
        finance.mart_revenue_reconciliation_by_period,
        ("dim_accounting_periods", "int_revenue_by_period_retail", "int_revenue_by_period_billing"),
    ),
    "mart_cash_movements_by_period": (
        finance.mart_cash_movements_by_period,
        ("dim_accounting_periods", "int_cash_movements_retail", "int_cash_movements_billing"),
    ),
    "mart_volume_anomalies": (reliability.mart_volume_anomalies, ("int_volume_anomaly_by_period",)),
}

MODELS: dict[str, _Model] = {**STAGING, **INTERMEDIATE, **MARTS}

#: Intermediates read by several marts: written once in a full build, instead of recomputed.
SHARED = (
    "int_subscription_mrr_by_chain_month",
    "int_subscription_mrr_movements",
    "int_events_resolved",
    "int_active_customers_by_period",
)

#: Intermediates whose rows a mart holds as they are: read from there, with the columns that are named otherwise.
SAME_ROWS: dict[str, tuple[str, dict[str, str]]] = {
    "int_order_items_enriched": ("fct_order_items", {}),
    "int_payment_refund_netting": ("fct_payments", {}),
    "int_invoice_payment_status": ("fct_invoices", {}),
    "int_subscription_periods": ("fct_subscriptions", {}),
    "int_sessions": ("fct_events", {"customer_id": "resolved_customer_id"}),
    "int_period_close_adjustments": ("fct_period_close_adjustments", {}),
}

#: Tables that grow with the business lie by month, sorted by what they are looked up by.
LAYOUTS: dict[str, Layout] = {
    "fct_orders": Layout("order_date", ("customer_id", "order_id")),
    "fct_order_items": Layout("order_date", ("order_id",)),
    "fct_invoices": Layout("invoice_date", ("customer_id", "invoice_id")),
    "fct_payments": Layout("payment_date", ("invoice_id",)),
    "fct_events": Layout("event_timestamp", ("anonymous_id", "event_timestamp")),
    "fct_sessions": Layout("session_start", ("anonymous_id", "session_start")),
    "int_events_resolved": Layout("event_timestamp", ("anonymous_id", "event_timestamp")),
}

_MONEY = "decimal(18,2)"

CONTRACTS: dict[str, Contract] = {
    "fct_orders": Contract(
        {
            "order_id": "bigint",
            "customer_id": "bigint",
            "order_date": "date",
            "order_status": "string",
            "order_channel": "string",
            "item_quantity": "bigint",
            "order_amount": _MONEY,
            "amount_collected": _MONEY,
            "payment_attempt_count": "bigint",
            "has_succeeded_payment": "boolean",
            "revenue_minus_collected_variance": _MONEY,
        },
        ("order_id",),
        ("customer_id", "order_date", "order_status"),
    ),
    "fct_invoices": Contract(
        {
            "invoice_id": "bigint",
            "subscription_id": "bigint",
            "customer_id": "bigint",
            "invoice_date": "date",
            "invoice_amount": _MONEY,
            "payment_attempt_count": "bigint",
            "has_succeeded_payment": "boolean",
            "has_failed_attempt": "boolean",
            "net_collected_amount": _MONEY,
            "refunded_amount": _MONEY,
            "last_payment_date": "date",
            "outstanding_balance": _MONEY,
        },
        ("invoice_id",),
        ("subscription_id", "customer_id", "invoice_date"),
    ),
    "mart_revenue_reconciliation_by_period": Contract(
        {
            "period_id": "int",
            "period_start_date": "date",
            "period_end_date": "date",
            "is_closed": "boolean",
            "retail_net_booked_revenue": _MONEY,
            "billing_net_booked_revenue": _MONEY,
            "retail_collected_against_bookings": _MONEY,
            "billing_collected_against_bookings": _MONEY,
            "billing_refunded_amount_against_bookings": _MONEY,
            "total_net_booked_revenue": _MONEY,
            "total_tax_amount": _MONEY,
            "total_collected_against_bookings": _MONEY,
            "variance": _MONEY,
        },
        ("period_id",),
        ("period_start_date", "period_end_date", "is_closed"),
    ),
    "mart_cash_movements_by_period": Contract(
        {
            "period_id": "int",
            "period_start_date": "date",
            "period_end_date": "date",
            "is_closed": "boolean",
            "retail_cash_in": _MONEY,
            "retail_cash_out": _MONEY,
            "billing_cash_in": _MONEY,
            "billing_cash_out": _MONEY,
            "retail_net_cash_movement": _MONEY,
            "billing_net_cash_movement": _MONEY,
            "total_cash_in": _MONEY,
            "total_cash_out": _MONEY,
            "total_net_cash_movement": _MONEY,
        },
        ("period_id",),
        ("period_start_date", "period_end_date", "is_closed"),
    ),
}


class Warehouse(Mapping[str, DataFrame]):
    """Models by name over named sources; nothing runs until an action on a model.

    Sources may be DataFrames or functions that make one. A finished table can be put in the
    place of any model with ``use``.
    """

    def __init__(self, sources: Mapping[str, DataFrame | Callable[[], DataFrame]]) -> None:
        self._sources = dict(sources)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in MODELS:
                build, reads = MODELS[name]
                self._frames[name] = build(*[self[r] for r in reads])
            else:
                source = self._sources[name]
                self._frames[name] = source if isinstance(source, DataFrame) else source()
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter([*self._sources, *MODELS])

    def __len__(self) -> int:
        return len(self._sources) + len(MODELS)

    def use(self, name: str, df: DataFrame) -> None:
        self._frames[name] = df

    def beside(self, frames: Mapping[str, DataFrame]) -> Warehouse:
        """A warehouse over the same tables, with others in the place of some."""
        other = Warehouse(self._sources)
        other._frames = {**self._frames, **frames}
        return other

    def share(
        self,
        *names: str,
        counting: Mapping[str, Mapping[str, Column]] | None = None,
        keeping: Mapping[str, Collection[str]] | None = None,
        passing: Mapping[str, Callable[[str, DataFrame], dict[str, int]]] | None = None,
        at_once: int = AT_ONCE,
    ) -> dict[str, int]:
        """Compute models or sources once that the next query reads several times.

        They are written to the session's shared checkpoint folder and read back, so neither the
        consumers nor a lost executor recompute the chain behind them, and each consumer reads
        only its own columns. Without such a folder they stay lazy. Returns the aggregates of ``counting``
        (by table, then name), which the writes work out on the way. ``keeping`` names the columns that are
        read later, for tables of which not all are; tables in ``passing`` are not written but given to a function that
        counts them.
        """
        counted: dict[str, int] = {}

        def write(name: str) -> DataFrame:
            if passing and name in passing:
                counted.update(passing[name](name, self[name]))
                return self[name]
            written, counts = write_scratch_counted(self[name], (counting or {}).get(name), (keeping or {}).get(name))
            counted.update(counts)
            return written

        self.compute(names, write, at_once)
        return counted

    def compute(self, names: Iterable[str], write: Callable[[str], DataFrame], at_once: int = AT_ONCE) -> None:
        """Write tables and read what is written from then on.

        ``at_once`` tables are written at a time, each as soon as those it is made from are there. An intermediate
        whose rows a mart holds is read from the mart once that is written. If one fails, those under way are
        finished, no other is begun, and the error is raised.
        """
        left = list(names)
        behind = {n: _behind(n) & set(left) for n in left}
        done: set[str] = set()
        running: dict[Future, str] = {}
        failed: list[Future] = []
        with ThreadPoolExecutor(at_once) as pool:
            while running or (left and not failed):
                for name in [n for n in left if behind[n] <= done and not failed]:
                    left.remove(name)
                    running[pool.submit(write, name)] = name
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    name = running.pop(future)
                    if future.exception():
                        failed.append(future)
                        continue
                    done.add(name)
                    self.use(name, future.result())
                    for same, (mart, _) in SAME_ROWS.items():
                        if mart == name:
                            self.use(same, as_intermediate(same, future.result()))
        for future in failed:
            future.result()


def _behind(name: str) -> set[str]:
    """All models and sources that a model is made from."""
    reads = set(MODELS[name][1]) if name in MODELS else set()
    holders = {SAME_ROWS[r][0] for r in reads if r in SAME_ROWS} - {name}
    return reads.union(holders, *map(_behind, reads))


def held_by(names: Collection[str], tables: Collection[str]) -> set[str]:
    """Which of ``tables`` are made from any of ``names``."""
    return {t for t in tables if _behind(t) & set(names)}


def as_intermediate(name: str, mart: DataFrame) -> DataFrame:
    """The rows of an intermediate out of the mart that holds them."""
    return mart.withColumnsRenamed(SAME_ROWS[name][1])


def _layer(name: str) -> str:
    return "marts" if name in MARTS else "intermediate"


WRITTEN = (*SHARED, *MARTS)


def stage(warehouse: Warehouse, root: str, counting: Mapping[str, Mapping[str, Column]] | None = None) -> tuple[Warehouse, dict[str, Staged]]:
    """Write the shared intermediates and all marts under ``root`` without publishing them.

    Every table is computed from tables already written, so lineage stays short and a lost
    executor costs the tasks of one model, not the whole chain. A broken contract stops the
    build. Returns a warehouse over the new versions, and these.
    """
    built = Warehouse(warehouse._sources)
    staged: dict[str, Staged] = {}

    def write(name: str) -> DataFrame:
        staged[name] = stage_table(
            built[name], f"{root}/{_layer(name)}/{name}", CONTRACTS.get(name), layout=LAYOUTS.get(name), counting=(counting or {}).get(name)
        )
        return staged[name].written

    built.compute(WRITTEN, write)
    return built, staged


def build(warehouse: Warehouse, root: str) -> Warehouse:
    """Write and publish the shared intermediates and all marts; returns a warehouse over them."""
    built, staged = stage(warehouse, root)
    for table in staged.values():
        publish_table(table)
    return built


def open_warehouse(spark: SparkSession, root: str, sources: Mapping[str, DataFrame]) -> Warehouse:
    """A warehouse over what is published under ``root``."""
    opened = Warehouse(sources)
    for name in WRITTEN:
        opened.use(name, read_table(spark, f"{root}/{_layer(name)}/{name}"))
    for name, (mart, _) in SAME_ROWS.items():
        opened.use(name, as_intermediate(name, opened[mart]))
    return opened
