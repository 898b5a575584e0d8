"""Registered queries: ``(spark, directory) -> DataFrame`` over the whole test tables."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions.columns import calendar_months_between
from tallyworks.operators.checks import (
    AcceptedRange,
    AcceptedValues,
    NotImplausiblyLarge,
    NotNegative,
    NotNull,
    Relationships,
    Unique,
    check_grew,
    run_checks,
    summarize,
)
from tallyworks.operators.contracts import assert_contract, freshness
from tallyworks.operators.events import session_totals
from tallyworks.operators.history import scd2_apply, start_history
from tallyworks.operators.joins import join_hot
from tallyworks.operators.metrics import metric_query
from tallyworks.operators.periods import assign_period, overlap_period, with_tax
from tallyworks.operators.reconcile import reconcile, reconcile_summary
from tallyworks.operators.spine import zero_fill
from tallyworks.operators.subscriptions import authoritative
from tallyworks.operators.windows import lead_date
from tallyworks.plans import events, reports
from tallyworks.plans.audit import all_results
from tallyworks.plans.faults import FAULTS, LOST, NEGATIVE_PAYMENTS, Fault, Lost
from tallyworks.plans.governed import registry
from tallyworks.plans.named_checks import NAMED_CHECKS
from tallyworks.plans.warehouse import CONTRACTS, MODELS, Warehouse
from tallyworks.session import rely_on_aqe, scratch_root
from tallyworks.sources.ingest import SOURCES, coerce_temporal, stamp_loaded_at
from tallyworks.sources.testdata import TestTables
from tallyworks.streaming.events import dedup_stream, read_event_files, run_available, session_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The models in the order of their inventory numbers.
STAGING_IDS = (
    "stg_customers",
    "stg_products",
    "stg_orders",
    "stg_order_items",
    "stg_payments",
    "stg_billing__plans",
    "stg_billing__subscriptions",
    "stg_billing__invoices",
    "stg_billing__invoice_lines",
    "stg_billing__payments",
    "stg_billing__refunds",
    "stg_events__events",
)
MODEL_IDS = (
    "int_order_items_enriched",
    "int_order_payment_summary",
    "int_payment_refund_netting",
    "int_invoice_payment_status",
    "int_subscription_periods",
    "int_subscription_active_phase_months",
    "int_subscription_chain_month_spine",
    "int_subscription_mrr_by_chain_month",
    "int_subscription_mrr_movements",
    "int_identity_resolution",
    "int_events_resolved",
    "int_events_deduplicated",
    "int_sessions",
    "int_revenue_by_period_retail",
    "int_revenue_by_period_billing",
    "int_cash_movements_retail",
    "int_cash_movements_billing",
    "int_period_close_adjustments",
    "int_active_customers_by_period",
    "int_volume_by_period",
    "int_volume_anomaly_by_period",
    "dim_customers",
    "dim_products",
    "dim_date",
    "fct_orders",
    "fct_order_items",
    "dim_plans",
    "fct_subscriptions",
    "fct_invoices",
    "fct_payments",
    "mart_monthly_recurring_revenue",
    "mart_mrr_movements",
    "mart_retention_cohorts",
    "mart_customer_lifetime_value",
    "mart_customer_metrics",
    "mart_invoice_reconciliation",
    "fct_events",
    "fct_sessions",
    "mart_funnel_conversion",
    "mart_activation",
    "dim_accounting_periods",
    "fct_period_close_adjustments",
    "mart_revenue_reconciliation_by_period",
    "mart_cash_movements_by_period",
    "mart_volume_anomalies",
)


# Models a query reads several times, in the order they build on each other.
MONTHLY = "int_subscription_mrr_by_chain_month"
ADJUSTMENTS = "fct_period_close_adjustments"
# Item lines and billing runs, which most queries over retail or billing money make several tables from.
INPUTS = (("_merged",), ("subscriptions", "_billed"))
# All checks read all sources, so those that take a join are made once as well.
ALL_INPUTS = (("_merged", "payments"), ("subscriptions", "_billed"), ("customers",))
INPUTS_BY_QUERY = {
    **dict.fromkeys(("sem17_reconciliation", "bi1_scorecard"), INPUTS),
    **dict.fromkeys(("chk13_check_results", "chk13_check_summary", "bi8_alert", "bi9_health"), ALL_INPUTS),
}
SHARED_BY_QUERY: dict[str, tuple[str, ...]] = {
    "md34_mart_customer_lifetime_value": (MONTHLY,),
    "chk16_check_grew": (ADJUSTMENTS,),
    "sem17_reconciliation": (
        "mart_revenue_reconciliation_by_period",
        "mart_cash_movements_by_period",
        "int_active_customers_by_period",
        "mart_mrr_movements",
        "mart_funnel_conversion",
    ),
    "bi1_scorecard": (MONTHLY, "int_active_customers_by_period"),
}


def warehouse(spark: SparkSession, directory: str, query: str = "") -> Warehouse:
    """All models over the canonical tables derived from one test-data directory."""
    rely_on_aqe(spark)
    tables = TestTables(spark, directory)
    tables.share(*INPUTS_BY_QUERY.get(query, ()))
    w = Warehouse(tables.makers())
    w.share(*SHARED_BY_QUERY.get(query, ()))
    return w


def _model(name: str, query: str) -> Query:
    return lambda spark, directory: warehouse(spark, directory, query)[name]


def _named_check(name: str, fault: Fault | Lost | None = None) -> Query:
    def query(spark: SparkSession, directory: str) -> DataFrame:
        w = warehouse(spark, directory)
        return NAMED_CHECKS[name](fault.plant(w) if fault else w)

    return query


for _prefix, _names in (("stg", STAGING_IDS), ("md", MODEL_IDS)):
    for _i, _name in enumerate(_names, 1):
        _query = f"{_prefix}{_i:02d}_{_name}"
        QUERIES[_query] = _model(_name, _query)
for _i, _name in enumerate(NAMED_CHECKS, 1):
    QUERIES[f"sgl{_i:02d}_{_name}"] = _named_check(_name)
    if _name in FAULTS:
        QUERIES[f"sgl{_i:02d}_fault_{_name}"] = _named_check(_name, FAULTS[_name])
    if _name in LOST:
        QUERIES[f"sgl{_i:02d}_fault_lost_{_name}"] = _named_check(_name, LOST[_name])
assert set(STAGING_IDS) | set(MODEL_IDS) == set(MODELS)


def register(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, directory: fn(warehouse(spark, directory, fn.__name__))
    return fn


def register_raw(fn: Callable[[TestTables], DataFrame]) -> Callable[[TestTables], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, directory: fn(TestTables(spark, directory))
    return fn


# -- sources ----------------------------------------------------------------------------------


@register_raw
def src2_coerce_temporal(t: TestTables) -> DataFrame:
    """A text extract of the orders: times, days, and a column that is neither."""
    text = t.read("orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_time"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"),
        "o_orderpriority",
    )
    return coerce_temporal(text)


@register_raw
def src3_stamp_loaded_at(t: TestTables) -> DataFrame:
    stamped = stamp_loaded_at(t.orders().select("order_id"), F.lit("2001-09-01 06:00:00"))
    return stamped.select("order_id", F.col("_loaded_at").cast("timestamp_ntz").alias("loaded_at"))


@register
def src7_accounting_periods(w: Warehouse) -> DataFrame:
    return w["accounting_periods"]


@register
def src8_tax_rates(w: Warehouse) -> DataFrame:
    return w["tax_rates"]


# -- filters, joins, windows, series ----------------------------------------------------------


@register
def flt1_completed_orders(w: Warehouse) -> DataFrame:
    return w["stg_orders"].filter(F.col("order_status") == "completed")


@register
def flt2_first_phases(w: Warehouse) -> DataFrame:
    phases = w["int_subscription_periods"].filter(F.col("phase_type").isin("trial", "new"))
    return phases.select("subscription_id", "phase_type", "phase_start_date")


@register
def flt3_identified_events(w: Warehouse) -> DataFrame:
    known = w["stg_events__events"].filter(F.col("customer_id").isNotNull())
    return known.select("event_id", "anonymous_id", "customer_id")


@register
def flt4_authoritative_phase(w: Warehouse) -> DataFrame:
    return authoritative(
        w["int_subscription_active_phase_months"],
        ["subscription_chain_id", "activity_month"],
        ["phase_start_date", "subscription_id"],
    )


@register
def flt5_frequent_buyers(w: Warehouse) -> DataFrame:
    completed = w["stg_orders"].filter(F.col("order_status") == "completed")
    counts = completed.groupBy("customer_id").agg(F.count("*").alias("order_count"))
    return counts.filter(F.col("order_count") > 4)


@register
def flt7_late_adjustments(w: Warehouse) -> DataFrame:
    return w["fct_period_close_adjustments"].filter("is_late_adjustment")


@register
def flt8_orders_without_items(w: Warehouse) -> DataFrame:
    with_items = w["stg_order_items"].select("order_id").distinct()
    return w["stg_orders"].join(with_items, "order_id", "left_anti").select("order_id", "order_status")


@register
def jn3_tax_by_region(w: Warehouse) -> DataFrame:
    located = join_hot(w["fct_orders"], w["stg_customers"].select("customer_id", "region"), "customer_id")
    return with_tax(located.select("order_id", "region", "order_amount"), "order_amount", w["tax_rates"])


@register
def jn6_payment_periods(w: Warehouse) -> DataFrame:
    payments = w["stg_payments"].select("payment_id", "payment_date", "amount")
    return assign_period(payments, "payment_date", w["accounting_periods"])


@register
def jn8_phase_periods(w: Warehouse) -> DataFrame:
    phases = w["int_subscription_periods"].select(
        "subscription_id", "customer_id", "phase_start_date", "phase_end_date"
    )
    placed = overlap_period(
        phases, "phase_start_date", "phase_end_date", w["accounting_periods"], ("period_id", "period_start_date")
    )
    return placed.select("subscription_id", "customer_id", "period_id", "period_start_date")


@register
def jn14_latest_month_rows(w: Warehouse) -> DataFrame:
    monthly = w["int_subscription_mrr_by_chain_month"]
    latest = monthly.agg(F.max("activity_month")).scalar()
    return monthly.filter(F.col("activity_month") == latest)


@register
def sc16_months_since_signup(w: Warehouse) -> DataFrame:
    orders = join_hot(w["stg_orders"], w["stg_customers"].select("customer_id", "signup_date"), "customer_id")
    return orders.select(
        "order_id", calendar_months_between("order_date", "signup_date").alias("months_since_signup")
    )


@register
def sg4_zero_fill(w: Warehouse) -> DataFrame:
    return zero_fill(w["int_volume_by_period"], w["accounting_periods"])


@register
def sg4_zero_fill_latest(w: Warehouse) -> DataFrame:
    return zero_fill(w["int_volume_by_period"], w["accounting_periods"], until="latest")


@register
def wn9_next_phase_start(w: Warehouse) -> DataFrame:
    phases = w["fct_subscriptions"].select("subscription_id", "subscription_chain_id", "phase_start_date")
    return lead_date(phases, "subscription_chain_id", "phase_start_date", "subscription_id", "next_phase_start_date")


@register
def wn4_sessions_12h(w: Warehouse) -> DataFrame:
    """Sessions with a wide gap, so that most of them hold several events."""
    return events.int_sessions(w["stg_events__events"], gap_minutes=720)


@register
def ag3_session_totals_12h(w: Warehouse) -> DataFrame:
    return session_totals(w["stg_events__events"], gap_minutes=720)


@register_raw
def hx1_scd2_customers(t: TestTables) -> DataFrame:
    """Two runs: everybody as they are, then with moves, new mail, new names, losses and arrivals."""
    raw = t.customers().drop("signup_date")
    first, second = F.lit("2001-09-01 00:00:00").cast("timestamp"), F.lit("2001-09-02 00:00:00").cast("timestamp")
    key = F.col("customer_id")
    # Each customer yields the row it has in the second run (none if lost) and possibly a newcomer.
    kept = F.when(key % 13 != 0, key)
    arrived = F.when(key % 17 == 0, key + 1_000_000_000_000)
    later = raw.withColumn("_id", F.explode(F.array_compact(F.array(kept, arrived)))).select(
        F.col("_id").alias("customer_id"),
        F.when(key % 5 == 0, F.lit("Renamed")).otherwise(F.col("first_name")).alias("first_name"),
        "last_name",
        F.when(key % 7 == 0, F.concat(F.lit("new."), "email")).otherwise(F.col("email")).alias("email"),
        F.when(key % 11 == 0, F.lit("MOVED")).otherwise(F.col("region")).alias("region"),
        "country",
    )
    history = scd2_apply(start_history(raw, first), later, "customer_id", ["region", "email"], second)
    return history.withColumn("valid_from", F.col("valid_from").cast("timestamp_ntz")).withColumn(
        "valid_to", F.col("valid_to").cast("timestamp_ntz")
    )


# -- checks -----------------------------------------------------------------------------------


@register
def chk1_unique(w: Warehouse) -> DataFrame:
    return Unique("stg_order_items", ("order_id",)).failures(w)


@register
def chk2_not_null(w: Warehouse) -> DataFrame:
    return NotNull("int_events_resolved", "resolved_customer_id").failures(w).select("event_id", "anonymous_id")


@register
def chk3_accepted_values(w: Warehouse) -> DataFrame:
    return AcceptedValues("stg_billing__subscriptions", "ended_reason", ("cancelled", "paused")).failures(w)


@register
def chk4_relationships(w: Warehouse) -> DataFrame:
    return Relationships("stg_orders", "order_id", "stg_order_items", "order_id").failures(w)


@register
def chk5_accepted_range(w: Warehouse) -> DataFrame:
    # Strictly inside 0..1: rates of exactly 0 or 1 fail.
    check = AcceptedRange("mart_retention_cohorts", "retention_rate", 0, 1, inclusive=False)
    return check.failures(w).select("cohort_month", "months_since_cohort_start", "retention_rate")


def chk6_rows(w: Warehouse) -> DataFrame:
    return NotNegative("fct_payments", "net_collected_amount").failures(w).select("payment_id", "net_collected_amount")


@register
def chk6_not_negative(w: Warehouse) -> DataFrame:
    return chk6_rows(w)


@register
def chk6_fault_not_negative(w: Warehouse) -> DataFrame:
    return chk6_rows(NEGATIVE_PAYMENTS.plant(w))


@register
def chk7_not_implausibly_large(w: Warehouse) -> DataFrame:
    return NotImplausiblyLarge("fct_orders", "order_amount", 10_000).failures(w).select("order_id", "order_amount")


@register
def chk8_unique_combination(w: Warehouse) -> DataFrame:
    return Unique("stg_orders", ("customer_id", "order_date")).failures(w)


@register
def chk9_contract(w: Warehouse) -> DataFrame:
    name = "mart_cash_movements_by_period"
    return assert_contract(w[name], CONTRACTS[name])


def contract_rows(name: str) -> Query:
    return lambda spark, directory: assert_contract(warehouse(spark, directory)[name], CONTRACTS[name])


for _name in CONTRACTS:
    QUERIES[f"chk9_contract_{_name}"] = contract_rows(_name)


def _freshness(w: Warehouse) -> DataFrame:
    """All twelve sources, loaded nine hours apart before the day after next of the newest order."""
    as_of = F.date_add(w["stg_orders"].agg(F.max("order_date")).scalar(), 2).cast("timestamp")
    frames = []
    for i, (source, table) in enumerate((s, t) for s, tables in SOURCES.items() for t in tables):
        stamped = stamp_loaded_at(w[f"{source}.{table}"], as_of - F.expr(f"INTERVAL {9 * i} HOURS"))
        frames.append(freshness(stamped, f"{source}.{table}", as_of))
    return reduce(DataFrame.unionByName, frames)


@register
def chk10_freshness(w: Warehouse) -> DataFrame:
    return _freshness(w).withColumn("max_loaded_at", F.col("max_loaded_at").cast("timestamp_ntz"))


@register
def chk12_volume_anomaly(w: Warehouse) -> DataFrame:
    return w["mart_volume_anomalies"].filter("is_anomaly")


@register
def chk13_check_results(w: Warehouse) -> DataFrame:
    return all_results(w)


@register
def chk13_check_summary(w: Warehouse) -> DataFrame:
    return summarize(all_results(w))


@register
def chk14_reconcile(w: Warehouse) -> DataFrame:
    booked = w["mart_revenue_reconciliation_by_period"].select(
        "period_id", F.col("total_collected_against_bookings").alias("amount")
    )
    moved = w["mart_cash_movements_by_period"].select("period_id", F.col("total_cash_in").alias("amount"))
    return reconcile(booked, moved, "period_id", ["amount"])


@register
def chk16_check_grew(w: Warehouse) -> DataFrame:
    adjustments = w["fct_period_close_adjustments"]
    return check_grew(adjustments.filter("is_late_adjustment"), adjustments)


# -- governed metrics -------------------------------------------------------------------------

MONTH = reports.MONTH


@register
def sem5_simple_metric(w: Warehouse) -> DataFrame:
    return metric_query(registry(), w, ["mrr", "opening_mrr", "expansion_mrr"], [MONTH])


@register
def sem6_filtered_metric(w: Warehouse) -> DataFrame:
    return metric_query(registry(), w, ["signups", "activated_customers", "activation_rate"], ["customer_id__region"])


@register
def sem6_filtered_metric_alone(w: Warehouse) -> DataFrame:
    return metric_query(registry(), w, ["activated_customers"], [MONTH])


@register
def sem7_derived_metrics(w: Warehouse) -> DataFrame:
    wanted = ["arr", "churn_rate", "gross_revenue_retention", "net_revenue_retention"]
    return metric_query(registry(), w, wanted, [MONTH])


@register
def sem8_rolled_up_time(w: Warehouse) -> DataFrame:
    return metric_query(registry(), w, ["viewers", "purchasers", "view_to_purchase_rate"], [MONTH])


@register
def sem9_own_dimension(w: Warehouse) -> DataFrame:
    return metric_query(
        registry(), w, ["order_revenue", "order_amount_collected"], ["order_id__order_channel", "order_id__order_status"]
    )


@register
def sem10_joined_dimension(w: Warehouse) -> DataFrame:
    return metric_query(registry(), w, ["order_revenue"], ["customer_id__country", "metric_time__year"])


@register
def sem10_joined_distinct(w: Warehouse) -> DataFrame:
    return metric_query(registry(), w, ["active_customers"], ["customer_id__region", MONTH])


@register
def sem11_where(w: Warehouse) -> DataFrame:
    return metric_query(
        registry(),
        w,
        ["order_revenue"],
        ["order_id__order_channel"],
        where={
            "order_id__order_status": lambda c: c == "completed",
            "customer_id__country": lambda c: c != "ASIA",
        },
    )


@register
def sem12_several_models(w: Warehouse) -> DataFrame:
    return metric_query(
        registry(), w, ["net_booked_revenue", "cash_in", "active_customers", "mrr", "order_revenue"], [MONTH]
    )


@register
def sem12_shared_period(w: Warehouse) -> DataFrame:
    return metric_query(registry(), w, ["booking_variance", "net_cash_movement"], ["period_id__is_closed"])


@register
def sem13_totals(w: Warehouse) -> DataFrame:
    return metric_query(registry(), w, ["net_booked_revenue", "cash_out", "signups", "cohort_size"])


@register
def sem17_reconciliation(w: Warehouse) -> DataFrame:
    """Seven metric queries against their source tables: keys compared and cells that differ."""
    r = registry()
    revenue, cash = w["mart_revenue_reconciliation_by_period"], w["mart_cash_movements_by_period"]
    month = F.col("period_start_date").alias(MONTH)
    direct = {
        "net_booked_revenue": revenue.select(month, F.col("total_net_booked_revenue").alias("net_booked_revenue")),
        "cash_collected_against_bookings": revenue.select(
            month, F.col("total_collected_against_bookings").alias("cash_collected_against_bookings")
        ),
        "cash_in": cash.select(month, F.col("total_cash_in").alias("cash_in")),
        "cash_out": cash.select(month, F.col("total_cash_out").alias("cash_out")),
        "mrr": w["mart_mrr_movements"].select(F.col("activity_month").alias(MONTH), F.col("closing_mrr").alias("mrr")),
        "active_customers": w["int_active_customers_by_period"]
        .groupBy(month)
        .agg(F.countDistinct("customer_id").alias("active_customers")),
    }
    pairs = [(name, metric_query(r, w, [name], [MONTH]), df, MONTH, [name]) for name, df in direct.items()]
    day = "metric_time__day"
    funnel = w["mart_funnel_conversion"].select(F.col("activity_date").alias(day), "viewers", "purchasers")
    daily = metric_query(r, w, ["viewers", "purchasers"], [day])
    pairs.append(("viewers,purchasers", daily, funnel, day, ["viewers", "purchasers"]))
    return reconcile_summary(pairs)


# -- streams ----------------------------------------------------------------------------------


def _streamed(w: Warehouse, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Land the events as files, stream them through ``make`` until none is left, and read what came out."""
    events = w["stg_events__events"]
    spark = events.sparkSession
    folder = f"{scratch_root(spark)}/tallyworks/{uuid4().hex}"
    events.write.parquet(f"{folder}/events")
    stream = make(read_event_files(spark, f"{folder}/events", events.schema))
    return run_available(stream, f"{folder}/out", f"{folder}/state")


@register
def str1_events_deduplicated(w: Warehouse) -> DataFrame:
    done = _streamed(w, dedup_stream)
    return done.select("anonymous_id", "event_type", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"), "product_id")


@register
def str2_closed_sessions(w: Warehouse) -> DataFrame:
    done = _streamed(w, session_stream)
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")}
    return done.withColumns(times)


# -- report datasets --------------------------------------------------------------------------


@register
def bi1_scorecard(w: Warehouse) -> DataFrame:
    return reports.scorecard(registry(), w)


@register
def bi2_booked_revenue_trend(w: Warehouse) -> DataFrame:
    return reports.booked_revenue_trend(registry(), w)


@register
def bi3_mrr_trend(w: Warehouse) -> DataFrame:
    return reports.mrr_trend(registry(), w)


@register
def bi4_revenue_by_channel(w: Warehouse) -> DataFrame:
    return reports.revenue_by_channel(registry(), w)


@register
def bi5_top_regions(w: Warehouse) -> DataFrame:
    return reports.top_regions(registry(), w)


@register
def bi6_funnel_totals(w: Warehouse) -> DataFrame:
    return reports.funnel_totals(registry(), w)


@register
def bi7_retention_curve(w: Warehouse) -> DataFrame:
    return reports.retention_curve(registry(), w)


@register
def chk15_late_adjustments(w: Warehouse) -> DataFrame:
    return reports.late_adjustments(w)


@register
def bi8_alert(w: Warehouse) -> DataFrame:
    return reports.alert(all_results(w), w)


@register
def bi9_health(w: Warehouse) -> DataFrame:
    contracted = {name: (*contract.primary_key, *contract.not_null) for name, contract in CONTRACTS.items()}
    return reports.health(all_results(w, contracted), _freshness(w), CONTRACTS, w)
