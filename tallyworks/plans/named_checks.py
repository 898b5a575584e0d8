"""The hand-written checks. Each returns the offending rows; empty means pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.functions.columns import money, sum_money, zero_money
from tallyworks.operators.checks import Unique
from tallyworks.operators.joins import join_hot
from tallyworks.operators.periods import assign_period
from tallyworks.operators.subscriptions import monthly_price
from tallyworks.operators.windows import lead_date

Tables = Mapping[str, DataFrame]


def periods_have_no_gaps_or_overlaps(t: Tables) -> DataFrame:
    # one row per period: the only window without a partition key, bounded by the calendar
    following = F.lead("period_start_date").over(Window.orderBy("period_start_date"))
    return (
        t["accounting_periods"]
        .select("period_id", "period_end_date", following.alias("next_period_start_date"))
        .filter(F.col("next_period_start_date") != F.date_add("period_end_date", 1))
    )


def activation_purchase_not_before_signup(t: Tables) -> DataFrame:
    return (
        t["mart_activation"]
        .filter(F.col("first_purchase_at") < F.col("first_signup_at"))
        .select("customer_id", "first_signup_at", "first_purchase_at")
    )


def annual_plans_normalize_to_monthly_mrr(t: Tables) -> DataFrame:
    plans = t["dim_plans"].filter(F.col("billing_interval") == "annual").select("plan_id", "list_price")
    expected = monthly_price(F.col("list_price"), F.lit("annual"))
    return (
        t["fct_subscriptions"]
        .filter(~F.col("is_trial"))
        .join(plans, "plan_id")
        .select("subscription_id", "mrr_amount", expected.alias("expected_mrr_amount"))
        .filter(F.col("mrr_amount") != F.col("expected_mrr_amount"))
    )


def anonymous_id_maps_to_at_most_one_customer(t: Tables) -> DataFrame:
    return (
        t["stg_events__events"]
        .filter(F.col("customer_id").isNotNull())
        .groupBy("anonymous_id")
        .agg(F.countDistinct("customer_id").alias("distinct_customer_count"))
        .filter(F.col("distinct_customer_count") > 1)
    )


def _recomputed(df: DataFrame, date_col: str, amount: str, periods: DataFrame, name: str) -> DataFrame:
    return assign_period(df, date_col, periods).groupBy("period_id").agg(sum_money(amount).alias(name))


def _recomputed_totals(t: Tables, parts: list[DataFrame], totals: dict[str, list[str]]) -> DataFrame:
    out = t["dim_accounting_periods"].select("period_id")
    for part in parts:
        out = out.join(part, "period_id", "left")
    sums = []
    for name, columns in totals.items():
        filled = [F.coalesce(F.col(c), zero_money()) for c in columns]
        sums.append(money(sum(filled[1:], filled[0])).alias(name))
    return out.select("period_id", *sums)


def cash_movements_match_source_facts(t: Tables) -> DataFrame:
    """Cash totals computed a second way, from filtered facts instead of conditional sums."""
    periods = t["dim_accounting_periods"]
    retail, billing = t["stg_payments"], t["stg_billing__payments"]
    status = F.col("payment_status")
    parts = [
        _recomputed(retail.filter(status.isin("succeeded", "refunded")), "payment_date", "amount", periods, "_ri"),
        _recomputed(retail.filter(status == "refunded"), "payment_date", "amount", periods, "_ro"),
        _recomputed(billing.filter(status == "succeeded"), "payment_date", "payment_amount", periods, "_bi"),
        _recomputed(t["stg_billing__refunds"], "refund_date", "refund_amount", periods, "_bo"),
    ]
    again = _recomputed_totals(
        t,
        parts,
        {"recomputed_total_cash_in": ["_ri", "_bi"], "recomputed_total_cash_out": ["_ro", "_bo"]},
    )
    return (
        t["mart_cash_movements_by_period"]
        .join(again, "period_id")
        .select(
            "period_id",
            "total_cash_in",
            "recomputed_total_cash_in",
            "total_cash_out",
            "recomputed_total_cash_out",
        )
        .filter(
            (F.col("total_cash_in") != F.col("recomputed_total_cash_in"))
            | (F.col("total_cash_out") != F.col("recomputed_total_cash_out"))
        )
    )


def days_after_close_consistent_with_late_flag(t: Tables) -> DataFrame:
    late, days = F.col("is_late_adjustment"), F.col("days_after_close")
    wrong = (late & (days.isNull() | (days <= 0))) | (~late & days.isNotNull())
    return (
        t["fct_period_close_adjustments"].filter(wrong).select("refund_id", "is_late_adjustment", "days_after_close")
    )


def invoice_lines_reconcile_to_invoice_amount(t: Tables) -> DataFrame:
    lines = t["stg_billing__invoice_lines"].groupBy("invoice_id").agg(sum_money("line_amount").alias("line_total"))
    return (
        t["stg_billing__invoices"]
        .join(lines, "invoice_id")
        .select("invoice_id", "invoice_amount", "line_total")
        .filter(F.col("invoice_amount") != F.col("line_total"))
    )


def late_adjustment_scenario_exists(t: Tables) -> DataFrame:
    late = t["fct_period_close_adjustments"].filter("is_late_adjustment")
    return late.agg(F.count("*").alias("late_adjustment_count")).filter(F.col("late_adjustment_count") == 0)


def late_refund_lands_in_its_own_cash_period(t: Tables, refund_ids: Sequence[int] | None = None) -> DataFrame:
    """Late refunds that the period they were paid in does not show as cash out.

    Anchored on what is expected: the given refunds, or at least one late refund. What is missing is a
    failing row, so tables without refunds do not pass.
    """
    found = t["fct_period_close_adjustments"].select("refund_id", "adjustment_period_id", "refund_amount", "is_late_adjustment")
    if refund_ids is None:
        late = found.filter("is_late_adjustment").drop("is_late_adjustment")
        none = late.agg(F.count("*").alias("_n")).filter(F.col("_n") == 0)
        expected = late.unionByName(none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in late.schema.fields]))
    else:
        named = found.sparkSession.createDataFrame([(i,) for i in refund_ids], "refund_id long")
        expected = named.join(found.drop("is_late_adjustment"), "refund_id", "left")
    paid = assign_period(t["stg_billing__refunds"].select("refund_id", "refund_date"), "refund_date", t["accounting_periods"])
    paid = paid.select("refund_id", F.col("period_id").alias("_paid_in"))
    cash = t["mart_cash_movements_by_period"].select(F.col("period_id").alias("adjustment_period_id"), "billing_cash_out")
    checked = expected.join(paid, "refund_id", "left").join(cash, "adjustment_period_id", "left")
    lands = (F.col("_paid_in") == F.col("adjustment_period_id")) & (F.col("billing_cash_out") >= F.col("refund_amount"))
    return checked.filter(~F.coalesce(lands, F.lit(False))).select("refund_id", "adjustment_period_id", "refund_amount", "billing_cash_out")


def mrr_bridge_reconciles(t: Tables) -> DataFrame:
    return t["mart_mrr_movements"].filter(F.col("closing_mrr") != F.col("computed_closing_mrr"))


def no_duplicate_events_remain(t: Tables) -> DataFrame:
    keyed = t["fct_events"].withColumn("product_id_key", F.coalesce("product_id", F.lit(-1)))
    key = ("anonymous_id", "event_type", "event_timestamp", "product_id_key")
    return Unique("events", key).failures({"events": keyed}).withColumnRenamed("n_records", "row_count")


def no_negative_total_revenue(t: Tables) -> DataFrame:
    completed = t["fct_orders"].filter(F.col("order_status") == "completed")
    return completed.agg(sum_money("order_amount").alias("total_revenue")).filter(F.col("total_revenue") < 0)


def no_volume_anomaly(t: Tables) -> DataFrame:
    return (
        t["mart_volume_anomalies"]
        .filter("is_anomaly")
        .select(
            "source_name",
            "period_id",
            "period_start_date",
            "row_count",
            "trailing_avg_row_count",
            "pct_change_vs_trailing_avg",
        )
    )


def reconciliation_matches_source_facts(t: Tables) -> DataFrame:
    periods = t["dim_accounting_periods"]
    completed = t["fct_orders"].filter(F.col("order_status") == "completed")
    parts = [
        _recomputed(completed, "order_date", "order_amount", periods, "_retail"),
        _recomputed(t["fct_invoices"], "invoice_date", "invoice_amount", periods, "_billing"),
    ]
    again = _recomputed_totals(t, parts, {"recomputed_total_net_booked_revenue": ["_retail", "_billing"]})
    return (
        t["mart_revenue_reconciliation_by_period"]
        .join(again, "period_id")
        .select("period_id", "total_net_booked_revenue", "recomputed_total_net_booked_revenue")
        .filter(F.col("total_net_booked_revenue") != F.col("recomputed_total_net_booked_revenue"))
    )


def refunded_retail_payments_net_to_zero(t: Tables) -> DataFrame:
    refunded = _recomputed(
        t["stg_payments"].filter(F.col("payment_status") == "refunded"),
        "payment_date",
        "amount",
        t["accounting_periods"],
        "refunded_amount",
    )
    return (
        refunded.join(t["mart_cash_movements_by_period"], "period_id")
        .select("period_id", "refunded_amount", "retail_cash_in", "retail_cash_out")
        .filter(
            (F.col("retail_cash_in") < F.col("refunded_amount"))
            | (F.col("retail_cash_out") != F.col("refunded_amount"))
        )
    )


def scenario_produces_two_sessions(t: Tables, customer_id: int = 14, sessions: int = 2) -> DataFrame:
    return (
        t["fct_events"]
        .filter(F.col("customer_id") == customer_id)
        .groupBy("customer_id")
        .agg(F.countDistinct("session_id").alias("session_count"))
        .filter(F.col("session_count") != sessions)
    )


def subscription_phases_do_not_overlap(t: Tables) -> DataFrame:
    phases = t["fct_subscriptions"].select(
        "subscription_id", "subscription_chain_id", "phase_start_date", "phase_end_date"
    )
    following = lead_date(
        phases, "subscription_chain_id", "phase_start_date", "subscription_id", "next_phase_start_date"
    )
    return following.filter(F.col("phase_end_date") > F.col("next_phase_start_date"))


NAMED_CHECKS: dict[str, Callable[[Tables], DataFrame]] = {
    "assert_accounting_periods_no_gaps_or_overlaps": periods_have_no_gaps_or_overlaps,
    "assert_activation_purchase_not_before_signup": activation_purchase_not_before_signup,
    "assert_annual_plans_normalize_to_monthly_mrr": annual_plans_normalize_to_monthly_mrr,
    "assert_anonymous_id_maps_to_at_most_one_customer": anonymous_id_maps_to_at_most_one_customer,
    "assert_cash_movements_match_source_facts": cash_movements_match_source_facts,
    "assert_days_after_close_consistent_with_late_flag": days_after_close_consistent_with_late_flag,
    "assert_invoice_lines_reconcile_to_invoice_amount": invoice_lines_reconcile_to_invoice_amount,
    "assert_late_adjustment_scenario_exists": late_adjustment_scenario_exists,
    "assert_late_refund_lands_in_its_own_cash_period": late_refund_lands_in_its_own_cash_period,
    "assert_mrr_bridge_reconciles": mrr_bridge_reconciles,
    "assert_no_duplicate_events_remain": no_duplicate_events_remain,
    "assert_no_negative_total_revenue": no_negative_total_revenue,
    "assert_no_volume_anomaly": no_volume_anomaly,
    "assert_reconciliation_matches_source_facts": reconciliation_matches_source_facts,
    "assert_refunded_retail_payments_net_to_zero": refunded_retail_payments_net_to_zero,
    "assert_scenario_14_produces_two_sessions": scenario_produces_two_sessions,
    "assert_subscription_phases_do_not_overlap": subscription_phases_do_not_overlap,
}
