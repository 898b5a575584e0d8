import billing_fixture as fx
import pytest
from pyspark.sql import functions as F
from tests_helpers import d, dec, rows

from tallyworks.operators.periods import make_accounting_periods
from tallyworks.operators.subscriptions import MOVEMENTS
from tallyworks.plans.warehouse import Warehouse


@pytest.fixture(scope="module")
def w(spark):
    bounds = spark.sql("select date'2024-01-01' as first_month, date'2025-12-01' as last_month")
    customers = spark.range(1, 11).select(
        F.col("id").alias("customer_id"),
        F.lit("A").alias("first_name"),
        F.lit("B").alias("last_name"),
        F.lit("X@Y.com").alias("email"),
        F.lit(d("2024-01-01")).alias("signup_date"),
        F.when(F.col("id") == 10, "Nowhere").otherwise("Somewhere").alias("region"),
        F.lit("C").alias("country"),
    )
    return Warehouse(
        {
            "raw.customers": customers,
            "raw_billing.plans": spark.createDataFrame(fx.plans(), fx.PLANS),
            "raw_billing.subscriptions": spark.createDataFrame(fx.phases(), fx.SUBSCRIPTIONS),
            "raw_billing.invoices": spark.createDataFrame(fx.invoices(), fx.INVOICES),
            "raw_billing.invoice_lines": spark.createDataFrame(fx.lines(), fx.LINES),
            "raw_billing.payments": spark.createDataFrame(fx.payments(), fx.PAYMENTS),
            "raw_billing.refunds": spark.createDataFrame(fx.refunds(), fx.REFUNDS),
            "accounting_periods": make_accounting_periods(bounds),
            "tax_rates": spark.sql("select 'Somewhere' as region, cast(0.1 as decimal(6,4)) as tax_rate"),
        }
    )


@pytest.fixture(scope="module")
def moves(w):
    """Non-zero movements per customer: {(customer, month): (kind, amount)}."""
    found = {}
    for r in w["int_subscription_mrr_movements"].collect():
        hits = [(name, r[name]) for name in MOVEMENTS if r[name] != 0]
        assert len(hits) <= 1, "at most one movement per chain and month"
        if hits:
            found[(r.customer_id, r.activity_month)] = hits[0]
    return found


def of(moves, customer):
    return {str(month)[:7]: hit for (c, month), hit in moves.items() if c == customer}


@pytest.mark.parametrize(
    ("customer", "expected"),
    [
        (1, {"2025-01": ("new_mrr", "9.99")}),
        (2, {"2025-02": ("new_mrr", "16.58")}),
        # trial and paid phase touch the same month: the later one wins, once
        (3, {"2025-03": ("new_mrr", "9.99")}),
        (4, {"2025-01": ("new_mrr", "9.99"), "2025-06": ("expansion_mrr", "10.00")}),
        (5, {"2025-01": ("new_mrr", "19.99"), "2025-07": ("contraction_mrr", "10.00")}),
        (6, {"2025-01": ("new_mrr", "9.99"), "2025-04": ("churned_mrr", "9.99")}),
        (
            7,
            {
                "2025-01": ("new_mrr", "9.99"),
                "2025-03": ("churned_mrr", "9.99"),
                "2025-08": ("reactivation_mrr", "9.99"),
            },
        ),
        (
            8,
            {
                "2025-01": ("new_mrr", "19.99"),
                "2025-05": ("churned_mrr", "19.99"),
                "2025-09": ("reactivation_mrr", "19.99"),
            },
        ),
        (9, {"2024-06": ("new_mrr", "8.25")}),
    ],
)
def test_movements_of_named_customers(moves, customer, expected):
    # the series ends with the last billed day: open phases stop there, which is no churn
    got = {m: h for m, h in of(moves, customer).items() if m < "2026-05"}
    assert got == {m: (kind, dec(a)) for m, (kind, a) in expected.items()}


def test_bridge_closes_and_opening_zero_has_no_retention(w):
    bridge = w["mart_mrr_movements"].orderBy("activity_month").collect()
    assert all(r.closing_mrr == r.computed_closing_mrr for r in bridge)
    first = bridge[0]
    assert first.opening_mrr == 0 and first.gross_revenue_retention is None and first.net_revenue_retention is None
    june = next(r for r in bridge if r.activity_month == d("2025-06-01"))
    assert june.expansion_mrr == dec("10.00") and june.net_revenue_retention > june.gross_revenue_retention


def test_invoice_status(w):
    status = {r.invoice_id: r for r in w["fct_invoices"].collect()}
    retried = status[2]
    assert (retried.payment_attempt_count, retried.has_failed_attempt, retried.has_succeeded_payment) == (2, True, True)
    assert retried.outstanding_balance == 0
    assert status[3].refunded_amount == dec("9.99") and status[3].outstanding_balance == dec("9.99")
    assert status[4].outstanding_balance == dec("9.99")  # the refunded half is open again
    assert status[5].outstanding_balance == dec("49.50")
    failed_only = status[8]
    assert failed_only.net_collected_amount == 0 and failed_only.refunded_amount == 0
    assert failed_only.outstanding_balance == dec("19.99")
    never_paid = status[6]
    assert never_paid.payment_attempt_count == 0 and never_paid.has_succeeded_payment is False
    assert never_paid.last_payment_date is None


def test_late_adjustment(w):
    late = {r.refund_id: r for r in w["fct_period_close_adjustments"].collect()}
    first = late[1]
    # January 2025 is the 13th period of a calendar that starts in January 2024
    assert (first.original_period_id, first.adjustment_period_id) == (13, 14)
    assert first.is_late_adjustment and first.days_after_close == 10
    assert not late[4].is_late_adjustment and late[4].days_after_close is None


def test_booking_and_cash_dates_differ(w):
    revenue = {r.invoice_id: r for r in w["int_revenue_by_period_billing"].collect()}
    cash = {r.period_id: r for r in w["int_cash_movements_billing"].collect()}
    assert revenue[3].period_id == 13 and revenue[3].refunded_amount_against_bookings == dec("9.99")
    # February: refund 1 (9.99), the mistaken refund (1.00) and refund 4 (1.00)
    assert cash[14].cash_out == dec("11.99")
    assert revenue[9].period_id == 15 and cash[16].cash_in == dec("19.99")  # paid 45 days late
    assert 26 not in cash
    assert revenue[1].tax_amount == dec("1.00") and revenue[9].tax_amount == 0  # region without a rate


def test_invoice_lines_add_up(w):
    from tallyworks.plans.named_checks import invoice_lines_reconcile_to_invoice_amount as check

    assert check(w).count() == 0


def test_customer_metrics_and_value(w):
    metrics = {r.customer_id: r for r in w["mart_customer_metrics"].collect()}
    assert metrics[6].is_currently_active is False and metrics[7].is_currently_active is True
    assert metrics[9].tenure_months == 23  # 2024-06 to the last billed month 2026-05
    assert metrics[2].lifetime_invoiced_amount == 0
    assert metrics[9].lifetime_collected_amount == dec("49.50")
    (value,) = w["mart_customer_lifetime_value"].collect()
    assert value.as_of_month == d("2026-05-01") and value.estimated_clv > 0


def test_cohort_rows_exist_with_nobody_paying(w):
    cohorts = w["mart_retention_cohorts"]
    january = {r.months_since_cohort_start: r for r in cohorts.filter("cohort_month = '2025-01-01'").collect()}
    assert january[0].cohort_size == 7 and january[0].active_chain_count == 7
    assert january[3].active_chain_count == 5  # two of them have stopped by April
    assert january[3].retention_rate == dec("0.7143")
    assert rows(cohorts.filter("cohort_month = '2024-06-01' and months_since_cohort_start = 0"), "retention_rate") == [
        (dec("1.0000"),)
    ]


def test_phase_of_no_length_has_no_month(spark):
    from tallyworks.operators.spine import explode_months

    phases = spark.createDataFrame(
        [(1, d("2025-03-01"), d("2025-03-01")), (2, d("2025-03-01"), d("2025-04-01")), (3, d("2025-05-10"), None)],
        "id long, start date, stop date",
    )
    months = explode_months(phases, ["id"], "start", "stop", F.lit(d("2025-06-01")), "month")
    assert rows(months) == [(2, d("2025-03-01")), (3, d("2025-05-01"))]
