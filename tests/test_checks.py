"""Every kind of corruption must be caught by the check that is there for it."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from tests_helpers import dec

from tallyworks.operators.checks import check_grew, run_checks, summarize
from tallyworks.operators.contracts import ContractViolation, assert_contract, freshness, schema_drift, table_columns
from tallyworks.plans import reports
from tallyworks.plans.checkbook import generic_checks, named_checks
from tallyworks.plans.named_checks import NAMED_CHECKS
from tallyworks.plans.warehouse import CONTRACTS, MARTS, SHARED, Warehouse, build, open_warehouse
from tallyworks.sources.testdata import TestTables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sources(spark):
    return TestTables(spark, SMALL).makers()


def corrupted(sources, name, change):
    changed = dict(sources)
    changed[name] = lambda: change(sources[name]())
    return Warehouse(changed)


def failing(warehouse, *tables):
    """Names of failing declared checks on the given tables."""
    wanted = [c for c in generic_checks() if c.table in tables]
    return {r["check"] for r in run_checks(warehouse, wanted).filter("status = 'fail'").collect()}


def test_number_of_declared_checks():
    assert len(generic_checks()) == 182 and len(NAMED_CHECKS) == 17
    assert len({c.name for c in generic_checks()}) == 182


def test_build_and_all_checks(spark, sources, tmp_path_factory):
    """A full build, then all 199 checks on what it wrote."""
    root = str(tmp_path_factory.mktemp("warehouse"))
    built = build(Warehouse(sources), root)
    again = open_warehouse(spark, root, sources)
    assert {n: again[n].count() for n in MARTS if n != "dim_date"} == {
        n: built[n].count() for n in MARTS if n != "dim_date"
    }
    results = {r["check"]: r for r in run_checks(again, generic_checks()).collect()}
    assert len(results) == 182
    # the test data breaks exactly these: its orders are dearer than the ceiling allows
    assert {n for n, r in results.items() if r.status == "fail"} == {"not_implausibly_large_fct_orders_order_amount"}
    tables, checks = named_checks(again)
    named = run_checks(tables, checks)
    failed = {r["check"] for r in named.filter("status = 'fail'").collect()}
    # these three look for scenarios of particular customers and refunds, or for volume drops
    assert failed <= {
        "assert_no_volume_anomaly",
        "assert_scenario_14_produces_two_sessions",
        "assert_late_refund_lands_in_its_own_cash_period",
    }
    assert {r.status: r.checks for r in summarize(named).collect()}["pass"] >= 14
    assert set(SHARED) <= set(again)


def test_dropped_column(sources):
    w = corrupted(sources, "raw.orders", lambda df: df.drop("status"))
    live = {"orders": w["raw.orders"]}
    expected = {"orders": sources["raw.orders"]()}
    spark = live["orders"].sparkSession
    drift = schema_drift(table_columns(spark, expected), table_columns(spark, live)).collect()
    assert [(r.finding, r.column_name) for r in drift] == [("MISSING COLUMN", "status")]
    with pytest.raises(AnalysisException):
        w["stg_orders"]


def test_changed_type(sources):
    w = corrupted(
        sources, "raw.orders", lambda df: df.withColumn("customer_id", F.concat(F.lit("C"), F.col("customer_id")))
    )
    with pytest.raises(ContractViolation, match="customer_id is string"):
        assert_contract(w["fct_orders"], CONTRACTS["fct_orders"])
    try:
        found = failing(w, "stg_orders")
    except Exception as error:  # comparing text with a number may be refused outright
        assert "CAST_INVALID_INPUT" in str(error)
    else:
        assert "relationships_stg_orders_customer_id__stg_customers_customer_id" in found


def test_bad_status(sources):
    w = corrupted(
        sources,
        "raw.orders",
        lambda df: df.withColumn("status", F.when(F.col("order_id") == 5, "unknown").otherwise(F.col("status"))),
    )
    assert failing(w, "stg_orders") == {"accepted_values_stg_orders_order_status"}


def test_duplicate_key(sources):
    w = corrupted(sources, "raw.orders", lambda df: df.unionByName(df.filter("order_id = 5")))
    assert failing(w, "stg_orders") == {"unique_stg_orders_order_id"}


def test_orphan_key(sources):
    w = corrupted(
        sources,
        "raw.order_items",
        lambda df: df.withColumn(
            "order_id", F.when(F.col("product_id") == 7, 10**12).otherwise(F.col("order_id")).cast("long")
        ),
    )
    assert failing(w, "stg_order_items") == {"relationships_stg_order_items_order_id__stg_orders_order_id"}


def test_missing_key(sources):
    w = corrupted(
        sources,
        "raw.payments",
        lambda df: df.withColumn("order_id", F.when(F.col("payment_id") % 2 == 0, F.col("order_id"))),
    )
    assert failing(w, "stg_payments") == {"not_null_stg_payments_order_id"}  # NULL is no orphan


def test_volume_drop(sources):
    def thin(df):
        month = F.trunc("order_date", "MM") == F.lit("1998-06-01").cast("date")
        return df.filter(~month | (F.dayofmonth("order_date") <= 3))

    def flagged(w):
        odd = NAMED_CHECKS["assert_no_volume_anomaly"](w).filter("source_name = 'orders'")
        return {str(r.period_start_date) for r in odd.collect()}

    assert flagged(corrupted(sources, "raw.orders", thin)) - flagged(Warehouse(sources)) == {"1998-06-01"}


def test_implausible_order(sources):
    def spike(df):
        return df.withColumn(
            "unit_price", F.when(F.col("order_item_id") == df_first, 5_000_000).otherwise(1).cast("decimal(18,2)")
        )

    df_first = sources["raw.order_items"]().agg(F.min("order_item_id")).first()[0]
    w = corrupted(sources, "raw.order_items", spike)
    check = next(c for c in generic_checks() if c.name == "not_implausibly_large_fct_orders_order_amount")
    (row,) = check.failures(w).collect()
    assert row.order_amount > dec("1000000")


def test_stale_source(sources):
    now = F.lit("2025-01-11 00:00:00").cast("timestamp")
    stale = sources["raw.orders"]().withColumn("_loaded_at", F.lit("2025-01-01 00:00:00").cast("timestamp"))
    assert freshness(stale, "orders", now).first().status == "error"


def test_late_refund_is_informational(sources):
    before = Warehouse(sources)["fct_period_close_adjustments"].filter("is_late_adjustment")

    def later(df):
        return df.withColumn("refund_date", F.date_add("refund_date", 60))

    w = corrupted(sources, "raw_billing.refunds", later)
    after = w["fct_period_close_adjustments"].filter("is_late_adjustment")
    assert check_grew(before, after).first().grew
    assert failing(w, "stg_billing__refunds", "int_period_close_adjustments", "fct_period_close_adjustments") == set()
    assert reports.late_adjustments(w).count() == after.count()


@pytest.mark.parametrize(
    ("check", "source", "change"),
    [
        (
            "assert_accounting_periods_no_gaps_or_overlaps",
            "accounting_periods",
            lambda df: df.filter("period_id <> 12"),
        ),
        (
            "assert_anonymous_id_maps_to_at_most_one_customer",
            "raw_events.events",
            lambda df: df.withColumn("customer_id", F.col("event_id").cast("double")),
        ),
        (
            "assert_invoice_lines_reconcile_to_invoice_amount",
            "raw_billing.invoice_lines",
            lambda df: df.withColumn("amount", F.col("amount") + 1),
        ),
        ("assert_late_adjustment_scenario_exists", "raw_billing.refunds", lambda df: df.limit(0)),
        (
            "assert_subscription_phases_do_not_overlap",
            "raw_billing.subscriptions",
            lambda df: df.withColumn("phase_end_date", F.date_add("phase_end_date", 40)),
        ),
        (
            "assert_late_refund_lands_in_its_own_cash_period",
            "raw_billing.refunds",
            lambda df: df.limit(0),
        ),
    ],
)
def test_named_checks_fail_when_they_should(sources, check, source, change):
    assert NAMED_CHECKS[check](corrupted(sources, source, change)).count() > 0


def test_all_checks_are_run():
    """The names are written down here, apart from the code that declares the checks."""
    from pathlib import Path

    from tallyworks.plans.checkbook import generic_checks
    from tallyworks.plans.named_checks import NAMED_CHECKS

    expected = Path(__file__).with_name("check_names.txt").read_text().split()
    assert len(expected) == 199
    assert sorted([c.name for c in generic_checks()] + list(NAMED_CHECKS)) == expected
