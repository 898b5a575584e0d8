"""What a query makes several tables from is computed once, and exploded months are not broadcast."""

import re

import pytest
from pyspark.sql import functions as F
from tests_helpers import plan_text, rows

from tallyworks.operators.checks import Unique, run_checks
from tallyworks.plans import reports
from tallyworks.plans.billing import int_subscription_mrr_by_chain_month
from tallyworks.plans.governed import registry
from tallyworks.queries import warehouse

SMALL = "/root/testdata/sf0.001"


def scans(df, columns):
    """How often the plan, with its subqueries, reads a table of exactly these columns."""
    text = df._jdf.queryExecution().optimizedPlan().toString()
    return len(re.findall(r"Relation \[" + ",".join(rf"{c}#\d+L?" for c in columns) + r"\]", text))


@pytest.fixture(scope="module")
def scorecard(spark):
    return warehouse(spark, SMALL, "bi1_scorecard")


@pytest.mark.parametrize("model", ["stg_order_items", "stg_payments"])
def test_item_lines_are_computed_once(scorecard, model):
    assert "lineitem.parquet" not in plan_text(scorecard[model])


@pytest.mark.parametrize("model", ["stg_billing__invoices", "stg_billing__invoice_lines", "stg_billing__payments", "stg_billing__refunds"])
def test_billing_runs_are_computed_once(spark, scorecard, model):
    plain = warehouse(spark, SMALL)
    assert "Window" in plan_text(plain[model]) and "Window" not in plan_text(scorecard[model])
    assert rows(scorecard[model]) == rows(plain[model])


def test_scorecard_counts_active_customers_once(scorecard):
    card = reports.scorecard(registry(), scorecard)
    assert scans(card, ["period_id", "customer_id", "period_start_date"]) == 1


def test_active_customers_of_another_month(spark, scorecard):
    """The closed month of the card has no active customers: those of their own newest month are shown."""
    active = scorecard["int_active_customers_by_period"]
    tables = {n: scorecard[n] for n in ("mart_revenue_reconciliation_by_period", "mart_mrr_movements", "mart_retention_cohorts")}
    early = active.filter("period_id <= 3")
    tables["int_active_customers_by_period"] = early
    card = reports.scorecard(registry(), tables).first()
    assert card.active_customers == early.filter("period_id = 3").select("customer_id").distinct().count()
    tables["int_active_customers_by_period"] = active.filter("false")
    assert reports.scorecard(registry(), tables).first().active_customers is None


def test_exploded_months_are_not_broadcast(spark):
    spine = spark.range(10).select(
        F.col("id").alias("subscription_chain_id"), F.lit(1).alias("customer_id"), F.explode(F.expr("sequence(date'2025-01-01', date'2025-06-01', interval 1 month)")).alias("activity_month")
    )
    active = spine.select(
        "subscription_chain_id", "activity_month", F.lit(1).alias("plan_id"), F.lit(2).cast("decimal(18,2)").alias("mrr_amount"),
        F.col("activity_month").alias("phase_start_date"), F.col("subscription_chain_id").alias("subscription_id"),
    )
    plan = plan_text(int_subscription_mrr_by_chain_month(spine, active))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_key_of_a_held_table_is_counted_once(spark):
    mart = spark.createDataFrame([(1, 5), (1, 6), (2, 6), (None, 7)], "id long, mart_id long")
    tables = {"mart": mart, "held": mart.withColumnRenamed("mart_id", "held_id")}
    checks = [Unique("mart", ("id",)), Unique("held", ("id",)), Unique("held", ("held_id",))]
    held = {"held": ("mart", {"mart_id": "held_id"})}
    got = run_checks(tables, checks, held=held)
    assert rows(got, "check", "table", "failing_rows") == sorted((c.name, c.table, 1) for c in checks)
    assert rows(got) == rows(run_checks(tables, checks))
    assert plan_text(run_checks(tables, checks, held=held)).count("Scan ExistingRDD[id") == 2
    assert plan_text(run_checks(tables, checks)).count("Scan ExistingRDD[id") == 3
