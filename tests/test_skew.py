"""One key holding a third of all rows: right results, and no task that gets all of them."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from tests_helpers import plan_text

from tallyworks.operators.events import activation, dedup_exact, event_key, resolve_identity, session_totals, sessionize
from tallyworks.operators.periods import assign_period, make_accounting_periods
from tallyworks.operators.subscriptions import authoritative
from tallyworks.operators.windows import lead_date
from tallyworks.plans.finance import int_revenue_by_period_retail
from tallyworks.plans.retail import fct_orders, int_order_payment_summary
from tallyworks.session import rely_on_aqe

ROWS = 60_000


@pytest.fixture(scope="module")
def small_partitions(spark):
    """Thresholds scaled down to the test data, so AQE sees the hot partition as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    rely_on_aqe(spark)
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot_events(spark):
    """A third of the events from one visitor, half of those in one minute, many of them copies."""
    i = F.col("id")
    hot = i % 3 == 0
    seconds = F.when(hot & (i % 2 == 0), i % 50).when(hot, i * 37 % 4_000_000).otherwise(i * 101 % 4_000_000)
    return spark.range(0, ROWS, 1, 8).select(
        i.alias("event_id"),
        F.when(hot, "bot").otherwise(F.concat(F.lit("v"), (i % 2000).cast("string"))).alias("anonymous_id"),
        F.when(i % 11 == 0, F.when(hot, 7).otherwise(i % 2000)).cast("long").alias("customer_id"),
        F.when(i % 5 == 0, "signup").when(i % 5 == 1, "purchase").otherwise("product_view").alias("event_type"),
        (F.lit("2025-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)).alias("event_timestamp"),
        (i % 4).alias("product_id"),
        F.lit(None).cast("long").alias("order_id"),
        F.lit(None).cast("string").alias("search_query"),
    )


def plain_sessions(events):
    """The same sessions by sorting each visitor's events, fine on test data only."""
    w = Window.partitionBy("anonymous_id").orderBy("event_timestamp", "event_id")
    idle = F.col("event_timestamp") - F.lag("event_timestamp").over(w)
    starts = F.when(idle.isNull() | (idle > F.expr("interval 30 minutes")), 1).otherwise(0)
    numbered = events.withColumn("_s", starts).withColumn("_n", F.sum("_s").over(w))
    return numbered.select("event_id", F.concat_ws("_", "anonymous_id", "_n").alias("session_id"))


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_sessions_of_a_hot_visitor(small_partitions, hot_events):
    got = sessionize(hot_events).select("event_id", "session_id")
    same(got, plain_sessions(hot_events))
    assert "skew=true" in executed(got)  # the busiest slot is split over several tasks


def test_session_totals_of_a_hot_visitor(small_partitions, hot_events):
    once = dedup_exact(hot_events, event_key(), "event_id")
    sessions = plain_sessions(once).join(once.drop("customer_id"), "event_id")
    who = hot_events.groupBy("anonymous_id").agg(F.max("customer_id").alias("customer_id"))
    expected = (
        sessions.join(who, "anonymous_id")
        .groupBy("session_id", "anonymous_id", "customer_id")
        .agg(
            F.min("event_timestamp").alias("session_start"),
            F.max("event_timestamp").alias("session_end"),
            F.count("*").alias("event_count"),
            F.bool_or(F.col("event_type") == "purchase").alias("converted"),
        )
    )
    totals = session_totals(hot_events)
    same(totals, expected.select(*totals.columns))
    assert "Join" not in plan_text(totals)


def test_identity_of_a_hot_visitor(small_partitions, hot_events):
    resolved = resolve_identity(hot_events).select("event_id", "resolved_customer_id")
    w = Window.partitionBy("anonymous_id")
    same(resolved, hot_events.select("event_id", F.max("customer_id").over(w).alias("resolved_customer_id")))
    assert "skew=true" in executed(resolved)


def test_copies_reach_the_shuffle_once_per_task(hot_events):
    copies = hot_events.withColumn("event_timestamp", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")).withColumn(
        "product_id", F.lit(None).cast("long")
    )
    kept = dedup_exact(copies, event_key(), "event_id")
    assert plan_text(kept).count("WindowGroupLimit") == 2
    assert kept.count() == copies.select("anonymous_id", "event_type").distinct().count()


def test_activation_of_a_hot_customer(small_partitions, hot_events):
    resolved = resolve_identity(hot_events)
    got = activation(resolved)
    first = resolved.filter("event_type = 'signup'").groupBy("resolved_customer_id").agg(
        F.min("event_timestamp").alias("s")
    )
    bought = (
        resolved.filter("event_type = 'purchase'")
        .join(first, "resolved_customer_id")
        .filter("event_timestamp >= s")
        .groupBy("resolved_customer_id")
        .agg(F.min("event_timestamp").alias("p"))
    )
    expected = first.filter("resolved_customer_id is not null").join(bought, "resolved_customer_id", "left")
    same(got.select("customer_id", "first_signup_at", "first_purchase_at"), expected)
    assert executed(got).count("skew=true") >= 2  # finding the visitor, and the customer's signup


def test_revenue_of_a_hot_customer(small_partitions, spark):
    """Customers arrive already partitioned by their key, which must not stop the split."""
    i = F.col("id")
    orders = spark.range(0, ROWS, 1, 8).select(
        i.alias("order_id"),
        F.when(i % 3 == 0, 0).otherwise(i % 2000).alias("customer_id"),
        F.date_add(F.lit("2025-01-01").cast("date"), (i % 300).cast("int")).alias("order_date"),
        F.lit("completed").alias("order_status"),
        (i % 97).cast("decimal(18,2)").alias("order_amount"),
        (i % 89).cast("decimal(18,2)").alias("amount_collected"),
    )
    customers = orders.groupBy("customer_id").agg(F.concat(F.lit("R"), F.max(i_mod("order_id"))).alias("region"))
    rates = spark.sql("select 'R1' as region, cast(0.05 as decimal(6,4)) as tax_rate")
    bounds = spark.sql("select date'2025-01-01' as first_month, date'2025-12-01' as last_month")
    got = int_revenue_by_period_retail(orders, customers, rates, make_accounting_periods(bounds))
    assert got.count() == ROWS
    assert "skew=true" in executed(got)


def i_mod(column, n=5):
    return F.col(column) % n


def test_hot_order_is_one_row_at_the_join(small_partitions, spark):
    i = F.col("id")
    order = F.when(i % 3 == 0, 0).otherwise(i % 500)
    items = spark.range(0, ROWS, 1, 8).select(
        i.alias("order_item_id"),
        order.alias("order_id"),
        F.lit(1).cast("long").alias("quantity"),
        F.lit("1.00").cast("decimal(18,2)").alias("line_amount"),
    )
    payments = items.select(
        F.col("order_item_id").alias("payment_id"),
        "order_id",
        F.lit("2025-01-01").cast("date").alias("payment_date"),
        F.lit("succeeded").alias("payment_status"),
        F.col("line_amount").alias("amount"),
    )
    orders = spark.range(500).select(
        i.alias("order_id"),
        i.alias("customer_id"),
        F.lit("2025-01-01").cast("date").alias("order_date"),
        F.lit("completed").alias("order_status"),
        F.lit("web").alias("order_channel"),
    )
    facts = fct_orders(orders, items, int_order_payment_summary(payments))
    hot = facts.filter("order_id = 0").first()
    assert hot.item_quantity == items.filter("order_id = 0").count() == hot.payment_attempt_count
    assert hot.order_amount == hot.amount_collected and facts.count() == 500
    plan = plan_text(facts)
    # every exchange below the joins carries partial aggregates, or the orders themselves
    assert plan.count("partial_sum") >= 2 and plan.count("Exchange hashpartitioning(order_id") <= 3


def test_hot_day_needs_no_shuffle(small_partitions, spark):
    bounds = spark.sql("select date'2025-01-01' as first_month, date'2025-12-01' as last_month")
    facts = spark.range(0, ROWS, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("2025-03-01")).otherwise(F.lit("2025-04-02")).cast("date").alias("day")
    )
    placed = assign_period(facts, "day", make_accounting_periods(bounds))
    assert placed.groupBy("period_id").count().collect().__len__() == 2
    assert "Exchange hashpartitioning" not in plan_text(placed)


def test_hot_chain(small_partitions, spark):
    i = F.col("id")
    phases = spark.range(0, ROWS, 1, 8).select(
        i.alias("subscription_id"),
        F.when(i % 3 == 0, 0).otherwise(i % 4000).alias("chain"),
        F.date_add(F.lit("2020-01-01").cast("date"), (i * 13 % 1500).cast("int")).alias("start"),
    )
    w = Window.partitionBy("chain").orderBy("start", "subscription_id")
    same(
        lead_date(phases, "chain", "start", "subscription_id", "next"),
        phases.withColumn("next", F.lead("start").over(w)).select("chain", "start", "subscription_id", "next"),
    )
    monthly = phases.withColumn("month", F.trunc("start", "MM"))
    newest = authoritative(monthly, ["chain", "month"], ["start", "subscription_id"])
    assert plan_text(newest).count("WindowGroupLimit") == 2
    assert newest.count() == monthly.select("chain", "month").distinct().count()


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from tallyworks.plans.staging import stg_orders

    path = str(tmp_path / "orders")
    spark.sql(
        "select 1L as order_id, 1L as customer_id, date'2025-01-01' as order_date, 'completed' as status, 'web' as channel"
    ).write.parquet(path)
    staged = stg_orders(spark.read.parquet(path)).filter("order_status = 'completed'").select("order_id")
    plan = plan_text(staged)
    assert "EqualTo(status,completed)" in plan
    assert "ReadSchema: struct<order_id:bigint,status:string>" in plan
