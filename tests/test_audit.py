"""All checks at once: the same counts as check by check, from few and narrow tables."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tests_helpers import plan_text, rows

from tallyworks.functions.columns import cents, money
from tallyworks.operators.checks import NotNull, Relationships, RowsExpectedEmpty, Unique, count_checks, count_table, run_checks
from tallyworks.plans import audit
from tallyworks.plans.checkbook import generic_checks, named_checks
from tallyworks.plans.warehouse import MODELS, Warehouse
from tallyworks.session import DROP_SHUFFLES, checkpoint_dir, settings
from tallyworks.sources.tables import with_columns_of, write_scratch_counted
from tallyworks.sources.testdata import TestTables

SMALL = "/root/testdata/sf0.001"


def local(path):
    from pathlib import Path

    return Path(str(path).removeprefix("file:"))


@pytest.fixture
def small(spark):
    return {
        "parent": spark.createDataFrame([(1, "a"), (2, "b"), (2, None), (None, "a")], "id long, name string"),
        "child": spark.createDataFrame([(1, 1)] * 5 + [(2, 9), (3, 9), (4, None), (5, 8)], "n long, id long"),
        "pairs": spark.createDataFrame([(1, None), (1, None), (2, 1), (2, 2), (None, None)], "a long, b long"),
    }


def test_counts_are_those_of_the_single_plan(small):
    checks = [
        Unique("parent", ("id",)), Unique("parent", ("name",)), Unique("pairs", ("a", "b")), Unique("child", ("n",)), NotNull("parent", "id"),
        NotNull("child", "id"), Relationships("child", "id", "parent", "id"), Relationships("pairs", "b", "parent", "id"), RowsExpectedEmpty("rows", "child"),
    ]
    got = count_checks(small, checks)
    assert got == {r["check"]: r["failing_rows"] for r in run_checks(small, checks).collect()}
    assert got["relationships_child_id__parent_id"] == 3 and got["unique_combination_pairs_a_b"] == 1 and got["rows"] == 9
    left = count_checks(small, checks, {c.name: 0 for c in checks[1:]})
    assert left == {"unique_parent_id": 1}


def test_rows_and_keys_of_a_table_in_one_pass(small):
    counts = {"missing": F.count_if(F.col("id").isNull()), "large": F.count_if(F.col("id") > 8)}
    assert count_table(small["child"], counts, ("id",)) == ({"missing": 1, "large": 2}, 2)
    assert count_table(small["child"], {}, ("n",)) == ({}, 1)
    assert count_table(small["child"], counts) == ({"missing": 1, "large": 2}, 0)
    assert count_table(small["child"], {}) == ({}, 0)


def test_columns_that_were_not_kept(spark, small):
    df = small["parent"].withColumn("price", F.lit(1).cast("decimal(18,2)"))
    written, counts = write_scratch_counted(df, {"n": F.count_if(F.col("price") > 0)}, ("id",))
    assert written.schema.simpleString() == df.schema.simpleString() and counts == {"n": 4}
    assert rows(written, "id") == rows(df, "id") and written.join(small["child"], "id").count() == 5
    with pytest.raises(Exception, match="column price was not kept"):
        written.select("price").collect()
    assert with_columns_of(df, df.schema).columns == df.columns


def test_shuffle_files_go_with_their_action(spark):
    seen = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {str(f) for f in seen.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before = files()
    with settings(spark, DROP_SHUFFLES):
        spark.range(0, 10_000, 1, 4).groupBy(F.col("id") % 100).count().agg(F.sum("count")).first()
    assert spark.conf.get(next(iter(DROP_SHUFFLES)), None) != "true"
    for _ in range(50):
        if not files() - before:
            break
        __import__("time").sleep(0.1)
    assert not files() - before


def test_every_table_is_named_once():
    written = {*audit.TABLES, *audit.SMALL, audit.MOVEMENTS}
    assert written | set(audit.HELD) == {*MODELS, "accounting_periods", "tax_rates"}
    assert set(audit.PASSED) | set(audit.KEPT) <= written and not set(audit.PASSED) & set(audit.KEPT)


@pytest.fixture(scope="module")
def broken(spark):
    """Sources with repeated and missing keys, orphans and a word nobody knows."""
    makers = TestTables(spark, SMALL).makers()
    orders, items, payments, invoices, phases = (
        makers[n] for n in ("raw.orders", "raw.order_items", "raw.payments", "raw_billing.invoices", "raw_billing.subscriptions")
    )
    status = F.when(F.col("order_id") == 9, "unknown").otherwise(F.col("status"))
    return makers | {
        "raw.orders": lambda: orders().withColumn("status", status).unionByName(orders().filter("order_id in (5, 6)")),
        "raw.order_items": lambda: items().withColumn("product_id", F.when(F.col("order_id") == 7, 10**12).otherwise(F.col("product_id")).cast("long")),
        "raw.payments": lambda: payments().withColumn("order_id", F.when(F.col("order_id") % 100 != 0, F.col("order_id"))),
        "raw_billing.invoices": lambda: invoices().withColumn("amount", F.when(F.col("invoice_id") % 1000 != 0, F.col("amount")).otherwise(-5).cast("decimal(18,2)")),
        "raw_billing.subscriptions": lambda: phases().withColumn("phase_end_date", F.date_add("phase_end_date", 40)),
    }


def test_all_checks_of_broken_tables(spark, broken):
    folder = local(checkpoint_dir(spark)) / "tallyworks"
    before = set(folder.glob("*")) if folder.exists() else set()
    got = {r["check"]: r["failing_rows"] for r in audit.all_results(Warehouse(broken)).collect()}
    written = [set(pq.read_schema(next(f.glob("*.parquet"))).names) for f in set(folder.glob("*")) - before]
    single = Warehouse(broken)
    single.share(*broken)
    named, checks = named_checks(single)
    tables = {**{n: single[n] for n in single}, **named}
    assert got == {r["check"]: r["failing_rows"] for r in run_checks(tables, [*generic_checks(), *checks]).collect()}
    assert sum(1 for n in got.values() if n) > 8
    assert len(written) == len(audit.TABLES) - len(audit.PASSED) + len(audit.SMALL) + 1
    assert not [columns for columns in written if columns & {"product_category", "order_channel", "search_query", "quantity", "is_retry"}]


def test_chains_are_followed_without_a_shuffle_of_months(spark):
    w = Warehouse(TestTables(spark, SMALL).makers())
    with settings(spark, audit.JOIN_AS_DEALT):
        plan = plan_text(w.beside({audit.PHASES: w[audit.PHASES].repartition(audit.CHAIN)})[audit.MOVEMENTS])
    assert not [line for line in plan.split("\n") if "Exchange" in line and "activity_month" in line]
    plain = [line for line in plan_text(w[audit.MOVEMENTS]).split("\n") if "Exchange" in line and "activity_month" in line]
    assert plain


def test_active_customers_meet_without_a_shuffle_of_periods(spark):
    w = Warehouse(TestTables(spark, SMALL).makers())
    w.share(*audit.SMALL)
    met = audit.meet_customers(w)
    keys = met.select(F.col("period_id").alias("_k0"), F.col("customer_id").alias("_k1")).groupBy("_k0", "_k1").count()
    assert not [line for line in plan_text(keys).split("\n") if "Exchange hashpartitioning" in line and "period_id" in line]
    assert rows(met) == rows(w[audit.CUSTOMERS])
    assert keys.filter("count > 1").count() == 0 and keys.count() == met.count()


def test_cents_are_those_of_money(spark):
    import random

    random.seed(5)
    values = [0.0, -0.0, 0.005, 1.005, 2.675, -2.675, 0.1 + 0.2, 84197.04, 1e13, 1e13 + 0.01, 123456789012345.67, 9_007_199_254_740_993.0, -1.015, None]
    values += [round(random.uniform(-1e6, 1e6), random.randint(0, 4)) for _ in range(5000)] + [random.uniform(0, 1e13) for _ in range(500)]
    values += [k / 1000 + 0.0005 for k in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", cents("x").alias("cents"), money("x").alias("money"))
    assert df.filter(~(F.col("cents") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(18,2)").eqNullSafe(F.col("money"))).collect() == []
    assert df.filter("cents is null").count() == 1
