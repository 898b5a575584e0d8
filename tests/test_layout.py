"""How tables are written: by month and sorted, counted on the way, checked before anybody reads them."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from tests_helpers import plan_text, rows

from tallyworks.operators.checks import NotNull, Relationships, Unique, key_domains, row_counts, run_checks
from tallyworks.plans import run as run_module
from tallyworks.plans.checkbook import generic_checks
from tallyworks.plans.run import ChecksFailed, landed_freshness, land, run
from tallyworks.plans.warehouse import LAYOUTS, MARTS, SAME_ROWS, WRITTEN, Warehouse, build, open_warehouse
from tallyworks.sources.ingest import LOADED_MICROS
from tallyworks.sources.tables import Layout, footer_maximum, publish_table, read_months, read_table, replace_table, stage_table
from tallyworks.sources.testdata import TestTables

SMALL = "/root/testdata/sf0.001"
CEILING = "not_implausibly_large_fct_orders_order_amount"


@pytest.fixture(scope="module")
def sources(spark):
    """The raw tables, written once."""
    w = Warehouse(TestTables(spark, SMALL).makers())
    w.share(*[n for n in TestTables(spark, SMALL).makers()])
    return {n: w[n] for n in w._sources}


def test_a_month_is_read_from_its_folder_alone(spark, tmp_path):
    path, layout = str(tmp_path / "t"), Layout("day", ("visitor",))
    df = spark.range(4000).select(
        "id", F.date_add(F.lit("2025-01-01"), (F.col("id") % 120).cast("int")).alias("day"), (F.col("id") * 7 % 100).alias("visitor")
    )
    df = df.unionByName(df.limit(3).withColumn("day", F.lit(None).cast("date")))
    written = replace_table(df, path, layout=layout)
    assert written.columns == df.columns and read_table(spark, path).columns == df.columns
    assert rows(read_table(spark, path)) == rows(df)
    some = read_months(spark, path, layout, date(2025, 2, 10), date(2025, 3, 5))
    assert rows(some) == rows(df.filter("day between '2025-02-10' and '2025-03-05'"))
    scan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_month" in scan and "202502" in scan
    some.collect()
    (folder,) = (tmp_path / "t").glob("v_*")
    assert {f.name for f in folder.iterdir() if f.is_dir()} >= {"_month=202501", "_month=202504", "_month=__HIVE_DEFAULT_PARTITION__"}
    for file in (folder / "_month=202502").glob("*.parquet"):
        visitors = [r.visitor for r in spark.read.parquet(str(file)).select("visitor").collect()]
        assert visitors == sorted(visitors)


def test_a_hot_month_is_cut_into_several_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        df = spark.range(0, 200_000, 1, 8).select("id", F.lit(date(2025, 1, 5)).alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        replace_table(df, str(tmp_path / "t"), layout=Layout("day", ("id",)))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    (folder,) = (tmp_path / "t").glob("v_*")
    assert len(list((folder / "_month=202501").glob("*.parquet"))) > 3


def test_row_checks_are_counted_by_the_write(spark, tmp_path):
    checks = [NotNull("t", "a"), NotNull("t", "b")]
    df = spark.createDataFrame([(1, None), (None, None), (3, 3)], "a int, b int")
    staged = stage_table(df, str(tmp_path / "t"), counting=row_counts(checks)["t"])
    assert staged.counts == {"not_null_t_a": 1, "not_null_t_b": 2}
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "t"))
    publish_table(staged)
    counted = run_checks({}, checks, staged.counts)
    assert rows(counted, "check", "failing_rows") == [("not_null_t_a", 1), ("not_null_t_b", 2)]
    assert read_table(spark, str(tmp_path / "t")).count() == 3


def test_key_checks_of_one_key_share_an_exchange(spark):
    tables = {
        "parent": spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long"),
        "child": spark.createDataFrame([(1, 1)] * 5 + [(2, 9), (3, 9), (4, None)], "n long, id long"),
        "other": spark.createDataFrame([(2,), (7,)], "parent_id long"),
    }
    checks = [
        Unique("parent", ("id",)),
        Relationships("child", "id", "parent", "id"),
        Relationships("other", "parent_id", "parent", "id"),
        Unique("child", ("n", "id")),
    ]
    assert [len(g) for g in key_domains(checks).values()] == [3, 1]
    got = run_checks(tables, checks)
    assert rows(got, "check", "failing_rows") == sorted(zip([c.name for c in checks], (1, 2, 1, 1)))
    plan = plan_text(run_checks(tables, [*checks[:3], Unique("child", ("n",)), Unique("other", ("parent_id",))]))
    # one exchange by tag and key, counted per task before it, and one of a row for each tag
    assert plan.count("Exchange hashpartitioning(_domain") == 2 and plan.count("Exchange hashpartitioning") == 2
    assert plan.index("Exchange hashpartitioning(_domain#", plan.index("Exchange hashpartitioning(_domain#") + 1) < plan.rindex("partial_count")


def test_key_checks_of_empty_tables_pass(spark):
    tables = {n: spark.createDataFrame([], "id long, name string") for n in ("parent", "child")}
    checks = [Unique("parent", ("id",)), Unique("parent", ("name",)), Unique("child", ("id", "name")), Relationships("child", "id", "parent", "id")]
    assert {r["failing_rows"] for r in run_checks(tables, checks).collect()} == {0} and run_checks(tables, checks).count() == 4


def test_the_declared_keys_meet_in_few_aggregations(sources):
    domains = key_domains(generic_checks())
    assert sum(len(g) for g in domains.values()) == 67
    assert len(domains["stg_orders", ("order_id",)]) == 4
    plan = plan_text(run_checks(Warehouse(sources), [c for c in generic_checks() if c.name in {x.name for g in domains.values() for x in g}]))
    assert plan.count("Exchange hashpartitioning(_domain") <= 2 * 6


def test_build_lays_tables_out_and_writes_none_twice(spark, sources, tmp_path):
    root = str(tmp_path)
    built = build(Warehouse(sources), root)
    again = open_warehouse(spark, root, sources)
    for name in LAYOUTS:
        layer = "marts" if name in MARTS else "intermediate"
        (folder,) = (tmp_path / layer / name).glob("v_*")
        assert any(f.name.startswith("_month=2") for f in folder.iterdir()), name
    lazy = Warehouse(sources)
    for name in SAME_ROWS:
        assert not (tmp_path / "intermediate" / name).exists()
        assert set(again[name].columns) == set(lazy[name].columns), name
    for name in ("int_sessions", "int_invoice_payment_status", "mart_customer_metrics", "fct_sessions"):
        want = lazy[name]
        assert rows(again[name].select(*want.columns)) == rows(want) == rows(built[name].select(*want.columns)), name


def test_marts_that_fail_are_held_back_with_what_is_made_from_them(spark, sources, tmp_path):
    root = str(tmp_path)
    quiet = {CEILING, "assert_no_volume_anomaly", "assert_scenario_14_produces_two_sessions"}
    run(Warehouse(sources), root, datetime(2025, 1, 1, tzinfo=timezone.utc), warn_only=quiet)
    published = {n: (tmp_path / ("marts" if n in MARTS else "intermediate") / n / "_current").read_text().split()[0] for n in WRITTEN}
    with pytest.raises(ChecksFailed, match=f"{CEILING}: .* rows; held back: .*fct_orders") as error:
        run(Warehouse(sources), root, datetime(2025, 1, 2, tzinfo=timezone.utc), warn_only=quiet - {CEILING})
    held = set(str(error.value).rsplit("held back: ", 1)[1].split(", "))
    now = {n: (tmp_path / ("marts" if n in MARTS else "intermediate") / n / "_current").read_text().split()[0] for n in WRITTEN}
    assert {n for n in WRITTEN if now[n] == published[n]} == held
    assert held == {"fct_orders", "mart_revenue_reconciliation_by_period"}


def test_hand_written_checks_are_held_against_the_tables_they_read(spark, sources, monkeypatch, tmp_path):
    def nothing_adds_up(t):
        return t["mart_cash_movements_by_period"].select("period_id").limit(1)

    monkeypatch.setattr(run_module, "NAMED_CHECKS", {"nothing_adds_up": nothing_adds_up})
    with pytest.raises(ChecksFailed, match="nothing_adds_up: 1 rows; held back: mart_cash_movements_by_period$"):
        run(Warehouse(sources), str(tmp_path), datetime(2025, 1, 1, tzinfo=timezone.utc), warn_only={CEILING})
    assert (tmp_path / "marts/fct_orders/_current").exists()
    assert not (tmp_path / "marts/mart_cash_movements_by_period/_current").exists()


def test_freshness_of_landed_tables_comes_from_footers(spark, tmp_path):
    (tmp_path / "events.csv").write_text("event_id,note\n" + "".join(f"{i},x\n" for i in range(500)))
    root = str(tmp_path / "root")
    landed = land(spark, {"raw_events": str(tmp_path)}, root, datetime(2025, 1, 2, tzinfo=timezone.utc))
    assert LOADED_MICROS not in landed["raw_events.events"].columns
    plan = footer_maximum(spark, f"{root}/landed/raw_events/events", LOADED_MICROS)._jdf.queryExecution().toString()
    assert "PushedAggregation: [MAX(_loaded_micros)]" in plan
    for day, status in ((2, "pass"), (4, "warn"), (9, "error")):
        as_of = F.lit(f"2025-01-{day:02d} 12:00:00").cast("timestamp")
        assert rows(landed_freshness(spark, root, as_of), "source_name", "status") == [("raw_events.events", status)]
