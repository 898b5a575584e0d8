import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from tests_helpers import d, dec, plan_text, rows, ts

from tallyworks.functions.columns import elapsed_days, padded_name, ratio
from tallyworks.operators.contracts import (
    Contract,
    ContractViolation,
    assert_contract,
    freshness,
    schema_drift,
    schema_snapshot,
    snapshot_columns,
    table_columns,
)
from tallyworks.operators.history import scd2_apply, start_history
from tallyworks.operators.periods import assign_period, make_accounting_periods, overlap_period
from tallyworks.operators.reconcile import reconcile, reconcile_all, reconcile_summary
from tallyworks.operators.spine import date_range, zero_fill
from tallyworks.operators.volume import flag_anomalies, trailing_change
from tallyworks.operators.windows import lead_date
from tallyworks.plans.staging import stg_customers, stg_order_items, stg_products


@pytest.fixture(scope="module")
def periods(spark):
    return make_accounting_periods(spark.sql("select date'2025-01-01' as first_month, date'2025-06-01' as last_month"))


def test_accounting_periods(periods):
    got = rows(periods)
    assert got[0] == (1, d("2025-01-01"), d("2025-01-31"), d("2025-02-10"))
    assert [r[3] for r in got] == [d(f"2025-0{m}-10") for m in range(2, 6)] + [None, None]


def test_assign_period_drops_dates_outside(spark, periods):
    df = spark.createDataFrame(
        [(1, d("2025-01-31")), (2, d("2025-02-01")), (3, d("2024-12-31")), (4, None)], "id int, day date"
    )
    assert rows(assign_period(df, "day", periods), "id", "period_id") == [(1, 1), (2, 2)]
    assert len(rows(assign_period(df, "day", periods, how="left"))) == 4
    plan = plan_text(assign_period(df, "day", periods))
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_overlap_equals_brute_force(spark):
    """Calendars with gaps, overlaps and odd lengths; open, reversed-free random intervals."""
    rng = random.Random(3)
    base = d("2025-01-01")
    calendar = []
    for i in range(12):
        start = base + timedelta(days=rng.randrange(0, 400))
        calendar.append((i, start, start + timedelta(days=rng.randrange(0, 70)), None))
    intervals = []
    for i in range(150):
        start = base + timedelta(days=rng.randrange(-200, 700))
        end = None if i % 4 == 0 else start + timedelta(days=rng.randrange(0, 200))
        intervals.append((i, start, end))
    expected = sorted(
        (i, p) for i, s, e in intervals for p, ps, pe, _ in calendar if s <= pe and (e is None or e >= ps)
    )
    periods = spark.createDataFrame(
        calendar, "period_id int, period_start_date date, period_end_date date, closed_at date"
    )
    df = spark.createDataFrame(intervals, "id int, start date, stop date")
    joined = overlap_period(df, "start", "stop", periods)
    assert sorted(rows(joined, "id", "period_id")) == expected
    assert "NestedLoop" not in plan_text(joined) and "Cartesian" not in plan_text(joined)


def test_phase_ending_on_first_day_of_period_is_active_in_it(spark, periods):
    df = spark.createDataFrame([(1, d("2025-01-10"), d("2025-02-01"))], "id int, start date, stop date")
    assert rows(overlap_period(df, "start", "stop", periods), "period_id") == [(1,), (2,)]


def test_lead_date_equals_window(spark):
    rng = random.Random(5)
    base = d("2025-01-01")
    made = [(i, rng.randrange(3), base + timedelta(days=rng.randrange(12))) for i in range(90)]
    df = spark.createDataFrame(made, "id long, grp long, day date")
    expected = {}
    for g in range(3):
        ordered = sorted((day, i) for i, grp, day in made if grp == g)
        for (day, i), nxt in zip(ordered, [*ordered[1:], (None, None)]):
            expected[i] = nxt[0]
    assert dict(rows(lead_date(df, "grp", "day", "id", "next"), "id", "next")) == expected


def test_date_attributes(spark):
    (sunday,) = date_range(spark, "2025-03-02", "2025-03-02").collect()
    assert tuple(sunday) == (d("2025-03-02"), 2025, 1, 3, 2, 0, "Sunday   ", "March    ", True)
    assert date_range(spark, "2025-03-03", "2025-03-02").count() == 0
    assert spark.range(1).select(padded_name(F.lit(d("2025-09-03")), "EEEE")).first()[0] == "Wednesday"


def test_ratio_rounds_half_up_and_is_null_safe(spark):
    df = spark.sql("select 1 a, 800 b union all select 5, 0 union all select 28515, 100000 union all select 1, null")
    assert sorted(str(v) for (v,) in rows(df.select(ratio("a", "b")))) == ["0.0013", "0.2852", "None", "None"]


def test_elapsed_days_keeps_microseconds(spark):
    df = spark.createDataFrame(
        [(ts("2025-03-01T00:00:00"), ts("2025-03-02T12:00:00.000001"))], "a timestamp_ntz, b timestamp_ntz"
    )
    assert df.select(elapsed_days("a", "b")).first()[0] == (36 * 3600 * 10**6 + 1) / 86_400_000_000.0


def _volume(spark, counts):
    return spark.createDataFrame(
        [(s, p, n) for s, series in counts.items() for p, n in series.items()],
        "source_name string, period_id int, row_count long",
    )


def test_volume_zero_and_rounding(spark, periods):
    volume = _volume(
        spark,
        {
            "stops": {1: 100, 2: 100, 3: 100, 5: 100},
            "edge": {1: 2000, 2: 2000, 3: 2000, 4: 1201},
            "tiny": {1: 3, 2: 3, 3: 3, 4: 0},
        },
    )
    calendar = periods.withColumn("is_closed", F.lit(True))
    filled = zero_fill(volume, periods)
    flagged = flag_anomalies(trailing_change(filled).join(calendar.select("period_id", "is_closed"), "period_id"))
    got = {(r.source_name, r.period_id): r for r in flagged.collect()}
    gap = got["stops", 4]
    assert gap.row_count == 0 and gap.pct_change_vs_trailing_avg == dec("-100.0") and gap.is_anomaly
    edge = got["edge", 4]  # -39.95 rounds to -40.0
    assert edge.pct_change_vs_trailing_avg == dec("-40.0") and edge.is_anomaly
    assert got["tiny", 4].is_anomaly is False
    first = got["stops", 1]
    assert first.trailing_avg_row_count is None and first.is_anomaly is None
    assert ("edge", 5) not in got
    latest = zero_fill(volume, periods, until="latest")
    assert rows(latest.filter("source_name = 'edge' and period_id = 5"), "row_count") == [(0,)]
    with pytest.raises(ValueError):
        zero_fill(volume, periods, until="never")


def test_scd2(spark):
    schema = "customer_id long, name string, region string, email string"
    day1 = spark.createDataFrame(
        [(1, "a", "N", "x"), (2, "b", "N", "y"), (3, "c", None, "z"), (4, "d", "N", "w")], schema
    )
    day2 = spark.createDataFrame(
        [(1, "a", "N", "x2"), (2, "B", "N", "y"), (3, "c", "S", "z"), (5, "e", "N", "v")], schema
    )
    t1, t2, t3 = (F.lit(f"2025-01-0{i} 00:00:00").cast("timestamp") for i in (1, 2, 3))
    h1 = start_history(day1, t1)
    h2 = scd2_apply(h1, day2, "customer_id", ["region", "email"], t2)
    versions = {}
    for r in h2.collect():
        versions.setdefault(r.customer_id, []).append((r.email, r.region, r.valid_to is None))
    assert sorted(versions[1]) == [("x", "N", False), ("x2", "N", True)]
    assert versions[2] == [("y", "N", True)]  # a new name alone is no change
    assert len(versions[3]) == 2  # NULL to a value is one
    assert versions[4] == [("w", "N", True)]  # gone from the source, stays open
    assert versions[5] == [("v", "N", True)]
    h3 = scd2_apply(h2, day2, "customer_id", ["region", "email"], t3)
    assert rows(h3) == rows(h2)  # a run without changes adds nothing


def test_reconcile(spark):
    a = spark.createDataFrame([(1, 10.004), (2, 0.0), (3, 5.0)], "k int, v double")
    b = spark.createDataFrame([(1, 10.001), (3, 6.0), (4, None), (5, 7.0)], "k int, v double")
    assert rows(reconcile(a, b, "k", ["v"]), "k", "left_value", "right_value") == [
        (3, dec("5.00"), dec("6.00")),
        (5, dec("0.00"), dec("7.00")),
    ]
    keyed = [df.withColumn("k", F.date_add(F.lit("2025-01-01").cast("date"), F.col("k"))) for df in (a, b)]
    pairs = [("v", *keyed, "k", ["v"])]
    assert rows(reconcile_all(pairs), "metric", "key_date") == [("v", d("2025-01-04")), ("v", d("2025-01-06"))]
    assert rows(reconcile_summary(pairs)) == [("v", 4, 2)]


def test_contract(spark):
    contract = Contract({"id": "bigint", "name": "string"}, ("id",), ("name",))
    good = spark.createDataFrame([("a", 1), ("b", 2)], "name string, id long")
    assert assert_contract(good, contract).columns == ["id", "name"]
    bad = {
        "missing column name": good.drop("name"),
        "unexpected column more": good.withColumn("more", F.lit(1)),
        "column id is string": good.withColumn("id", F.col("id").cast("string")),
        "repeated primary keys": good.union(good),
        "NULLs in required column name": good.withColumn("name", F.when(F.col("id") > 1, F.col("name"))),
    }
    for message, df in bad.items():
        with pytest.raises(ContractViolation, match=message):
            assert_contract(df, contract)


def test_schema_drift(spark):
    def table(ddl):
        return spark.createDataFrame([], ddl)

    expected = {"a": table("x int, y string"), "b": table("x int"), "d": table("x int")}
    live = {"a": table("x long, z int"), "c": table("x int"), "d": table("x int")}
    snapshot = schema_snapshot(expected)
    drift = schema_drift(snapshot_columns(spark, snapshot), table_columns(spark, live))
    assert [tuple(r) for r in drift.select("finding", "table_name", "column_name").collect()] == [
        ("MISSING COLUMN", "a", "y"),
        ("NEW COLUMN", "a", "z"),
        ("TYPE CHANGED", "a", "x"),
        ("MISSING TABLE", "b", None),
        ("NEW TABLE", "c", None),
    ]


def test_freshness(spark):
    as_of = F.lit("2025-01-10 00:00:00").cast("timestamp")
    for loaded, status in (("2025-01-09 00:00:00", "pass"), ("2025-01-08 00:00:00", "warn"), ("2025-01-01 00:00:00", "error")):
        df = spark.range(1).select(F.lit(loaded).cast("timestamp").alias("_loaded_at"))
        assert freshness(df, "orders", as_of).first().status == status
    empty = spark.createDataFrame([], "_loaded_at timestamp")
    assert freshness(empty, "orders", as_of).first().status == "error"


def test_staging_rules(spark):
    customers = spark.createDataFrame(
        [(1, "Ann", None, "A@B.C", d("2025-01-01"), "N", "X"), (2, "Ann", "Lee", "A@B.C", d("2025-01-01"), "N", "X")],
        "customer_id long, first_name string, last_name string, email string, signup_date date, region string, country string",
    )
    assert rows(stg_customers(customers), "customer_id", "customer_name", "email") == [
        (1, None, "a@b.c"),
        (2, "Ann Lee", "a@b.c"),
    ]
    items = spark.createDataFrame(
        [(1, 1, 1, 3, 19.99, None), (2, 1, 1, 3, 19.99, 0.15), (3, 1, 1, 1000, 0.125, 0.33333)],
        "order_item_id long, order_id long, product_id long, quantity long, unit_price double, discount double",
    )
    assert rows(stg_order_items(items), "order_item_id", "line_amount") == [(1, dec("59.97")), (2, dec("50.97")), (3, dec("83.33"))]
    products = spark.createDataFrame(
        [(1, "p", "c", 19.99, 9.99, True), (2, "p", "c", 0.004, 0.013, True)],
        "product_id long, product_name string, category string, unit_cost double, unit_price double, is_active boolean",
    )
    assert rows(stg_products(products), "unit_margin") == [(dec("-10.00"),), (dec("0.01"),)]
