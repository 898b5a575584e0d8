"""Whole runs: landing, the gate, and the history over several runs."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from tests_helpers import rows

from tallyworks.operators.history import scd2_apply, start_history
from tallyworks.plans import run as run_module
from tallyworks.plans.run import ChecksFailed, check_staging, keep_history, land, read_history
from tallyworks.plans.warehouse import Warehouse
from tallyworks.sources.tables import read_table


def test_landed_tables_are_written_once_and_typed(spark, tmp_path):
    (tmp_path / "events.csv").write_text('event_id,customer_id,note\n9007199254740993,,"a ""b"""\n2,7,c\n')
    stamp = datetime(2025, 1, 2, tzinfo=timezone.utc)
    landed = land(spark, {"raw_events": str(tmp_path)}, str(tmp_path / "root"), stamp)
    (tmp_path / "events.csv").unlink()
    assert sorted(landed) == ["raw_events.events"]
    assert sorted(r[0] for r in landed["raw_events.events"].select("event_id").collect()) == [2, 9007199254740993]
    again = read_table(spark, str(tmp_path / "root/landed/raw_events/events"))
    assert dict(again.dtypes)["customer_id"] == "bigint" and again.filter(F.col("note") == 'a "b"').count() == 1


def test_a_failing_staging_check_replaces_nothing(spark, warehouse, monkeypatch, tmp_path):
    built = []
    monkeypatch.setattr(run_module, "stage", lambda w, root, counting: (built.append(root), (w, {}))[1])
    monkeypatch.setattr(run_module, "audit", lambda w, counted: {})
    check_staging(warehouse)
    run_module.run(warehouse, str(tmp_path / "root"), datetime(2025, 1, 1, tzinfo=timezone.utc))
    assert built and (tmp_path / "root/history/customers").exists()
    before = read_history(spark, str(tmp_path / "root/history/customers")).count()
    broken = Warehouse(warehouse._sources)
    twice = warehouse["raw.orders"].limit(3)
    broken.use("raw.orders", warehouse["raw.orders"].unionByName(twice))
    with pytest.raises(ChecksFailed, match="unique_stg_orders_order_id: 3 rows"):
        run_module.run(broken, str(tmp_path / "root"), datetime(2025, 1, 2, tzinfo=timezone.utc))
    assert len(built) == 1
    assert read_history(spark, str(tmp_path / "root/history/customers")).count() == before


def test_history_over_runs(spark, tmp_path):
    def customers(*data):
        return spark.createDataFrame([(*r, "x") for r in data], "customer_id long, email string, region string, _loaded_at string")

    def at(day):
        return F.lit(f"2025-01-0{day} 00:00:00").cast("timestamp")

    root = str(tmp_path)
    keep_history(customers((1, "a", "N"), (2, "b", "N")), root, at(1))
    keep_history(customers((1, "a", "S"), (3, "c", "N")), root, at(2))
    keep_history(customers((1, "a", "S"), (3, "c", "N")), root, at(3))
    got = read_history(spark, f"{root}/history/customers").select(
        "customer_id", "region", F.dayofmonth("valid_from").alias("f"), F.dayofmonth("valid_to").alias("t")
    )
    assert rows(got) == [(1, "N", 1, 2), (1, "S", 2, None), (2, "N", 1, None), (3, "N", 2, None)]


def parts(tmp_path):
    folder = tmp_path / "history/customers"
    return {f.name: sorted((x.name, x.stat().st_mtime_ns) for x in f.iterdir()) for f in folder.iterdir() if f.name.startswith("part=")}


def test_closed_versions_are_never_written_again(spark, tmp_path):
    def customers(n, region):
        return spark.range(n).selectExpr("id AS customer_id", "concat('m', id) AS email", f"'{region}' || id % 3 AS region")

    def at(day):
        return F.lit(f"2025-01-0{day} 00:00:00").cast("timestamp")

    root, want = str(tmp_path), None
    for day, (n, region) in enumerate([(9, "N"), (9, "S"), (12, "S"), (12, "W")], 1):
        before = parts(tmp_path) if day > 1 else {}
        got = keep_history(customers(n, region), root, at(day))
        kept = parts(tmp_path)
        assert all(kept[name] == files for name, files in before.items())
        want = start_history(customers(n, region), at(day)) if want is None else scd2_apply(want, customers(n, region), "customer_id", ["region", "email"], at(day))
        assert rows(got) == rows(want.select(*got.columns))
    once = rows(got)
    # the same run again changes nothing
    assert rows(keep_history(customers(12, "W"), root, at(4))) == once
    assert rows(read_history(spark, f"{root}/history/customers")) == once


def test_history_with_null_keys_and_new_columns(spark, tmp_path):
    def at(day):
        return F.lit(f"2025-01-0{day} 00:00:00").cast("timestamp")

    root = str(tmp_path)
    first = spark.createDataFrame([(1, "a", "N"), (None, "x", "N"), (2, "b", "N")], "customer_id long, email string, region string")
    keep_history(first, root, at(1))
    wider = spark.createDataFrame([(1, "a", "N", 7), (2, "b", "S", 8), (None, "y", "S", 9)], "customer_id long, email string, region string, points int")
    keep_history(wider, root, at(2))
    narrow = spark.createDataFrame([(3, "c", "N")], "customer_id long, email string, region string")
    got = keep_history(narrow, root, at(3))
    assert got.columns == ["customer_id", "email", "region", "points", "valid_from", "valid_to"]
    days = got.select("customer_id", "region", "points", F.dayofmonth("valid_from").alias("f"), F.dayofmonth("valid_to").alias("t"))
    assert rows(days) == [(1, "N", None, 1, None), (2, "N", None, 1, 2), (2, "S", 8, 2, None), (3, "N", None, 3, None)]
    nobody = keep_history(narrow.limit(0), str(tmp_path / "empty"), at(1))
    assert nobody.count() == 0 and keep_history(narrow, str(tmp_path / "empty"), at(2)).count() == 1


def test_a_version_without_a_key_stays_as_it_is(spark):
    then, now = (F.lit(f"2025-01-0{d} 00:00:00").cast("timestamp") for d in (1, 2))
    old = start_history(spark.createDataFrame([(None, "b"), (1, "a")], "customer_id long, email string"), then)
    got = scd2_apply(old, spark.createDataFrame([(None, "c"), (1, "z")], "customer_id long, email string"), "customer_id", ["email"], now)
    assert rows(got, "customer_id", "email") == [(1, "a"), (1, "z"), (None, "b")]
