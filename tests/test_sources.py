from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from tests_helpers import d, plan_text, rows, ts

from tallyworks.operators.contracts import Contract, ContractViolation
from tallyworks.sources.ingest import SOURCES, coerce_temporal, load_csv, load_tables
from tallyworks.sources.tables import read_table, replace_table, table_exists, write_csv


def test_coerce_temporal_is_all_or_nothing(spark):
    df = spark.createDataFrame(
        [
            ("2025-01-01 10:00:00", "2025-01-01", "2025-01-01", None, "2025-02-30", "2025-01-01", 1),
            ("2025-01-02 23:59:59", None, "soon", None, "2025-01-01", "2025-01-01 00:00:00", 2),
        ],
        "stamp string, day string, mixed string, empty string, invalid string, both string, n int",
    )
    got = coerce_temporal(df)
    assert {f.name: f.dataType.simpleString() for f in got.schema.fields} == {
        "stamp": "timestamp_ntz",
        "day": "date",
        "mixed": "string",
        "empty": "string",
        "invalid": "string",
        "both": "string",
        "n": "int",
    }
    first = got.orderBy("n").first()
    assert first.stamp == ts("2025-01-01T10:00:00") and first.day == d("2025-01-01")


def test_load_csv_finds_types(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(
        "event_id,customer_id,amount,ok,when,day,note\n"
        "1,,1.50,True,2025-01-01 00:00:01,2025-01-01,a\n"
        "2,7,2,False,2025-01-01 00:00:02,,b\n"
    )
    df = load_csv(spark, str(path))
    assert [f.dataType.simpleString() for f in df.schema.fields] == [
        "bigint",
        "bigint",  # whole numbers with gaps stay whole
        "double",
        "boolean",
        "timestamp_ntz",
        "date",
        "string",
    ]
    declared = load_csv(
        spark, str(path), "event_id long, customer_id long, amount double, ok boolean, when string, day string, note string"
    )
    assert [f.dataType.simpleString() for f in declared.schema.fields][4:] == ["timestamp_ntz", "date", "string"]


def test_load_csv_loses_nothing(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        "id,gap,code,huge,mixed,long_fraction,note\n"
        '9000000000000000001,9007199254740993,007,99999999999999999999,1,0.12345678901234567,"say ""hi"", now"\n'
        '9000000000000000002,,008,1,2.5,1,"two\nlines"\n'
    )
    df = load_csv(spark, str(path))
    assert [f.dataType.simpleString() for f in df.schema.fields] == [
        "bigint",
        "bigint",
        "string",
        "decimal(38,0)",
        "double",
        "string",
        "string",
    ]
    got = df.orderBy("id").collect()
    assert [r.id for r in got] == [9000000000000000001, 9000000000000000002]
    assert (got[0].gap, got[0].code, got[0].huge) == (9007199254740993, "007", 99999999999999999999)
    assert [r.note for r in got] == ['say "hi", now', "two\nlines"]


def test_declared_columns_go_by_name_and_refuse_what_does_not_fit(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,price,qty\n1,2.50,30\n")
    assert load_csv(spark, str(path), "id long, qty int, price double").collect() == [(1, 30, 2.5)]
    with pytest.raises(ValueError, match="missing: \\['cost'\\], not declared: \\['price'\\]"):
        load_csv(spark, str(path), "id long, qty int, cost double")
    path.write_text("id,price,qty\n1,x,30\n2,,\n")
    with pytest.raises(ValueError, match="'price': 1"):
        load_csv(spark, str(path), "id long, qty int, price double")


def test_load_tables_stamps_and_refuses_missing_files(spark, tmp_path):
    assert [len(tables) for tables in SOURCES.values()] == [5, 6, 1]
    (tmp_path / "events.csv").write_text("event_id\n1\n2\n")
    loaded_at = datetime(2025, 1, 2, tzinfo=timezone.utc)
    tables = load_tables(spark, "raw_events", str(tmp_path), loaded_at)
    assert tables["events"].select("_loaded_at").distinct().count() == 1
    with pytest.raises(FileNotFoundError):
        load_tables(spark, "raw", str(tmp_path), loaded_at)


def test_replace_table_is_repeatable_and_keeps_readers(spark, tmp_path):
    path = str(tmp_path / "orders")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id long, note string")
    assert not table_exists(spark, path)
    reader = replace_table(first, path)
    replace_table(first, path)
    assert rows(read_table(spark, path)) == [(1, "a"), (2, "b")]
    assert reader.count() == 2  # the version read before is still there
    # a table from before load times were recorded takes them, and keeps columns the load lacks
    newer = first.drop("note").withColumn("_loaded_at", F.lit("2025-01-01").cast("timestamp"))
    kept = replace_table(newer, path, keep_columns=True)
    assert set(kept.columns) == {"id", "note", "_loaded_at"}
    assert kept.filter("note is null").count() == 2
    with pytest.raises(ContractViolation, match="extra"):
        replace_table(newer.withColumn("extra", F.lit(1)), path, keep_columns=True)


def test_versions_of_other_writers_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(1), path)
    (tmp_path / "t" / "v_other").mkdir()
    for n in (2, 3, 4):
        replace_table(spark.range(n), path)
        assert read_table(spark, path).count() == n
    assert (tmp_path / "t" / "v_other").exists()
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("v_")]) == 3
    assert [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("_current")] == ["_current"]


def test_broken_contract_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    contract = Contract({"id": "bigint"}, ("id",))
    replace_table(spark.range(3), path, contract)
    with pytest.raises(ContractViolation):
        replace_table(spark.range(3).union(spark.range(1)), path, contract)
    with pytest.raises(ContractViolation):
        replace_table(spark.range(3).withColumn("x", F.lit(1)), path, contract)
    assert read_table(spark, path).count() == 3


def test_write_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "metric")
    write_csv(spark.range(3), path)
    assert rows(load_csv(spark, path)) == [(0,), (1,), (2,)]


def test_landing_parses_the_text_once_by_many_tasks(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text("event_id,code,note\n" + "".join(f'{i},00{i % 7},"a ""b"", {i}"\n' for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64KB")
    try:
        df = load_csv(spark, str(path), landing=str(tmp_path / "text"))
        parts = [f for f in (tmp_path / "text").iterdir() if f.name.endswith(".parquet")]
        plain = load_csv(spark, str(path))
        assert plain.rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(parts) > 3
    # what follows reads the landed rows, not the text
    plan = plan_text(df)
    assert "events.csv" not in plan and "Format: Parquet" in plan
    assert rows(df.filter("event_id < 5")) == [(i, f"00{i % 7}", f'a "b", {i}') for i in range(5)]
    assert rows(df) == rows(plain) and df.schema == plain.schema
    path.unlink()
    assert df.count() == 20_000


@pytest.mark.parametrize("landed", [False, True])
@pytest.mark.parametrize("declared", [None, True])
def test_line_breaks_in_quotes_are_found(spark, tmp_path, landed, declared):
    path = tmp_path / "t.csv"
    path.write_text('id,note\n1,"two\nlines"\n2,one\n\n3,\n')
    df = load_csv(spark, str(path), line_breaks=declared, landing=str(tmp_path / "text") if landed else None)
    assert rows(df) == [(1, "two\nlines"), (2, "one"), (3, None)]


def test_undeclared_line_breaks_and_other_headers_are_errors(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,note\n1,"two\nlines"\n')
    with pytest.raises(ValueError, match="open quote"):
        load_csv(spark, str(tmp_path / "t.csv"), line_breaks=False, landing=str(tmp_path / "text"))
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.csv").write_text("id,note\n1,a\n")
    (folder / "b.csv").write_text("id,note\n2,b\n")
    assert rows(load_csv(spark, str(folder), landing=str(tmp_path / "text2"))) == [(1, "a"), (2, "b")]
    (folder / "c.csv").write_text("note,id\nc,3\n")
    with pytest.raises(ValueError, match="header"):
        load_csv(spark, str(folder), landing=str(tmp_path / "text3"))
