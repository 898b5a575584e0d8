"""Streams of event files against the batch models."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from tests_helpers import rows

from tallyworks.operators.events import dedup_exact, event_key, session_totals
from tallyworks.streaming.events import dedup_stream, read_event_files, run_available, session_stream

SCHEMA = "event_id long, anonymous_id string, customer_id long, event_type string, event_timestamp timestamp_ntz, product_id long"
START = datetime(2025, 1, 1, 12)


def event(i, visitor, minutes, kind="product_view", product=None, micros=0):
    return (i, visitor, None, kind, START + timedelta(minutes=minutes, microseconds=micros), product)


def streamed(spark, tmp_path, batches, make):
    """Each batch is a file; files arrive, and are read, one by one."""
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    frame = None
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        schema = spark.read.parquet(folder).schema
        frame = run_available(make(read_event_files(spark, folder, schema, 1)), out, state)
    return frame


def test_copies_in_later_files_are_dropped(spark, tmp_path):
    first = [event(1, "a", 0), event(2, "a", 5, product=3), event(3, "b", 7)]
    second = [event(11, "a", 5, product=3), event(12, "b", 20), event(13, "a", 0)]
    third = [event(21, "b", 20), event(22, "b", 20, kind="purchase")]
    got = streamed(spark, tmp_path, [first, second, third], dedup_stream)
    every = spark.createDataFrame(first + second + third, SCHEMA)
    want = dedup_exact(every, event_key(), "event_id")
    assert rows(got.select("event_id", "anonymous_id")) == rows(want.select("event_id", "anonymous_id"))


def test_late_rows_are_dropped_first_or_not(spark, tmp_path):
    first = [event(1, "a", 0), event(2, "a", 300)]
    second = [event(3, "a", 400)]  # moves the watermark to 340 minutes
    late = [event(4, "a", 0), event(5, "b", 10), event(6, "c", 395)]
    got = streamed(spark, tmp_path, [first, second, late], dedup_stream)
    assert rows(got.select("event_id")) == [(1,), (2,), (3,), (6,)]


def test_closed_sessions_equal_the_batch_model(spark, tmp_path):
    first = [event(1, "a", 0), event(2, "a", 30), event(3, "a", 60, micros=1), event(4, "b", 10, kind="purchase")]
    second = [event(5, "b", 40), event(6, "b", 41), event(16, "b", 41), event(7, "c", 70)]
    third = [event(8, "z", 1000)]
    got = streamed(spark, tmp_path, [first, second, third, [event(9, "z", 2000)]], session_stream)
    every = spark.createDataFrame(first + second + third, SCHEMA)
    want = session_totals(every).select("anonymous_id", "session_start", "session_end", "event_count", "converted")
    times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("session_start", "session_end")]
    assert rows(got.select("anonymous_id", *times, "event_count", "converted")) == rows(want)
    # idle for exactly half an hour goes on; a microsecond more begins a new session
    assert sorted(r.event_count for r in got.filter("anonymous_id = 'a'").collect()) == [1, 2]


def test_open_sessions_wait(spark, tmp_path):
    got = streamed(spark, tmp_path, [[event(1, "a", 0), event(2, "b", 85)]], session_stream)
    assert got.count() == 0  # the watermark stands at 25 minutes
    got = streamed(spark, tmp_path, [[event(3, "b", 100)]], session_stream)
    assert rows(got.select("anonymous_id", "event_count")) == [("a", 1)]


def test_state_is_bounded_by_the_watermark(spark, tmp_path):
    plan = dedup_stream(read_event_files(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema))._jdf.queryExecution().logical().toString()
    assert "EventTimeWatermark" in plan and "DeduplicateWithinWatermark" in plan
