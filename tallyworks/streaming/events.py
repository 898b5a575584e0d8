"""Event models over a stream of event files: exact copies dropped, sessions totalled once they are closed.

State is bounded by the watermark: an event, or a session, is remembered until event time has moved on by
``delay`` beyond it, and a row that is older than that when it comes is late and dropped. A late copy is
therefore dropped whether or not the first one was seen; a late *first* event is lost, which the batch
models do not do. Identity is resolved over a visitor's whole history and stays with the batch models.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELAY = "1 hour"
GAP_MINUTES = 30


def read_event_files(spark: SparkSession, path: str, schema: T.StructType, files_at_once: int | None = None) -> DataFrame:
    """A stream of the Parquet files in a folder, ``files_at_once`` in a batch."""
    reader = spark.readStream.schema(schema)
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return reader.parquet(path)


def dedup_stream(events: DataFrame, delay: str = DELAY, ts: str = "event_timestamp") -> DataFrame:
    """The first copy to arrive of every exact event (the key of ``event_key``); events without a time are left out.

    Copies have one time, so all that are not late fall within the watermark of the first. Of copies in one
    batch any may be kept; they differ in ``event_id`` at most.
    """
    timed = events.filter(F.col(ts).isNotNull()).withColumn(ts, F.col(ts).cast("timestamp"))
    keyed = timed.withWatermark(ts, delay).withColumn("_product", F.coalesce("product_id", F.lit(-1)))
    return keyed.dropDuplicatesWithinWatermark(["anonymous_id", "event_type", "_product", ts]).drop("_product")


def session_stream(
    events: DataFrame,
    gap_minutes: int = GAP_MINUTES,
    converts: str = "purchase",
    delay: str = DELAY,
    anon: str = "anonymous_id",
    ts: str = "event_timestamp",
) -> DataFrame:
    """One row per closed session of exact events: ``anonymous_id, session_start, session_end, event_count, converted``.

    A session is closed, and its row given out, once the watermark has passed its last event by more than
    the gap. A new one starts after an idle time strictly above the gap, as Spark joins windows that touch.
    Sessions have no number here, as that would take the visitor's whole past; start and visitor name one.
    """
    once = dedup_stream(events, delay, ts)
    window = F.session_window(ts, f"{gap_minutes} minutes")
    totals = once.groupBy(anon, window.alias("_session")).agg(
        F.max(ts).alias("session_end"),
        F.count("*").alias("event_count"),
        F.bool_or(F.coalesce(F.col("event_type") == converts, F.lit(False))).alias("converted"),
    )
    return totals.select(anon, F.col("_session.start").alias("session_start"), "session_end", "event_count", "converted")


def run_available(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Process what is there, append it as Parquet to ``out`` and stop; the next call goes on where this one ended.

    Returns all that was ever appended: the sink's log tells finished batches from broken ones.
    """
    query = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start(out).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)
