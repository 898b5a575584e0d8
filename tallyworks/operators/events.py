"""Product-event operators: exact de-duplication, identity, sessions, funnel, activation.

One visitor (a bot, a shared device) may own a large share of all events, so no operator here
sorts a visitor's raw events in one task. Sessions are numbered on a per-visitor *spine* whose
length is bounded by elapsed time, not by event count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.functions.columns import elapsed_days, ratio
from tallyworks.operators.joins import join_hot


def dedup_exact(df: DataFrame, keys: Sequence[Column | str], order: str) -> DataFrame:
    """Keep the first row by ``order`` of every exact key.

    ``row_number() = 1`` is planned with a group limit before the exchange as well as after it:
    each map task sends at most one row per key, so a group of copies of any size collapses
    before the shuffle.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("_rn", first).filter(F.col("_rn") == 1).drop("_rn")


def event_key(product: str = "product_id") -> list[Column | str]:
    """What makes two events the same event; product-less events compare as product -1."""
    return ["anonymous_id", "event_type", F.coalesce(F.col(product), F.lit(-1)), "event_timestamp"]


def identity_map(events: DataFrame, anon: str = "anonymous_id", known: str = "customer_id") -> DataFrame:
    """One row per anonymous id with the customer it was ever seen as (NULL if never)."""
    return events.groupBy(anon).agg(F.max(known).alias("resolved_customer_id"))


def resolve_identity(
    events: DataFrame, anon: str = "anonymous_id", known: str = "customer_id"
) -> DataFrame:
    """Back-fill the resolved customer onto every event of the visitor, earlier ones included."""
    return join_hot(events.drop(known), identity_map(events, anon, known), anon, "left")


def _slot(events: DataFrame, ts: str, minutes: int) -> Column:
    """Start of the ``minutes``-wide slot, in minutes since the epoch; NULL for a NULL timestamp."""
    if isinstance(events.schema[ts].dataType, T.TimestampType):
        minute = F.floor(F.unix_micros(ts) / F.lit(60_000_000))
    else:
        minute = F.unix_date(F.to_date(ts)).cast("long") * 1440 + F.hour(ts) * 60 + F.minute(ts)
    return minute - F.pmod(minute, F.lit(minutes))


def session_spine(
    events: DataFrame,
    key: str = "anonymous_id",
    ts: str = "event_timestamp",
    gap_minutes: int = 30,
    identity: str | None = None,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Session number of every (visitor, time slot).

    Time is cut into slots one gap wide. Two events in one slot are less than a gap apart, so a
    session can only break *between* slots: exactly when the first event of a slot is more than
    the gap after the last event of the visitor's previous slot. Events therefore reduce, with
    partial aggregation, to (min, max) per slot, and the per-visitor window runs over slots; a
    visitor with any number of events has at most (history / gap) of them.

    ``identity`` also resolves that column over the visitor; ``extra`` adds per-slot aggregates.
    """
    aggregates = [F.min(ts).alias("_first"), F.max(ts).alias("_last")]
    aggregates += [expr.alias(name) for name, expr in (extra or {}).items()]
    if identity:
        aggregates.append(F.max(identity).alias("_identity"))
    slotted = events.filter(F.col(ts).isNotNull()).withColumn("_slot", _slot(events, ts, gap_minutes))
    slots = slotted.groupBy(key, "_slot").agg(*aggregates)

    by_time = Window.partitionBy(key).orderBy("_slot")
    idle = F.col("_first") - F.lag("_last").over(by_time)
    starts = F.when(idle.isNull() | (idle > F.make_dt_interval(mins=F.lit(gap_minutes))), 1).otherwise(0)
    spine = slots.withColumn("_starts", starts).withColumn(
        "session_number",
        F.sum("_starts").over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    )
    if identity:
        spine = spine.withColumn("resolved_customer_id", F.max("_identity").over(Window.partitionBy(key)))
        spine = spine.drop("_identity")
    return spine.drop("_starts")


def session_id(key: str = "anonymous_id") -> Column:
    return F.concat(F.col(key), F.lit("_"), F.col("session_number").cast("string"))


def sessionize(
    events: DataFrame,
    key: str = "anonymous_id",
    ts: str = "event_timestamp",
    gap_minutes: int = 30,
    spine: DataFrame | None = None,
) -> DataFrame:
    """Add ``session_id``: a new session starts after an idle time strictly above the gap.

    The spine joins back on (visitor, slot). Even one visitor's events spread over all slots,
    and a slot that is still too big is split by AQE, since nothing else hangs on that shuffle.
    A ready-made ``spine`` may carry the resolved identity along, saving a second join.
    Rows without a timestamp belong to no session and keep a NULL ``session_id``.
    """
    if spine is None:
        spine = session_spine(events, key, ts, gap_minutes)
    numbers = spine.drop("_first", "_last")
    slotted = events.withColumn("_slot", _slot(events, ts, gap_minutes))
    joined = slotted.join(numbers, [key, "_slot"], "left")
    return joined.withColumn("session_id", session_id(key)).drop("_slot", "session_number")


def session_totals(
    events: DataFrame,
    gap_minutes: int = 30,
    converts: str = "purchase",
    anon: str = "anonymous_id",
    ts: str = "event_timestamp",
) -> DataFrame:
    """One row per session, straight from the event rows: no event-level join or sort.

    Copies of an event fold in the first aggregation, its slots in the second (both partial on
    the map side), and what is left per visitor is the slot spine, already partitioned the way
    the closing per-session aggregation needs it.
    """
    keyed = events.withColumn("_product", F.coalesce("product_id", F.lit(-1)))
    once = keyed.groupBy(anon, "event_type", "_product", ts).agg(F.max("customer_id").alias("customer_id"))
    is_goal = F.col("event_type") == converts
    spine = session_spine(
        once,
        anon,
        ts,
        gap_minutes,
        identity="customer_id",
        extra={"_events": F.count("*"), "_converted": F.bool_or(is_goal)},
    )
    return (
        spine.groupBy(anon, "session_number", F.col("resolved_customer_id").alias("customer_id"))
        .agg(
            F.min("_first").alias("session_start"),
            F.max("_last").alias("session_end"),
            F.sum("_events").alias("event_count"),
            F.bool_or("_converted").alias("converted"),
        )
        .select(
            session_id(anon).alias("session_id"),
            anon,
            "customer_id",
            "session_start",
            "session_end",
            "event_count",
            "converted",
        )
    )


def count_distinct_events(events: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Events per day after exact de-duplication, as ``(event_date, row_count)``."""
    keyed = events.withColumn("_product", F.coalesce("product_id", F.lit(-1)))
    once = keyed.select("anonymous_id", "event_type", "_product", ts).distinct()
    return once.groupBy(F.to_date(ts).alias("event_date")).agg(F.count("*").alias("row_count"))


def presence_funnel(
    events: DataFrame,
    steps: Mapping[str, str],
    rates: Mapping[str, tuple[str, str]],
    ts: str = "event_timestamp",
    visitor: Column | None = None,
    day: str = "activity_date",
) -> DataFrame:
    """Distinct visitors per day that showed each step's event; steps need not follow each other.

    ``steps`` maps an output column to an event type, ``rates`` an output column to
    (numerator, denominator). The first aggregation leaves one row per (day, visitor), so the
    second one counts flags instead of counting distinct keys (no ``Expand``).
    """
    if visitor is None:
        visitor = F.coalesce(F.col("resolved_customer_id").cast("string"), F.col("anonymous_id"))
    wanted = events.select(F.to_date(ts).alias(day), visitor.alias("_visitor"), "event_type")
    flags = wanted.groupBy(day, "_visitor").agg(
        *[F.bool_or(F.col("event_type") == event).alias(name) for name, event in steps.items()]
    )
    # A visitor without any key counts in no step.
    seen = F.col("_visitor").isNotNull()
    daily = flags.groupBy(day).agg(*[F.count_if(F.col(s) & seen).alias(s) for s in steps])
    return daily.select(
        day, *steps, *[ratio(num, den).alias(name) for name, (num, den) in rates.items()]
    )


def activation(
    events: DataFrame,
    start_event: str = "signup",
    goal_event: str = "purchase",
    days: int = 14,
    actor: str = "resolved_customer_id",
    ts: str = "event_timestamp",
) -> DataFrame:
    """First start event per customer, the first goal event at or after it, and whether it came in time.

    Both minima ignore copies of an event, so un-deduplicated events give the same rows.
    """
    known = events.filter(F.col(actor).isNotNull()).select(F.col(actor).alias("customer_id"), "event_type", ts)
    starts = (
        known.filter(F.col("event_type") == start_event)
        .groupBy("customer_id")
        .agg(F.min(ts).alias("first_signup_at"))
    )
    goals = known.filter(F.col("event_type") == goal_event)
    reached = (
        join_hot(goals, starts, "customer_id")
        .filter(F.col(ts) >= F.col("first_signup_at"))
        .groupBy("customer_id")
        .agg(F.min(ts).alias("first_purchase_at"))
    )
    return (
        starts.join(reached, "customer_id", "left")
        .select(
            "customer_id",
            "first_signup_at",
            "first_purchase_at",
            elapsed_days("first_signup_at", "first_purchase_at").alias("days_to_first_purchase"),
            F.coalesce(
                F.col("first_purchase_at") <= F.col("first_signup_at") + F.make_dt_interval(days=F.lit(days)),
                F.lit(False),
            ).alias("is_activated"),
        )
    )
