import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from tests_helpers import d, dec, plan_text, rows, ts

from tallyworks.operators.events import activation, resolve_identity, session_totals, sessionize
from tallyworks.plans import events as models

SCHEMA = (
    "event_id long, anonymous_id string, customer_id long, event_type string, event_timestamp timestamp_ntz, "
    "product_id long, order_id long, search_query string"
)


def scenario_events():
    made = []

    def add(anon, kind, when, customer=None, product=None, query=None, event_id=None):
        made.append((event_id or len(made) + 1, anon, customer, kind, when, product, None, query))

    t = ts("2025-03-01T10:00:00")
    minute = timedelta(minutes=1)
    for i, (kind, customer) in enumerate(
        [("page_view", None), ("product_view", None), ("signup", 11), ("add_to_cart", None), ("checkout_start", None),
         ("purchase", 11)]
    ):
        add("a11", kind, t + i * 3 * minute, customer, 1 if kind != "page_view" else None)
    add("a12", "product_view", t, product=2)
    add("a12", "add_to_cart", t + minute, product=2)
    add("a13", "product_view", t, 13, 3, event_id=900)
    add("a13", "product_view", t, 13, 3, event_id=100)
    for m in (0, 5, 120, 124):
        add("a14", "page_view", t + m * minute, 14)
    add("a15", "search", t, 15, query="lamp")
    add("a17a", "product_view", t, 17, 5)
    add("a17b", "product_view", t + timedelta(days=1), 17, 5)
    add("a18", "product_view", t + 40 * minute, 18, 6)
    add("a18", "page_view", t, 18)
    add("a19", "signup", t, 19)
    add("a19", "purchase", t + timedelta(days=3), 19)
    add("a20", "signup", t, 20)
    add("a20", "purchase", t + timedelta(days=25), 20)
    add("a21", "purchase", t - timedelta(days=1), 21)
    add("a21", "signup", t, 21)
    add("a22", "signup", t, 22)
    add("a22", "purchase", t + timedelta(days=14), 22)
    return made


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(scenario_events(), SCHEMA)


@pytest.fixture(scope="module")
def sessions(events):
    return models.int_sessions(events).cache()


def test_identity_is_backfilled(sessions):
    by_anon = {a: c for a, c in rows(sessions, "anonymous_id", "resolved_customer_id")}
    assert by_anon["a11"] == 11 and by_anon["a12"] is None and by_anon["a17a"] == by_anon["a17b"] == 17
    assert sessions.filter("anonymous_id = 'a11' and resolved_customer_id = 11").count() == 6


def test_copies_keep_lowest_event_id(sessions):
    assert rows(sessions.filter("anonymous_id = 'a13'"), "event_id") == [(100,)]


def test_sessions(sessions):
    per_visitor = {a: n for a, n in rows(sessions.groupBy("anonymous_id").agg(F.countDistinct("session_id")))}
    assert per_visitor["a11"] == 1 and per_visitor["a14"] == 2 and per_visitor["a18"] == 2
    # the later row has the earlier time: order is by time, not by arrival
    assert rows(sessions.filter("anonymous_id = 'a18'"), "event_type", "session_id") == [
        ("page_view", "a18_1"),
        ("product_view", "a18_2"),
    ]
    assert rows(sessions.filter("event_type = 'search'"), "search_query") == [("lamp",)]


def test_layers_agree_with_fused_model(events, sessions):
    layered = sessionize(models.int_events_deduplicated(events))
    assert rows(layered.select(*sessions.columns)) == rows(sessions)


def test_session_totals_match_events(events, sessions):
    totals = session_totals(events)
    expected = sessions.groupBy(
        "session_id", "anonymous_id", F.col("resolved_customer_id").alias("customer_id")
    ).agg(
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count("*").alias("event_count"),
        F.bool_or(F.col("event_type") == "purchase").alias("converted"),
    )
    assert rows(totals) == rows(expected.select(*totals.columns))


@pytest.mark.parametrize("gap", [7, 30, 720])
def test_session_numbers_equal_a_plain_walk(spark, gap):
    """Against brute force on random times, including gaps of exactly the limit and a microsecond more."""
    rng = random.Random(gap)
    start = ts("2025-03-01T00:00:00")
    made, expected = [], {}
    for visitor in range(12):
        t, number = start + timedelta(minutes=rng.randrange(0, 90)), 1
        for i in range(40):
            event_id = visitor * 100 + i
            if i:
                step = rng.choice(
                    [timedelta(0), timedelta(minutes=gap), timedelta(minutes=gap, microseconds=1),
                     timedelta(minutes=gap, microseconds=-1), timedelta(minutes=rng.randrange(0, 3 * gap))]
                )
                t += step
                number += step > timedelta(minutes=gap)
            made.append((event_id, f"v{visitor}", t))
            expected[event_id] = f"v{visitor}_{number}"
    rng.shuffle(made)
    df = spark.createDataFrame(made, "event_id long, anonymous_id string, event_timestamp timestamp_ntz")
    assert dict(rows(sessionize(df, gap_minutes=gap), "event_id", "session_id")) == expected
    zoned = df.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    assert dict(rows(sessionize(zoned, gap_minutes=gap), "event_id", "session_id")) == expected


def test_event_without_time_is_kept_without_session(spark):
    df = spark.createDataFrame(
        [(1, "v", ts("2025-03-01T00:00:00")), (2, "v", None)],
        "event_id long, anonymous_id string, event_timestamp timestamp_ntz",
    )
    assert rows(sessionize(df), "event_id", "session_id") == [(1, "v_1"), (2, None)]


def test_funnel_counts_presence_per_day(events):
    funnel = {r.activity_date: r for r in models.mart_funnel_conversion(models.int_events_resolved(events)).collect()}
    first = funnel[d("2025-03-01")]
    # viewers a11, a12, a13, 17 and 18; carters a11 and a12
    assert (first.viewers, first.carters, first.checkout_starters, first.purchasers) == (5, 2, 1, 1)
    assert first.view_to_cart_rate == dec("0.4000") and first.cart_to_checkout_rate == dec("0.5000")
    assert funnel[d("2025-03-02")].viewers == 1
    later = funnel[d("2025-03-04")]
    assert later.viewers == 0 and later.purchasers == 1 and later.view_to_purchase_rate is None


def test_activation(events):
    got = {r.customer_id: r for r in activation(resolve_identity(events)).collect()}
    assert set(got) == {11, 19, 20, 21, 22}
    assert got[19].is_activated and got[19].days_to_first_purchase == 3.0
    assert not got[20].is_activated and got[20].days_to_first_purchase == 25.0
    assert got[21].first_purchase_at is None and not got[21].is_activated  # bought only before signing up
    assert got[22].is_activated  # exactly fourteen days


def test_copies_collapse_before_the_shuffle(events):
    plan = plan_text(models.int_events_deduplicated(events))
    assert plan.count("WindowGroupLimit") == 2  # once on each side of the exchange


def test_sessions_never_window_raw_events(events):
    """Only the slot spine is windowed by visitor; events meet it through a join on (visitor, slot)."""
    plan = plan_text(sessionize(events))
    below_window = plan[plan.index("Window [") :]
    exchange = below_window.index("Exchange hashpartitioning(anonymous_id#")
    assert "Aggregate(keys=[anonymous_id" in below_window[exchange:]  # the window reads aggregated slots
    assert plan.index("Join [anonymous_id") < plan.index("Window [")  # and events only join on (visitor, slot)
    assert "Window [" not in plan[: plan.index("Join [anonymous_id")]
