"""Product-event models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.events import (
    activation,
    dedup_exact,
    event_key,
    identity_map,
    presence_funnel,
    resolve_identity,
    session_spine,
    session_totals,
    sessionize,
)
from tallyworks.operators.joins import join_hot

# Columns of the event models, funnel steps and rates.
EVENT_COLUMNS = [
    "event_id",
    "anonymous_id",
    "resolved_customer_id",
    "event_type",
    "event_timestamp",
    "product_id",
    "order_id",
    "search_query",
]
FUNNEL_STEPS = {
    "viewers": "product_view",
    "carters": "add_to_cart",
    "checkout_starters": "checkout_start",
    "purchasers": "purchase",
}
FUNNEL_RATES = {
    "view_to_cart_rate": ("carters", "viewers"),
    "cart_to_checkout_rate": ("checkout_starters", "carters"),
    "checkout_to_purchase_rate": ("purchasers", "checkout_starters"),
    "view_to_purchase_rate": ("purchasers", "viewers"),
}


def int_identity_resolution(events: DataFrame) -> DataFrame:
    return identity_map(events)


def int_events_resolved(events: DataFrame) -> DataFrame:
    return resolve_identity(events).select(*EVENT_COLUMNS)


def int_events_deduplicated(events: DataFrame) -> DataFrame:
    """Resolved events without copies, from the staged events.

    Copies go first, straight off the scan, so they are dropped before any shuffle; identity
    still comes from all events, since a dropped copy may be the one that names the customer.
    """
    once = dedup_exact(events.drop("customer_id"), event_key(), "event_id")
    return join_hot(once, identity_map(events), "anonymous_id", "left").select(*EVENT_COLUMNS)


def int_sessions(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Resolved, de-duplicated events with their session, from the staged events.

    Identity and session number travel on one spine, so the events are shuffled twice in all:
    once to drop copies and once to meet the spine.
    """
    spine = session_spine(events, gap_minutes=gap_minutes, identity="customer_id")
    once = dedup_exact(events.drop("customer_id"), event_key(), "event_id")
    return sessionize(once, gap_minutes=gap_minutes, spine=spine).select(*EVENT_COLUMNS, "session_id")


def fct_events(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "event_id",
        "anonymous_id",
        F.col("resolved_customer_id").alias("customer_id"),
        "session_id",
        "event_type",
        "event_timestamp",
        "product_id",
        "order_id",
        "search_query",
    )


def fct_sessions(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    return session_totals(events, gap_minutes)


def mart_funnel_conversion(resolved: DataFrame) -> DataFrame:
    """Presence flags do not change with copies of an event, so resolved events are enough."""
    return presence_funnel(resolved, FUNNEL_STEPS, FUNNEL_RATES)


def mart_activation(resolved: DataFrame) -> DataFrame:
    return activation(resolved)
