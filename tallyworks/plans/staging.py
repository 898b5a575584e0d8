"""Staging models: rename, cast, derive. One row in, one row out, no joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.columns import MONEY, TAX_RATE, money

# Inputs of a product or a difference keep their places until its one rounding. These widths make
# quantity * price * (1 - discount) fit 38 digits exactly.
WIDE_PRICE, WIDE_DISCOUNT, COUNT = "decimal(16,6)", "decimal(9,8)", "decimal(10,0)"


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "first_name",
        "last_name",
        "signup_date",
        "region",
        "country",
        F.lower("email").alias("email"),
        # concat, not concat_ws: a missing part makes the whole name unknown
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
    )


def stg_products(products: DataFrame) -> DataFrame:
    cost, price = F.col("unit_cost").cast(WIDE_PRICE), F.col("unit_price").cast(WIDE_PRICE)
    return products.select(
        "product_id",
        "product_name",
        "category",
        money(cost).alias("unit_cost"),
        money(price).alias("unit_price"),
        "is_active",
        F.round(price - cost, 2).cast(MONEY).alias("unit_margin"),
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    # customer_id is deliberately not cast: a type change upstream must surface in the contract
    return orders.select(
        "order_id",
        "customer_id",
        "order_date",
        F.col("status").alias("order_status"),
        F.col("channel").alias("order_channel"),
    )


def stg_order_items(items: DataFrame) -> DataFrame:
    price = F.col("unit_price").cast(WIDE_PRICE)
    discount = F.coalesce(F.col("discount").cast(WIDE_DISCOUNT), F.lit(0).cast(WIDE_DISCOUNT))
    full = F.col("quantity").cast(COUNT) * price
    return items.select(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        money(price).alias("unit_price"),
        discount.cast(TAX_RATE).alias("discount"),
        F.round(full * (1 - discount), 2).cast(MONEY).alias("line_amount"),
    )


def stg_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        "payment_id",
        "order_id",
        "payment_date",
        "payment_method",
        F.col("status").alias("payment_status"),
        money("amount").alias("amount"),
    )


def stg_billing__plans(plans: DataFrame) -> DataFrame:
    return plans.select("plan_id", "plan_name", "billing_interval", "currency", money("price").alias("price"))


def stg_billing__subscriptions(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.select(
        "subscription_id",
        "subscription_chain_id",
        "customer_id",
        "plan_id",
        "phase_start_date",
        "phase_end_date",
        "phase_type",
        "is_trial",
        "ended_reason",
    )


def stg_billing__invoices(invoices: DataFrame) -> DataFrame:
    return invoices.select(
        "invoice_id",
        "subscription_id",
        "customer_id",
        "invoice_date",
        "period_start",
        "period_end",
        money("amount").alias("invoice_amount"),
    )


def stg_billing__invoice_lines(lines: DataFrame) -> DataFrame:
    return lines.select(
        "invoice_line_id",
        "invoice_id",
        "subscription_id",
        "description",
        "quantity",
        money("unit_amount").alias("unit_amount"),
        money("amount").alias("line_amount"),
    )


def stg_billing__payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        "payment_id",
        "invoice_id",
        "payment_date",
        "payment_method",
        "is_retry",
        F.col("status").alias("payment_status"),
        money("amount").alias("payment_amount"),
    )


def stg_billing__refunds(refunds: DataFrame) -> DataFrame:
    return refunds.select(
        "refund_id",
        "payment_id",
        "refund_date",
        F.col("reason").alias("refund_reason"),
        money("amount").alias("refund_amount"),
    )


def stg_events__events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "anonymous_id",
        F.col("customer_id").cast("long").alias("customer_id"),
        "event_type",
        "event_timestamp",
        F.col("product_id").cast("long").alias("product_id"),
        F.col("order_id").cast("long").alias("order_id"),
        "search_query",
    )
