"""Retail order models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.columns import money, sum_money, sum_money_if, zero_money
from tallyworks.operators.netting import net_children

def _succeeded() -> Column:
    return F.col("payment_status") == "succeeded"


def int_order_items_enriched(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    return (
        items.join(orders, "order_id")
        .join(products.select("product_id", F.col("category").alias("product_category")), "product_id")
        .select(
            "order_item_id",
            "order_id",
            "customer_id",
            "order_date",
            "order_status",
            "order_channel",
            "product_id",
            "product_category",
            "quantity",
            "unit_price",
            "discount",
            "line_amount",
        )
    )


def int_order_payment_summary(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.count("*").alias("payment_attempt_count"),
        sum_money_if(_succeeded(), "amount").alias("amount_collected"),
        F.bool_or(_succeeded()).alias("has_succeeded_payment"),
        F.bool_or(F.col("payment_status") == "failed").alias("has_failed_attempt"),
        F.max("payment_date").alias("last_payment_date"),
    )


def dim_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return net_children(
        customers.select("customer_id", "customer_name", "email", "signup_date", "region", "country"),
        orders.filter(F.col("order_status") == "completed"),
        "customer_id",
        {
            "first_order_date": F.min("order_date"),
            "most_recent_order_date": F.max("order_date"),
            "lifetime_order_count": F.count("*"),
        },
        {"lifetime_order_count": F.lit(0).cast("long")},
    )


def dim_products(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", "product_name", "category", "unit_cost", "unit_price", "unit_margin", "is_active"
    )


def fct_orders(orders: DataFrame, items: DataFrame, payment_summary: DataFrame) -> DataFrame:
    """Every order, whatever its status, with item totals and money collected."""
    with_items = net_children(
        orders,
        items,
        "order_id",
        {"item_quantity": F.sum("quantity"), "order_amount": sum_money("line_amount")},
        {"item_quantity": F.lit(0).cast("long"), "order_amount": zero_money()},
    )
    joined = with_items.join(payment_summary, "order_id", "left")
    collected = F.coalesce("amount_collected", zero_money())
    return joined.select(
        "order_id",
        "customer_id",
        "order_date",
        "order_status",
        "order_channel",
        "item_quantity",
        "order_amount",
        collected.alias("amount_collected"),
        F.coalesce("payment_attempt_count", F.lit(0).cast("long")).alias("payment_attempt_count"),
        F.coalesce("has_succeeded_payment", F.lit(False)).alias("has_succeeded_payment"),
        money(F.col("order_amount") - collected).alias("revenue_minus_collected_variance"),
    )


def fct_order_items(enriched: DataFrame) -> DataFrame:
    return enriched
