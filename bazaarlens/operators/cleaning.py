"""Cleaning and per-order aggregates of the raw datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame

from bazaarlens.functions.delivery import delay_days, late_flag
from bazaarlens.functions.numeric import exact_mean, exact_sum, to_double


def clean_orders(orders: DataFrame) -> DataFrame:
    """Orders that were delivered, with known purchase and delivery times."""
    return orders.filter(
        "order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL "
        "AND order_purchase_timestamp IS NOT NULL"
    )


def with_delivery(orders: DataFrame) -> DataFrame:
    """Add the delivery delay in days and the late flag."""
    delay = delay_days("order_delivered_customer_date", "order_estimated_delivery_date")
    return orders.select("*", delay.alias("delivery_delay_days")).select(
        "*", late_flag("delivery_delay_days").alias("is_late")
    )


def payment_agg(payments: DataFrame) -> DataFrame:
    """Total paid and mean number of instalments per order."""
    return payments.groupBy("order_id").agg(
        exact_sum("payment_value").alias("total_payment"),
        exact_mean("payment_installments").alias("avg_installments"),
    )


def review_agg(reviews: DataFrame) -> DataFrame:
    """Mean review score per order, over the scores that are numbers."""
    return (
        reviews.select("order_id", to_double("review_score").alias("review_score"))
        .filter("review_score IS NOT NULL")
        .groupBy("order_id")
        .agg(exact_mean("review_score").alias("avg_review_score"))
    )


def translate_products(products: DataFrame, category: DataFrame) -> DataFrame:
    """Products with the English category name; null where there is none."""
    return products.join(category, on="product_category_name", how="left")
