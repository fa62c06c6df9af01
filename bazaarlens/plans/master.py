"""The master table: delivered orders at item grain, with everything known about them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from bazaarlens.operators.cleaning import (
    clean_orders,
    payment_agg,
    review_agg,
    translate_products,
    with_delivery,
)
from bazaarlens.operators.joins import left_join_many, marked_rows
from bazaarlens.operators.repeats import Copies, with_copies

Datasets = Mapping[str, DataFrame]

MASTER_COLUMNS = (
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "product_id",
    "seller_id",
    "price",
    "freight_value",
    "product_category_name",
    "product_category_name_english",
    "customer_state",
    "seller_city",
    "seller_state",
    "total_payment",
    "avg_installments",
    "avg_review_score",
    "delivery_delay_days",
    "is_late",
)


def order_rows(data: Datasets) -> DataFrame:
    """Delivered orders, one row each, with delivery, payment and review columns.

    Payments and reviews are aggregated to the order before they are joined, so
    the three inputs meet on one partitioning by order_id. An aggregate whose
    columns go unused is dropped from the plan by the optimizer.
    """
    return (
        with_delivery(clean_orders(data["orders"]))
        .join(payment_agg(data["payments"]), on="order_id", how="left")
        .join(review_agg(data["reviews"]), on="order_id", how="left")
    )


def item_rows(data: Datasets, copies: Copies | None = None) -> DataFrame:
    """Master rows before lookups: one per item, and one per order without items.

    With ``copies``, each has the copies of its keys beside it, looked up before items meet orders.
    """
    orders, items = with_copies(order_rows(data), copies), with_copies(data["order_items"], copies)
    return left_join_many(orders, items, "order_id")


def build_master(data: Datasets) -> DataFrame:
    """The master table. Columns the datasets have beyond the named ones come last.

    Customers are looked up at order grain, where there are fewer rows, and
    before the joins on order_id. The plan is the same at every size: adaptive
    execution knows the bytes of a lookup and broadcasts it if they are few.

    Items, payments and reviews of other orders, of those not delivered or outside the months of a refresh, are
    left out before they are shuffled.
    """
    kept = clean_orders(data["orders"]).select("order_id")
    data = {**data, **{name: marked_rows(data[name], "order_id", kept) for name in ("order_items", "payments", "reviews")}}
    orders = order_rows(
        {
            "orders": data["orders"].join(data["customers"], on="customer_id", how="left"),
            "payments": data["payments"],
            "reviews": data["reviews"],
        }
    )
    products = translate_products(data["products"], data["category"])
    master = (
        left_join_many(orders, data["order_items"], "order_id")
        .join(products, on="product_id", how="left")
        .join(data["sellers"], on="seller_id", how="left")
    )
    others = [name for name in master.columns if name not in MASTER_COLUMNS]
    return master.select(*MASTER_COLUMNS, *others)
