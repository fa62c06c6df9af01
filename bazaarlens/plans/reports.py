"""Ranked reports over the feature tables.

Rankings by a rate use the rate to ten decimals, and the key decides between
equals, so a report shows the same rows on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.numeric import exact, exact_mean_sql, percent, rounded
from bazaarlens.plans.features import CATEGORY


def _top(table: DataFrame, by: Column, key: str, n: int) -> DataFrame:
    return table.orderBy(by.desc_nulls_last(), F.asc_nulls_last(key)).limit(n)


def seller_summary(sellers: DataFrame) -> DataFrame:
    """Platform figures: plain means over sellers, and item rows in all."""
    return sellers.agg(
        rounded(exact_mean_sql("seller_avg_review"), 2).alias("avg_review"),
        percent(exact_mean_sql("seller_late_rate")).alias("late_pct"),
        F.count(F.lit(1)).alias("total_sellers"),
        F.sum("seller_total_orders").alias("total_orders"),
    )


def top_sellers_by_review(sellers: DataFrame, n: int = 5) -> DataFrame:
    return _top(sellers, exact("seller_avg_review"), "seller_id", n).select(
        "seller_id",
        "seller_state",
        rounded("seller_avg_review", 2).alias("avg_review"),
        "seller_total_orders",
    )


def top5_categories(categories: DataFrame, n: int = 5) -> DataFrame:
    return _top(categories, F.col("category_total_orders"), CATEGORY, n).select(
        CATEGORY,
        "category_total_orders",
        rounded("category_avg_price", 2).alias("avg_price"),
        rounded("category_avg_review", 2).alias("avg_review"),
    )


def worst5_states(states: DataFrame, n: int = 5) -> DataFrame:
    return _top(states, exact("state_late_rate"), "customer_state", n).select(
        "customer_state",
        "state_total_orders",
        percent("state_late_rate").alias("late_pct"),
    )


def top10_categories(categories: DataFrame, n: int = 10) -> DataFrame:
    return _top(categories, F.col("category_total_orders"), CATEGORY, n).select(
        CATEGORY,
        "category_total_orders",
        rounded("category_avg_price", 2).alias("avg_price"),
        rounded("category_avg_review", 2).alias("avg_review"),
        percent("category_late_rate").alias("late_pct"),
    )


def late_states(states: DataFrame, n: int = 10) -> DataFrame:
    return _top(states, exact("state_late_rate"), "customer_state", n).select(
        "customer_state",
        "state_total_orders",
        percent("state_late_rate").alias("late_pct"),
        rounded("state_avg_payment", 2).alias("avg_payment"),
    )


def bad_sellers(sellers: DataFrame, min_orders: int = 10, n: int = 10) -> DataFrame:
    """Sellers with enough rows, worst late rate first."""
    known = sellers.filter(F.col("seller_total_orders") >= min_orders)
    return _top(known, exact("seller_late_rate"), "seller_id", n).select(
        "seller_id",
        "seller_state",
        rounded("seller_avg_review", 2).alias("avg_review"),
        percent("seller_late_rate").alias("late_pct"),
        "seller_total_orders",
    )


def high_risk_sellers(sellers: DataFrame, min_orders: int = 20, n: int = 20) -> DataFrame:
    """Like :func:`bad_sellers`, but ranked by the percentage as shown."""
    known = sellers.filter(F.col("seller_total_orders") >= min_orders).select(
        "seller_id",
        "seller_state",
        rounded("seller_avg_review", 2).alias("avg_review"),
        percent("seller_late_rate").alias("late_pct"),
        F.col("seller_total_orders").alias("total_orders"),
    )
    return _top(known, F.col("late_pct"), "seller_id", n)


def all_categories(categories: DataFrame) -> DataFrame:
    """Every category, largest first."""
    return categories.select(
        F.col(CATEGORY).alias("category"),
        F.col("category_total_orders").alias("orders"),
        rounded("category_avg_price", 2).alias("avg_price"),
        rounded("category_avg_review", 2).alias("avg_review"),
        percent("category_late_rate").alias("late_pct"),
    ).orderBy(F.desc_nulls_last("orders"), F.asc_nulls_last("category"))


def all_states(states: DataFrame) -> DataFrame:
    """Every state, highest late percentage as shown first."""
    return states.select(
        F.col("customer_state").alias("state"),
        F.col("state_total_orders").alias("orders"),
        percent("state_late_rate").alias("late_pct"),
        rounded("state_avg_payment", 2).alias("avg_payment"),
    ).orderBy(F.desc_nulls_last("late_pct"), F.asc_nulls_last("state"))


def chart_top_categories(categories: DataFrame, n: int = 10) -> DataFrame:
    """Bars of the category chart: length and colour."""
    return all_categories(categories).limit(n).select("category", "orders", "avg_review")
