"""The ranked reports as views of a published database: plain SQL over its feature tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from bazaarlens.functions.numeric import exact_mean_sql, exact_sql, rounded_sql
from bazaarlens.plans.features import CATEGORY
from bazaarlens.sources.generations import create_view


def _percent(rate: str) -> str:
    return rounded_sql(f"({rate} * 100)", 1)


def _top(columns: str, table: str, by: str, key: str, n: int, where: str = "true") -> str:
    """The first ``n`` rows; the key decides between equals, so a report is the same on every run."""
    return f"SELECT {columns} FROM {{db}}.{table} WHERE {where} ORDER BY {by} DESC NULLS LAST, {key} ASC NULLS LAST LIMIT {n}"


_REVIEW = f"{rounded_sql('seller_avg_review', 2)} AS avg_review"
_CATEGORY_FIGURES = (
    f"{rounded_sql('category_avg_price', 2)} AS avg_price, {rounded_sql('category_avg_review', 2)} AS avg_review"
)
_CATEGORY_LATE = f"{_percent('category_late_rate')} AS late_pct"
_STATE_LATE = f"{_percent('state_late_rate')} AS late_pct"
_PAYMENT = f"{rounded_sql('state_avg_payment', 2)} AS avg_payment"
_ALL_CATEGORIES = (
    f"SELECT {CATEGORY} AS category, category_total_orders AS orders, {_CATEGORY_FIGURES}, {_CATEGORY_LATE} "
    "FROM {db}.category_features ORDER BY orders DESC NULLS LAST, category ASC NULLS LAST"
)

#: Each report over the tables of the database ``{db}``.
REPORTS: dict[str, str] = {
    "seller_summary": (
        f"SELECT {rounded_sql(exact_mean_sql('seller_avg_review'), 2)} AS avg_review, {_percent(exact_mean_sql('seller_late_rate'))} AS late_pct, "
        "count(*) AS total_sellers, sum(seller_total_orders) AS total_orders FROM {db}.seller_features"
    ),
    "top_sellers_by_review": _top(
        f"seller_id, seller_state, {_REVIEW}, seller_total_orders",
        "seller_features", exact_sql("seller_avg_review"), "seller_id", 5,
    ),
    "top5_categories": _top(
        f"{CATEGORY}, category_total_orders, {_CATEGORY_FIGURES}",
        "category_features", "category_total_orders", CATEGORY, 5,
    ),
    "worst5_states": _top(
        f"customer_state, state_total_orders, {_STATE_LATE}",
        "customer_features", exact_sql("state_late_rate"), "customer_state", 5,
    ),
    "top10_categories": _top(
        f"{CATEGORY}, category_total_orders, {_CATEGORY_FIGURES}, {_CATEGORY_LATE}",
        "category_features", "category_total_orders", CATEGORY, 10,
    ),
    "late_states": _top(
        f"customer_state, state_total_orders, {_STATE_LATE}, {_PAYMENT}",
        "customer_features", exact_sql("state_late_rate"), "customer_state", 10,
    ),
    "bad_sellers": _top(
        f"seller_id, seller_state, {_REVIEW}, {_percent('seller_late_rate')} AS late_pct, seller_total_orders",
        "seller_features", exact_sql("seller_late_rate"), "seller_id", 10, "seller_total_orders >= 10",
    ),
    "high_risk_sellers": _top(
        f"seller_id, seller_state, {_REVIEW}, {_percent('seller_late_rate')} AS late_pct, seller_total_orders AS total_orders",
        "seller_features", "late_pct", "seller_id", 20, "seller_total_orders >= 20",
    ),
    "all_categories": _ALL_CATEGORIES,
    "all_states": (
        f"SELECT customer_state AS state, state_total_orders AS orders, {_STATE_LATE}, {_PAYMENT} "
        "FROM {db}.customer_features ORDER BY late_pct DESC NULLS LAST, state ASC NULLS LAST"
    ),
    "chart_top_categories": f"SELECT category, orders, avg_review FROM ({_ALL_CATEGORIES} LIMIT 10)",
}


def report_sql(name: str, database: str) -> str:
    return REPORTS[name].replace("{db}", f"`{database}`")


def publish_reports(spark: SparkSession, database: str) -> None:
    """One view per report in the database. They read its tables, so a refresh moves them on too."""
    for name in REPORTS:
        create_view(spark, database, name, report_sql(name, database))


def long_sql(database: str) -> str:
    """All numbers of all reports, read from the views: report, entity, metric, value."""
    selects = []
    for name, (key, metrics) in FIGURES.items():
        cells = ", ".join(f"'{metric}', CAST({metric} AS double)" for metric in metrics)
        selects.append(
            f"SELECT '{name}' AS report, {key} AS entity, "
            f"stack({len(metrics)}, {cells}) AS (metric, value) FROM `{database}`.`{name}`"
        )
    return " UNION ALL ".join(selects)


#: The entity and the numbers of each report.
FIGURES: dict[str, tuple[str, tuple[str, ...]]] = {
    "seller_summary": ("'platform'", ("avg_review", "late_pct", "total_sellers", "total_orders")),
    "top_sellers_by_review": ("string(seller_id)", ("avg_review", "seller_total_orders")),
    "top5_categories": (CATEGORY, ("category_total_orders", "avg_price", "avg_review")),
    "worst5_states": ("customer_state", ("state_total_orders", "late_pct")),
    "top10_categories": (CATEGORY, ("category_total_orders", "avg_price", "avg_review", "late_pct")),
    "late_states": ("customer_state", ("state_total_orders", "late_pct", "avg_payment")),
    "bad_sellers": ("string(seller_id)", ("avg_review", "late_pct", "seller_total_orders")),
    "high_risk_sellers": ("string(seller_id)", ("avg_review", "late_pct", "total_orders")),
    "all_categories": ("category", ("orders", "avg_price", "avg_review", "late_pct")),
    "all_states": ("state", ("orders", "late_pct", "avg_payment")),
    "chart_top_categories": ("category", ("orders", "avg_review")),
}
