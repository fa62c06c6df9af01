"""Findings over the feature tables: outliers, insights and the combined report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.functions.numeric import exact, exact_moments, exact_sum, rounded, rounded_sql
from bazaarlens.plans.features import CATEGORY
from bazaarlens.plans.reports import seller_summary

# What to do about each kind of finding.
ACTIONS = {
    "late_rate": "review logistics and carriers",
    "avg_review": "audit product quality and support",
}

# The sections of the report in their order.
SECTIONS = ("summary", "insights", "risks", "actions")


def _flag_order() -> list[Column]:
    """Largest deviation first."""
    return [F.expr("abs(z)").desc(), F.col("entity_type"), F.col("entity_id"), F.col("metric")]


def _population(table: DataFrame, kind: str, key: str, **metrics: str) -> DataFrame:
    """A feature table in long form: one row per entity and metric with a value."""
    values = F.array(
        *(
            F.struct(F.lit(metric).alias("metric"), F.col(column).alias("value"))
            for metric, column in metrics.items()
        )
    )
    return (
        table.filter(F.col(key).isNotNull())
        .select(
            F.lit(kind).alias("entity_type"),
            F.col(key).cast("string").alias("entity_id"),
            F.inline(values),
        )
        .filter(F.col("value").isNotNull())
    )


def anomaly_flags(
    sellers: DataFrame,
    categories: DataFrame,
    states: DataFrame,
    z_min: float = 2.0,
    min_orders: int = 10,
    n: int = 5,
) -> DataFrame:
    """Entities far from the mean of their kind: often late, or badly reviewed."""
    known = sellers.filter(F.col("seller_total_orders") >= min_orders)
    entities = (
        _population(
            known,
            "seller",
            "seller_id",
            late_rate="seller_late_rate",
            avg_review="seller_avg_review",
        )
        .unionByName(
            _population(
                categories,
                "category",
                CATEGORY,
                late_rate="category_late_rate",
                avg_review="category_avg_review",
            )
        )
        .unionByName(
            _population(states, "state", "customer_state", late_rate="state_late_rate")
        )
    )
    # One row per kind and metric, five in all.
    mean, spread = exact_moments("value")
    baselines = entities.groupBy("entity_type", "metric").agg(
        mean.alias("baseline"), spread.alias("spread")
    )
    z = "((value - baseline) / nullif(spread, 0.0D))"
    action = F.coalesce(
        *(F.when(F.col("metric") == metric, text) for metric, text in ACTIONS.items())
    )
    return (
        entities.join(F.broadcast(baselines), on=["entity_type", "metric"])
        .select("*", rounded(z, 6).alias("z"))
        .filter(
            f"(metric = 'late_rate' AND z >= {z_min}) OR (metric = 'avg_review' AND z <= -{z_min})"
        )
        .orderBy(*_flag_order())
        .limit(n)
        .select(
            "entity_type",
            "entity_id",
            "metric",
            rounded("value", 6).alias("value"),
            rounded("baseline", 6).alias("baseline"),
            "z",
            action.alias("action"),
        )
    )


def _first(
    rows: DataFrame, order: Column, rank: int, theme: str, key: str, metric: str, value: str
) -> DataFrame:
    """The first row as an insight."""
    return (
        rows.orderBy(order, key)
        .limit(1)
        .selectExpr(
            f"{rank} AS rank",
            f"'{theme}' AS theme",
            f"string({key}) AS entity_id",
            f"'{metric}' AS metric",
            f"{rounded_sql(value, 2)} AS value",
        )
    )


def business_insights(categories: DataFrame, states: DataFrame) -> DataFrame:
    """Five top-1 answers on revenue, satisfaction and geography."""
    state = "customer_state"
    categories = categories.filter(f"{CATEGORY} IS NOT NULL")
    states = states.filter(f"{state} IS NOT NULL")
    revenue = "(category_avg_price * category_total_orders)"
    largest = categories.orderBy(F.desc("category_total_orders"), CATEGORY).limit(10)
    overall = states.selectExpr(
        "state_late_rate * state_total_orders AS late", "state_total_orders AS total"
    ).agg(F.try_divide(exact_sum("late"), F.sum("total")).alias("rate")).select(exact("rate"))
    behind = states.filter(exact("state_late_rate") > overall.scalar())
    answers = [
        _first(
            categories, exact(rounded_sql(revenue, 2)).desc_nulls_last(),
            1, "revenue", CATEGORY, "revenue", revenue,
        ),
        _first(
            largest, exact("category_avg_review").asc_nulls_last(),
            2, "satisfaction", CATEGORY, "avg_review", "category_avg_review",
        ),
        _first(
            behind, F.desc_nulls_last("state_total_orders"),
            3, "geography", state, "total_orders", "state_total_orders",
        ),
        _first(
            states, exact("state_avg_payment").desc_nulls_last(),
            4, "revenue", state, "avg_payment", "state_avg_payment",
        ),
        _first(
            states, exact("state_late_rate").desc_nulls_last(),
            5, "geography", state, "late_pct", "state_late_rate * 100",
        ),
    ]
    result = answers[0]
    for answer in answers[1:]:
        result = result.unionByName(answer)
    return result


def findings_report(
    sellers: DataFrame, categories: DataFrame, states: DataFrame, **flag_options
) -> DataFrame:
    """Summary, insights, risks and actions in one table, ordered by section_no and seq."""
    summary = seller_summary(sellers).select(
        F.posexplode(
            F.array(
                *(
                    F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"))
                    for name in ("avg_review", "late_pct", "total_sellers", "total_orders")
                )
            )
        ).alias("position", "item")
    )
    # Numbering the few rows that the limit inside anomaly_flags lets through.
    flags = anomaly_flags(sellers, categories, states, **flag_options).withColumn(
        "seq", F.row_number().over(Window.orderBy(*_flag_order()))
    )
    risk = F.struct(
        F.lit("risks").alias("section"),
        F.concat_ws(" ", "entity_type", "metric").alias("metric"),
        F.col("value"),
    )
    remedy = F.struct(
        F.lit("actions").alias("section"),
        F.col("action").alias("metric"),
        F.col("z").alias("value"),
    )
    parts = [
        summary.select(
            F.lit("summary").alias("section"),
            (F.col("position") + 1).alias("seq"),
            F.lit("platform").alias("entity_id"),
            "item.metric",
            "item.value",
        ),
        business_insights(categories, states).select(
            F.lit("insights").alias("section"),
            F.col("rank").alias("seq"),
            "entity_id",
            "metric",
            "value",
        ),
        flags.select("seq", "entity_id", F.explode(F.array(risk, remedy)).alias("item")).select(
            "item.section", "seq", "entity_id", "item.metric", "item.value"
        ),
    ]
    number = F.coalesce(
        *(F.when(F.col("section") == name, i) for i, name in enumerate(SECTIONS, 1))
    )
    report = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return report.select(number.alias("section_no"), "*").orderBy("section_no", "seq")
