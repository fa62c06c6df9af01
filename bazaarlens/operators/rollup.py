"""Sums that can be added up again at any coarser grain, exactly.

Feature tables are means over master rows. A mean is kept as a sum and a count
until the end, so rows can be aggregated on an id before the id is looked up,
and the lookup joins see one row per id instead of a skewed fact table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.numeric import ADDENDS, exact_addends, exact_total, exact_units


def mean_parts(name: str, value: str, weight: str = "1") -> list[str]:
    """The addends and the count of ``value``, standing for ``weight`` equal rows."""
    addends = exact_addends(f"double({value}) * {weight}")
    return [
        *(f"{addend} AS {name}{end}" for end, addend in zip(ADDENDS, addends, strict=True)),
        f"bigint(if({value} IS NOT NULL, {weight}, 0)) AS {name}_n",
    ]


def flag_parts(name: str, value: str, weight: str = "1") -> list[str]:
    """The rows where ``value`` is 1, and those where it is known: whole numbers as they are."""
    return [
        f"bigint({value} * {weight}) AS {name}_yes_n",
        f"bigint(if({value} IS NOT NULL, {weight}, 0)) AS {name}_n",
    ]


def sales_measures(rows: DataFrame, *keys: str, weight: str = "1") -> DataFrame:
    """Item rows as addable measures: orders, late, price and review; ``weight`` is the master rows of one."""
    return rows.selectExpr(
        *keys,
        f"bigint(if(order_id IS NOT NULL, {weight}, 0)) AS orders_n",
        *flag_parts("late", "is_late", weight),
        *mean_parts("price", "price", weight),
        *mean_parts("review", "avg_review_score", weight),
    )


def payment_measures(orders: DataFrame, *keys: str, weight: str = "1") -> DataFrame:
    """The measures of the state table; ``weight`` is the master rows of an order."""
    return orders.selectExpr(
        *keys,
        f"bigint(if(order_id IS NOT NULL, {weight}, 0)) AS orders_n",
        *mean_parts("payment", "total_payment", weight),
        *flag_parts("late", "is_late", weight),
    )


def rollup(measures: DataFrame, *keys: str, extra: tuple[Column, ...] = ()) -> DataFrame:
    """Add up the measures per key; rows of measures and rolled-up ones alike.

    The four whole addends of a mean become one decimal, ``_sum``, in units of 1e-8, which further
    rollups add up: no carry is lost and nothing overflows, however often states are merged.
    """
    totals = []
    for name in measures.columns:
        if name.endswith(("_sum", "_far", "_n")):
            totals.append(F.sum(name).alias(name))
        elif name.endswith(ADDENDS[0]):
            measure = name.removesuffix(ADDENDS[0])
            whole = (f"sum({measure}{end})" for end in ADDENDS[:4])
            totals.append(F.expr(exact_units(*whole)).alias(f"{measure}_sum"))
    return measures.groupBy(*keys).agg(*extra, *totals)


def mean(name: str, column: str) -> str:
    """The mean of a measure, as a select expression; null when nothing was counted."""
    return f"try_divide({exact_total(f'{name}_sum', f'{name}_far')}, {name}_n) AS {column}"


def share(name: str, column: str) -> str:
    """The share of a flag, as a select expression; null when nothing was counted."""
    return f"try_divide({name}_yes_n, {name}_n) AS {column}"
