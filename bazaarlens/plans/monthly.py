"""Refreshes that touch only the months that changed.

Master is kept by purchase month, and beside it, for each month, the order table and the addable measures of sellers,
categories and states. A refresh computes the months with changes anew, and feature tables by adding
up stored measures: neither the items nor the master rows of other months are read, and their files stay.

A month's rows depend on the orders of the month and on everything looked up for them, so the caller names the keys that
changed in any dataset, and the months they stand in are found in the new orders and in the stored master.
order_id must not stand in two months; ``duplicate_keys`` of a full refresh lists repeated ones.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.operators.cleaning import clean_orders
from bazaarlens.operators.rollup import payment_measures, rollup, sales_measures
from bazaarlens.plans.features import CATEGORY, SELLER_KEYS, features_from_master, features_from_measures
from bazaarlens.plans.master import Datasets, build_master
from bazaarlens.plans.refresh import for_all, new_run, refuse_other_kind, switch
from bazaarlens.sources.generations import MONTH, Line, columns_of, last_lines, open_table, run_folder
from bazaarlens.sources.storage import read_parquet, write_parquet

#: Keys by which a change can be named, all of them columns of master.
KEYS = ("order_id", "customer_id", "product_id", "seller_id", "product_category_name")


def month_of(time: str) -> Column:
    return F.year(time) * 100 + F.month(time)


def by_month(master: DataFrame) -> dict[str, DataFrame]:
    """What is kept for every month beside master: its orders, and measures that months add up to."""
    return {
        "order_features": features_from_master(master, MONTH)["order_features"],
        "seller_measures": rollup(sales_measures(master, MONTH, *SELLER_KEYS), MONTH, *SELLER_KEYS),
        "category_measures": rollup(sales_measures(master, MONTH, CATEGORY), MONTH, CATEGORY),
        "state_measures": rollup(payment_measures(master, MONTH, "customer_state"), MONTH, "customer_state"),
    }


def changed_months(orders: DataFrame, changed: Mapping[str, DataFrame], stored: Callable[[str], DataFrame] | None) -> list[int]:
    """The months of the rows that have a changed key, in the new orders or in the stored master.

    ``stored`` opens a table by name. The stored order table has every order of master once, so it is read for order_id.
    """
    unknown = set(changed) - set(KEYS)
    if unknown:
        raise ValueError(f"changes are named by {KEYS}, not by {sorted(unknown)}")
    orders = clean_orders(orders).select(*KEYS[:2], month_of("order_purchase_timestamp").alias(MONTH))
    found = []
    for key, ids in changed.items():
        tables = [orders] if key in orders.columns else []
        if stored is not None:
            tables.append(stored("order_features" if key == "order_id" else "master"))
        for rows in tables:
            found.append(rows.join(ids.select(key).distinct(), key, "left_semi").select(MONTH).distinct())
    months = found[0]
    for more in found[1:]:
        months = months.union(more)
    # One number for each month of the calendar that orders were made in.
    return sorted(r[0] for r in months.distinct().collect())


def refresh_months(
    spark: SparkSession,
    data: Datasets,
    out: str,
    changed: Mapping[str, DataFrame] | None = None,
    database: str | None = None,
) -> list[int]:
    """Bring the tables below ``out`` up to ``data``, where only rows with a ``changed`` key differ from before.

    ``changed`` has frames of changed values by key column; None means everything. The first refresh of
    a folder writes every month. Returns the months that were written or emptied, in order. A changed
    customer, product, seller or category touches the months in which it stands in master, and a customer also the
    months of its orders.
    """
    refuse_other_kind(spark, out, monthly=True)
    before = last_lines(spark, out)
    touched: list[int] | None = None
    if before and changed is not None:
        touched = changed_months(data["orders"], changed, lambda name: open_table(spark, out, name, before))
    run = new_run()
    lines: list[Line] = []

    def write(name: str, frame: DataFrame) -> DataFrame:
        """The touched months of one table; the others stay where they are."""
        columns = columns_of(frame)
        folder = run_folder(out, name, columns, run)
        # Dealt by month, where adaptive execution splits large months and puts small ones together.
        dealt = frame.hint("rebalance", MONTH)
        dealt.write.partitionBy(MONTH).parquet(folder)
        stored = spark.read.schema(f"{columns}, {MONTH} int").parquet(folder)
        new = [r[0] for r in stored.select(MONTH).distinct().collect()]
        old = {
            line["purchase_month"]: Line(name, line["stored_run"], line["columns"], line["purchase_month"])
            for line in before
            if line["table_name"] == name and touched is not None and line["purchase_month"] not in {*touched, 0}
        }
        lines.extend([*old.values(), *(Line(name, run, columns, month) for month in sorted(new))])
        if not (old or new):
            frame.drop(MONTH).limit(0).write.parquet(f"{folder}/{MONTH}=0")
            lines.append(Line(name, run, columns, 0))
        return stored

    orders = data["orders"]
    if touched is not None:
        orders = orders.where(month_of("order_purchase_timestamp").isin(touched) if touched else F.lit(False))
    master = build_master({**data, "orders": orders})
    stored = write("master", master.withColumn(MONTH, month_of("order_purchase_timestamp")))
    for_all(by_month(stored), write)
    held = {name: open_table(spark, out, name, rows) for name, rows in _as_rows(lines).items() if name.endswith("_measures")}

    def write_whole(name: str, frame: DataFrame) -> None:
        columns = columns_of(frame)
        write_parquet(frame, run_folder(out, name, columns, run))
        lines.append(Line(name, run, columns))

    for_all(features_from_measures(**held), write_whole)
    switch(spark, out, run, lines, database)
    return sorted({line.month for line in lines if line.run == run and line.month} | set(touched or ()))


def _as_rows(lines: list[Line]) -> dict[str, list[dict]]:
    """The lines of a generation not yet added, as its readers will find them."""
    found: dict[str, list[dict]] = {}
    for line in lines:
        row = {"table_name": line.table, "stored_run": line.run, "columns": line.columns, "purchase_month": line.month, "finished": 0}
        found.setdefault(line.table, []).append(row)
    return found
