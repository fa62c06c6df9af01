"""The datasets of this package over an order/lineitem star schema in parquet.

The star tables are another domain; these views give them the columns, null
cases and dirty values that the raw marketplace datasets have.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from bazaarlens.functions.numeric import rounded_sql

Table = Callable[[str], DataFrame]


def _orders(table: Table) -> DataFrame:
    # The status test is null-safe and nested, so that a filter on the status
    # folds to one on the code, which the parquet scan can take.
    return table("orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "if(o_orderstatus <=> 'F', 'delivered', "
        "CASE o_orderstatus WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'canceled' END) AS order_status",
        "o_orderdate AS order_purchase_timestamp",
        "if(o_orderkey % 40 != 0, o_orderdate + make_dt_interval("
        "int(o_orderkey * 37 % 45), int(o_orderkey % 24)), NULL) AS order_delivered_customer_date",
        "o_orderdate + make_dt_interval(30) AS order_estimated_delivery_date",
    )


def _order_items(table: Table) -> DataFrame:
    return table("lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS order_item_id",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "l_extendedprice AS price",
        f"{rounded_sql('(l_extendedprice * l_tax)', 2)} AS freight_value",
    )


def _products(table: Table) -> DataFrame:
    return table("part").selectExpr(
        "p_partkey AS product_id",
        "if(p_partkey % 97 != 0, replace(p_name, ' ', '_'), NULL) AS product_category_name",
    )


def _category(table: Table) -> DataFrame:
    return (
        table("part")
        .filter("p_name NOT LIKE 'red %'")
        .selectExpr(
            "replace(p_name, ' ', '_') AS product_category_name",
            "upper(p_name) AS product_category_name_english",
        )
        .distinct()
    )


def _customers(table: Table) -> DataFrame:
    customer, nation = table("customer"), table("nation")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).selectExpr(
        "c_custkey AS customer_id", "n_name AS customer_state"
    )


def _sellers(table: Table) -> DataFrame:
    supplier, nation = table("supplier"), table("nation")
    return supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).selectExpr(
        "s_suppkey AS seller_id", "s_name AS seller_city", "n_name AS seller_state"
    )


def _reviews(table: Table) -> DataFrame:
    return table("events").selectExpr(
        "shiftright(event_id, 1) * 3 AS order_id",
        "if(event_type <=> 'error', 'n/a', string(floor(value) % 5 + 1)) AS review_score",
    )


def _payments(table: Table) -> DataFrame:
    return table("lineitem").selectExpr(
        "l_orderkey AS order_id",
        f"{rounded_sql('(l_extendedprice * (1 - l_discount))', 2)} AS payment_value",
        "l_linenumber AS payment_installments",
    )


def _geolocation(table: Table) -> DataFrame:
    return table("customer").selectExpr(
        "c_custkey AS geolocation_zip_code_prefix", "c_nationkey AS geolocation_state"
    )


def _raw_payments(table: Table) -> DataFrame:
    return table("lineitem").selectExpr(
        "string(l_orderkey) AS order_id",
        "CASE WHEN (l_orderkey * 7 + l_linenumber) % 5003 = 0 THEN 'not paid' "
        "WHEN (l_orderkey * 7 + l_linenumber) % 4001 = 0 THEN NULL "
        "ELSE string(CAST(l_extendedprice AS DECIMAL(18,2))) END AS payment_value",
        "string(l_linenumber) AS payment_installments",
    )


def _raw_reviews(table: Table) -> DataFrame:
    return _reviews(table).selectExpr("string(order_id) AS order_id", "review_score")


def _raw_order_items(table: Table) -> DataFrame:
    return table("lineitem").selectExpr(
        "string(l_orderkey) AS order_id",
        "string(l_linenumber) AS order_item_id",
        "string(l_partkey) AS product_id",
        "string(l_suppkey) AS seller_id",
        "CASE WHEN (l_orderkey * 5 + l_linenumber) % 4507 = 0 THEN 'R$ 12,50' "
        "ELSE string(CAST(l_extendedprice AS DECIMAL(18,2))) END AS price",
        "string(CAST(l_tax AS DECIMAL(18,2))) AS freight_value",
    )


def _damaged_payments(table: Table) -> DataFrame:
    """Lines of a raw file, some without a cell, with one too many, or with a quote left open."""
    kind = "(l_orderkey * 7 + l_linenumber) % 1009"
    value = "string(CAST(l_extendedprice AS DECIMAL(18,2)))"
    return table("lineitem").selectExpr(
        f"CASE {kind} WHEN 0 THEN concat_ws(',', l_orderkey, {value}) "
        f"WHEN 1 THEN concat_ws(',', l_orderkey, {value}, l_linenumber, 'again') "
        f"WHEN 2 THEN concat(l_orderkey, ',', {value}, ',\"', l_linenumber) "
        f"WHEN 3 THEN concat(l_orderkey, ',\"', {value}, ',', l_linenumber) "
        f"WHEN 4 THEN concat(l_orderkey, ',\"', {value}, ',', l_linenumber, '\",1') "
        f"ELSE concat_ws(',', l_orderkey, {value}, l_linenumber) END AS line"
    )


def _damaged_reviews(table: Table) -> DataFrame:
    """Records of free text with quotes and line breaks, some without a cell or with one too many."""
    text = "concat('\"', replace(text, '\"', '\"\"'), '\"')"
    return table("documents").where("text IS NOT NULL").selectExpr(
        f"CASE doc_id % 97 WHEN 0 THEN concat_ws(',', doc_id, 4) WHEN 1 THEN concat_ws(',', doc_id, 4, {text}, {text}) "
        f"ELSE concat_ws(',', doc_id, 4, {text}) END AS line"
    )


#: Raw files with damaged records: the dataset's header and its lines.
DAMAGED: Mapping[str, tuple[str, Callable[[Table], DataFrame]]] = {
    "payments": ("order_id,payment_value,payment_installments", _damaged_payments),
    "reviews": ("order_id,review_score,review_comment_message", _damaged_reviews),
}


class StarDatasets(Mapping[str, DataFrame]):
    """The nine datasets by logical name, each opened when it is asked for."""

    _views: Mapping[str, Callable[[Table], DataFrame]] = {
        "orders": _orders,
        "order_items": _order_items,
        "products": _products,
        "customers": _customers,
        "sellers": _sellers,
        "reviews": _reviews,
        "payments": _payments,
        "geolocation": _geolocation,
        "category": _category,
    }

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder
        self._opened: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
        return self._opened[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self._views[name](self._table)

    def __iter__(self) -> Iterator[str]:
        return iter(self._views)

    def __len__(self) -> int:
        return len(self._views)


class RawTexts(StarDatasets):
    """The three datasets with numbers to check as the text a raw file holds, some malformed."""

    _views: Mapping[str, Callable[[Table], DataFrame]] = {
        "payments": _raw_payments,
        "reviews": _raw_reviews,
        "order_items": _raw_order_items,
    }


def damaged_lines(spark: SparkSession, folder: str, name: str) -> tuple[str, DataFrame]:
    """The header and the lines of a damaged raw file."""
    header, lines = DAMAGED[name]
    return header, lines(lambda table: spark.read.parquet(f"{folder}/{table}.parquet"))


def star_datasets(spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    return StarDatasets(spark, folder)
