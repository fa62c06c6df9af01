"""Data quality profiles: values that should be numbers, and table shapes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.numeric import is_not_number

# The columns that must hold numbers.
NUMERIC_COLUMNS = {
    "payments": "payment_value",
    "reviews": "review_score",
    "order_items": "price",
}

# The columns that must be unique.
UNIQUE_KEYS = {
    "orders": "order_id",
    "products": "product_id",
    "customers": "customer_id",
    "sellers": "seller_id",
    "category": "product_category_name",
}


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for other in frames[1:]:
        result = result.unionByName(other)
    return result


def bad_values(raw: Mapping[str, DataFrame], first: int = 5) -> DataFrame:
    """The first rows, by order and value, whose number is missing or malformed.

    ``whole_row`` is the row as one JSON text.
    """
    return _union(
        [
            raw[name]
            .filter(is_not_number(column))
            .select(
                F.lit(name).alias("dataset"),
                F.lit(column).alias("column_name"),
                F.col("order_id").cast("string").alias("order_id"),
                F.col(column).cast("string").alias("value"),
                F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("whole_row"),
            )
            .orderBy(
                F.asc_nulls_last("order_id"), F.asc_nulls_last("value"), F.asc_nulls_last("whole_row")
            )
            .limit(first)
            for name, column in NUMERIC_COLUMNS.items()
        ]
    )


def bad_value_counts(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Rows in all, and rows whose number is missing or malformed, per dataset."""
    return _union(
        [
            raw[name]
            .agg(
                F.count(F.lit(1)).alias("total_rows"),
                F.count_if(is_not_number(column)).alias("bad_rows"),
            )
            .select(
                F.lit(name).alias("dataset"),
                F.lit(column).alias("column_name"),
                "total_rows",
                "bad_rows",
            )
            for name, column in NUMERIC_COLUMNS.items()
        ]
    )


def _flaw() -> Column:
    """What is wrong with a record; null if it has a cell for each column."""
    return F.expr(
        "CASE WHEN cells IS NULL THEN 'unclosed quote' WHEN cells < expected THEN 'too few cells' "
        "WHEN cells > expected THEN 'too many cells' END"
    )


def broken_records(records: Mapping[str, DataFrame]) -> DataFrame:
    """Every record that does not have one cell for each column of its file, as it stands there.

    ``records`` has, by dataset, frames with ``record``, ``cells`` and ``expected``.
    """
    return _union(
        [
            frame.withColumn("reason", _flaw())
            .filter("reason IS NOT NULL")
            .select(F.lit(name).alias("dataset"), "reason", "cells", "expected", "record")
            for name, frame in records.items()
        ]
    )


def broken_record_counts(records: Mapping[str, DataFrame]) -> DataFrame:
    """Records in all and the broken ones by what is wrong, per dataset."""
    return _union(
        [
            frame.withColumn("reason", _flaw())
            .agg(
                F.count(F.lit(1)).alias("total_records"),
                F.count_if(F.col("reason") == "too few cells").alias("too_few_cells"),
                F.count_if(F.col("reason") == "too many cells").alias("too_many_cells"),
                F.count_if(F.col("reason") == "unclosed quote").alias("unclosed_quotes"),
            )
            .select(F.lit(name).alias("dataset"), "*")
            for name, frame in records.items()
        ]
    )


def duplicate_keys(data: Mapping[str, DataFrame]) -> DataFrame:
    """Keys that stand on several rows of the dataset they should identify one row of.

    Joins with such a dataset repeat rows, and plans that leave a lookup out do not.
    """
    return _union(
        [
            data[name]
            .filter(F.col(key).isNotNull())
            .groupBy(F.col(key).cast("string").alias("key_value"))
            .agg(F.count(F.lit(1)).alias("row_count"))
            .filter("row_count > 1")
            .select(F.lit(name).alias("dataset"), F.lit(key).alias("key_column"), "*")
            for name, key in UNIQUE_KEYS.items()
        ]
    )


def table_schemas(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of each table in order: type, rows with a value, and rows in all."""

    def profile(name: str, table: DataFrame) -> DataFrame:
        fields = table.schema.fields
        counts = [F.count(F.col(f.name)).alias(f"c{i}") for i, f in enumerate(fields)]
        columns = F.array(
            *(
                F.struct(
                    F.lit(name).alias("table_name"),
                    F.lit(i + 1).alias("position"),
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                    F.col(f"c{i}").alias("non_null_rows"),
                    F.col("total_rows"),
                )
                for i, f in enumerate(fields)
            )
        )
        return table.agg(*counts, F.count(F.lit(1)).alias("total_rows")).select(F.inline(columns))

    return _union([profile(name, table) for name, table in tables.items()])
