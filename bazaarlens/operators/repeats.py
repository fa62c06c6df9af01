"""Repeated keys of lookups as weights, for plans that leave a lookup out.

Master joins customers, products and sellers, and a key that stands twice in one of them
repeats its rows. A plan without such a join gets the same numbers if it counts a row as often
as the join would have repeated it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.operators.cleaning import translate_products
from bazaarlens.sources.storage import materialize

#: By key column, the keys with several rows, and their number in ``<key>_copies``.
Copies = Mapping[str, DataFrame]


def repeated_keys(data: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The repeated keys of the lookups of master, each written once.

    A product has as many rows as its translations, so repeated category names count with it.
    A null key finds nothing in a join, so it is not among them.
    """
    looked_up = {
        "customer_id": data["customers"],
        "product_id": translate_products(data["products"], data["category"]),
        "seller_id": data["sellers"],
    }
    return {key: materialize(_repeated(rows, key), f"repeated-{key}") for key, rows in looked_up.items()}


def _repeated(rows: DataFrame, key: str) -> DataFrame:
    counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(f"{key}_copies"))
    return counted.where(f"{key}_copies > 1")


def with_copies(rows: DataFrame, copies: Copies | None) -> DataFrame:
    """Rows with the number of copies beside each key they have; null stands for one."""
    for key in copies or ():
        if key in rows.columns:
            rows = rows.join(copies[key], on=key, how="left")
    return rows


def weight_of(copies: Copies | None) -> str:
    """The rows that a row stands for, as an expression over the columns of :func:`with_copies`."""
    return " * ".join(f"coalesce({key}_copies, 1)" for key in copies or ()) or "1"


def left_out(copies: Copies | None, *joined: str) -> Copies | None:
    """The copies of lookups that are not joined."""
    return copies and {key: frame for key, frame in copies.items() if key not in joined}
