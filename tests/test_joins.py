"""Skewed joins: exact results and spread work, by one plan at every size."""

import contextlib
import io
import re

import pytest
from conftest import multiset
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.operators.joins import left_join_many, marked_rows
from bazaarlens.plans.features import seller_features_window
from bazaarlens.plans.master import build_master

ROWS = 60_000


def final_plan(frame):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain()
    return out.getvalue().split("== Initial Plan ==")[0]


def mixed(salt, hot, other, keys):
    """A third of the rows on one key, the others spread."""
    draw = F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(3 * keys))
    name = F.concat(F.lit(other), F.pmod(draw, F.lit(keys)).cast("string"))
    return F.when(draw < keys, F.lit(hot)).otherwise(name)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Datasets where one order, product, seller and customer hold a third each."""
    root = str(tmp_path_factory.mktemp("skewed"))
    noon = "CAST('2018-01-01 12:00:00' AS TIMESTAMP_NTZ)"
    spark.range(0, ROWS, 1, 16).select(
        mixed("o", "o7", "o", 5000).alias("order_id"),
        mixed("p", "p3", "p", 900).alias("product_id"),
        mixed("s", "s3", "s", 300).alias("seller_id"),
        (F.col("id") % 100).cast("double").alias("price"),
        F.lit(1.0).alias("freight_value"),
    ).write.parquet(f"{root}/items")
    items = spark.read.parquet(f"{root}/items")
    return {
        "orders": spark.range(0, 8000, 1, 8).select(
            F.concat(F.lit("o"), F.col("id").cast("string")).alias("order_id"),
            mixed("c", "c1", "c", 8000).alias("customer_id"),
            F.lit("delivered").alias("order_status"),
            F.expr(f"{noon} AS order_purchase_timestamp"),
            F.expr(f"{noon} AS order_delivered_customer_date"),
            F.expr(f"{noon} AS order_estimated_delivery_date"),
        ),
        "order_items": items,
        "products": spark.range(900).selectExpr(
            "concat('p', id) AS product_id", "concat('n', id % 50) AS product_category_name"
        ),
        "category": spark.range(40).selectExpr(
            "concat('n', id) AS product_category_name",
            "concat('e', id) AS product_category_name_english",
        ),
        "customers": spark.range(8000).selectExpr(
            "concat('c', id) AS customer_id", "concat('st', id % 27) AS customer_state"
        ),
        "sellers": spark.range(300).selectExpr(
            "concat('s', id) AS seller_id", "'x' AS seller_city", "'y' AS seller_state"
        ),
        "payments": items.selectExpr(
            "order_id", "price AS payment_value", "1 AS payment_installments"
        ),
        "reviews": items.selectExpr("order_id", "'4' AS review_score"),
    }


def shuffle_only(settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
    )


def largest_share(frame):
    sizes = [r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def test_hot_keys_are_spread_and_no_row_is_lost(skewed, settings):
    shuffle_only(settings)
    orders, items = skewed["orders"].select("order_id"), skewed["order_items"]
    plain = orders.join(items, on="order_id", how="left")
    spread = left_join_many(orders, items, "order_id")
    assert largest_share(plain) > 0.33
    assert largest_share(spread) < 0.2
    assert multiset(spread.groupBy(*items.columns).count()) == multiset(
        plain.groupBy(*items.columns).count()
    )


def test_every_large_join_of_master_splits_its_hot_key(skewed, settings):
    shuffle_only(settings)
    master = build_master(skewed)
    rows = master.collect()
    plan = final_plan(master)
    for key in ("order_id", "customer_id", "product_id", "seller_id"):
        # The join of orders and items matches null keys too, and so shuffles by coalesce(key).
        assert re.search(rf"SortMergeJoin\(skew=true\) \[(coalesce\()?{key}", plan), key
    assert len(rows) == ROWS + 8000 - skewed["order_items"].select("order_id").distinct().count()


def test_seller_means_are_joined_back_in_parts(skewed, settings):
    shuffle_only(settings)
    rows = seller_features_window(skewed)
    rows.collect()
    assert "SortMergeJoin(skew=true)" in final_plan(rows)


def test_no_action_runs_while_a_plan_is_built(skewed, monkeypatch):
    def refuse(self):
        raise AssertionError("an action ran while the plan was built")

    monkeypatch.setattr(DataFrame, "count", refuse)
    monkeypatch.setattr(DataFrame, "collect", refuse)
    build_master(skewed)


keys = st.lists(st.sampled_from(["a", "b", "c", "d", None]), max_size=12)


@hypothesis_settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(one=keys, many=keys)
def test_equals_the_plain_left_join(spark, one, many):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(one)], "k string, x int")
    right = spark.createDataFrame([(k, i) for i, k in enumerate(many)], "k string, y int")
    right = right.repartition(3)
    assert multiset(left_join_many(left, right, "k")) == multiset(
        left.join(right, on="k", how="left")
    )


@pytest.mark.parametrize("key", ["id", "int(id) AS id", "concat('k', id) AS id"])
def test_marked_rows_lack_no_match_and_few_others(spark, key):
    rows = spark.range(0, 40_000, 1, 4).selectExpr(key, "id AS n").union(spark.range(1).selectExpr("NULL", "-1L"))
    wanted = rows.where("n % 4 = 0 OR n < 0")
    found = marked_rows(rows, "id", wanted)
    assert found.join(wanted, "id", "left_semi").count() == 10_000
    assert found.count() < 10_100


def test_keys_of_other_types_are_left_to_the_join(spark):
    rows = spark.range(9)
    for kind in ("string", "double", "decimal(9,0)"):
        wanted = rows.select(F.col("id").cast(kind))
        assert marked_rows(rows, "id", wanted) is rows
    doubles = rows.select(F.col("id").cast("double"))
    assert marked_rows(doubles, "id", doubles) is doubles


def test_rows_of_orders_that_are_not_kept_are_not_shuffled(skewed, settings):
    shuffle_only(settings)
    data = {**skewed, "orders": skewed["orders"].withColumn("order_status", F.expr("if(order_id = 'o1', 'delivered', 'shipped')"))}
    master = build_master(data)
    items = data["order_items"].where("order_id = 'o1'").count()
    assert len(master.collect()) == max(items, 1)
    # Items stand there twice: as rows, and as the keys that orders lack.
    assert final_plan(master).count("LeftSemi") >= 3
