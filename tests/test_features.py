"""Feature tables: known results, the two ways of building them, invariants."""

import pytest
from conftest import SF_CHECK, multiset
from pyspark.sql import Window
from pyspark.sql import functions as F

from bazaarlens.operators.repeats import repeated_keys
from bazaarlens.plans import features
from bazaarlens.plans.master import build_master
from bazaarlens.sources.star import star_datasets

THIRD = pytest.approx(1 / 3)


def direct(data):
    return {
        "order_features": features.order_features(data),
        "seller_features": features.seller_features(data),
        "category_features": features.category_features(data),
        "customer_features": features.customer_features(data),
    }


@pytest.fixture(params=["from_master", "direct"])
def tables(request, golden):
    if request.param == "direct":
        return direct(golden)
    return features.features_from_master(build_master(golden))


def by_key(frame):
    return {row[0]: tuple(row)[1:] for row in frame.collect()}


def test_order_features(tables):
    assert by_key(tables["order_features"]) == {
        "o1": (150.0, 15.0, 2, 4.5, 2.0, 1.0, 165.0),
        "o2": (100.0, 12.0, 1, None, 0.0, 0.0, 112.0),
        "o3": (30.0, 3.0, 1, 3.0, -15.0, 0.0, 33.0),
        "o6": (None, None, 0, 1.0, 10.0, 1.0, 80.0),
        "o7": (20.0, 2.0, 1, None, None, 0.0, None),
    }


def test_seller_features(tables):
    assert by_key(tables["seller_features"]) == {
        "s1": ("campinas", "SP", 4.5, THIRD, 3, pytest.approx(220 / 3)),
        "s2": ("curitiba", "PR", 3.75, 0.5, 2, 40.0),
        None: (None, None, 1.0, 1.0, 1, None),
    }


def test_category_features(tables):
    assert by_key(tables["category_features"]) == {
        "health_beauty": (100.0, 4.5, 2, 0.5),
        "bed_bath_table": (50.0, 4.5, 1, 1.0),
        None: (25.0, 2.0, 3, THIRD),
    }


def test_customer_features(tables):
    assert by_key(tables["customer_features"]) == {
        "SP": (4, 121.0, 0.5),
        "RJ": (1, 112.0, 0.0),
        "AL": (1, 80.0, 1.0),
    }


def test_types_are_those_of_the_plain_aggregates(tables):
    kinds = {f: t for table in tables.values() for f, t in table.dtypes}
    assert kinds["order_item_count"] == kinds["seller_total_orders"] == "bigint"
    assert {kinds[c] for c in kinds if "avg" in c or "rate" in c or "payment" in c} == {"double"}


def test_window_form_equals_real_windows(golden):
    seller = Window.partitionBy("seller_id")
    windows = build_master(golden).select(
        "order_id",
        "product_id",
        "seller_id",
        F.avg("avg_review_score").over(seller).alias("seller_avg_review"),
        F.avg("is_late").over(seller).alias("seller_late_rate"),
        F.count("order_id").over(seller).alias("seller_total_orders"),
        F.avg("price").over(seller).alias("seller_avg_price"),
    )
    assert multiset(features.seller_features_window(golden)) == multiset(windows)


def test_both_ways_agree_on_larger_data(spark):
    data = star_datasets(spark, SF_CHECK)
    from_master = features.features_from_master(build_master(data))
    for name, table in direct(data).items():
        assert multiset(table) == multiset(from_master[name]), name


def test_one_pass_over_sellers_and_products_serves_both_tables(spark):
    data = star_datasets(spark, SF_CHECK)
    tables = features.report_tables(data)
    assert multiset(tables["sellers"]) == multiset(features.seller_features(data))
    assert multiset(tables["categories"]) == multiset(features.category_features(data))


def test_invariants(spark):
    data = star_datasets(spark, SF_CHECK)
    master = build_master(data).cache()
    tables = features.features_from_master(master)
    rows = master.count()

    def total(table, column):
        return tables[table].agg(F.sum(column)).first()[0]

    assert total("seller_features", "seller_total_orders") == rows
    assert total("category_features", "category_total_orders") == rows
    assert total("customer_features", "state_total_orders") == rows
    itemless = master.filter("product_id IS NULL").count()
    assert total("order_features", "order_item_count") == rows - itemless
    assert tables["order_features"].count() == master.select("order_id").distinct().count()
    assert {r[0] for r in master.select("is_late").distinct().collect()} == {0, 1}
    late = tables["order_features"].select("order_is_late").distinct().collect()
    assert {r[0] for r in late} == {0.0, 1.0}
    master.unpersist()


def test_missing_order_ids_count_as_rows_but_not_as_orders(spark, golden):
    data = dict(golden)
    nameless = golden["orders"].filter("order_id = 'o6'").selectExpr(
        "CAST(NULL AS STRING) AS order_id", "* EXCEPT (order_id)"
    )
    data["orders"] = golden["orders"].unionByName(nameless)
    from_master = features.features_from_master(build_master(data))
    for name, table in direct(data).items():
        assert multiset(table) == multiset(from_master[name]), name
    assert by_key(from_master["customer_features"])["AL"][0] == 1


def weighted(data):
    copies = repeated_keys(data)
    tables = features.report_tables(data, copies)
    return {
        "order_features": [features.order_features(data, copies)],
        "seller_features": [features.seller_features(data, copies=copies), tables["sellers"]],
        "category_features": [features.category_features(data, copies=copies), tables["categories"]],
        "customer_features": [features.customer_features(data, copies), tables["states"]],
    }


@pytest.mark.parametrize("name", ["orders", "customers", "products", "sellers", "category", "all", "none"])
def test_repeated_keys_count_as_often_as_in_master(golden, name):
    data = dict(golden)
    for each in ("orders", "customers", "products", "sellers", "category"):
        if name in (each, "all"):
            rows = golden[each]
            data[each] = rows.union(rows).union(rows.limit(1))
    master = build_master(data)
    from_master = features.features_from_master(master)
    for table, found in weighted(data).items():
        for frame in found:
            assert multiset(frame) == multiset(from_master[table]), table
    window = features.seller_features_window(data, repeated_keys(data))
    means = from_master["seller_features"].drop("seller_city", "seller_state")
    beside = master.select("order_id", "product_id", "seller_id").alias("m").join(
        means.withColumnRenamed("seller_id", "mean_of"), F.expr("seller_id <=> mean_of")
    )
    assert multiset(window) == multiset(beside.drop("mean_of"))


def test_orders_with_one_key_and_other_customers_weigh_by_their_customers(golden):
    data = dict(golden)
    other = golden["orders"].where("order_id = 'o1'").withColumns(
        {"customer_id": F.lit("c2"), "order_delivered_customer_date": F.expr("order_delivered_customer_date - INTERVAL 9 DAY")}
    )
    data["orders"] = golden["orders"].union(other)
    data["customers"] = golden["customers"].union(golden["customers"].where("customer_id = 'c2'"))
    data["payments"] = golden["payments"].where("order_id <> 'o1'")
    from_master = features.features_from_master(build_master(data))
    for table, found in weighted(data).items():
        for frame in found:
            assert multiset(frame) == multiset(from_master[table]), table
