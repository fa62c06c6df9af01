"""Physical plans: what reaches the scan, what is left out, how top-k runs."""

import contextlib
import io

import pytest
from conftest import SF_SMALL

from bazaarlens.plans import features, reports
from bazaarlens.plans.queries import QUERIES
from bazaarlens.sources.star import star_datasets


def formatted(frame):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


def test_filter_and_columns_reach_the_parquet_scan(spark):
    rows = QUERIES["scan_parquet"](spark, SF_SMALL).filter("l_quantity >= 25")
    plan = formatted(rows.select("l_orderkey", "l_linenumber", "l_extendedprice"))
    assert "GreaterThanOrEqual(l_quantity,25.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double," in plan
    assert "l_tax" not in plan


def test_status_filter_reaches_the_scan_through_the_view(spark):
    plan = formatted(QUERIES["clean_orders"](spark, SF_SMALL))
    assert "EqualNullSafe(o_orderstatus,F)" in plan
    assert "o_totalprice" not in plan


def test_seller_table_reads_neither_payments_nor_customers_nor_products(spark):
    plan = formatted(features.seller_features(star_datasets(spark, SF_SMALL)))
    for unused in ("l_discount", "customer.parquet", "part.parquet"):
        assert unused not in plan


def test_order_table_joins_only_order_grain_inputs(spark):
    plan = formatted(features.order_features(star_datasets(spark, SF_SMALL)))
    assert plan.count("lineitem.parquet") == 2  # items and payments, each aggregated first
    assert "explode" not in plan and "customer.parquet" not in plan


@pytest.mark.parametrize(
    "name", ["bad_sellers", "high_risk_sellers", "top10_categories", "late_states"]
)
def test_rankings_with_a_limit_never_sort_everything(spark, name):
    plan = formatted(QUERIES[name](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_threshold_is_pushed_to_a_stored_feature_table(spark, golden, tmp_path):
    features.seller_features(golden).write.parquet(str(tmp_path / "sellers"))
    stored = spark.read.parquet(str(tmp_path / "sellers"))
    assert "GreaterThanOrEqual(seller_total_orders,10)" in formatted(reports.bad_sellers(stored))


def test_master_features_use_hash_aggregation_on_the_rows(spark, golden):
    from bazaarlens.plans.master import build_master

    tables = features.features_from_master(build_master(golden))
    plan = formatted(tables["seller_features"])
    first = plan.index("HashAggregate")
    assert first >= 0 and plan.count("SortAggregate (") <= 2
