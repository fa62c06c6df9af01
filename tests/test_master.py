"""Master over the nine-order fixture."""

from conftest import multiset

from bazaarlens.operators.cleaning import clean_orders, payment_agg, review_agg, with_delivery
from bazaarlens.plans.master import MASTER_COLUMNS, build_master


def test_only_delivered_orders_with_known_times_are_kept(golden):
    kept = {r.order_id for r in clean_orders(golden["orders"]).collect()}
    assert kept == {"o1", "o2", "o3", "o6", "o7"}


def test_delay_counts_calendar_days_and_unknown_is_not_late(golden):
    rows = with_delivery(clean_orders(golden["orders"])).collect()
    found = {r.order_id: (r.delivery_delay_days, r.is_late) for r in rows}
    assert found == {"o1": (2, 1), "o2": (0, 0), "o3": (-15, 0), "o6": (10, 1), "o7": (None, 0)}


def test_order_aggregates(golden):
    paid = {r.order_id: (r.total_payment, r.avg_installments) for r in payment_agg(golden["payments"]).collect()}
    assert paid == {"o1": (165.0, 1.5), "o2": (112.0, 3.0), "o3": (33.0, 1.0), "o6": (80.0, 4.0)}
    score = {r.order_id: r.avg_review_score for r in review_agg(golden["reviews"]).collect()}
    assert score == {"o1": 4.5, "o3": 3.0, "o6": 1.0}


def test_master_rows(golden):
    master = build_master(golden)
    assert tuple(master.columns[: len(MASTER_COLUMNS)]) == MASTER_COLUMNS
    rows = master.select(
        "order_id", "product_id", "seller_id", "price", "product_category_name_english",
        "customer_state", "seller_city", "total_payment", "avg_review_score", "is_late",
    )
    found = sorted(map(tuple, rows.collect()), key=lambda r: (r[0], str(r[1])))
    assert found == [
        ("o1", "p1", "s1", 100.0, "health_beauty", "SP", "campinas", 165.0, 4.5, 1),
        ("o1", "p2", "s2", 50.0, "bed_bath_table", "SP", "curitiba", 165.0, 4.5, 1),
        ("o2", "p1", "s1", 100.0, "health_beauty", "RJ", "campinas", 112.0, None, 0),
        ("o3", "p3", "s2", 30.0, None, "SP", "curitiba", 33.0, 3.0, 0),
        ("o6", None, None, None, None, "AL", None, 80.0, 1.0, 1),
        ("o7", "p4", "s1", 20.0, None, "SP", "campinas", None, None, 0),
    ]


def test_other_columns_are_carried_along(golden):
    data = dict(golden)
    data["sellers"] = golden["sellers"].selectExpr("*", "'01037' AS seller_zip")
    master = build_master(data)
    assert master.columns[-1] == "seller_zip"
    assert {r.seller_zip for r in master.collect()} == {"01037", None}


def test_duplicate_lookup_rows_fan_out_like_a_join(golden):
    data = dict(golden)
    data["sellers"] = golden["sellers"].union(golden["sellers"])
    assert build_master(data).count() == 11
    assert multiset(build_master(data).distinct()) == multiset(build_master(golden))
