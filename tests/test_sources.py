"""CSV edge cases, parquet and catalog round trips, working folders."""

import shutil

import pytest
from conftest import multiset

from bazaarlens.__main__ import run_refresh
from bazaarlens.operators import quality
from bazaarlens.plans.refresh import latest
from bazaarlens.sources import scratch, storage
from bazaarlens.sources.datasets import DATASETS, read_dataset, read_datasets, read_records

FILES = {
    "x_orders_dataset.csv": (
        "order_id,customer_id,order_status,order_purchase_timestamp,"
        "order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2018-01-01 10:00:00,2018-01-10 18:00:00,2018-01-08 00:00:00\n"
        "o2,c2,delivered,not a time,,2018-01-09 00:00:00\n"
    ),
    "x_order_items_dataset.csv": (
        "order_id,order_item_id,product_id,seller_id,price,freight_value\n"
        "o1,1,p1,s1,100.5,10\no1,2,p2,s2,bad,\no2,1,p1,s1,NaN,1e1\n"
    ),
    "x_products_dataset.csv": "product_id,product_category_name\np1,beleza_saude\np2,\n",
    "x_customers_dataset.csv": (
        "customer_id,customer_zip_code_prefix,customer_state\nc1,01037,SP\nc2,22000,RJ\n"
    ),
    "x_sellers_dataset.csv": "seller_id,seller_city,seller_state\ns1,campinas,SP\ns2,curitiba,PR\n",
    "x_order_reviews_dataset.csv": (
        "review_id,order_id,review_score,review_comment_message\n"
        'r1,o1,4,"first line\nsecond ""quoted"", line"\nr2,o1,oops,\nr3,o2, 5 ,fine\n'
    ),
    "x_order_payments_dataset.csv": (
        "order_id,payment_installments,payment_value\no1,2,100.25\no1,1,x\no2,3,5\n"
    ),
    "x_geolocation_dataset.csv": "geolocation_zip_code_prefix,lat.deg\n01037,-23.5\n",
    "product_category_name_translation.csv": (
        "﻿product_category_name,product_category_name_english\nbeleza_saude,health_beauty\n"
    ),
}


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for name, text in FILES.items():
        (folder / name).write_text(text, encoding="utf-8", newline="")
    return str(folder)


def test_every_dataset_is_found_and_counted(spark, raw):
    data = read_datasets(spark, raw)
    assert set(data) == set(DATASETS)
    counts = {r.dataset: r.row_count for r in storage.row_counts(data, "dataset").collect()}
    assert counts == {
        "orders": 2, "order_items": 3, "products": 2, "customers": 2, "sellers": 2,
        "reviews": 3, "payments": 3, "geolocation": 1, "category": 1,
    }


def test_byte_order_mark_is_not_part_of_the_first_name(spark, raw):
    assert read_dataset(spark, raw, "category").columns[0] == "product_category_name"


def test_bad_and_empty_cells_become_null_and_others_keep_their_value(spark, raw):
    prices = read_dataset(spark, raw, "order_items").select("price", "freight_value").collect()
    assert [tuple(r) for r in prices] == [(100.5, 10.0), (None, None), (None, 10.0)]
    orders = read_dataset(spark, raw, "orders")
    assert dict(orders.dtypes)["order_purchase_timestamp"] == "timestamp_ntz"
    assert [r.order_purchase_timestamp is None for r in orders.collect()] == [False, True]


def test_leading_zeros_survive(spark, raw):
    zips = {r.customer_zip_code_prefix for r in read_dataset(spark, raw, "customers").collect()}
    assert zips == {"01037", "22000"}


def test_quoted_line_breaks_and_quotes_stay_inside_their_cell(spark, raw):
    rows = read_dataset(spark, raw, "reviews").orderBy("review_id").collect()
    assert [r.review_score for r in rows] == ["4", "oops", " 5 "]
    assert rows[0].review_comment_message == 'first line\nsecond "quoted", line'


def test_a_file_with_other_columns_fails(spark, tmp_path):
    folder = tmp_path / "x_sellers_dataset.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("seller_id,seller_city,seller_state\ns1,campinas,SP\n")
    assert read_dataset(spark, str(tmp_path), "sellers").count() == 1
    (folder / "b.csv").write_text("seller_state,seller_id,seller_city\nIT,s2,rome\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_dataset(spark, str(tmp_path), "sellers").collect()


def test_files_with_other_headers_are_united_by_name(spark, tmp_path):
    folder = tmp_path / "x_sellers_dataset.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("seller_id,seller_city,seller_state\ns1,campinas,SP\n")
    (folder / "b.csv").write_text("\ufeffseller_state,seller_id,seller_city\nIT,s2,rome\nFR,s3,\n", encoding="utf-8")
    (folder / "c.csv").write_text("seller_id,seller_zip,seller_city,seller_state\ns4,00100,lima,PE\n")
    (folder / "d e.csv").write_text("seller_id,seller_city,seller_state\ns5,oslo,NO\n")
    found = read_dataset(spark, str(tmp_path), "sellers", mixed_headers=True)
    assert sorted(tuple(r) for r in found.select("seller_id", "seller_city", "seller_state", "seller_zip").collect()) == [
        ("s1", "campinas", "SP", None), ("s2", "rome", "IT", None), ("s3", None, "FR", None),
        ("s4", "lima", "PE", "00100"), ("s5", "oslo", "NO", None),
    ]
    for text, message in (
        ("seller_id,city,seller_state\ns6,x,y\n", "lacks"), ("seller_id,seller_city,seller_state,seller_id\n", "twice"), ("", "lacks"),
    ):
        (folder / "e.csv").write_text(text)
        with pytest.raises(ValueError, match=message):
            read_dataset(spark, str(tmp_path), "sellers", mixed_headers=True)


def test_two_publishers_fail(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}_sellers_dataset.csv").write_text("seller_id\ns1\n")
    with pytest.raises(ValueError, match="several files"):
        read_dataset(spark, str(tmp_path), "sellers")


def test_raw_reading_keeps_the_text(spark, raw):
    text = read_dataset(spark, raw, "order_items", raw=True)
    assert {t for _, t in text.dtypes} == {"string"}
    assert [r.price for r in text.collect()] == ["100.5", "bad", "NaN"]


BROKEN = {
    "x_order_payments_dataset.csv": (
        'order_id,payment_installments,payment_value\no1,2,100.25\no2,1\no3,1,2,3\no4,1,"5\no5,"1,5\n\no6,"1","a,b"\n'
        'o7,a"b,5\no8,"c"d,5\no9,"e\\"f,g",5\n,,\no10,1,"5\\"\n'
    ),
    "x_order_reviews_dataset.csv": (
        'review_id,order_id,review_score\nr1,o1,4\nr2,o2,"two\nlines, ""quoted"""\nr3,""\nr4,o4,4,"",5\nr5,o5,"""\n'
        + '""x" \nr6,o6,"never ""closed\nr7,o7,5\n'
    ),
    "x_sellers_dataset.csv": "seller_id,seller_city,seller_state\n" + 's1,"' + '""' * 50_000 + '",SP\n' + "s2," + '"' * 40_001 + ',SP\n"one cell"\ns3,"' + "x" * 50_000 + ",SP\n",
}


def test_broken_records_are_found_as_they_stand(spark, tmp_path):
    for name, text in BROKEN.items():
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    records = {name: read_records(spark, str(tmp_path), name) for name in ("payments", "reviews", "sellers")}
    rows = {(r.dataset, r.record): (r.reason, r.cells, r.expected) for r in quality.broken_records(records).collect()}
    assert {k: v for k, v in rows.items() if k[0] == "payments"} == {
        ("payments", "o2,1"): ("too few cells", 2, 3),
        ("payments", "o3,1,2,3"): ("too many cells", 4, 3),
        ("payments", 'o4,1,"5'): ("unclosed quote", None, 3),
        ("payments", 'o5,"1,5'): ("unclosed quote", None, 3),
        ("payments", 'o10,1,"5\\"'): ("unclosed quote", None, 3),
    }
    assert {k[1].split(",")[0]: v[0] for k, v in rows.items() if k[0] == "reviews"} == {
        "r3": "too few cells", "r4": "too many cells", "r6": "unclosed quote",
    }
    assert [k[1].split("\n")[-1] for k in rows if k[1].startswith("r6")] == ["r7,o7,5"]
    # In a plain file the first of two quotes closes a cell.
    assert sorted((k[1][:3], v) for k, v in rows.items() if k[0] == "sellers") == [
        ("one", ("too few cells", 1, 3)), ("s3,", ("unclosed quote", None, 3)),
    ]
    counts = {r.dataset: tuple(r)[1:] for r in quality.broken_record_counts(records).collect()}
    assert counts == {"payments": (11, 1, 1, 3), "reviews": (6, 1, 1, 1), "sellers": (4, 1, 0, 1)}


def test_broken_records_stay_or_go_whichever_columns_are_read(spark, tmp_path):
    for name, text in BROKEN.items():
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    kept = read_dataset(spark, str(tmp_path), "payments")
    whole = read_dataset(spark, str(tmp_path), "payments", drop_broken=True)
    assert {r.order_id for r in kept.select("order_id").collect()} - {r.order_id for r in whole.select("order_id").collect()} == {
        "o2", "o3", "o5",
    }
    assert kept.count() == 11 and whole.count() == 8


def test_a_refresh_sets_broken_records_aside(spark, raw, tmp_path):
    records = {name: read_records(spark, raw, name) for name in DATASETS}
    assert quality.broken_records(records).count() == 0
    broken = tmp_path / "raw"
    shutil.copytree(raw, broken)
    with open(broken / "x_orders_dataset.csv", "a", encoding="utf-8") as out:
        out.write("o3,c1,delivered\n")
    run_refresh(spark, str(broken), str(tmp_path / "out"))
    found = latest(spark, str(tmp_path / "out"))["broken_records"].collect()
    assert [tuple(r) for r in found] == [("orders", "too few cells", 3, 6, "o3,c1,delivered")]


def test_parquet_write_counts_and_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert storage.write_parquet(spark.range(5), path) == 5
    assert storage.write_parquet(spark.range(3), path) == 3
    assert storage.read_parquet(spark, path).count() == 3


def test_tables_are_created_replaced_and_queried(spark, tmp_path):
    spark.sql(f"CREATE DATABASE shop LOCATION '{tmp_path}/shop'")
    storage.create_table(spark.range(4), "shop.t")
    storage.create_table(spark.range(2), "shop.t")
    assert spark.sql("SELECT COUNT(*) AS n FROM shop.t").first().n == 2
    storage.write_parquet(spark.range(7), str(tmp_path / "folder"))
    for _ in range(2):
        storage.publish_folders(spark, {"u": str(tmp_path / "folder")}, "shop")
    assert spark.sql("SELECT COUNT(*) AS n FROM shop.u").first().n == 7
    spark.sql("DROP DATABASE shop CASCADE")


def test_materialized_frames_keep_their_rows(spark):
    frame = spark.range(10).selectExpr("id", "id * 0.5 AS half")
    assert multiset(storage.materialize(frame, "t")) == multiset(frame)


class FakeSession:
    def __init__(self, **settings):
        self._settings = {name.replace("__", "."): value for name, value in settings.items()}
        self.conf = self

    def get(self, name, default=None):
        return self._settings.get(name, default)


def test_working_folder_is_the_shared_one_of_the_session():
    session = FakeSession(spark__checkpoint__dir="hdfs://shared/x/", spark__master="yarn")
    first, second = (scratch.scratch_path(session, "t") for _ in range(2))
    assert first.startswith("hdfs://shared/x/t-") and first != second


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        scratch.scratch_path(FakeSession(spark__master="yarn"), "t")
