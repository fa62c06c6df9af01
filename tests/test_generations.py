"""Generations: what readers see between the steps of a refresh, and refreshes of the months that changed."""

import os
from urllib.parse import unquote, urlparse

import pytest
from conftest import SF_SMALL, multiset
from pyspark.sql import functions as F

from bazaarlens.plans import monthly
from bazaarlens.plans import refresh as refresh_module
from bazaarlens.plans.features import CATEGORY, features_from_master
from bazaarlens.plans.master import MASTER_COLUMNS, build_master
from bazaarlens.plans.monthly import changed_months, refresh_months
from bazaarlens.plans.refresh import latest, refresh
from bazaarlens.sources import generations
from bazaarlens.sources.generations import MONTH, Line
from bazaarlens.sources.star import star_datasets


def doubled(data):
    """Other values in every table: prices and payments doubled."""
    return {
        **data,
        "order_items": data["order_items"].withColumn("price", F.col("price") * 2),
        "payments": data["payments"].withColumn("payment_value", F.col("payment_value") * 2),
    }


def seen(spark, database):
    """A sum from each published table, in one query."""
    return tuple(
        spark.sql(f"""
        SELECT (SELECT sum(price) FROM {database}.master), (SELECT sum(order_payment_value) FROM {database}.order_features),
               (SELECT sum(seller_avg_price) FROM {database}.seller_features),
               (SELECT sum(category_avg_price) FROM {database}.category_features),
               (SELECT sum(state_avg_payment) FROM {database}.customer_features),
               (SELECT sum(avg_price) FROM {database}.all_categories)""").first()
    )


@pytest.mark.parametrize("by_months", [False, True])
def test_readers_see_one_generation_between_any_two_steps(spark, golden, tmp_path, monkeypatch, by_months):
    out, database = str(tmp_path / "out"), f"steps_{int(by_months)}"
    run = refresh_months if by_months else refresh
    run(spark, golden, out, database=database)
    before, looks = seen(spark, database), []

    def watched(module, name):
        step = getattr(module, name)

        def call(*args, **options):
            result = step(*args, **options)
            # A look after each kind of step, and after each of the last ones.
            if not any(of == name for of, _ in looks) or name not in ("write_parquet", "columns_of"):
                looks.append((name, seen(spark, database)))
            return result

        monkeypatch.setattr(module, name, call)

    for name in ("write_parquet", "publish", "add_generation", "publish_reports"):
        watched(refresh_module, name)
    watched(monthly, "write_parquet")
    watched(monthly, "columns_of")
    run(spark, doubled(golden), out, database=database)
    after = seen(spark, database)
    # Means of prices rounded to cents double exactly here, as every sum does.
    assert after == tuple(2 * value for value in before)
    assert [found for _, found in looks] == [before] * (len(looks) - 2) + [after] * 2
    assert [name for name, _ in looks][-3:] == ["publish", "add_generation", "publish_reports"]
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_columns_that_come_and_go(spark, golden, tmp_path):
    out = str(tmp_path / "out")
    refresh(spark, golden, out, "columns")
    more = {**golden, "sellers": golden["sellers"].withColumn("seller_zip", F.lit(7))}
    refresh(spark, more, out, "columns")
    assert spark.table("columns.master").columns == [*latest(spark, out)["master"].columns]
    assert {r[0] for r in spark.sql("SELECT seller_zip FROM columns.master WHERE seller_id IS NOT NULL").collect()} == {7}
    refresh(spark, golden, out, "columns")
    assert "seller_zip" not in spark.table("columns.master").columns
    assert spark.table("columns.master").count() == 6
    spark.sql("DROP DATABASE columns CASCADE")


def test_the_largest_number_is_the_last_generation_whatever_the_clock_says(spark, tmp_path):
    out = str(tmp_path / "out")
    numbers = [generations.add_generation(spark, out, run, [Line("t", run, "`a` int")]) for run in ("rb", "ra", "rc")]
    assert numbers == [1, 2, 3]
    # Two refreshes that ended at the same time share a number; readers take the lines of one of them.
    log = spark.read.parquet(f"{out}/{generations.GENERATIONS}").where("generation = 3")
    log.withColumn("run", F.lit("rd")).withColumn("finished", F.lit("1970-01-01").cast("timestamp")).select(*log.columns).write.mode(
        "append"
    ).parquet(f"{out}/{generations.GENERATIONS}")
    assert [r["run"] for r in generations.last_lines(spark, out)] == ["rd"]


def test_an_out_folder_holds_one_kind(spark, golden, tmp_path):
    refresh(spark, golden, str(tmp_path / "whole"))
    refresh_months(spark, golden, str(tmp_path / "months"))
    with pytest.raises(ValueError):
        refresh_months(spark, golden, str(tmp_path / "whole"))
    with pytest.raises(ValueError):
        refresh(spark, golden, str(tmp_path / "months"))
    with pytest.raises(ValueError):
        latest(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError):
        refresh_months(spark, golden, str(tmp_path / "months"), {"review_id": golden["reviews"]})


def files(folder):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(folder) for n in names if n.startswith("part-")}


def check_tables(spark, out, data):
    """The stored tables against master and features computed at once."""
    tables, master = latest(spark, out), build_master(data).select(*MASTER_COLUMNS)
    assert multiset(tables["master"].select(*MASTER_COLUMNS)) == multiset(master)
    for name, table in features_from_master(master).items():
        assert multiset(tables[name].drop(MONTH)) == multiset(table), name


def test_changes_of_every_kind_touch_their_months_only(spark, tmp_path):
    """Small orders of twelve months: changed, moved, emptied and new ones, and changed lookups."""
    out = str(tmp_path / "out")
    data = dict(star_datasets(spark, SF_SMALL))
    data["orders"] = data["orders"].where("order_purchase_timestamp < '1996-01-01'")
    assert refresh_months(spark, data, out) == list(range(199501, 199513))
    check_tables(spark, out, data)
    before = files(out)

    # One order moves from its month to another, and one order of a third month is canceled.
    rows = data["orders"].where("order_status = 'delivered' AND order_id % 40 != 0").select("order_id", F.month("order_purchase_timestamp").alias("m"))
    moved, gone = (rows.where(f"m = {m}").orderBy("order_id").first()[0] for m in (2, 5))
    later = F.expr(f"if(order_id = {moved}, timestamp_ntz'1995-09-09 00:00:00', order_purchase_timestamp)")
    status = F.expr(f"if(order_id = {gone}, 'canceled', order_status)")
    data["orders"] = data["orders"].withColumn("order_purchase_timestamp", later).withColumn("order_status", status)
    ids = spark.createDataFrame([(moved,), (gone,)], "order_id long")
    assert refresh_months(spark, data, out, {"order_id": ids}) == [199502, 199505, 199509]
    check_tables(spark, out, data)
    kept = {f: t for f, t in files(out).items() if f in before}
    assert kept == before
    new = {f.split(f"{MONTH}=")[1][:6] for f in files(out) if f not in before and f"{MONTH}=" in f}
    assert new == {"199502", "199505", "199509"}

    # All orders of a month go, and a new month comes.
    june = data["orders"].where("month(order_purchase_timestamp) = 6 AND year(order_purchase_timestamp) = 1995").select("order_id")
    more = star_datasets(spark, SF_SMALL)["orders"].where("order_purchase_timestamp >= '1996-01-01' AND order_purchase_timestamp < '1996-02-01'")
    data["orders"] = data["orders"].join(june, "order_id", "left_anti").union(more)
    assert refresh_months(spark, data, out, {"order_id": june.union(more.select("order_id"))}) == [199506, 199601]
    check_tables(spark, out, data)
    assert 199506 not in {r[0] for r in latest(spark, out)["master"].select(MONTH).distinct().collect()}

    # A product changes its category, and a seller's city its name: their months are found in master.
    master = latest(spark, out)["master"]
    product = master.where("product_id IS NOT NULL").groupBy("product_id").count().orderBy("count", "product_id").first()[0]
    data["products"] = data["products"].withColumn(
        "product_category_name", F.expr(f"if(product_id = {product}, 'something_new', product_category_name)")
    )
    months = sorted({r[0] for r in master.where(f"product_id = {product}").select(MONTH).collect()})
    assert refresh_months(spark, data, out, {"product_id": spark.createDataFrame([(product,)], "product_id long")}) == months
    check_tables(spark, out, data)
    assert latest(spark, out)["category_features"].where(f"{CATEGORY} = 'something_new'").count() == 0

    # Nothing changed: no month is written, and the tables stand.
    none = spark.createDataFrame([], "order_id long")
    assert refresh_months(spark, data, out, {"order_id": none}) == []
    check_tables(spark, out, data)


def test_merged_features_read_no_rows_of_old_months(spark, tmp_path, monkeypatch):
    out, read = str(tmp_path / "out"), []
    data = dict(star_datasets(spark, SF_SMALL))
    refresh_months(spark, data, out)
    old = files(out)
    merge = monthly.features_from_measures

    def watched(**measures):
        tables = merge(**measures)
        read.extend(unquote(urlparse(f).path) for t in tables.values() for f in t.inputFiles())
        return tables

    monkeypatch.setattr(monthly, "features_from_measures", watched)
    some = data["orders"].where("order_purchase_timestamp >= '1997-01-01' AND order_purchase_timestamp < '1997-02-01'").select("order_id")
    assert refresh_months(spark, data, out, {"order_id": some}) == [199701]
    assert read and all("_measures/" in f for f in read)
    assert any(f in old for f in read) and not any("/master/" in f for f in read)
    check_tables(spark, out, data)


def test_no_orders_at_all(spark, golden, tmp_path):
    out = str(tmp_path / "out")
    nothing = {**golden, "orders": golden["orders"].limit(0)}
    assert refresh_months(spark, nothing, out, database="nothing") == []
    assert latest(spark, out)["master"].count() == 0 and spark.table("nothing.master").count() == 0
    ids = golden["orders"].select("order_id")
    assert refresh_months(spark, golden, out, {"order_id": ids}, "nothing") == [201801]
    check_tables(spark, out, golden)
    assert spark.table("nothing.order_features").count() == 5
    assert spark.table("nothing.master").count() == 6
    spark.sql("DROP DATABASE nothing CASCADE")


def test_changed_orders_are_looked_up_in_the_stored_order_table(spark, golden):
    held = spark.sql("SELECT * FROM VALUES ('o1', 201712), ('o3', 201801), ('o9', 201802) AS t(order_id, purchase_month)")
    opened = []

    def stored(name):
        opened.append(name)
        return held

    ids = spark.sql("SELECT * FROM VALUES ('o1'), ('o4'), ('o9') AS t(order_id)")
    assert changed_months(golden["orders"], {"order_id": ids}, stored) == [201712, 201801, 201802]
    assert opened == ["order_features"]
