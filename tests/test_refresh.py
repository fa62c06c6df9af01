"""The full refresh: files, counts, catalog tables and the command line."""

import glob

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL, multiset
from test_sources import raw  # noqa: F401

from bazaarlens import __main__ as jobs
from bazaarlens.plans import features, queries
from bazaarlens.plans import refresh as refresh_module
from bazaarlens.plans.master import build_master
from bazaarlens.plans.refresh import latest, refresh
from bazaarlens.sources.star import star_datasets


def test_refresh_writes_every_table_once_and_counts_it(spark, golden, tmp_path):
    result = refresh(spark, golden, str(tmp_path / "out"), database="market")
    assert result.rows == {
        "master": 6,
        "order_features": 5,
        "seller_features": 3,
        "category_features": 3,
        "customer_features": 3,
        "duplicate_keys": 0,
    }
    tables = result.tables(spark)
    assert multiset(tables["master"]) == multiset(build_master(golden))
    for name, table in features.features_from_master(tables["master"]).items():
        assert multiset(tables[name]) == multiset(table)
    top = spark.sql(
        "SELECT customer_state, ROUND(state_late_rate * 100, 1) AS late_pct "
        "FROM market.customer_features ORDER BY state_late_rate DESC LIMIT 1"
    )
    assert tuple(top.first()) == ("AL", 100.0)
    spark.sql("DROP DATABASE market CASCADE")


def test_readers_keep_the_last_complete_generation(spark, golden, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    refresh(spark, golden, out, database="shop")
    before = {name: multiset(table) for name, table in latest(spark, out).items()}
    write, calls = refresh_module.write_parquet, []

    def fails_at_the_third(frame, path):
        calls.append(path)
        if len(calls) == 3:
            raise OSError("no space left")
        return write(frame, path)

    fewer = {**golden, "orders": golden["orders"].limit(1)}
    monkeypatch.setattr(refresh_module, "write_parquet", fails_at_the_third)
    with pytest.raises(OSError):
        refresh(spark, fewer, out, database="shop")
    assert {name: multiset(t) for name, t in latest(spark, out).items()} == before
    for name, rows in before.items():
        assert multiset(spark.table(f"shop.{name}")) == rows
    monkeypatch.setattr(refresh_module, "write_parquet", write)
    refresh(spark, fewer, out, database="shop")
    assert latest(spark, out)["order_features"].count() == 1
    assert spark.table("shop.order_features").count() == 1
    spark.sql("DROP DATABASE shop CASCADE")


def test_tables_do_not_depend_on_the_number_of_partitions(spark, settings, tmp_path):
    data, found = star_datasets(spark, SF_SMALL), []
    for parts in ("3", "11"):
        settings(spark__sql__shuffle__partitions=parts)
        tables = refresh(spark, data, str(tmp_path / parts)).tables(spark)
        found.append({name: multiset(table) for name, table in tables.items()})
    assert found[0] == found[1]


def test_a_lookup_reads_few_row_groups_of_a_clustered_master(spark, settings, tmp_path):
    settings(spark__sql__shuffle__partitions="60", spark__sql__adaptive__coalescePartitions__enabled="false")
    data = star_datasets(spark, "/root/testdata/sf0.01")
    result = refresh(spark, data, str(tmp_path / "out"), cluster_by=("seller_id", "order_id"))
    groups = []
    for file in glob.glob(f"{result.folders['master']}/*.parquet"):
        stored = pq.ParquetFile(file)
        at = stored.schema_arrow.names.index("seller_id")
        for n in range(stored.num_row_groups):
            groups.append(stored.metadata.row_group(n).column(at).statistics)
    sellers = [r[0] for r in data["sellers"].select("seller_id").limit(20).collect()]
    assert len(groups) >= 50
    for seller in sellers:
        hit = sum(g.has_min_max and g.min <= seller <= g.max for g in groups)
        assert hit < len(groups) / 10
    assert multiset(result.tables(spark)["master"].select("order_id", "price")) == multiset(
        build_master(data).select("order_id", "price")
    )


def test_long_reports_are_written_in_full(spark, golden, tmp_path, capsys):
    names = spark.range(150).selectExpr(
        "concat('n', id) AS product_category_name", "concat('e', id) AS product_category_name_english"
    )
    data = {
        **golden,
        "order_items": spark.range(150).selectExpr(
            "'o1' AS order_id", "concat('p', id) AS product_id", "'s1' AS seller_id",
            "1.0D AS price", "1.0D AS freight_value",
        ),
        "products": spark.range(150).selectExpr(
            "concat('p', id) AS product_id", "concat('n', id) AS product_category_name"
        ),
        "category": names,
    }
    out = str(tmp_path / "out")
    refresh(spark, data, out)
    jobs.run_reports(spark, out)
    assert spark.read.parquet(f"{out}/reports/all_categories").count() == 151
    sections = spark.read.parquet(f"{out}/reports/findings_report").collect()
    assert [r.section_no for r in sections] == sorted(r.section_no for r in sections)
    assert sections[0].section == "summary"


def test_jobs_from_raw_files(spark, raw, tmp_path, capsys):  # noqa: F811
    out = str(tmp_path / "out")
    jobs.run_refresh(spark, raw, out)
    assert "master: 2 rows" in capsys.readouterr().out
    jobs.run_reports(spark, out)
    shown = capsys.readouterr().out
    assert "seller_summary" in shown and "findings_report" in shown
    assert spark.read.parquet(f"{out}/reports/all_states").count() == 1
    jobs.run_quality(spark, raw)
    assert "review_score" in capsys.readouterr().out


def test_raw_files_of_a_refresh_are_written_at_once(spark, monkeypatch):
    together, for_all = [], queries.for_all

    def noted(tables, write):
        together.append(len(tables))
        for_all(tables, write)

    monkeypatch.setattr(queries, "for_all", noted)
    queries.csv_refresh(spark, SF_SMALL)
    assert together == [9]
