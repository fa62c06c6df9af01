"""Every registered query against DuckDB, and the flagship query."""

import duckdb
import pytest
from conftest import SF_CHECK

import __spark_entry__ as driver
from bazaarlens.plans import features, reports
from bazaarlens.plans.oracle import ORACLE_SQL
from bazaarlens.plans.queries import QUERIES
from bazaarlens.sources.star import star_datasets

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_CHECK}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, oracle, name):
    frame = driver.queries()[name](spark, SF_CHECK)
    found = oracle.execute(driver.oracle_sql()[name])
    names = [column[0] for column in found.description]
    kinds = {column[0]: str(column[1]) for column in found.description}
    assert {c: TYPES[t] for c, t in frame.dtypes} == kinds
    rows = [tuple(row[c] for c in names) for row in frame.collect()]
    assert ordered(rows) == ordered(found.fetchall())


def test_seller_threshold_that_leaves_some_out(spark, oracle):
    data = star_datasets(spark, SF_CHECK)
    sql = driver.oracle_sql()["bad_sellers"]
    sql = sql.replace("WHERE seller_total_orders >= 10\n", "WHERE seller_total_orders >= 190\n")
    expected = oracle.execute(sql).fetchall()
    found = reports.bad_sellers(features.seller_features(data), min_orders=190).collect()
    assert [tuple(r) for r in found] == expected
    assert expected != oracle.execute(driver.oracle_sql()["bad_sellers"]).fetchall()


def test_entry(spark):
    assert driver.entry(spark).columns == ["section_no", "section", "seq", "entity_id", "metric", "value"]
    assert driver.entry(spark).count() >= 9
