"""The registered queries against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest
from test_chosen_path import expected as near_groups
from test_exact_dedup import expected as exact_groups

import __spark_entry__ as driver
import corpus_pipeline
from bazaarlens.llm import language
from bazaarlens.llm.queries import ORACLE_SQL, QUERIES

SF_SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_one_query_for_each_operator_and_the_pipeline():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 1 + len(QUERIES)))
    assert {*QUERIES, "pipeline"} <= set(driver.queries()) and set(ORACLE_SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "labels", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = connection.execute(ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    rows = [tuple(r[c] for c in columns) for r in QUERIES[name](spark, SF).collect()]
    assert sorted(rows, key=str) == sorted(found.fetchall(), key=str)


def test_stages(spark, tmp_path):
    """Each stage on what its predecessor kept, against the brute-force answer."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_SMALL).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        assert name == "packing" or docs.columns == columns
        kept.append((name, sorted((r.doc_id, r.text) for r in before.collect()), docs))
    steps = {name: (rows, out) for name, rows, out in kept}
    rows, out = steps["language"]
    judged = {r.doc_id: r for r in language.identify(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()}
    assert {r.doc_id for r in out.collect()} == {d for d, _ in rows if judged[d].lang_pred != "und" and judged[d].score >= 0.3}
    rows, out = steps["exact_dedup"]
    assert sorted(r.doc_id for r in out.collect()) == sorted(g[0] for g in exact_groups(rows) if g[3])
    rows, out = steps["near_dedup"]
    assert sorted(r.doc_id for r in out.collect()) == sorted(g[0] for g in near_groups(rows) if g[3])
    rows, out = steps["mixing"]
    assert sorted(r.doc_id for r in out.collect()) == [d for d, _ in rows]
    rows, out = steps["packing"]
    assert {r.doc_id for r in out.collect()} == {d for d, _ in rows}
    assert corpus_pipeline.run(spark, SF_SMALL).count() == out.count()


def test_targets_of_the_mix_change_the_packed_sequences(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    sources = {r.doc_id: r.source for r in docs.collect()}
    names = sorted(set(sources.values()))
    assert len(names) > 1
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[1:2] + corpus_pipeline.STAGES[3:])
    found = {}
    for name in names[:2]:
        monkeypatch.setattr(corpus_pipeline, "TARGETS", {name: 0.9})
        rows = corpus_pipeline.run(spark, SF_SMALL).collect()
        found[name] = [sources[r.doc_id] for r in sorted(rows, key=lambda r: r.sequence_id)][: len(rows) // 10]
    one, other = (found[n] for n in names[:2])
    assert one.count(names[0]) > other.count(names[0]) and other.count(names[1]) > one.count(names[1])


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0
