"""Exact dedup against a plain dictionary."""

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from llm_cases import awkward, documents, rows_of

from bazaarlens.llm import exact_dedup


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc_id, len(text or "")))
    out = []
    for norm, members in groups.items():
        order = sorted(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        for n, member in enumerate(order):
            out.append((member[0], order[0][0], len(order), n == 0, sha))
    return sorted(out, key=str)


ROWS = [
    (1, "a b c"), (2, "abc"), (3, "a\tb\nc "), (4, "abd"), (5, None), (6, ""), (7, " \n"),
    (8, "x" * 200_000), (9, "x" * 100_000 + " " + "x" * 100_000), (None, "a  b  c"), (None, "nul"),
    (11, "dup"), (11, "dup"), (12, "ü b"), (13, "üb"), (14, " "), (15, "A b c"),
]


def test_every_case(spark):
    assert rows_of(exact_dedup.exact_dedup(awkward(documents(spark, ROWS)))) == expected(ROWS)


def test_buckets_split_and_collisions_are_chained(spark):
    rows = [(i, f"text {i % 700}") for i in range(1500)]
    small = exact_dedup.exact_dedup(documents(spark, rows), capacity=4, depth=5)
    assert rows_of(small) == expected(rows)


def test_directory_splits_overfull_buckets_only(spark):
    # 40 hashes in the first quarter of the hash space, 2 elsewhere.
    hashes = [(n << 40,) for n in range(40)] + [(1 << 62,), (-1 << 62,)]
    cells = exact_dedup.directory(spark.createDataFrame(hashes, "hash long"), capacity=8, depth=4)
    assert {(r.bucket, r.depth) for r in cells.collect()} == {(0, 4), (4, 2), (8, 1)}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 9), st.text("ab \n", max_size=4)), max_size=12))
def test_any_rows(spark, rows):
    assert rows_of(exact_dedup.exact_dedup(documents(spark, rows))) == expected(rows)


def test_one_row_of_each_group_stays_with_its_columns(spark):
    docs = awkward(documents(spark, ROWS))
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    want = sorted((r[0], r[4]) for r in expected(ROWS) if r[3] and r[0] is not None)
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    sha = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest()
    assert sorted((i, sha(t)) for i, t in rows if i is not None) == want
    assert len(rows) == sum(r[3] for r in expected(ROWS))


@pytest.mark.parametrize("operator", [exact_dedup.exact_dedup, exact_dedup.keep_one])
def test_empty_table(spark, operator):
    assert operator(documents(spark, [])).count() == 0
