"""Malformed numbers and table shapes."""

import math
import statistics
from fractions import Fraction

import pandas as pd
from pyspark.sql import functions as F

from bazaarlens.functions.numeric import (
    exact,
    exact_mean,
    exact_moments,
    exact_sum,
    is_not_number,
    percent,
    rounded,
    to_double,
)
from bazaarlens.operators import quality
from bazaarlens.operators.cleaning import payment_agg
from bazaarlens.operators.rollup import mean, mean_parts, rollup
from bazaarlens.plans import findings

TEXTS = ["5", " 5 ", "5.5", ".5", "-1e3", "", "bad", "n/a", "NaN", "5d", "5.f", "1.5D", None, "inf"]


def test_bad_numbers_are_those_pandas_cannot_read(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    found = [r.bad for r in rows.select("i", is_not_number("t").alias("bad")).orderBy("i").collect()]
    assert found == list(pd.to_numeric(pd.Series(TEXTS), errors="coerce").isna())


def test_text_to_double(spark):
    rows = spark.createDataFrame([("5",), ("x",), ("NaN",), ("",), (None,)], "t string")
    assert [r.n for r in rows.select(to_double("t").alias("n")).collect()] == [5.0, None, None, None, None]


def test_rounding_is_half_up_on_the_decimal_value(spark):
    row = spark.createDataFrame([(1.005, 0.3245, math.inf, None)], "a double, b double, c double, d double")
    got = row.select(
        rounded("a", 2).alias("a"), percent("b").alias("b"), rounded("c", 2).alias("c"),
        rounded("d", 2).alias("d"), exact("b").alias("e"),
    ).first()
    assert (got.a, got.b, got.c, got.d) == (1.01, 32.5, math.inf, None)
    assert (got.e.side, str(got.e.near), got.e.far) == (0, "0.3245000000", None)


def test_ranking_keys_order_what_no_decimal_holds(spark):
    values = [1.5, math.inf, 1e19, 2e19, -1e19, -math.inf, 0.0, math.nan, None, 9e17]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    ranked = [r.v for r in frame.orderBy(exact("v").desc_nulls_last()).collect()]
    assert ranked[:8] == [math.inf, 2e19, 1e19, 9e17, 1.5, 0.0, -1e19, -math.inf]
    assert sum(v is None or v != v for v in ranked[8:]) == 2


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    values = [0.1, 0.2, 0.3, 1e15, -1e15, 0.7, 0.05] * 30
    found = set()
    for seed in range(4):
        frame = spark.createDataFrame([(v,) for v in values], "v double")
        frame = frame.orderBy(F.xxhash64("v", F.lit(seed))).repartition(seed + 1)
        found.add(tuple(frame.select(exact_sum("v"), exact_mean("v")).first()))
    assert len(found) == 1
    far = spark.createDataFrame([(1.0,), (math.inf,), (None,)], "v double")
    assert tuple(far.select(exact_sum("v"), exact_mean("v")).first()) == (math.inf, math.inf)
    none = spark.createDataFrame([(None,)], "v double")
    assert tuple(none.select(exact_sum("v"), exact_mean("v")).first()) == (None, None)


def test_sums_carry_where_a_long_would_overflow(spark):
    """Sentinels in many rows, through the sum, the payments and two rollups."""
    rows = spark.range(10_000).selectExpr("'o1' AS order_id", "9.9e14D AS payment_value", "1 AS payment_installments")
    assert payment_agg(rows).first().total_payment == 9.9e18
    mixed = spark.range(30_000).selectExpr(
        "int(id % 7) AS key", "if(id % 2 = 0, 999999999999999.25D, -0.1D) AS v", "id"
    )
    exactly = {}
    for i in range(30_000):
        exactly[i % 7] = exactly.get(i % 7, 0) + (Fraction("999999999999999.25") if i % 2 == 0 else Fraction(-1, 10))
    found = set()
    for parts in (1, 8, 37):
        states = rollup(mixed.repartition(parts, "id").selectExpr("key", "id % 5 AS part", *mean_parts("v", "v")), "key", "part")
        means = rollup(states, "key").selectExpr("key", mean("v", "mean"), "v_sum")
        direct = mixed.repartition(parts, "id").groupBy("key").agg(exact_mean("v").alias("direct"))
        found.add(tuple(sorted(map(tuple, means.join(direct, "key").collect()))))
    assert len(found) == 1
    for key, mean_, units, direct in found.pop():
        assert units == exactly[key] * 10**8 and mean_ == direct
        n = len(range(key, 30_000, 7))
        assert abs(mean_ - exactly[key] / n) <= abs(exactly[key] / n) * Fraction(1, 10**15)


def test_moments_are_the_same_to_the_bit_however_rows_are_dealt(spark):
    def moments(frame):
        mean, spread = exact_moments("v")
        return tuple(frame.agg(mean.alias("m"), spread.alias("s")).first())

    values = [((i * 7919) % 1000) / 999 + (i % 3) / 7 for i in range(5000)]
    frame = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    found = {moments(frame.orderBy(F.xxhash64("v", F.lit(n))).repartition(n)) for n in (1, 8, 64)}
    assert len(found) == 1
    mean, spread = found.pop()
    assert math.isclose(mean, statistics.fmean(values), rel_tol=1e-12)
    assert math.isclose(spread, statistics.pstdev(values), rel_tol=1e-11)
    assert moments(frame.where("false")) == (None, None)
    equal = spark.createDataFrame([(0.1,)] * 77, "v double")
    assert moments(equal) == (0.1, 0.0)
    large = spark.createDataFrame([(3e9,), (1e9,)], "v double")
    assert moments(large) == (2e9, 1e9)
    many = spark.range(200_000).selectExpr("900000D + id % 2 AS v")
    assert all(math.isclose(a, b, rel_tol=1e-6) for a, b in zip(moments(many), (900000.5, 0.5)))


def test_flags_do_not_depend_on_partitions(spark, settings):
    """Sellers whose z stands at the limit of two deviations: flagged under every partitioning, with one z."""
    rates = [0.1] * 12 + [0.3] * 12 + [0.2 + 2 * 0.1 * (25 / 21) ** 0.5]
    rows = [(i, "c", "s", 4.0 + (i % 7) / 10, r, 20, 5.0) for i, r in enumerate(rates)]
    schema = "seller_id long, seller_city string, seller_state string, seller_avg_review double, seller_late_rate double, seller_total_orders long, seller_avg_price double"
    none = spark.createDataFrame([], "product_category_name_english string, category_late_rate double, category_avg_review double")
    states = spark.createDataFrame([], "customer_state string, state_late_rate double")
    found = set()
    for parts in (1, 8, 64):
        sellers = spark.createDataFrame(rows, schema).repartition(parts, "seller_id")
        flags = findings.anomaly_flags(sellers, none, states, z_min=1.5).collect()
        found.add(tuple((r.entity_id, r.metric, r.z, r.baseline) for r in flags))
    assert len(found) == 1 and len(found.pop()) >= 1


def test_stored_states_merge_beyond_a_long(spark):
    """A partial far above 2**63 units, merged with others, loses no unit."""
    state = spark.createDataFrame([("s", "9223372036854775807999"), ("s", "1"), ("s", None)], "k string, u string")
    state = state.selectExpr("k", "CAST(u AS decimal(38,0)) AS v_sum", "CAST(NULL AS double) AS v_far", "bigint(2) AS v_n")
    merged = rollup(state, "k").selectExpr("v_sum", mean("v", "mean")).first()
    assert merged.v_sum == 9223372036854775808000 and merged.mean == 92233720368547.75808 / 6


def test_bad_rows_and_counts(spark):
    def frame(column, values):
        rows = [(f"o{i}", v) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, f"order_id string, {column} string")

    raw = {
        "payments": frame("payment_value", ["1", "2"]),
        "reviews": frame("review_score", ["bad"] * 7 + ["4", None]),
        "order_items": frame("price", ["x", "1.5"]),
    }
    counts = {r.dataset: (r.total_rows, r.bad_rows) for r in quality.bad_value_counts(raw).collect()}
    assert counts == {"payments": (2, 0), "reviews": (9, 8), "order_items": (2, 1)}
    rows = [tuple(r) for r in quality.bad_values(raw).collect()]
    assert [r for r in rows if r[0] == "reviews"] == [
        ("reviews", "review_score", f"o{i}", "bad", f'{{"order_id":"o{i}","review_score":"bad"}}')
        for i in range(5)
    ]
    assert [r for r in rows if r[0] == "order_items"] == [
        ("order_items", "price", "o0", "x", '{"order_id":"o0","price":"x"}')
    ]


def test_duplicate_keys_of_every_dataset(spark, golden):
    assert quality.duplicate_keys(golden).count() == 0
    twice = {name: golden[name].union(golden[name].limit(1)) for name in quality.UNIQUE_KEYS}
    rows = quality.duplicate_keys({**golden, **twice}).collect()
    assert {(r.dataset, r.key_column) for r in rows} == set(quality.UNIQUE_KEYS.items())
    assert {r.row_count for r in rows} == {2}


def test_schemas_with_counts(spark):
    table = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    empty = table.filter(F.lit(False))
    got = [tuple(r) for r in quality.table_schemas({"t": table, "e": empty}).collect()]
    assert got == [
        ("t", 1, "a", "int", 2, 2),
        ("t", 2, "b", "string", 1, 2),
        ("e", 1, "a", "int", 0, 0),
        ("e", 2, "b", "string", 0, 0),
    ]
