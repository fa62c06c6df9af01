"""Reports and findings over small feature tables, against plain Python."""

import statistics

import pytest

from bazaarlens.plans import features, findings, reports


@pytest.fixture(scope="module")
def tables(golden):
    return features.report_tables(golden)


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_summary_is_the_plain_mean_over_sellers(tables):
    assert rows(reports.seller_summary(tables["sellers"])) == [(3.08, 61.1, 3, 6)]


def test_unknown_groups_appear_in_rankings(tables):
    top = rows(reports.top5_categories(tables["categories"]))
    assert [r[:2] for r in top] == [(None, 3), ("health_beauty", 2), ("bed_bath_table", 1)]
    worst = rows(reports.bad_sellers(tables["sellers"], min_orders=1))
    assert [r[0] for r in worst] == [None, "s2", "s1"]
    assert [r[0] for r in rows(reports.top_sellers_by_review(tables["sellers"]))] == ["s1", "s2", None]


def test_states(tables):
    assert rows(reports.worst5_states(tables["states"])) == [
        ("AL", 1, 100.0), ("SP", 4, 50.0), ("RJ", 1, 0.0),
    ]
    assert rows(reports.late_states(tables["states"], n=1)) == [("AL", 1, 100.0, 80.0)]
    assert rows(reports.all_states(tables["states"]))[1] == ("SP", 4, 50.0, 121.0)


def test_threshold_is_inclusive(tables):
    assert [r[0] for r in rows(reports.high_risk_sellers(tables["sellers"], min_orders=3))] == ["s1"]
    assert rows(reports.high_risk_sellers(tables["sellers"])) == []


def test_rounded_ranking_breaks_ties_by_key(spark):
    sellers = spark.createDataFrame(
        [("b", "X", "Y", 4.0, 0.50049, 30, 1.0), ("a", "X", "Y", 4.0, 0.50041, 30, 1.0)],
        "seller_id string, seller_city string, seller_state string, seller_avg_review double, "
        "seller_late_rate double, seller_total_orders bigint, seller_avg_price double",
    )
    assert [r[0] for r in rows(reports.high_risk_sellers(sellers))] == ["a", "b"]
    assert [r[0] for r in rows(reports.bad_sellers(sellers))] == ["b", "a"]


def test_chart_rows(tables):
    assert rows(reports.chart_top_categories(tables["categories"], n=2)) == [
        (None, 3, 2.0), ("health_beauty", 2, 4.5),
    ]
    assert rows(reports.all_categories(tables["categories"]))[2] == ("bed_bath_table", 1, 50.0, 4.5, 100.0)


SELLERS = [(f"s{i}", "c", "t", 4.0 + 0.01 * (i % 3), 0.10 + 0.01 * (i % 4), 20, 1.0) for i in range(20)]
SELLERS += [("late", "c", "t", 4.0, 0.9, 50, 1.0), ("bad", "c", "t", 1.0, 0.1, 50, 1.0)]
SELLERS += [("few", "c", "t", 1.0, 1.0, 9, 1.0), (None, None, None, 1.0, 1.0, 99, None)]


@pytest.fixture(scope="module")
def outliers(spark):
    return {
        "sellers": spark.createDataFrame(
            SELLERS,
            "seller_id string, seller_city string, seller_state string, seller_avg_review double, "
            "seller_late_rate double, seller_total_orders bigint, seller_avg_price double",
        ),
        "categories": spark.createDataFrame(
            [(f"c{i}", 10.0, 4.0, 100 + i, 0.1) for i in range(12)] + [(None, 1.0, 1.0, 999, 0.9)],
            "product_category_name_english string, category_avg_price double, "
            "category_avg_review double, category_total_orders bigint, category_late_rate double",
        ),
        "states": spark.createDataFrame(
            [("A", 10, 5.0, 0.5), ("B", 100, 7.0, 0.1), ("C", 30, 9.0, 0.2)],
            "customer_state string, state_total_orders bigint, state_avg_payment double, "
            "state_late_rate double",
        ),
    }


def test_flags_are_the_outliers_among_known_sellers(outliers):
    known = [s for s in SELLERS if s[0] and s[5] >= 10]
    expected = {}
    for metric, column, sign in (("late_rate", 4, 1), ("avg_review", 3, -1)):
        values = [s[column] for s in known]
        mean, spread = statistics.fmean(values), statistics.pstdev(values)
        expected |= {
            (s[0], metric): round((s[column] - mean) / spread, 6)
            for s in known
            if sign * (s[column] - mean) / spread >= 2
        }
    flags = findings.anomaly_flags(**outliers).collect()
    assert {(f.entity_id, f.metric): f.z for f in flags} == pytest.approx(expected)
    assert {f.entity_type for f in flags} == {"seller"}  # equal categories have no spread
    assert {f.entity_id: f.action for f in flags} == {
        "late": "review logistics and carriers",
        "bad": "audit product quality and support",
    }


def test_insights(outliers):
    got = rows(findings.business_insights(outliers["categories"], outliers["states"]))
    assert got == [
        (1, "revenue", "c11", "revenue", 1110.0),
        (2, "satisfaction", "c10", "avg_review", 4.0),
        (3, "geography", "C", "total_orders", 30.0),
        (4, "revenue", "C", "avg_payment", 9.0),
        (5, "geography", "A", "late_pct", 50.0),
    ]


def test_report_sections(outliers):
    report = findings.findings_report(**outliers).collect()
    sections = {}
    for r in report:
        sections.setdefault(r.section, []).append(r.seq)
    assert {name: sorted(found) for name, found in sections.items()} == {
        "summary": [1, 2, 3, 4],
        "insights": [1, 2, 3, 4, 5],
        "risks": [1, 2],
        "actions": [1, 2],
    }
