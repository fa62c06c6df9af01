"""Time the headline queries and print one JSON line.

``page_reports`` runs the summary, category, state and seller reports over the
tables that a refresh has written, ``stored_*`` each report over them alone; the other
queries start from the raw tables.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from bazaarlens.__main__ import REPORTS
from bazaarlens.plans import reports
from bazaarlens.plans.queries import QUERIES
from bazaarlens.plans.refresh import refresh
from bazaarlens.session import local_session
from bazaarlens.sources.scratch import scratch_path
from bazaarlens.sources.star import star_datasets

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
SETTINGS = (
    "spark.driver.memory",
    "spark.sql.shuffle.partitions",
    "spark.sql.autoBroadcastJoinThreshold",
    "spark.sql.adaptive.autoBroadcastJoinThreshold",
)
HEADLINE = (
    "master",
    "order_features",
    "seller_features",
    "seller_features_window",
    "category_features",
    "customer_features",
    "bad_sellers",
    "top10_categories",
    "late_states",
    "findings_report",
    "bad_value_counts",
)


def seconds(run: Callable[[], None]) -> float:
    """The best wall time of a few runs."""
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def drain(frame: DataFrame) -> None:
    """Compute every row and keep none."""
    frame.write.format("noop").mode("overwrite").save()


def page_reports(tables: dict[str, DataFrame]) -> None:
    reports.seller_summary(tables["seller_features"]).collect()
    reports.all_categories(tables["category_features"]).collect()
    reports.all_states(tables["customer_features"]).collect()
    reports.high_risk_sellers(tables["seller_features"]).collect()


def main() -> None:
    spark: SparkSession = local_session(CPUS, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    written = []

    def run_refresh() -> None:
        written.append(refresh(spark, star_datasets(spark, FOLDER), scratch_path(spark, "bench")))

    times["full_refresh"] = seconds(run_refresh)
    tables = written[-1].tables(spark)
    times["page_reports"] = seconds(lambda: page_reports(tables))
    for table, views in REPORTS.items():
        for view in views:
            name = f"stored_{view.__name__}"
            times[name] = seconds(lambda: view(tables[table]).collect())  # noqa: B023
    for name in HEADLINE:
        times[name] = seconds(lambda: drain(QUERIES[name](spark, FOLDER)))
        print(name, times[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(t for n, t in times.items() if not n.startswith("stored_")), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(FOLDER).name.removeprefix("sf"),
                "cpus": CPUS,
                "runs": RUNS,
                "spark": spark.version,
                "settings": {name: spark.conf.get(name) for name in SETTINGS},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
