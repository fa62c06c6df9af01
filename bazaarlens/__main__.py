"""Run the jobs: ``spark-submit`` this package, or ``python -m bazaarlens``.

    refresh RAW OUT [DATABASE]   raw CSV folder to master, feature tables and a table of broken records
    reports OUT                  all reports over the last refresh, written in full to OUT/reports
    quality RAW                  row counts, malformed numbers and broken records of the raw files
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from bazaarlens.operators import quality
from bazaarlens.plans import findings, reports
from bazaarlens.plans.refresh import latest, refresh
from bazaarlens.sources.datasets import DATASETS, read_datasets, read_records
from bazaarlens.sources.storage import read_parquet, row_counts, write_parquet

#: Rows of a report that are printed; its files hold all of them.
PREVIEW = 100
REPORTS = {
    "seller_features": (
        reports.seller_summary,
        reports.top_sellers_by_review,
        reports.bad_sellers,
        reports.high_risk_sellers,
    ),
    "category_features": (
        reports.top5_categories,
        reports.top10_categories,
        reports.chart_top_categories,
        reports.all_categories,
    ),
    "customer_features": (reports.worst5_states, reports.late_states, reports.all_states),
}


def run_refresh(spark: SparkSession, raw: str, out: str, database: str | None = None) -> None:
    data = read_datasets(spark, raw)
    records = {name: read_records(spark, raw, name) for name in DATASETS}
    beside = {"broken_records": quality.broken_records(records)}
    for name, rows in refresh(spark, data, out, database, beside).rows.items():
        print(f"{name}: {rows} rows")


def run_reports(spark: SparkSession, out: str) -> None:
    tables = latest(spark, out)
    tables = {name: tables[name] for name in REPORTS}
    frames = {
        view.__name__: view(tables[name]) for name, views in REPORTS.items() for view in views
    }
    frames["findings_report"] = findings.findings_report(*tables.values())
    for name, frame in frames.items():
        path = f"{out}/reports/{name}"
        rows = write_parquet(frame, path)
        print(f"{name}: {rows} rows in {path}" + (f", the first {PREVIEW}:" if rows > PREVIEW else ""))
        # Reports that are lists keep their order in the files.
        read_parquet(spark, path).show(PREVIEW, truncate=False)


def run_quality(spark: SparkSession, raw: str) -> None:
    data = read_datasets(spark, raw, raw=True)
    row_counts(data, "dataset").show(truncate=False)
    quality.bad_value_counts(data).show(truncate=False)
    quality.bad_values(data).show(truncate=False)
    records = {name: read_records(spark, raw, name) for name in DATASETS}
    quality.broken_record_counts(records).show(truncate=False)
    quality.broken_records(records).show(PREVIEW, truncate=200)


JOBS = {"refresh": run_refresh, "reports": run_reports, "quality": run_quality}


def main(arguments: list[str]) -> None:
    if not arguments or arguments[0] not in JOBS:
        raise SystemExit(__doc__)
    spark = SparkSession.builder.appName("bazaarlens").getOrCreate()
    JOBS[arguments[0]](spark, *arguments[1:])
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
