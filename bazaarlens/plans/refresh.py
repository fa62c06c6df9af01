"""The full refresh: raw datasets to master, features and published tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from bazaarlens.operators.quality import duplicate_keys
from bazaarlens.plans.features import features_from_master
from bazaarlens.plans.master import Datasets, build_master
from bazaarlens.plans.report_views import publish_reports
from bazaarlens.sources.generations import (
    Line,
    add_generation,
    columns_of,
    last_lines,
    open_table,
    publish,
    run_folder,
    tables_of,
)
from bazaarlens.sources.storage import clustered, read_parquet, write_parquet


@dataclass(frozen=True)
class Refresh:
    """What a refresh left behind: the folder and the row count of every table."""

    folders: dict[str, str]
    rows: dict[str, int]

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {name: read_parquet(spark, path) for name, path in self.folders.items()}


def new_run() -> str:
    return f"r{uuid.uuid4().hex}"


def for_all(tables: Mapping[str, DataFrame], write: Callable[[str, DataFrame], object]) -> None:
    """Write independent tables at once: a job fills the cores that the last tasks of another leave idle."""
    with ThreadPoolExecutor(len(tables)) as pool:
        for written in [pool.submit(write, name, table) for name, table in tables.items()]:
            written.result()


def switch(spark: SparkSession, out: str, run: str, lines: list[Line], database: str | None) -> None:
    """Add the generation to the log, which moves all readers on; views are made ready before."""
    if database is None:
        add_generation(spark, out, run, lines)
        return
    first = not last_lines(spark, out)
    if not first:
        publish(spark, out, database, lines)
    add_generation(spark, out, run, lines)
    if first:
        publish(spark, out, database, lines)
    publish_reports(spark, database)


def refuse_other_kind(spark: SparkSession, out: str, monthly: bool) -> None:
    if any((line["purchase_month"] is not None) != monthly for line in last_lines(spark, out) if line["table_name"] == "master"):
        raise ValueError(f"{out} holds tables {'written whole' if monthly else 'kept by months'}: choose another folder")


def refresh(
    spark: SparkSession,
    data: Datasets,
    out: str,
    database: str | None = None,
    beside: Mapping[str, DataFrame] | None = None,
    cluster_by: Sequence[str] = (),
) -> Refresh:
    """Write master once, and the four feature tables from it, as a new generation.

    Every table is computed once: counts come from the write itself, and the
    feature tables read the written master, which also ends its lineage. All go to
    folders of their own. Readers, and with ``database`` the catalog views, see the generation once all of
    it is written: its lines in the log are appended last, together.
    ``duplicate_keys`` and the frames ``beside`` are written as tables too and counted. With ``cluster_by``, say
    ``("seller_id", "order_id")``, lookups by the first key skip most of master's row groups.
    """
    refuse_other_kind(spark, out, monthly=False)
    run, folders, rows, lines = new_run(), {}, {}, []

    def write(name: str, frame: DataFrame) -> None:
        columns = columns_of(frame)
        folder = run_folder(out, name, columns, run)
        rows[name] = write_parquet(frame, folder)
        folders[name] = folder
        lines.append(Line(name, run, columns))

    rows_of_master = build_master(data)
    write("master", clustered(rows_of_master, *cluster_by) if cluster_by else rows_of_master)
    master = read_parquet(spark, folders["master"])
    tables = {**features_from_master(master), "duplicate_keys": duplicate_keys(data), **(beside or {})}
    for_all(tables, write)
    switch(spark, out, run, lines, database)
    return Refresh(folders, rows)


def latest(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The tables of the last complete refresh below ``out``, all of one generation."""
    lines = last_lines(spark, out)
    if not lines:
        raise ValueError(f"no refresh has ended below {out}")
    return {name: open_table(spark, out, name, lines) for name in tables_of(lines)}
