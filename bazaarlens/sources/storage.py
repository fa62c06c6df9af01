"""Parquet folders and catalog tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bazaarlens.sources.scratch import scratch_path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(frame: DataFrame, path: str) -> int:
    """Replace the folder with the frame and return its row count, in one job.

    The path must not be one the frame itself is read from: Spark clears it
    before the first row is written.
    """
    seen = Observation()
    counted = frame.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def clustered(frame: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt to files by ranges of the keys, and sorted within them.

    A filter on the first key then skips the row groups of other ranges. Give a second key that spreads
    the rows of a hot first one, or they end up in one file. Spark samples the frame to find the ranges,
    which computes its last stage twice.
    """
    return frame.repartitionByRange(*keys).sortWithinPartitions(*keys)


def materialize(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared working folder and read back.

    For results that several plans use: they are computed once, and their
    lineage ends here.
    """
    path = scratch_path(frame.sparkSession, label)
    write_parquet(frame, path)
    return read_parquet(frame.sparkSession, path)


def create_table(frame: DataFrame, name: str) -> None:
    """Create or replace a catalog table holding the frame's rows."""
    frame.write.mode("overwrite").format("parquet").saveAsTable(name)


def publish_folders(spark: SparkSession, folders: Mapping[str, str], database: str) -> None:
    """Make parquet folders queryable as ``database.name`` without copying them.

    A table that exists with the same columns is pointed to its new folder, so a reader
    never finds it missing; only other columns make it a new table.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, path in folders.items():
        table = f"`{database}`.`{name}`"
        if spark.catalog.tableExists(f"{database}.{name}"):
            if spark.table(table).dtypes == read_parquet(spark, path).dtypes:
                spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
                spark.catalog.refreshTable(f"{database}.{name}")
                continue
            spark.sql(f"DROP TABLE {table}")
        spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")


def row_counts(frames: Mapping[str, DataFrame], label: str) -> DataFrame:
    """One row per frame: its name under ``label``, and ``row_count``."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).selectExpr(
            f"'{name}' AS {label}", "row_count"
        )
        for name, frame in frames.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
