"""Working folders that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names; a new temporary one in local mode only."""
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="bazaarlens-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
