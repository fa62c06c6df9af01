"""Session settings for runs on one machine."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int = 8, app: str = "bazaarlens") -> SparkSession:
    """A local session. On a cluster, bring your own: nothing here is required."""
    # A broadcast is built by one thread. With a low limit on estimates, larger
    # joins use every core; what proves small when measured is still broadcast.
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.autoBroadcastJoinThreshold", "1MB")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
