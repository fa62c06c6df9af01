"""Delivery delay and the late flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def delay_days(delivered: str, estimated: str) -> Column:
    """Whole calendar days from the estimate to the delivery; time of day is ignored."""
    return F.expr(f"datediff(date({delivered}), date({estimated}))")


def late_flag(days: str) -> Column:
    """1 when delivered after the estimated day; 0 otherwise, also without an estimate."""
    return F.expr(f"CASE WHEN {days} > 0 THEN 1 ELSE 0 END")
