"""Scans over partitioned feeds, and the binding of the driver test tables."""

from tallyspark.sources.scans import (
    day_predicate,
    key_list,
    latest_snapshot,
    scan_day,
    scan_days,
    scan_range,
    scan_reject,
)

__all__ = ["day_predicate", "key_list", "latest_snapshot", "scan_day", "scan_days",
           "scan_range", "scan_reject"]
