"""tallyspark: a PySpark library for daily revenue-recognition batches.

Reusable DataFrame operators (partition-pruned scans, null-safe column
clean-up, ranked and fallback enrichment joins, prefix-key and anti joins,
rate allocation, wide roll-ups, dynamic-partition overwrite and full-sync
merge) plus the data flows that map charge, usage, accrual and breakage
feeds onto one partitioned ledger table.

Everything is expressed with built-in DataFrame functions so Catalyst can
prune, push down and code-generate the whole plan.
"""

from tallyspark.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]
