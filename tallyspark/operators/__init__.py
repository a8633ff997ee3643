"""Table operators: enrichment joins, ledger roll-ups, allocation, sinks."""

from tallyspark.operators.audit import Audit
from tallyspark.operators.allocate import newest_rates, rate_join, reverse, unrated
from tallyspark.operators.enrich import (
    anti_lookup,
    coalesce_sources,
    dedup_keys,
    handed_off,
    lookup,
    reduce_to,
    repeated_keys,
    semi_lookup,
    top_ranked,
    union_all,
)
from tallyspark.operators.ledger import ledger_project, ledger_rollup
from tallyspark.operators.totals import key_totals
from tallyspark.operators.sinks import (
    ensure_table,
    merge_actions,
    merge_full_sync,
    overwrite_partitions,
    promote,
    read_target,
)

__all__ = [
    "Audit", "anti_lookup", "coalesce_sources", "dedup_keys", "ensure_table", "handed_off", "key_totals",
    "ledger_project", "ledger_rollup", "lookup", "merge_actions", "merge_full_sync",
    "newest_rates", "overwrite_partitions", "promote", "rate_join", "read_target", "reduce_to", "repeated_keys", "reverse",
    "semi_lookup", "top_ranked", "union_all", "unrated",
]
