"""Write PLANS.md: the physical plans of the main flows after execution.

Usage: python tools/show_plans.py [sf_dir] > PLANS.md

Each query runs once (noop sink) so the adaptive plan is final, then its
plan tree and the scan details (partition filters, pushed filters, read
schema width) are printed.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from tallyspark import schema as S  # noqa: E402
from tallyspark.operators.sinks import merge_actions, merge_counts  # noqa: E402
from tallyspark.plans import flows  # noqa: E402
from tallyspark.plans import queries as Q  # noqa: E402
from tallyspark.plans.queries import QUERIES, feeds, prepare  # noqa: E402
from tallyspark.session import build_session  # noqa: E402

FLOWS = ["flow_charge", "flow_stage", "flow_package", "flow_unmatched", "flow_late_match",
         "flow_breakage_stage", "flow_breakage", "rate_allocate", "merge_target", "newest_loads", "key_lookup", "latest_snapshot"]

# Sink queries whose plan is that of another entry: promotions of other feeds
# and between tables, first loads, runs of flows for their counts.
SAME_PLAN = ("promote_two_keys", "promote_load_date", "promote_expiry_date", "promote_ledger", "promote_clear",
             "promote_drop", "first_load", "merge_recovered", "flow_audit")
# What the sink queries write, as the sinks deal it out.
WRITES = {
    "overwrite_partition": lambda s, sf: QUERIES["flow_charge"](s, sf).hint("rebalance", *S.LEDGER_PARTITIONS),
    "merge_full_sync": lambda s, sf: merge_actions(
        *(feeds(s, sf).feed(n).select(*S.VOUCHER_MERGE_KEYS) for n in ("voucher_target", "voucher_source")),
        list(S.VOUCHER_MERGE_KEYS)),
    # the counts and checks; the source is then written as it lies
    "merge_target": lambda s, sf: merge_counts(feeds(s, sf).voucher_target, feeds(s, sf).voucher_source, list(S.VOUCHER_MERGE_KEYS)),
    "promote": lambda s, sf: feeds(s, sf).location,
    "daily_late_match": lambda s, sf: flows.flow_late_match(
        feeds(s, sf).billing, feeds(s, sf).catalogue, Q.ledger_table(s, sf), Q._daily()),
    "daily_breakage": lambda s, sf: flows.flow_breakage(
        Q.breakage_stage_table(s, sf), Q.ledger_table(s, sf), feeds(s, sf).billing, feeds(s, sf).rates,
        Q.with_rates(s, sf, Q._daily())),
}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 32, extra={"spark.ui.showConsoleProgress": "false"})
    prepare(spark, sf)
    print(f"# Physical plans (final adaptive plans, {sf}, local[8])\n")
    print("Generated by `tools/show_plans.py`. Scan lines list partition filters, pushed "
          "filters and how many columns each scan reads.\n")
    print("## Shuffle and join counts per query\n")
    print("`default`: the session defaults (AQE broadcasts sides measured under 10 MB). "
          "`no broadcast`: broadcasting disabled, which approximates the plan at 100 TB where "
          "profile, location, billing and ledger sides are far above any broadcast threshold "
          "(rate table, catalogue and key list would still be broadcast there).\n")
    print(f"Not listed, as their plans are those of other entries: {', '.join(SAME_PLAN)}.\n")
    print("| query | shuffles (default) | broadcast joins (default) | shuffles (no broadcast) "
          "| sort-merge joins (no broadcast) |")
    print("| --- | --- | --- | --- | --- |")
    # The sink queries return a table read back; what they cost is their write.
    builders = {n: f for n, f in QUERIES.items() if n not in WRITES and n not in SAME_PLAN}
    for name, build in {**builders, **WRITES}.items():
        counts = []
        for threshold in ("10485760", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
            df = build(spark, sf)
            df.write.format("noop").mode("overwrite").save()
            df.collect()
            final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            counts.append((final.count("Exchange hashpartitioning"),
                           final.count("BroadcastHashJoin"), final.count("SortMergeJoin")))
        print(f"| {name} | {counts[0][0]} | {counts[0][1]} | {counts[1][0]} | {counts[1][2]} |")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10485760")
    print()
    for name in FLOWS:
        df = {**QUERIES, **WRITES}[name](spark, sf)
        df.collect()  # the same query execution now holds the final adaptive plan
        # partition keys are joined by characters that no text file holds
        text = df._jdf.queryExecution().executedPlan().toString().replace("\0", "\\0").replace("\1", "\\1")
        print(f"## {name}\n")
        print("```")
        for ln in text.splitlines():
            ln = re.sub(r"#\d+L?", "", ln)
            m = re.search(r"FileScan parquet \[([^\]]*)\]", ln)
            if m:
                head = ln[:ln.index("FileScan")]
                loc = re.search(r"InMemoryFileIndex\(\d+ paths\)\[[^\]]*/([^/\],]+)", ln)
                pf = re.search(r"PartitionFilters: \[([^\]]*)\]", ln)
                pu = re.search(r"PushedFilters: \[([^\]]*)\]", ln)
                ln = (f"{head}FileScan {loc.group(1) if loc else ''} cols={len(m.group(1).split(','))}"
                      f" PartitionFilters=[{pf.group(1) if pf else ''}]"
                      f" PushedFilters=[{pu.group(1) if pu else ''}]")
                print(ln[:400])
                continue
            print(ln[:170])
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
