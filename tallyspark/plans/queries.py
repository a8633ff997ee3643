"""Registered queries: every operator and flow bound to the driver test tables.

Each entry is ``(spark, sf_dir) -> DataFrame``.  The flows run as back-fills
over every partition of the derived feeds (``days=None``), so each query's
work grows with the tables; the scan operators that exist to prune
(``scan_day``, ``scan_range``, ``scan_reject``, ``latest_snapshot``) keep
their partition predicate because pruning is the feature under test.

The sink queries write under the shared work folder and return the table
read back.
"""

from __future__ import annotations

import threading
import uuid
from dataclasses import replace
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import schema as S
from tallyspark.functions import (
    classify_patterns,
    day_shift,
    equals_one,
    hex_epoch_day,
    not_like_folded,
    nth_token,
    null_default_not_equal,
    padded_id,
    prefix,
    present_flag,
    stamp_to_day_text,
    to_int,
    unknown_if_blank,
)
from tallyspark.operators import (
    Audit,
    coalesce_sources,
    dedup_keys,
    ensure_table,
    key_totals,
    ledger_project,
    ledger_rollup,
    lookup,
    merge_actions,
    merge_full_sync,
    newest_rates,
    overwrite_partitions,
    promote,
    publish,
    rate_join,
    read_target,
    semi_lookup,
    union_all,
)
from tallyspark.plans import flows
from tallyspark.plans.params import RunParams
from tallyspark.session import ensure_session_defaults, scratch_path
from tallyspark.sources import driver as D
from tallyspark.sources.scans import (
    latest_snapshot,
    newest_loads,
    newest_partition,
    scan_day,
    scan_newest_loads,
    scan_range,
    scan_reject,
)

C = F.col

# Parameters of the registered runs (fixed test values).
DAY = "2024-01-15"
RANGE = ("2024-01-10", "2024-01-20")
PARAMS = RunParams(load_date=D.LOAD_DATE, days=None, fallback_date=D.FALLBACK_DATE,
                   purchase_month=D.PURCHASE_MONTH, offer_window=None, run_date=D.RUN_DATE)
# The ledger's flows write together, each in ranges of these columns.
LEDGER_PARAMS = replace(PARAMS, lie_by=("event_date", "msisdn", "transaction_id", "sigma_business_id"))
# Load day of the daily accrual run; it reads the day before.
ACCRUAL_LOAD = "2024-01-16"
# The promotion test stages a newer load of these days.
PROMOTE_FROM = "2024-01-16"
# Load day of the superseded ledger load.
EARLIER_LOAD = "2024-02-01"

_FEEDS: dict[tuple[str, str], D.DriverFeeds] = {}
_FEEDS_LOCK = threading.Lock()


def feeds(spark: SparkSession, sf_dir: str) -> D.DriverFeeds:
    """The derived feed tables of one scale factor, written once per session."""
    ensure_session_defaults(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    with _FEEDS_LOCK:
        if key not in _FEEDS:
            _FEEDS[key] = D.DriverFeeds(spark, sf_dir)
        return _FEEDS[key]


def with_rates(spark: SparkSession, sf_dir: str, params: RunParams) -> RunParams:
    """``params`` with the newest rate snapshot, from the partition list."""
    return replace(params, rate_day=newest_partition(spark, feeds(spark, sf_dir).path("rates")))


def handoff(spark: SparkSession, sf_dir: str, name: str, build, partitions, cluster_by=(),
            rebalance: str | None = "partitions") -> DataFrame:
    """A table one flow writes and a later flow reads (stage, ledger).

    Written once per session with dynamic partition overwrite under the
    shared work folder and read back with its schema -- the same hand-off
    the daily jobs make through stored tables, and a lineage cut that
    survives executor loss.
    """
    f = feeds(spark, sf_dir)
    cache_key = f"__handoff_{name}"
    with f.lock:
        if cache_key not in f._cache:
            path = f"{f.root}/{name}"
            schema = None
            for df in build():
                schema = df.schema
                overwrite_partitions(df, path, partitions, rebalance, cluster_by=cluster_by)
            f._cache[cache_key] = read_target(spark, path, schema).select(*schema.names)
        return f._cache[cache_key]


# ------------------------------------------------------------------ flows
def q_flow_charge(spark, sf, params=PARAMS):
    return flows.flow_charge(feeds(spark, sf).charge, params)


def q_flow_expiry(spark, sf):
    return flows.flow_expiry(feeds(spark, sf).expiry, PARAMS)


def q_flow_seized(spark, sf, params=PARAMS):
    return flows.flow_seized(feeds(spark, sf).seized, params)


def q_flow_upcc(spark, sf, params=PARAMS):
    return flows.flow_upcc(feeds(spark, sf).quota, params)


def q_flow_stage(spark, sf):
    f = feeds(spark, sf)
    return flows.flow_stage(f.package, f.profile, f.location, f.location, PARAMS)


def _charge_offers(f: D.DriverFeeds) -> DataFrame:
    return flows.offers_by_charge_id(f.usage_offers, f.usage_rejects, f.voucher_offers,
                                     f.voucher_rejects, f.recharge_offers, f.recharge_rejects,
                                     PARAMS)


def stage_table(spark, sf) -> DataFrame:
    """Package-charge stage (D5) as written for the package flow."""
    return handoff(spark, sf, "stage", lambda: [q_flow_stage(spark, sf)], ["event_date"])


def q_flow_package(spark, sf, params=PARAMS):
    f = feeds(spark, sf)
    return flows.flow_package(stage_table(spark, sf), f.subscriber_offers, _charge_offers(f),
                              params)


def q_flow_accrual(spark, sf):
    return flows.flow_accrual(feeds(spark, sf).accrual, PARAMS)


def q_flow_overusage(spark, sf):
    return flows.flow_overusage(feeds(spark, sf).overusage, PARAMS)


def q_flow_unmatched(spark, sf, params=PARAMS):
    f = feeds(spark, sf)
    return flows.flow_unmatched(f.billing, f.catalogue, params)


def ledger_table(spark, sf) -> DataFrame:
    """The ledger as the upstream jobs leave it: usage charges, seized
    balance, quota usage, unmatched billing and package charges, each
    written into its own (load_date, event_date, source) partitions."""
    def build():
        # The five flows never share a (load_date, event_date, source)
        # partition, so each is written by itself, as by its own job run, and
        # its shuffle files go before the next one starts.  Each roll-up
        # leaves its rows in ranges of day and subscriber, so they are written
        # as they come.
        for flow in (q_flow_charge, q_flow_seized, q_flow_upcc, q_flow_unmatched, q_flow_package):
            yield flow(spark, sf, LEDGER_PARAMS)
    return handoff(spark, sf, "ledger", build, list(S.LEDGER_PARTITIONS), ["msisdn"], rebalance=None)


def q_flow_late_match(spark, sf):
    f = feeds(spark, sf)
    return flows.flow_late_match(f.billing, f.catalogue, ledger_table(spark, sf), PARAMS)


def q_flow_breakage_stage(spark, sf):
    f = feeds(spark, sf)
    return flows.flow_breakage_stage(f.package, f.profile, f.location, f.location, f.rates, with_rates(spark, sf, PARAMS))


def breakage_stage_table(spark, sf) -> DataFrame:
    return handoff(spark, sf, "breakage_stage", lambda: [q_flow_breakage_stage(spark, sf)],
                   ["event_date"])


def q_flow_breakage(spark, sf):
    f = feeds(spark, sf)
    return flows.flow_breakage(breakage_stage_table(spark, sf), ledger_table(spark, sf),
                               f.billing, f.rates, with_rates(spark, sf, PARAMS))


# ------------------------------------------------------------------ scans
def q_scan_day(spark, sf):
    return scan_day(feeds(spark, sf).charge, DAY).select(
        "event_date", "msisdn", "transaction_id", "event_allowance_consumed", "rev_per_usage")


def q_scan_range(spark, sf):
    return scan_range(feeds(spark, sf).package, *RANGE).select(
        "event_date", "msisdn", "transaction_id", "status", "alloc_tp")


def q_scan_reject(spark, sf):
    return scan_reject(feeds(spark, sf).usage_rejects, D.RUN_DATE, RANGE).select(
        "event_date", "trx_date", "charging_id", "provider_id")


def q_latest_snapshot(spark, sf):
    """Rows of the newest catalogue listing day (the same scan the rate table
    gets inside the breakage flows, on a table that grows with the data)."""
    f = feeds(spark, sf)
    return latest_snapshot(f.catalogue, newest=newest_partition(spark, f.path("catalogue")))


def q_scan_reject_today(spark, sf):
    """Rejects of the day the query runs on (X16): the newest reject
    partition is laid under today's date, and no run date is given."""
    rows = feeds(spark, sf).usage_rejects
    today = F.when(C("event_date") == F.lit(D.RUN_DATE).cast("date"), F.current_date()).otherwise(C("event_date"))
    return scan_reject(rows.withColumn("event_date", today), None, RANGE).select("trx_date", "charging_id", "provider_id")


def q_newest_loads(spark, sf):
    """A ledger whose later days were loaded twice for one tag: the newest
    load of each day and tag (T7)."""
    f = feeds(spark, sf)
    target, struct = scratch_path(spark, "ledger"), S.ledger_struct()
    morning = f.charge.where(F.substring("timestamp_ifrs", 9, 2) < "12")
    early = replace(PARAMS, load_date=EARLIER_LOAD)
    overwrite_partitions(flows.flow_charge(morning, early).unionByName(flows.flow_seized(f.seized, early)), target, S.LEDGER_PARTITIONS)
    overwrite_partitions(flows.flow_charge(f.charge.where(C("event_date") >= F.lit(PROMOTE_FROM).cast("date")), PARAMS),
                         target, S.LEDGER_PARTITIONS)
    return scan_newest_loads(read_target(spark, target, struct), newest_loads(spark, target)).select(*S.LEDGER_NAMES)


# ------------------------------------------------------------------ filters / columns
def q_filters_basic(spark, sf):
    b = feeds(spark, sf).billing
    rows = b.where(C("source").isin(*S.LATE_MATCH_SOURCES)
                   & (C("l1_name") == S.LATE_MATCH_L1_NAME) & (C("pre_post_flag") == "1"))
    return rows.select("event_date", "msisdn", "pack_id", "source", "rev")


def q_filters_nulls(spark, sf):
    b = feeds(spark, sf).billing
    rows = b.where(equals_one("pre_post_flag")
                   & not_like_folded("l3_name", S.EXCLUDED_L3_PATTERN)
                   & ~C("source").isin(*S.PAYU_EXCLUDED_SOURCES)
                   & null_default_not_equal("brand", S.POSTPAID_BRAND))
    return rows.select("event_date", "msisdn", "pack_id", "source", "l3_name", "rev")


def q_ledger_project(spark, sf):
    ch = feeds(spark, sf).charge
    mapping = {"trx_date": C("trx_date"), "purchase_date": stamp_to_day_text("timestamp_ifrs"),
               "transaction_id": C("transaction_id"), "msisdn": C("msisdn"),
               "price_plan_id": C("price_plan_id"), "pre_post_flag": C("pre_post_flag"),
               "lacci_id": C("lacci_id_ifrs"), "area_sales": unknown_if_blank("area_sales"),
               "lacci_closing_flag": C("lacci_closing_flag"), "l1_ias": "",
               "cust_id": C("cust_id"), "load_date": PARAMS.load_date,
               "event_date": C("event_date"), "source": S.TAG_CHG}
    measures = {"rev_per_usage": C("rev_per_usage"), "dur": C("call_duration"),
                "trx": C("event_allowance_consumed"), "vol": C("total_volume")}
    return ledger_project(ch, mapping, measures)


def q_ledger_rollup(spark, sf):
    rows = q_ledger_project(spark, sf)
    mapping = {n: C(n) for n in S.LEDGER_KEYS}
    measures = {"rev_per_usage": F.sum("rev_per_usage"), "rev_seized": 0,
                "dur": F.sum("dur"), "trx": F.sum("trx"), "vol": F.sum("vol")}
    return ledger_rollup(rows, mapping, measures)


def q_unknown_fill(spark, sf):
    ch = feeds(spark, sf).charge
    return ch.select("event_date", "msisdn", "transaction_id",
                     *[unknown_if_blank(g).alias(g) for g in S.GEO_COLUMNS])


def q_classify_pattern(spark, sf):
    pk = feeds(spark, sf).package
    return pk.select("transaction_id", "allowance_sub_type",
                     classify_patterns("allowance_sub_type").alias("allowance"))


def q_parse_ids(spark, sf):
    ex = feeds(spark, sf).expiry
    return ex.select("transaction_id", "msisdn", "reserve1",
                     to_int("reserve1").alias("price_plan_id"))


def q_id_slices(spark, sf):
    ch = feeds(spark, sf).charge
    return ch.select("transaction_id", "timestamp_ifrs",
                     stamp_to_day_text("timestamp_ifrs").alias("purchase_date"),
                     prefix("transaction_id", 2).alias("channel_id"),
                     padded_id("cust_id", 8).alias("padded_cust_id"),
                     F.substring("sigma_business_id", 1, 8).alias("business_prefix"))


def q_nth_token(spark, sf):
    qf = feeds(spark, sf).quota
    return qf.select("quota_extended_attribute", "ifrs_param",
                     nth_token("ifrs_param", 9).alias("service_filter"))


def q_hex_epoch_day(spark, sf):
    ac = feeds(spark, sf).accrual
    return ac.select("transaction_id", hex_epoch_day("transaction_id").alias("purchase_date"))


def q_date_shift(spark, sf):
    ac = feeds(spark, sf).accrual
    return ac.select("transaction_id", day_shift("trx_date", -1).alias("trx_date"),
                     day_shift("event_date", -1).alias("event_date"))


# ------------------------------------------------------------------ enrichment
def q_enrich_profile(spark, sf):
    f = feeds(spark, sf)
    prof = f.profile.select("event_date", "msisdn", "brand", "region_hlr")
    out = lookup(f.package, prof, ["event_date", "msisdn"], ["event_date", "msisdn"])
    return out.select("event_date", "msisdn", "transaction_id", "brand", "region_hlr", "alloc_tp")


def q_rank_latest(spark, sf):
    return flows.ranked_location(feeds(spark, sf).location, None)


def q_dual_location(spark, sf):
    f = feeds(spark, sf)
    cur = flows.ranked_location(f.location, None)
    fb = flows.ranked_location(f.location, D.FALLBACK_DATE, per_day=False).drop("event_date")
    base = f.package.select("event_date", "msisdn", "transaction_id", "alloc_tp")
    return coalesce_sources(base, cur, fb, S.LOCATION_COLUMNS, ["event_date", "msisdn"],
                            ["msisdn"])


def q_dedup_keys(spark, sf):
    return dedup_keys(feeds(spark, sf).subscriber_offers, ["event_date", "msisdn", "provider_id"])


def q_offer_lookup(spark, sf):
    f = feeds(spark, sf)
    offers = dedup_keys(f.subscriber_offers, ["event_date", "msisdn", "provider_id"])
    out = lookup(f.package.select("event_date", "msisdn", "transaction_id", "alloc_tp"),
                 offers, ["event_date", "msisdn"], ["event_date", "msisdn"])
    return out


def q_union_offers(spark, sf):
    return _charge_offers(feeds(spark, sf))


def q_prefix_join(spark, sf):
    f = feeds(spark, sf)
    offers = dedup_keys(f.usage_offers.where(C("pre_post_flag") == "1"),
                        ["charging_id", "provider_id"])
    base = f.package.select("event_date", "msisdn", "transaction_id", "alloc_tp")
    return lookup(base, offers, [prefix("transaction_id", 32)], [prefix("charging_id", 32)])


def q_catalogue_match(spark, sf):
    f = feeds(spark, sf)
    cat = dedup_keys(f.catalogue.where((C("status_flag") == "Y")
                                       & (F.lower(C("ifrs_flag")) == "true"))
                     .select("event_date", padded_id("business_id", 8).alias("bid")),
                     ["event_date", "bid"])
    rows = semi_lookup(f.billing, cat, ["event_date", prefix("pack_id", 8)], ["event_date", "bid"])
    return rows.select("event_date", "msisdn", "pack_id", "source", "rev")


def q_rate_allocate(spark, sf):
    f = feeds(spark, sf)
    ch = f.charge.select("event_date", "msisdn", "transaction_id", "customer_sub_segment",
                         "rev_per_usage",
                         classify_patterns("l3_allowance_type").alias("allowance"))
    rated = rate_join(ch, newest_rates(f.rates, newest=newest_partition(spark, f.path("rates"))), "allowance", "customer_sub_segment",
                      ("seized_rate", "allocation_rate"))
    return rated.select("event_date", "msisdn", "transaction_id", "allowance",
                        C("customer_sub_segment").alias("region"),
                        (C("rev_per_usage") * C("seized_rate")).cast("decimal(38,6)").alias("seized"),
                        (C("rev_per_usage") * C("allocation_rate")).cast("decimal(38,6)")
                        .alias("allocated"))


def q_count_distinct(spark, sf):
    pk = feeds(spark, sf).package
    return pk.groupBy("event_date", "msisdn", "transaction_id").agg(
        F.max(present_flag("transaction_id")).cast("int").alias("trx"),
        F.sum("alloc_tp").alias("rev"))


def q_ledger_by_source(spark, sf):
    ledger = ledger_table(spark, sf)
    rows = ledger.where(C("source").isin(*S.LATE_MATCH_RECOGNISED_TAGS))
    return dedup_keys(rows, ["event_date", "source", "sigma_business_id"])


# ------------------------------------------------------------------ sinks
def q_overwrite_partition(spark, sf):
    """Two loads into one ledger path: a morning CHG load plus SEIZED, then a
    full-day CHG load.  Dynamic overwrite replaces the CHG partitions and
    keeps SEIZED."""
    f = feeds(spark, sf)
    target = scratch_path(spark, "ledger")
    morning = f.charge.where(F.substring("timestamp_ifrs", 9, 2) < "12")
    first = flows.flow_charge(morning, PARAMS).unionByName(flows.flow_seized(f.seized, PARAMS))
    overwrite_partitions(first, target, S.LEDGER_PARTITIONS)
    overwrite_partitions(flows.flow_charge(f.charge, PARAMS), target, S.LEDGER_PARTITIONS)
    return read_target(spark, target, S.ledger_struct()).select(*S.LEDGER_NAMES)


def q_merge_full_sync(spark, sf):
    """What the merge does to each row, by action."""
    f = feeds(spark, sf)
    return merge_actions(f.voucher_target, f.voucher_source, list(S.VOUCHER_MERGE_KEYS))


def q_merge_target(spark, sf):
    """A day-partitioned target after the merge, read back."""
    f = feeds(spark, sf)
    target = scratch_path(spark, "voucher")
    overwrite_partitions(f.voucher_target, target, ["event_date"])
    merge_full_sync(spark, f.voucher_source, target, list(S.VOUCHER_MERGE_KEYS), ["event_date"],
                    f.voucher_target.schema)
    return read_target(spark, target, f.voucher_target.schema).select(*f.voucher_target.columns)


def q_merge_recovered(spark, sf):
    """The same merge after a run that broke off once it had decided: its
    replacement, of all but the first of the merge's days, is finished, then
    merged over."""
    f = feeds(spark, sf)
    target, rows = scratch_path(spark, "voucher"), f.voucher_source
    overwrite_partitions(f.voucher_target, target, ["event_date"])
    later = rows.where(C("event_date") > rows.select(F.min("event_date")).scalar())
    publish.decide(spark, target, publish.stage(spark, later, target, ["event_date"]), rows.schema)
    counts = merge_full_sync(spark, rows, target, list(S.VOUCHER_MERGE_KEYS), ["event_date"], rows.schema)
    merged = read_target(spark, target, rows.schema).select(*rows.columns)
    return merged.withColumns({"n_updated": F.lit(counts.update).cast("long"), "n_inserted": F.lit(counts.insert).cast("long"),
                               "n_deleted": F.lit(counts.delete).cast("long")})


def _promoted(spark, rows: DataFrame, earlier: str, day_col: str, keys: list[str],
              rebalance: str | None = None) -> DataFrame:
    """An earlier load holding only the ``earlier`` rows, then a full reload
    of the later days staged and promoted by the partition ``keys``.  Rows of
    a table that lies by these keys are written as they come; others are dealt
    by ``rebalance``."""
    target, staged = scratch_path(spark, "promoted"), scratch_path(spark, "staged")
    overwrite_partitions(rows.where(earlier), target, keys, rebalance)
    overwrite_partitions(rows.where(C(day_col) >= F.lit(PROMOTE_FROM).cast("date")), staged, keys, rebalance)
    promote(spark, staged, target, keys, target_columns=rows.columns, schema=rows.schema)
    return read_target(spark, target, rows.schema).select(*rows.columns)


def q_promote(spark, sf):
    return _promoted(spark, feeds(spark, sf).location, "node_type != 'error'", "event_date", ["event_date"])


def _table(spark, name: str, rows: DataFrame, keys: list[str]) -> str:
    """A catalog table of this run with ``rows`` in it."""
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    ensure_table(spark, table, rows.schema, keys)
    overwrite_partitions(rows, table, keys)
    return table


def _promoted_table(spark, sf, clear: bool) -> DataFrame:
    """Locations promoted between catalog tables; rows a day of the target
    and of what is left of the staged table."""
    rows = feeds(spark, sf).location
    target = _table(spark, "promoted", rows.where("node_type != 'error'"), ["event_date"])
    staged = _table(spark, "staged", rows.where(C("event_date") >= F.lit(PROMOTE_FROM).cast("date")), ["event_date"])
    promote(spark, staged, target, ["event_date"], target_columns=spark.table(target).columns,
            clear_source=clear, drop_source=not clear)
    sides = [spark.table(target).withColumn("side", F.lit("target"))]
    if spark.catalog.tableExists(staged):
        sides.append(spark.table(staged).withColumn("side", F.lit("staged")))
    return union_all(sides).groupBy("side", "event_date").agg(F.count(F.lit(1)).alias("n_rows"))


def q_promote_clear(spark, sf):
    """The staged table is truncated once it is promoted (K5)."""
    return _promoted_table(spark, sf, clear=True)


def q_promote_drop(spark, sf):
    """The staged table is dropped once it is promoted (K6)."""
    return _promoted_table(spark, sf, clear=False)


def q_first_load(spark, sf):
    """A ledger load into a catalog that has no ledger yet, and a second one
    into the table the first has made (K1, K7)."""
    f = feeds(spark, sf)
    table, loads = f"ledger_{uuid.uuid4().hex[:12]}", []
    for flow, feed, tag in ((flows.flow_charge, f.charge, S.TAG_CHG), (flows.flow_seized, f.seized, S.TAG_SEIZED)):
        rows = flow(feed, PARAMS)
        loads.append(ensure_table(spark, table, S.ledger_struct(), S.LEDGER_PARTITIONS, ["msisdn"]))
        overwrite_partitions(rows, table, S.LEDGER_PARTITIONS, cluster_by=["msisdn"])
    return spark.table(table).select(*S.LEDGER_NAMES, F.lit(loads == [True, False]).alias("made_once"))


def q_flow_audit(spark, sf):
    """What the flows drop and multiply, counted while they run (T2, T16,
    F7)."""
    f, audit = feeds(spark, sf), Audit()
    flows_run = [flows.flow_breakage_stage(f.package, f.profile, f.location, f.location, f.rates, with_rates(spark, sf, PARAMS), audit),
                 flows.flow_seized(f.seized, PARAMS, audit)]
    for rows in flows_run:
        rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(sorted(audit.report().items()), "name string, n long")


def q_promote_two_keys(spark, sf):
    """Keyed by event day and load day (M5, M6)."""
    rows = feeds(spark, sf).accrual.select("event_date", "load_date", "transaction_id", "charge_code", "rev")
    return _promoted(spark, rows, "charge_code != 'CC-error'", "event_date", ["event_date", "load_date"], "partitions")


def q_promote_load_date(spark, sf):
    """Keyed by load day (M7)."""
    rows = feeds(spark, sf).overusage.select("load_date", "transaction_id", "msisdn", "flag", "pi_value_final")
    return _promoted(spark, rows, "flag = 'alloc_<_rev'", "load_date", ["load_date"])


def q_promote_expiry_date(spark, sf):
    """Keyed by expiry day."""
    rows = feeds(spark, sf).expiry.select("expiry_date", "transaction_id", "msisdn", "reserve1", "pi_value_final")
    return _promoted(spark, rows, "reserve1 != 'junk'", "expiry_date", ["expiry_date"])


def q_promote_ledger(spark, sf):
    """Keyed like the ledger (M11): load day, event day and tag."""
    return _promoted(spark, ledger_table(spark, sf), "source != 'PAYU'", "event_date", list(S.LEDGER_PARTITIONS))


# ------------------------------------------------------------------ daily runs
def _daily(**changes) -> RunParams:
    return RunParams(**{**PARAMS.__dict__, "days": DAY, **changes})


def q_daily_expiry(spark, sf):
    return flows.flow_expiry(feeds(spark, sf).expiry, _daily())


def q_daily_accrual(spark, sf):
    """The day follows from the load day, whatever event day is asked for."""
    return flows.flow_accrual(feeds(spark, sf).accrual,
                              _daily(load_date=ACCRUAL_LOAD, days=flows.accrual_days(ACCRUAL_LOAD)))


def q_daily_overusage(spark, sf):
    return flows.flow_overusage(feeds(spark, sf).overusage, _daily())


def q_daily_package(spark, sf):
    f, p = feeds(spark, sf), _daily(offer_window=RANGE)
    offers = flows.offers_by_charge_id(f.usage_offers, f.usage_rejects, f.voucher_offers, f.voucher_rejects,
                                       f.recharge_offers, f.recharge_rejects, p)
    return flows.flow_package(stage_table(spark, sf), f.subscriber_offers, offers, p)


def own_ledger(spark, sf, name: str) -> str:
    """Path of a ledger that a daily flow both reads and writes: a copy of the
    hand-off ledger, made once per session (``prepare``).  A flow replaces only
    partitions it does not read, so it can run on it again."""
    handoff(spark, sf, name, lambda: [ledger_table(spark, sf)], list(S.LEDGER_PARTITIONS), rebalance=None)
    return f"{feeds(spark, sf).root}/{name}"


def _into_own_ledger(spark, sf, name: str, flow) -> DataFrame:
    """Run a daily flow that reads the ledger and writes another partition of
    the same table (S6); the day's ledger read back."""
    target, struct = own_ledger(spark, sf, name), S.ledger_struct()
    overwrite_partitions(flow(read_target(spark, target, struct)), target, S.LEDGER_PARTITIONS, "rows")
    return scan_day(read_target(spark, target, struct), DAY).select(*S.LEDGER_NAMES)


def q_daily_late_match(spark, sf):
    f = feeds(spark, sf)
    return _into_own_ledger(spark, sf, "ledger_late_match", lambda ledger: flows.flow_late_match(
        f.billing, f.catalogue, ledger, _daily()))


def q_daily_breakage(spark, sf):
    f = feeds(spark, sf)
    return _into_own_ledger(spark, sf, "ledger_breakage", lambda ledger: flows.flow_breakage(
        breakage_stage_table(spark, sf), ledger, f.billing, f.rates, with_rates(spark, sf, _daily())))


def q_key_lookup(spark, sf):
    f = feeds(spark, sf)
    return key_totals(ledger_table(spark, sf), f.key_list)


def q_sample_filter(spark, sf):
    """Parameterised sample: rows with ``ID <= 10`` (the label says < 10)."""
    cust = feeds(spark, sf).t["customer"]
    df = cust.select(C("c_name").alias("Name"), C("c_custkey").alias("ID"))
    return df.filter(df["ID"] <= 10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_day": q_scan_day,
    "scan_range": q_scan_range,
    "scan_reject": q_scan_reject,
    "scan_reject_today": q_scan_reject_today,
    "latest_snapshot": q_latest_snapshot,
    "filters_basic": q_filters_basic,
    "filters_nulls": q_filters_nulls,
    "ledger_project": q_ledger_project,
    "unknown_fill": q_unknown_fill,
    "classify_pattern": q_classify_pattern,
    "enrich_profile": q_enrich_profile,
    "dual_location": q_dual_location,
    "offer_lookup": q_offer_lookup,
    "prefix_join": q_prefix_join,
    "catalogue_match": q_catalogue_match,
    "rate_allocate": q_rate_allocate,
    "union_offers": q_union_offers,
    "rank_latest": q_rank_latest,
    "dedup_keys": q_dedup_keys,
    "count_distinct": q_count_distinct,
    "ledger_rollup": q_ledger_rollup,
    "ledger_by_source": q_ledger_by_source,
    "parse_ids": q_parse_ids,
    "id_slices": q_id_slices,
    "nth_token": q_nth_token,
    "hex_epoch_day": q_hex_epoch_day,
    "date_shift": q_date_shift,
    "overwrite_partition": q_overwrite_partition,
    "merge_full_sync": q_merge_full_sync,
    "merge_target": q_merge_target,
    "merge_recovered": q_merge_recovered,
    "newest_loads": q_newest_loads,
    "first_load": q_first_load,
    "promote": q_promote,
    "promote_clear": q_promote_clear,
    "promote_drop": q_promote_drop,
    "flow_audit": q_flow_audit,
    "promote_two_keys": q_promote_two_keys,
    "promote_load_date": q_promote_load_date,
    "promote_expiry_date": q_promote_expiry_date,
    "promote_ledger": q_promote_ledger,
    "key_lookup": q_key_lookup,
    "sample_filter": q_sample_filter,
    "flow_charge": q_flow_charge,
    "flow_expiry": q_flow_expiry,
    "flow_seized": q_flow_seized,
    "flow_upcc": q_flow_upcc,
    "flow_stage": q_flow_stage,
    "flow_package": q_flow_package,
    "flow_accrual": q_flow_accrual,
    "flow_overusage": q_flow_overusage,
    "flow_unmatched": q_flow_unmatched,
    "flow_late_match": q_flow_late_match,
    "flow_breakage_stage": q_flow_breakage_stage,
    "flow_breakage": q_flow_breakage,
    "daily_expiry": q_daily_expiry,
    "daily_accrual": q_daily_accrual,
    "daily_overusage": q_daily_overusage,
    "daily_package": q_daily_package,
    "daily_late_match": q_daily_late_match,
    "daily_breakage": q_daily_breakage,
}


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Write every derived feed table and hand-off table up front (what the
    upstream loads and jobs leave behind before a daily run)."""
    f = feeds(spark, sf_dir)
    for name in [*D.FEEDS, "rates"]:
        f.feed(name)
    stage_table(spark, sf_dir)
    breakage_stage_table(spark, sf_dir)
    ledger_table(spark, sf_dir)
    for name in ("ledger_late_match", "ledger_breakage"):
        own_ledger(spark, sf_dir, name)
