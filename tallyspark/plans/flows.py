"""The ledger data flows (D1-D12) as functions ``(inputs, params) -> DataFrame``.

Each flow is a declarative DataFrame plan: scan with a partition filter,
row filters, lookups, then one wide roll-up.  Catalyst pushes the filters
into the scans, prunes unread columns, and every join is an equi-join that
AQE can plan as broadcast (small measured side) or sort-merge.

Day handling: ``params.days`` selects the feed partitions.  With one day
this is exactly the daily batch; with a range or ``None`` the same plan
back-fills many days at once, because every join and group key carries
``event_date`` (the fallback-location join, which deliberately ignores the
day, reads one fixed prior partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
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
    tax_net,
    to_int,
    unknown_if_blank,
)
from tallyspark.operators.allocate import newest_rates, rate_join, reverse
from tallyspark.operators.audit import Audit, watched
from tallyspark.operators.enrich import (
    anti_lookup,
    coalesce_sources,
    dedup_keys,
    handed_off,
    lookup,
    reduce_to,
    semi_lookup,
    top_ranked,
    union_all,
)
from tallyspark.operators.ledger import ledger_rollup
from tallyspark.plans.params import RunParams
from tallyspark.sources.scans import scan_days, scan_newest_loads, scan_reject

C = F.col

# Geography block under its ledger names, and the usual null/blank fill.
_GEO_SAME = {g: g for g in S.GEO_COLUMNS}


def _geo_filled(source_names: dict[str, str]) -> dict:
    return {dst: unknown_if_blank(src) for dst, src in source_names.items()}


# ---------------------------------------------------------------- D1 usage
def flow_charge(feed: DataFrame, p: RunParams) -> DataFrame:
    """Usage charges -> ledger ``CHG``."""
    rows = scan_days(feed, p.days).where(C("pre_post_flag") == "1")
    mapping = {
        "trx_date": C("trx_date"),
        "purchase_date": stamp_to_day_text("timestamp_ifrs"),
        "transaction_id": C("transaction_id"),
        "subs_id": C("subs_id"),
        "msisdn": C("msisdn"),
        "price_plan_id": C("price_plan_id"),
        "brand": C("brand"),
        "pre_post_flag": C("pre_post_flag"),
        "cust_type_desc": C("cust_type_desc"),
        "cust_subtype_desc": C("cust_subtype_desc"),
        "customer_sub_segment": C("customer_sub_segment"),
        "lac": C("lac"), "ci": C("ci"),
        "lacci_id": C("lacci_id_ifrs"),
        "node": C("node"),
        **_geo_filled(_GEO_SAME),
        "lacci_closing_flag": C("lacci_closing_flag"),
        "sigma_business_id": C("sigma_business_id"),
        "sigma_rules_id": C("sigma_rules_id"),
        "sku": C("sku"),
        "l1_payu": C("l1_payu"), "l2_service_type": C("l2_service_type"),
        "l3_allowance_type": C("l3_allowance_type"),
        "l4_product_category": C("l4_product_category"), "l5_product": C("l5_product"),
        "commercial_name": C("commercial_name"), "channel": C("channel"),
        "pack_validity": C("validity"),
        "cust_id": C("cust_id"),
        "quota_name": C("item_id"),
        "service_filter": C("service_filter"),
        "price_plan_name": C("price_plan_name"),
        "channel_id": C("channel_id"), "site_id": C("site_id"), "site_name": C("site_name"),
        "region_hlr": C("region_hlr"), "city_hlr": C("city_hlr"),
        "load_date": p.load_date,
        "event_date": C("event_date"),
        "source": S.TAG_CHG,
    }
    measures = {
        "rev_per_usage": F.sum("rev_per_usage"),
        "rev_seized": 0,
        "dur": F.sum("call_duration"),
        "trx": F.sum("event_allowance_consumed"),
        "vol": F.sum("total_volume"),
    }
    return ledger_rollup(rows, mapping, measures, p.lie_by)


# ---------------------------------------------------------------- D2 expiry
def _expiry_like_mapping(p: RunParams, day_col, tag: str) -> dict:
    return {
        "trx_date": day_col,
        "purchase_date": C("purchase_date_2"),
        "transaction_id": C("transaction_id"),
        "msisdn": C("msisdn"),
        "price_plan_id": to_int("reserve1"),
        "brand": C("brand"),
        "pre_post_flag": 1,
        "cust_type_desc": C("cust_type"),
        "cust_subtype_desc": C("cust_subtype"),
        "node": C("node_type"),
        "area_sales": S.UNKNOWN,
        "region_sales": unknown_if_blank("region"),
        "branch": unknown_if_blank("branch"),
        "subbranch": S.UNKNOWN,
        "cluster_sales": unknown_if_blank("cluster"),
        "provinsi": S.UNKNOWN, "kabupaten": S.UNKNOWN,
        "kecamatan": S.UNKNOWN, "kelurahan": S.UNKNOWN,
        "lacci_closing_flag": None,
        "sigma_business_id": C("bid"),
        "l1_ias": C("l1_ias"), "l2_ias": C("l2_ias"), "l3_ias": C("l3_ias"),
        "cust_id": None,
        "channel_id": prefix("transaction_id", 2),
        "load_date": p.load_date,
        "event_date": day_col,
        "source": tag,
    }


def flow_expiry(feed: DataFrame, p: RunParams) -> DataFrame:
    """Expiry-dated value -> ledger ``PI`` (D2); the day is the expiry day."""
    rows = scan_days(feed, p.days, "expiry_date")
    mapping = _expiry_like_mapping(p, C("expiry_date"), S.TAG_PI)
    return ledger_rollup(rows, mapping, {"rev_per_usage": F.sum("pi_value_final")})


# ---------------------------------------------------------------- D3 seized
def flow_seized(feed: DataFrame, p: RunParams, audit: Audit | None = None) -> DataFrame:
    """Seized balance -> ledger ``SEIZED`` (D3), without outliers of
    ``p.seized_cap`` and more (``seized_outliers`` lists them, an ``audit``
    counts them on the way)."""
    rows = scan_days(feed, p.days).where(C("pre_post_flag") == "1")
    rows = watched(audit, rows, "seized_outliers", _over_cap(p))
    rows = rows.where(C("rev_seized") < F.lit(p.seized_cap))
    geo = {"area_sales": "area_sales", "region_sales": "region_sales", "branch": "branch",
           "subbranch": "sub_branch", "cluster_sales": "cluster_sales", "provinsi": "propinsi",
           "kabupaten": "kabupaten", "kecamatan": "kecamatan", "kelurahan": "kelurahan"}
    mapping = {
        "trx_date": C("trx_date"),
        "purchase_date": stamp_to_day_text("timestamp_ifrs"),
        "transaction_id": C("transaction_id"),
        "subs_id": C("subs_id"), "msisdn": C("msisdn"),
        "price_plan_id": C("price_plan_id"), "brand": C("brand"),
        "pre_post_flag": C("pre_post_flag"),
        "cust_type_desc": C("cust_type_desc"), "cust_subtype_desc": C("cust_subtype_desc"),
        "customer_sub_segment": C("customer_sub_segment"),
        "lac": C("lac"), "ci": C("ci"), "lacci_id": C("lacci_id_ifrs"), "node": C("node"),
        **_geo_filled(geo),
        "lacci_closing_flag": C("lacci_closing_flag"),
        "sigma_business_id": C("sigma_business_id"), "sigma_rules_id": C("sigma_rules_id"),
        "sku": C("sku"),
        "l1_payu": C("l1_payu"), "l2_service_type": C("l2_service_type"),
        "l3_allowance_type": C("l3_allowance_type"),
        "l4_product_category": C("l4_product_category"), "l5_product": C("l5_product"),
        "commercial_name": C("commercial_name"), "channel": C("channel"),
        "pack_validity": C("validity"),
        "cust_id": C("cust_id"), "quota_name": C("item_id"),
        "channel_id": C("channel_id"),
        "region_hlr": C("region_hlr"), "city_hlr": C("city_hlr"),
        "load_date": p.load_date, "event_date": C("event_date"), "source": S.TAG_SEIZED,
    }
    measures = {"rev_seized": F.sum("rev_seized"), "trx": F.sum("remaining_quota")}
    return ledger_rollup(rows, mapping, measures, p.lie_by)


def seized_outliers(feed: DataFrame, p: RunParams) -> DataFrame:
    """Audit of D3: the prepaid rows its cap leaves out, null amounts included."""
    return scan_days(feed, p.days).where(_over_cap(p) & (C("pre_post_flag") == "1"))


def _over_cap(p: RunParams):
    return C("rev_seized").isNull() | (C("rev_seized") >= F.lit(p.seized_cap))


# ---------------------------------------------------------------- D4 quota
def flow_upcc(feed: DataFrame, p: RunParams) -> DataFrame:
    """Quota usage -> ledger ``UPCC-SEIZED`` / ``UPCC_USAGE``.

    The tag is computed per row (P6/A15): positive seized revenue routes to
    ``UPCC-SEIZED``, everything else (null too) to ``UPCC_USAGE``.
    """
    rows = (scan_days(feed, p.days)
            .where((F.substring("quota_extended_attribute", 19, 2) == "00")
                   & C("trigger_type").isin(*S.UPCC_TRIGGER_TYPES)
                   & (C("pre_post_flag") == "1")))
    geo = {"area_sales": "area_sales_ifrs", "region_sales": "region_sales_ifrs",
           "branch": "branch_ifrs", "subbranch": "sub_branch_ifrs",
           "cluster_sales": "cluster_ifrs", "provinsi": "provinsi_ifrs",
           "kabupaten": "kabupaten_ifrs", "kecamatan": "kecamatan_ifrs",
           "kelurahan": "kelurahan_ifrs"}
    mapping = {
        "trx_date": C("trx_date"),
        "purchase_date": stamp_to_day_text("ts_ifrs"),
        "transaction_id": C("quota_extended_attribute"),
        "subs_id": C("subs_id"), "msisdn": C("msisdn"),
        "price_plan_id": C("price_plan_id"), "brand": C("brand"),
        "pre_post_flag": C("pre_post_flag"),
        "cust_type_desc": C("cust_type_desc"), "cust_subtype_desc": C("cust_subtype_desc"),
        "customer_sub_segment": C("customer_sub_segment"),
        "lac": C("lac"), "ci": C("ci"), "lacci_id": C("lacci_id_ifrs"), "node": C("node_type"),
        **_geo_filled(geo),
        "lacci_closing_flag": C("lacci_closing_flag_ifrs"),
        "sigma_business_id": C("sigma_business_id"), "sigma_rules_id": C("sigma_rules_id"),
        "sku": C("package_id"),
        "l1_payu": C("l1_payu"), "l2_service_type": C("l2_service_type"),
        "l3_allowance_type": C("l3_allowance_type"),
        "l4_product_category": C("l4_product_category"), "l5_product": C("l5_product"),
        "commercial_name": C("commercial_name"), "channel": C("channel"),
        "pack_validity": C("validity"),
        "cust_id": C("cust_id"),
        "profile_name": C("service_name"), "quota_name": C("quota_name"),
        "service_filter": nth_token("ifrs_param", 9),
        "channel_id": C("channel_id"), "site_id": C("site_id"), "site_name": C("site_name"),
        "region_hlr": C("region_hlr"), "city_hlr": C("city_hlr"),
        "load_date": p.load_date, "event_date": C("event_date"),
        "source": F.when(C("rev_seized") > 0, F.lit(S.TAG_UPCC_SEIZED))
                   .otherwise(F.lit(S.TAG_UPCC_USAGE)),
    }
    measures = {
        "rev_per_usage": F.sum("rev_per_usage"),
        "rev_seized": F.sum("rev_seized"),
        "trx": F.count(F.lit(1)),
        "vol": F.sum("quota_usage"),
    }
    return ledger_rollup(rows, mapping, measures, p.lie_by)


# ---------------------------------------------------------------- D5 / D11 enrichment
def ranked_location(location: DataFrame, days, per_day: bool = True) -> DataFrame:
    """Distinct location rows of the day(s), top ``lacci_id`` per
    (day, subscriber), ties kept (A3 + W1).

    Exact repeats share a rank, so ranking first and removing repeats after
    gives the same rows, and the second step reuses the ranking's shuffle.

    ``per_day=False`` is for a single-day read (the fallback snapshot): the
    rank is then taken per subscriber alone -- the same rows -- so the
    window's partitioning is exactly the subscriber-only join that follows.
    """
    cols = ["event_date", "msisdn", *S.LOCATION_COLUMNS]
    keys = ["event_date", "msisdn"] if per_day else ["msisdn"]
    return dedup_keys(top_ranked(scan_days(location, days).select(*cols), keys, "lacci_id", ties="all"), cols)


def enrich_charges(charges: DataFrame, profile: DataFrame, current: DataFrame,
                   fallback: DataFrame, days, fallback_date: str, audit: Audit | None = None) -> DataFrame:
    """Charges + profile (J1) + current-or-fallback location.

    The profile is not de-duplicated, so a repeated subscriber-day multiplies
    charge rows exactly like the original left join (T2).
    """
    prof = scan_days(profile, days).select(
        "event_date", "msisdn", "brand", "region_hlr",
        "cust_type_desc", "cust_subtype_desc", "customer_sub_segment")
    charges = watched(audit, charges, "enriched_in")
    out = lookup(charges, prof, ["event_date", "msisdn"], ["event_date", "msisdn"])
    cur = ranked_location(current, days)
    if not isinstance(fallback_date, str):
        raise ValueError("fallback_date must be one day (the prior-period partition)")
    fb = ranked_location(fallback, fallback_date, per_day=False).drop("event_date")
    out = coalesce_sources(out, cur, fb, S.LOCATION_COLUMNS, ["event_date", "msisdn"], ["msisdn"])
    return watched(audit, out, "enriched_out")


def _stage_keys(columns: list[tuple[str, str]], measure: str, source: dict[str, str]) -> list:
    """Group keys of a stage table in its own column order; ``source`` names
    the enriched column where it differs."""
    typed = {"trx_date": C("trx_date").try_cast("date"), "event_date": C("event_date").try_cast("date")}
    return [typed.get(n, C(source.get(n, n))).alias(n) for n, _ in columns if n != measure]


def flow_stage(charges: DataFrame, profile: DataFrame, current: DataFrame,
               fallback: DataFrame, p: RunParams, audit: Audit | None = None) -> DataFrame:
    """Package-charge stage, 31 columns."""
    rows = (scan_days(charges, p.days)
            .where((C("non_usage_flag") == "1") & (C("status") == S.PACKAGE_OK_STATUS)))
    rich = enrich_charges(rows, profile, current, fallback, p.days, p.fallback_date, audit)
    keys = _stage_keys(S.STAGE_COLUMNS, "rev", {"allowance_subtype": "allowance_sub_type"})
    out = rich.groupBy(*keys).agg(F.sum("alloc_tp").alias("rev"))
    return out.select(*[n for n, _ in S.STAGE_COLUMNS])


def flow_breakage_stage(charges: DataFrame, profile: DataFrame, current: DataFrame,
                        fallback: DataFrame, rates: DataFrame, p: RunParams, audit: Audit | None = None) -> DataFrame:
    """Breakage stage, 31 columns (D11): enrichment, allowance class, the
    newest seized rate per (class, region), amount x rate."""
    rows = scan_days(charges, p.days).where(C("status") == S.PACKAGE_OK_STATUS)
    rich = enrich_charges(rows, profile, current, fallback, p.days, p.fallback_date, audit)
    rich = rich.withColumn("allowance", classify_patterns("allowance_sub_type"))
    keys = _stage_keys(S.BREAKAGE_STAGE_COLUMNS, "breakage", {})
    key_names = [k for k, _ in S.BREAKAGE_STAGE_COLUMNS if k != "breakage"]
    pre = rich.groupBy(*keys).agg(F.sum("alloc_tp").alias("rev"))
    rated = rate_join(pre, newest_rates(rates, newest=p.rate_day), "allowance", "region_sales", ("seized_rate",), audit=audit)
    rated = rated.where(null_default_not_equal("brand", S.POSTPAID_BRAND))
    out = rated.groupBy(*key_names).agg(
        F.sum(C("rev") * C("seized_rate")).cast(S.STAGE_MONEY).alias("breakage"))
    return out.select(*[n for n, _ in S.BREAKAGE_STAGE_COLUMNS])


# ---------------------------------------------------------------- D6 package charges
def offers_by_charge_id(usage: DataFrame, usage_rejects: DataFrame, voucher: DataFrame,
                        voucher_rejects: DataFrame, recharge: DataFrame,
                        recharge_rejects: DataFrame, p: RunParams) -> DataFrame:
    """Six charge-id -> offer branches, each distinct, joined by UNION ALL
    (U1): one id found in two branches stays twice (T3)."""
    w = p.offer_window

    def window(df):
        return scan_days(df, w)

    def rejects(df):
        return scan_reject(df, p.run_date, w)

    usage_ok = C("pre_post_flag") == "1"
    voucher_ok = ((C("status") == S.VOUCHER_REDEEMED) & (C("redeem_state") == S.VOUCHER_REDEEMED)
                  & C("bid_flag").isNull())
    recharge_ok = F.upper(C("processing_code")).isin(*S.RECHARGE_PROCESSING_CODES)

    def branch(i, df, cond, id_col, offer_col, label):
        return df.where(cond).select(
            F.lit(i).alias("__branch"), C(id_col).alias("charging_id"),
            F.lit(label).alias("offer_source"), C(offer_col).alias("offer_id"))

    # Each branch is distinct, the union is not: de-duplicating once over
    # (branch, row) gives exactly that, with one shuffle instead of six.
    tagged = union_all([
        branch(0, window(usage), usage_ok, "charging_id", "provider_id", S.OFFER_LABEL_USAGE),
        branch(1, rejects(usage_rejects), usage_ok, "charging_id", "provider_id",
               S.OFFER_LABEL_USAGE),
        branch(2, window(voucher), voucher_ok, "dc_order_id", "offer_id", S.OFFER_LABEL_VOUCHER),
        branch(3, rejects(voucher_rejects), voucher_ok, "dc_order_id", "offer_id",
               S.OFFER_LABEL_VOUCHER),
        branch(4, window(recharge), recharge_ok, "dc_orderid", "offer_id", S.OFFER_LABEL_RECHARGE),
        branch(5, rejects(recharge_rejects), recharge_ok, "dc_orderid", "offer_id",
               S.OFFER_LABEL_RECHARGE),
    ])
    return tagged.distinct().drop("__branch")


def attach_offers(stage_rows: DataFrame, subscriber_offers: DataFrame,
                  charge_offers: DataFrame, days, audit: Audit | None = None) -> DataFrame:
    """Offer per subscriber-day (J5) and per 32-character charge-id prefix
    (J6); both are left joins that multiply on repeated keys (T2)."""
    by_sub = dedup_keys(scan_days(subscriber_offers, days).select(
        "event_date", "msisdn", C("provider_id").alias("sub_offer_id")),
        ["event_date", "msisdn", "sub_offer_id"])
    stage_rows = watched(audit, stage_rows, "offers_in")
    out = lookup(stage_rows, by_sub, ["event_date", "msisdn"], ["event_date", "msisdn"],
                 spread_null_keys=True)
    by_id = charge_offers.select(C("charging_id").alias("__charging_id"),
                                 C("offer_id").alias("chg_offer_id"))
    out = lookup(out, by_id, [prefix("transaction_id", 32)], [prefix("__charging_id", 32)],
                 spread_null_keys=True)
    return watched(audit, out.drop("__charging_id"), "offers_out")


def flow_package(stage: DataFrame, subscriber_offers: DataFrame, charge_offers: DataFrame,
                 p: RunParams, audit: Audit | None = None) -> DataFrame:
    """Package charges -> ledger ``WISDOM``."""
    rows = scan_days(stage, p.days).where(null_default_not_equal("brand", S.POSTPAID_BRAND))
    rich = attach_offers(rows, subscriber_offers, charge_offers, p.days, audit)
    mapping = {
        "trx_date": C("trx_date"),
        "purchase_date": C("trx_date"),
        "transaction_id": C("transaction_id"),
        "msisdn": C("msisdn"),
        "price_plan_id": to_int(F.coalesce(C("sub_offer_id"), C("chg_offer_id"))),
        "brand": C("brand"),
        "pre_post_flag": 1,
        "cust_type_desc": C("cust_type_desc"), "cust_subtype_desc": C("cust_subtype_desc"),
        "customer_sub_segment": C("customer_sub_segment"),
        "lacci_id": C("lacci_id"),
        **_geo_filled(_GEO_SAME),
        "lacci_closing_flag": None,
        "sigma_business_id": C("business_id"), "sigma_rules_id": C("rules_id"),
        "sku": C("sku"),
        "l3_allowance_type": C("allowance_subtype"),
        "cust_id": None,
        "profile_name": C("profile_name"), "quota_name": C("quota_name"),
        "region_hlr": C("region_hlr"),
        "load_date": p.load_date, "event_date": C("event_date"), "source": S.TAG_WISDOM,
    }
    measures = {"rev_per_usage": F.sum("rev"),
                "trx": F.max(present_flag("transaction_id"))}
    return ledger_rollup(rich, mapping, measures, p.lie_by)


# ---------------------------------------------------------------- D7 accrual
def flow_accrual(feed: DataFrame, p: RunParams) -> DataFrame:
    """Daily product accrual -> ledger ``ACCRUAL``.

    ``days`` selects the *feed* partitions; a daily run passes
    ``accrual_days(load_date)`` (load day minus one, T12).  Both output days
    shift back one more day.
    The purchase day comes from the epoch hidden in the transaction id,
    read as milliseconds (T4).
    """
    rows = (scan_days(feed, p.days)
            .where(C("amdd_charge_code") == S.ACCRUAL_CHARGE_CODE))
    mapping = {
        "trx_date": day_shift("trx_date", -1),
        "purchase_date": hex_epoch_day("transaction_id"),
        "transaction_id": C("transaction_id"),
        "subs_id": C("subscriber_id"), "msisdn": C("msisdn"),
        "price_plan_id": to_int("price_plan_id"),
        "brand": C("brand"),
        "pre_post_flag": 2,
        "cust_type_desc": C("cust_type_desc"), "cust_subtype_desc": C("cust_subtype_desc"),
        "customer_sub_segment": C("customer_group"),
        "lac": C("lac"), "ci": C("ci"), "lacci_id": C("lacci_id"), "node": C("node"),
        **_geo_filled(_GEO_SAME),
        "lacci_closing_flag": to_int("lacci_closing_flag"),
        "sigma_business_id": C("sigma_business_id"), "sigma_rules_id": C("sigma_rules_id"),
        "sku": F.substring("transaction_id", 19, 13),
        "l1_payu": C("l1_payu"), "l2_service_type": C("l2_service_type"),
        "l3_allowance_type": C("l3_allowance_type"),
        "l4_product_category": C("l4_product_category"), "l5_product": C("l5_product"),
        "commercial_name": C("commercial_name"), "channel": C("channel"),
        "pack_validity": C("validity"),
        "cust_id": to_int("customer_id"),
        "profile_name": C("charge_code"), "quota_name": C("amdd_charge_code"),
        "service_filter": C("proration_ind"), "price_plan_name": C("offer_name"),
        "channel_id": C("channel_id"),
        "region_hlr": C("region_hlr"), "city_hlr": C("city_hlr"),
        "load_date": p.load_date,
        "event_date": day_shift("event_date", -1),
        "source": S.TAG_ACCRUAL,
    }
    measures = {"rev_per_usage": F.sum("rev"),
                "trx": F.max(present_flag("transaction_id"))}
    return ledger_rollup(rows, mapping, measures)


def accrual_days(load_date: str):
    """The feed partition a daily accrual run reads: load day minus one."""
    from datetime import date, timedelta
    return (date.fromisoformat(load_date) - timedelta(days=1)).isoformat()


# ---------------------------------------------------------------- D8 over-usage
def flow_overusage(feed: DataFrame, p: RunParams) -> DataFrame:
    """Over-usage -> ledger ``OVERUSAGE`` (D8).  The feed is partitioned by
    ``load_date``; that day becomes both ``trx_date`` and ``event_date``."""
    day = C("load_date").try_cast("date")
    rows = (scan_days(feed, p.days, "load_date")
            .where((C("expiry_month").try_cast("date") > day) & (C("flag") == S.OVERUSAGE_FLAG)))
    mapping = _expiry_like_mapping(p, day, S.TAG_OVERUSAGE)
    return ledger_rollup(rows, mapping, {"rev_per_usage": F.sum("pi_value_final")})


# ---------------------------------------------------------------- D9 / D10 billing
def _ledger_rows(ledger: DataFrame, p: RunParams) -> DataFrame:
    """Ledger rows of the run's days; with ``ledger_loads`` only those of the
    newest loads, with ``ledger_load_date`` only of that load (a day loaded
    twice is otherwise counted twice, T7)."""
    rows = scan_days(ledger, p.days)
    if p.ledger_loads is not None:
        rows = scan_newest_loads(rows, p.ledger_loads)
    if p.ledger_load_date is not None:
        rows = rows.where(C("load_date") == F.lit(p.ledger_load_date))
    return rows



def _catalogue_ids(catalogue: DataFrame, days) -> DataFrame:
    active = (scan_days(catalogue, days)
              .where((C("status_flag") == "Y") & (F.lower(C("ifrs_flag")) == "true")))
    return dedup_keys(active.select("event_date", padded_id("business_id", 8).alias("bid")),
                      ["event_date", "bid"])


def _billing_mapping(p: RunParams, tag: str) -> dict:
    return {
        "trx_date": C("trx_date"),
        "purchase_date": C("trx_date"),
        "subs_id": C("subs_id"), "msisdn": C("msisdn"),
        "price_plan_id": to_int("offer_id"),
        "brand": C("brand"),
        "pre_post_flag": to_int("pre_post_flag"),
        "cust_type_desc": C("cust_type_desc"), "cust_subtype_desc": C("cust_subtype_desc"),
        "lac": C("lac"), "ci": C("ci"), "lacci_id": C("lacci_id"), "node": C("node_type"),
        **_geo_filled(_GEO_SAME),
        "lacci_closing_flag": to_int("lacci_closing_flag"),
        "l1_ias": C("l1_name"), "l2_ias": C("l2_name"), "l3_ias": C("l3_name"),
        "cust_id": None,
        "price_plan_name": C("offer"), "channel_id": C("activation_channel_id"),
        "region_hlr": C("region_hlr"), "city_hlr": C("city_hlr"),
        "load_date": p.load_date, "event_date": C("event_date"), "source": tag,
    }


def flow_unmatched(billing: DataFrame, catalogue: DataFrame, p: RunParams) -> DataFrame:
    """Billed charges whose product is not in the day's active catalogue ->
    ledger ``PAYU`` (D9).  Anti join on (day, 8-character product id)."""
    rows = (scan_days(billing, p.days)
            .where(equals_one("pre_post_flag")
                   & not_like_folded("l3_name", S.EXCLUDED_L3_PATTERN)
                   & ~C("source").isin(*S.PAYU_EXCLUDED_SOURCES)))
    rows = anti_lookup(rows, _catalogue_ids(catalogue, p.days),
                       ["event_date", prefix("pack_id", 8)], ["event_date", "bid"])
    mapping = {**_billing_mapping(p, S.TAG_PAYU), "sigma_business_id": C("content_id")}
    measures = {"rev_per_usage": F.sum("rev"), "dur": F.sum("dur"),
                "trx": F.sum("trx"), "vol": F.sum("vol")}
    return ledger_rollup(rows, mapping, measures, p.lie_by)


def flow_late_match(billing: DataFrame, catalogue: DataFrame, ledger: DataFrame,
                    p: RunParams) -> DataFrame:
    """Digital charges that are in the catalogue but not yet recognised that
    day under the six usage tags -> ledger ``WISDOM-NBP`` (D10), net of tax.

    The catalogue side is de-duplicated, so the inner join is a semi join.
    """
    rows = (scan_days(billing, p.days)
            .where((C("pre_post_flag") == "1") & (C("l1_name") == S.LATE_MATCH_L1_NAME)
                   & not_like_folded("l3_name", S.EXCLUDED_L3_PATTERN)
                   & C("source").isin(*S.LATE_MATCH_SOURCES)))
    # the product id is carried as a column, so both lookups share one shuffle
    rows = rows.withColumn("pid", prefix("pack_id", 8))
    rows = semi_lookup(rows, _catalogue_ids(catalogue, p.days), ["event_date", "pid"],
                       ["event_date", "bid"])
    recognised = dedup_keys(
        _ledger_rows(ledger, p).where(C("source").isin(*S.LATE_MATCH_RECOGNISED_TAGS)),
        ["event_date", "sigma_business_id"])
    # The original compares the product id against every recognised id of the
    # day (T15); with a multi-day run the day is part of the key.
    rows = anti_lookup(rows, recognised, ["event_date", "pid"], ["event_date", "sigma_business_id"])
    mapping = {**_billing_mapping(p, S.TAG_WISDOM_NBP),
               "sigma_business_id": prefix("content_id", 8),
               "sigma_rules_id": F.substring("pack_id", 9, 5)}
    measures = {"rev_per_usage": F.sum(tax_net("rev")), "dur": F.sum("dur"),
                "trx": F.sum("trx"), "vol": F.sum("vol")}
    return ledger_rollup(rows, mapping, measures)


# ---------------------------------------------------------------- D12 breakage
_BREAKAGE_KEYS = ["trx_date", "transaction_id", "msisdn", "brand", "cust_type_desc",
                  "cust_subtype_desc", "customer_sub_segment", "lacci_id", *S.GEO_COLUMNS,
                  "business_id", "rules_id", "sku", "allowance_sub_type", "allowance",
                  "profile_name", "quota_name", "region_hlr", "event_date"]


def flow_breakage(stage: DataFrame, ledger: DataFrame, billing: DataFrame,
                  rates: DataFrame, p: RunParams, audit: Audit | None = None) -> DataFrame:
    """Breakage -> ledger ``BREAKAGE`` and ``BREAKAGE-SEIZED``.

    Stage breakage plus the *reversed* seized revenue of the purchase month
    (A10/U2/A14), an offer per subscriber-day from billing (J5), then the
    newest allocation rate per (class, region) (J10/A8).  Amounts are held at
    ``S.WORK_MONEY`` until the rate product, whose digits then all fit, and
    widened to the ledger's type last (T22).

    The breakage set is written to the shared folder first.  Its size is then
    known, and only the billing rows of its subscribers are de-duplicated
    (``reduce_to``).
    """
    if not p.purchase_month:
        raise ValueError("purchase_month is required: without it no seized row is reversed")
    staged = (scan_days(stage, p.days)
              .groupBy(*_BREAKAGE_KEYS)
              .agg(F.sum("breakage").cast(S.WORK_MONEY).alias("breakage"))
              .withColumn("tag", F.lit(S.TAG_BREAKAGE)))
    seized_rows = _ledger_rows(ledger, p).where(
        (F.substring("purchase_date", 1, 7) == F.lit(p.purchase_month))
        & C("source").isin(*S.SEIZED_TAGS) & (C("pre_post_flag") == 1))
    seized = (seized_rows.select(
        "trx_date", "transaction_id", "msisdn", "brand", "cust_type_desc",
        "cust_subtype_desc", "customer_sub_segment", "lacci_id", *S.GEO_COLUMNS,
        C("sigma_business_id").alias("business_id"), C("sigma_rules_id").alias("rules_id"),
        "sku", C("l3_allowance_type").alias("allowance_sub_type"),
        classify_patterns("l3_allowance_type").alias("allowance"),
        "profile_name", "quota_name", "region_hlr", "event_date", "rev_seized")
        .groupBy(*_BREAKAGE_KEYS)
        .agg(F.sum(reverse(C("rev_seized").cast(S.WORK_MONEY))).cast(S.WORK_MONEY).alias("breakage"))
        .withColumn("tag", F.lit(S.TAG_BREAKAGE_SEIZED)))
    both = union_all([staged, seized]).groupBy(*_BREAKAGE_KEYS, "tag").agg(
        F.sum("breakage").cast(S.WORK_MONEY).alias("breakage"))
    both = handed_off(both, "breakage-set")
    billed = scan_days(billing, p.days).where(C("pre_post_flag") == "1").select(
        "event_date", "msisdn", C("offer_id").alias("bill_offer_id"))
    offers = dedup_keys(reduce_to(billed, both, ["event_date", "msisdn"]), ["event_date", "msisdn", "bill_offer_id"])
    both = watched(audit, both, "offers_in")
    rich = lookup(both, offers, ["event_date", "msisdn"], ["event_date", "msisdn"],
                  spread_null_keys=True)
    rich = watched(audit, rich, "offers_out")
    rated = rate_join(rich, newest_rates(rates, newest=p.rate_day), "allowance", "region_sales",
                      ("allocation_rate",), audit=audit)
    mapping = {
        "trx_date": C("trx_date"),
        "purchase_date": C("trx_date"),
        "transaction_id": C("transaction_id"),
        "msisdn": C("msisdn"),
        "price_plan_id": to_int("bill_offer_id"),
        "brand": C("brand"),
        "pre_post_flag": 1,
        "cust_type_desc": C("cust_type_desc"), "cust_subtype_desc": C("cust_subtype_desc"),
        "customer_sub_segment": C("customer_sub_segment"),
        "lacci_id": C("lacci_id"),
        **{g: C(g) for g in S.GEO_COLUMNS},
        "lacci_closing_flag": None,
        "sigma_business_id": C("business_id"), "sigma_rules_id": C("rules_id"),
        "sku": C("sku"),
        "l3_allowance_type": C("allowance_sub_type"),
        "cust_id": None,
        "profile_name": C("profile_name"), "quota_name": C("quota_name"),
        "region_hlr": C("region_hlr"),
        "load_date": p.load_date, "event_date": C("event_date"), "source": C("tag"),
    }
    measures = {"rev_per_usage": F.sum(C("breakage") * C("allocation_rate"))}
    return ledger_rollup(rated, mapping, measures)
