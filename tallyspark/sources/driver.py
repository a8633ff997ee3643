"""Binding of the driver test tables to the feed shapes the flows read.

The test tables are a TPC-H-like star schema plus an ``events`` stream; the
flows read telecom feeds.  Each feed here is *derived by Spark* from those
tables (so its size grows with them): events joined to their customer's
nation and region stand in for usage, charge, location, profile and offer
feeds; line items joined to orders stand in for billing; parts for the
product catalogue; regions for the rate table; orders for the voucher
tables of the full-sync merge.

Columns are written as SQL expressions in the dialect Spark SQL and DuckDB
share (``||``, ``lpad``, ``substr``, ``CASE``, ``try_cast``...), applied with
``selectExpr``.  The DuckDB oracle reuses the same expressions so both
engines start from identical inputs; the flows themselves are implemented
independently on each side.  The few dialect-specific expressions are kept
in pairs.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Partition that holds "today's" rejects in the derived reject feeds.
RUN_DATE = "2024-02-01"
# Partition read as the prior-period (fallback) location snapshot.
FALLBACK_DATE = "2024-01-01"
# Month whose seized revenue the breakage flow reverses.
PURCHASE_MONTH = "2024-01"
# Load day written into every ledger row of the test runs.
LOAD_DATE = "2024-02-02"
# The two dated snapshots of the derived rate table (the newest one wins).
RATE_SNAPSHOTS = ("2023-12-31", "2024-01-01")

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}


# ----------------------------------------------------------- usage base ----
# events ⋈ customer ⋈ nation ⋈ region, plus derived columns every events feed uses.
USAGE_BASE_SQL = (
    "events e LEFT JOIN customer c ON e.user_id = c.c_custkey "
    "LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey "
    "LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"
)

USAGE_BASE: list[tuple[str, str]] = [
    ("event_id", "event_id"),
    ("user_id", "user_id"),
    ("event_type", "event_type"),
    ("ts", "ts"),
    ("event_date", "cast(ts as date)"),
    ("trx_date", "cast(cast(ts as date) as string)"),
    ("day_stamp", "cast(year(ts) as string) || lpad(cast(month(ts) as string), 2, '0') "
                  "|| lpad(cast(day(ts) as string), 2, '0')"),
    ("time_stamp", "lpad(cast(hour(ts) as string), 2, '0') || lpad(cast(minute(ts) as string), 2, '0') "
                   "|| lpad(cast(second(ts) as string), 2, '0')"),
    ("k", "try_cast(regexp_extract(props, '\"k\": ([0-9]+)', 1) as int)"),
    ("msisdn", "'628' || lpad(cast(user_id as string), 9, '0')"),
    ("rev", "cast(value as decimal(18,2))"),
    ("segment", "c_mktsegment"),
    ("nation", "n_name"),
    ("region", "r_name"),
    ("custkey", "c_custkey"),
    ("nationkey", "c_nationkey"),
]

# The columns of the joined rows that USAGE_BASE is worked out from, and the
# day their written copy lies by.
USAGE_ROW = ("event_id", "user_id", "event_type", "ts", "value", "props",
             "c_custkey", "c_nationkey", "c_mktsegment", "n_name", "r_name")
USAGE_DAY = "__usage_day"
# A day's rows lie by subscriber: neighbours share most of their wide text,
# so that files and shuffles of them are small.
SUBSCRIBER = {"usage": "user_id", "billing": "o_custkey"}

# Epoch seconds of ``ts`` computed without any session time zone.
EPOCH_SECONDS = {
    "spark": "cast(datediff(cast(ts as date), DATE '1970-01-01') as bigint) * 86400 "
             "+ hour(ts) * 3600 + minute(ts) * 60 + second(ts)",
    "duckdb": "cast(datediff('day', DATE '1970-01-01', cast(ts as date)) as bigint) * 86400 "
              "+ hour(ts) * 3600 + minute(ts) * 60 + second(ts)",
}

# 32-character charge-id prefix shared by package charges and offer feeds.
CHARGE_PREFIX = ("'PKG' || lpad(cast(user_id as string), 9, '0') || day_stamp "
                 "|| lpad(cast(k as string), 4, '0') || 'ABCDEFGH'")

# Some charges and locations name no subscriber.
MSISDN_OR_NULL = "CASE WHEN k % 50 = 49 THEN NULL ELSE msisdn END"

_GEO = [
    ("area_sales", "'AREA-' || region"),
    ("region_sales", "region"),
    ("branch", "segment"),
    ("subbranch", "CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN '' ELSE segment END"),
    ("cluster_sales", "CASE WHEN event_type = 'click' THEN '' ELSE nation END"),
    ("provinsi", "region"),
    ("kabupaten", "nation"),
    ("kecamatan", "CASE WHEN event_type = 'purchase' THEN NULL ELSE 'KEC-' || region END"),
    ("kelurahan", "CASE WHEN event_type = 'signup' THEN '' ELSE 'KEL-' || nation END"),
]

_ALLOWANCE_TEXT = ("CASE event_type WHEN 'view' THEN 'Data Harian' WHEN 'click' THEN 'SMS Paket' "
                   "WHEN 'purchase' THEN 'Voice Nelpon' WHEN 'signup' THEN 'Bonus UPCC' ELSE NULL END")

_SUBSCRIBER = [
    ("subs_id", "cast(user_id as string)"),
    ("msisdn", "msisdn"),
    ("price_plan_id", "cast(nationkey as int)"),
    ("brand", "segment"),
    ("pre_post_flag", "CASE WHEN event_type = 'signup' THEN '2' ELSE '1' END"),
    ("cust_type_desc", "segment"),
    ("cust_subtype_desc", "nation"),
    ("customer_sub_segment", "region"),
    ("lac", "event_type"),
    ("ci", "''"),
]

_PRODUCT = [
    ("sigma_business_id", "lpad(cast(user_id as string), 8, '0')"),
    ("sigma_rules_id", "'RULE-' || event_type"),
    ("sku", "'SKU-' || cast(nationkey as string)"),
    ("l1_payu", "'PAYU'"),
    ("l2_service_type", "event_type"),
    ("l3_allowance_type", _ALLOWANCE_TEXT),
    ("l4_product_category", "'CATEGORY'"),
    ("l5_product", "'PRODUCT-' || segment"),
    ("commercial_name", "'COMM-' || segment"),
    ("channel", "'APP'"),
    ("validity", "'30D'"),
]

_SITE = [
    ("cust_id", "cast(custkey as int)"),
    ("channel_id", "'CH' || cast(nationkey as string)"),
    ("site_id", "'SITE-' || nation"),
    ("site_name", "'Site ' || nation"),
    ("region_hlr", "region"),
    ("city_hlr", "nation"),
]

_LACCI = [
    ("lacci_id_ifrs", "event_type || '-' || nation"),
    ("node", "event_type"),
    ("lacci_closing_flag", "cast(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END as int)"),
]


@dataclass
class Feed:
    """A feed derived from a base relation by a list of column expressions."""
    base: str                                    # "usage", "billing", "part", "orders"
    columns: list[tuple[str, str]]
    where: str | None = None                     # a row predicate of the derivation
    distinct: bool = False
    dialect: dict[str, dict[str, str]] = field(default_factory=dict)  # name -> {engine: expr}

    def expressions(self, engine: str) -> list[tuple[str, str]]:
        return [(n, self.dialect.get(n, {}).get(engine, e)) for n, e in self.columns]


FEEDS: dict[str, Feed] = {
    # usage charge feed
    "charge": Feed("usage", [
        ("event_date", "event_date"), ("trx_date", "trx_date"),
        ("timestamp_ifrs", "day_stamp || time_stamp"),
        ("transaction_id", "'TRX' || cast(user_id as string) || '-' || day_stamp"),
        *_SUBSCRIBER, *_LACCI, *_GEO, *_PRODUCT,
        ("rev_per_usage", "rev"),
        ("call_duration", "k"),
        ("event_allowance_consumed", "cast(1 as int)"),
        ("total_volume", "cast(k as bigint) * 1000"),
        ("item_id", "'ITEM-' || event_type"),
        ("service_filter", "'SF'"),
        ("price_plan_name", "'PLAN-' || cast(nationkey as string)"),
        *_SITE,
    ]),
    # seized-balance feed (D3): two geography names differ, one huge value
    "seized": Feed("usage", [
        ("event_date", "event_date"), ("trx_date", "trx_date"),
        # bought this month or, one in four, the month before
        ("timestamp_ifrs", "CASE WHEN k % 4 = 0 THEN '202312' || substr(day_stamp, 7, 2) "
                           "ELSE day_stamp END || time_stamp"),
        ("transaction_id", "'SZ' || cast(user_id as string) || '-' || day_stamp"),
        *_SUBSCRIBER, *_LACCI,
        *[("sub_branch" if n == "subbranch" else "propinsi" if n == "provinsi" else n, e)
          for n, e in _GEO],
        *_PRODUCT,
        ("rev_seized", "cast(CASE WHEN event_type = 'error' AND k >= 90 "
                       "THEN rev * 1000000000000 ELSE rev END as decimal(18,2))"),
        ("remaining_quota", "cast(k as bigint)"),
        ("item_id", "'ITEM-' || event_type"),
        *_SITE,
    ]),
    # quota-usage feed
    "quota": Feed("usage", [
        ("event_date", "event_date"), ("trx_date", "trx_date"),
        ("ts_ifrs", "day_stamp || time_stamp"),
        ("quota_extended_attribute",
         "'QEA' || lpad(cast(event_id as string), 15, '0') || CASE WHEN event_type IN "
         "('view', 'click', 'purchase') THEN '00' ELSE '17' END || 'X'"),
        ("trigger_type", "cast(CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 18 "
                         "WHEN 'purchase' THEN 136 WHEN 'error' THEN 5 ELSE 100 END as int)"),
        ("ifrs_param", "CASE WHEN event_type = 'view' THEN 'a$b$c' "
                       "ELSE 'p0$p1$p2$p3$p4$p5$p6$p7$p8$' || event_type || '$tail' END"),
        ("package_id", "'PKG-' || cast(k as string)"),
        ("service_name", "'SVC-' || event_type"),
        ("quota_name", "'Q-' || event_type"),
        ("node_type", "event_type"),
        *_SUBSCRIBER,
        ("lacci_id_ifrs", "event_type || '-' || nation"),
        ("lacci_closing_flag_ifrs", "cast(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END as int)"),
        *[(n + "_ifrs" if n not in ("subbranch", "cluster_sales")
           else ("sub_branch_ifrs" if n == "subbranch" else "cluster_ifrs"), e) for n, e in _GEO],
        *_PRODUCT,
        ("rev_per_usage", "rev"),
        ("rev_seized", "CASE WHEN event_type = 'purchase' THEN rev WHEN event_type = 'click' "
                       "THEN NULL ELSE cast(0 as decimal(18,2)) END"),
        ("quota_usage", "cast(k as bigint)"),
        *_SITE,
    ]),
    # accrual feed (D7): hex epoch (seconds or milliseconds) inside the id
    "accrual": Feed("usage", [
        ("event_date", "event_date"),
        ("load_date", "event_date + 1"),
        ("trx_date", "trx_date"),
        ("transaction_id", "'AC' || CASE WHEN event_type IN ('view', 'click') "
                           "THEN '000' || lpad(hex(epoch_s), 8, '0') "
                           "ELSE lpad(hex(epoch_s * 1000 + event_id % 1000), 11, '0') END "
                           "|| 'Z0000' || lpad(cast(event_id as string), 13, '0')"),
        ("subscriber_id", "cast(user_id as string)"),
        ("msisdn", "msisdn"),
        ("price_plan_id", "CASE WHEN event_type = 'error' THEN 'x' || cast(k as string) "
                          "WHEN event_type = 'view' THEN '' ELSE cast(k as string) END"),
        ("brand", "segment"),
        ("cust_type_desc", "segment"),
        ("cust_subtype_desc", "nation"),
        ("customer_group", "region"),
        ("lac", "event_type"), ("ci", "''"),
        ("lacci_id", "event_type || '-' || nation"),
        ("node", "event_type"),
        *_GEO,
        ("lacci_closing_flag", "CASE WHEN event_type = 'click' THEN 'n/a' ELSE '1' END"),
        *_PRODUCT,
        ("rev", "rev"),
        ("customer_id", "cast(custkey as string)"),
        ("charge_code", "'CC-' || event_type"),
        ("amdd_charge_code", "CASE WHEN event_type IN ('purchase', 'signup', 'view') "
                             "THEN 'SFEE' ELSE 'OTHR' END"),
        ("proration_ind", "CASE WHEN k > 50 THEN 'Y' ELSE 'N' END"),
        ("offer_name", "'OFFER-' || segment"),
        ("channel_id", "'CH' || cast(nationkey as string)"),
        ("region_hlr", "region"), ("city_hlr", "nation"),
    ]),
    # expiry feed (D2) and over-usage feed (D8) share their columns
    "expiry": Feed("usage", [
        ("expiry_date", "event_date"),
        ("purchase_date_2", "trx_date"),
        ("transaction_id", "upper(substr(event_type, 1, 2)) || cast(user_id as string) || '-' || day_stamp"),
        ("msisdn", "msisdn"),
        ("reserve1", "CASE WHEN event_type = 'error' THEN 'junk' WHEN event_type = 'view' "
                     "THEN '' ELSE cast(k % 5 as string) END"),
        ("brand", "segment"), ("cust_type", "segment"), ("cust_subtype", "nation"),
        ("node_type", "event_type"),
        ("region", "CASE WHEN event_type = 'click' THEN '' ELSE nation END"),
        ("branch", "CASE WHEN event_type = 'error' THEN NULL ELSE segment END"),
        ("cluster", "region"),
        ("bid", "lpad(cast(user_id as string), 8, '0')"),
        ("l1_ias", "'IAS-' || region"), ("l2_ias", "event_type"), ("l3_ias", "'IAS3'"),
        ("pi_value_final", "rev"),
    ]),
    "overusage": Feed("usage", [
        ("load_date", "event_date"),
        ("purchase_date_2", "trx_date"),
        ("transaction_id", "upper(substr(event_type, 1, 2)) || cast(user_id as string) || '-' || day_stamp"),
        ("msisdn", "msisdn"),
        ("reserve1", "CASE WHEN event_type = 'error' THEN 'junk' WHEN event_type = 'view' "
                     "THEN '' ELSE cast(k % 5 as string) END"),
        ("brand", "segment"), ("cust_type", "segment"), ("cust_subtype", "nation"),
        ("node_type", "event_type"),
        ("region", "CASE WHEN event_type = 'click' THEN '' ELSE nation END"),
        ("branch", "CASE WHEN event_type = 'error' THEN NULL ELSE segment END"),
        ("cluster", "region"),
        ("bid", "lpad(cast(user_id as string), 8, '0')"),
        ("l1_ias", "'IAS-' || region"), ("l2_ias", "event_type"), ("l3_ias", "'IAS3'"),
        ("pi_value_final", "rev"),
        ("expiry_month", "CASE WHEN event_type IN ('view', 'click', 'signup') "
                         "THEN event_date + 20 ELSE event_date END"),
        ("flag", "CASE WHEN event_type IN ('view', 'purchase', 'error') "
                 "THEN 'alloc_<_rev' ELSE 'rev_<_alloc' END"),
    ]),
    # package charges
    "package": Feed("usage", [
        ("event_date", "event_date"), ("trx_date", "trx_date"),
        ("transaction_id", CHARGE_PREFIX + " || lpad(cast(event_id as string), 10, '0')"),
        ("sku", "'SKU-' || cast(k % 10 as string)"),
        ("business_id", "lpad(cast(k as string), 8, '0')"),
        ("rules_id", "'R-' || event_type"),
        ("msisdn", MSISDN_OR_NULL),
        ("non_usage_flag", "CASE WHEN event_type IN ('purchase', 'signup', 'view') THEN '1' ELSE '0' END"),
        ("status", "CASE WHEN event_type = 'error' THEN 'ER01' ELSE 'OK00' END"),
        ("allowance_sub_type", "CASE event_type WHEN 'view' THEN 'Data Harian' WHEN 'click' "
                               "THEN 'sms paket' WHEN 'purchase' THEN 'Voice Nelpon' WHEN 'signup' "
                               "THEN 'Bonus UPCC' ELSE NULL END"),
        ("allowances_descriptions", "'desc-' || event_type"),
        ("quota_name", "'Q' || cast(k % 5 as string)"),
        ("bonus_apps_id", "''"),
        ("profile_name", "'PROF-' || segment"),
        ("charge", "cast(k * 100 as string)"),
        ("alloc_tp", "cast(rev * 0.3333 as decimal(18,4))"),
    ]),
    # subscriber profile by day; a subscriber with an error event that day repeats
    "profile": Feed("usage", [
        ("event_date", "event_date"), ("msisdn", "msisdn"),
        ("brand", "CASE segment WHEN 'MACHINERY' THEN 'KartuHalo' WHEN 'BUILDING' THEN NULL "
                  "WHEN 'FURNITURE' THEN 'kartuHALO' ELSE 'simPATI' END"),
        ("region_hlr", "CASE WHEN event_type = 'error' THEN 'HLR-ERR' ELSE region END"),
        ("cust_type_desc", "segment"), ("cust_subtype_desc", "nation"),
        ("customer_sub_segment", "region"),
    ], distinct=True),
    # dominant location by day (read as current and, at FALLBACK_DATE, as fallback)
    "location": Feed("usage", [
        ("event_date", "event_date"), ("msisdn", MSISDN_OR_NULL),
        ("lacci_id", "CASE WHEN event_type = 'signup' THEN NULL ELSE 'LAC' || cast(k % 3 as string) END"),
        ("area_sales", "region"),
        ("region_sales", "CASE WHEN event_type = 'error' THEN NULL ELSE region END"),
        ("branch", "segment"),
        ("subbranch", "CASE WHEN event_type = 'view' THEN NULL ELSE segment || '-SB' END"),
        ("cluster_sales", "nation"),
        ("provinsi", "region"), ("kabupaten", "nation"), ("kecamatan", "'KEC-' || nation"),
        ("kelurahan", "CASE WHEN event_type = 'click' THEN '' ELSE 'KEL' END"),
        ("node_type", "event_type"),
    ]),
    # offer per subscriber-day
    "subscriber_offers": Feed("usage", [
        ("event_date", "event_date"), ("msisdn", "msisdn"),
        ("provider_id", "cast(100 + k % 4 as string)"),
    ]),
    # offers by charge id, and their rejects (stamped into the run day)
    "usage_offers": Feed("usage", [
        ("event_date", "event_date"),
        ("charging_id", CHARGE_PREFIX + " || 'U' || cast(event_id as string)"),
        ("provider_id", "cast(200 + k % 3 as string)"),
        ("pre_post_flag", "CASE WHEN event_type = 'click' THEN '2' ELSE '1' END"),
    ], where="event_type IN ('purchase', 'click', 'error')"),
    "usage_rejects": Feed("usage", [
        ("event_date", f"DATE '{RUN_DATE}'"), ("trx_date", "event_date"),
        ("charging_id", CHARGE_PREFIX + " || 'R' || cast(event_id as string)"),
        ("provider_id", "cast(300 + k % 3 as string)"),
        ("pre_post_flag", "'1'"),
    ], where="event_type = 'purchase'"),
    "voucher_offers": Feed("usage", [
        ("event_date", "event_date"),
        ("sne", "cast(event_id as string)"),
        ("dc_order_id", CHARGE_PREFIX + " || 'V'"),
        ("offer_id", "cast(400 + k % 2 as string)"),
        ("status", "CASE WHEN k % 5 = 0 THEN '2' ELSE '3' END"),
        ("redeem_state", "CASE WHEN k % 2 = 0 THEN '3' ELSE '1' END"),
        ("bid_flag", "CASE WHEN k > 90 THEN 'Y' ELSE NULL END"),
    ], where="event_type = 'view'"),
    "voucher_rejects": Feed("usage", [
        ("event_date", f"DATE '{RUN_DATE}'"), ("trx_date", "event_date"),
        ("sne", "cast(event_id as string)"),
        ("dc_order_id", CHARGE_PREFIX + " || 'W'"),
        ("offer_id", "cast(450 + k % 2 as string)"),
        ("status", "CASE WHEN k % 5 = 0 THEN '2' ELSE '3' END"),
        ("redeem_state", "CASE WHEN k % 2 = 0 THEN '3' ELSE '1' END"),
        ("bid_flag", "CASE WHEN k > 90 THEN 'Y' ELSE NULL END"),
    ], where="event_type = 'signup'"),
    "recharge_offers": Feed("usage", [
        ("event_date", "event_date"),
        ("dc_orderid", CHARGE_PREFIX + " || 'N'"),
        ("offer_id", "cast(500 + k % 2 as string)"),
        ("processing_code", "CASE k % 3 WHEN 0 THEN 'StockRechargePackage' WHEN 1 "
                            "THEN 'RECHARGEREVERSAL' ELSE 'otherCode' END"),
    ], where="event_type = 'signup'"),
    "recharge_rejects": Feed("usage", [
        ("event_date", f"DATE '{RUN_DATE}'"), ("trx_date", "event_date"),
        ("dc_orderid", CHARGE_PREFIX + " || 'M'"),
        ("offer_id", "cast(550 + k % 2 as string)"),
        ("processing_code", "CASE k % 3 WHEN 0 THEN 'modernStockRechargePackage' WHEN 1 "
                            "THEN 'RechargeReversal' ELSE 'other' END"),
    ], where="event_type = 'view'"),
    # billing feed (D9, D10, D12): line items of orders
    "billing": Feed("billing", [
        ("load_date", f"DATE '{RUN_DATE}'"),
        ("event_date", "make_date(2024, 1, day(l_shipdate))"),
        ("source", "CASE l_returnflag || l_linestatus WHEN 'RO' THEN 'CHG_GOOD' WHEN 'RF' "
                   "THEN 'CHG_REJECT' WHEN 'NO' THEN 'CHG_GOOD' WHEN 'AO' THEN 'LOENA_GOOD_ACT' "
                   "WHEN 'AF' THEN 'LOENA_REJECT_PAY' ELSE NULL END"),
        ("trx_date", "cast(make_date(2024, 1, day(l_shipdate)) as string)"),
        ("subs_id", "cast(o_custkey as string)"),
        ("msisdn", "'628' || lpad(cast(o_custkey as string), 9, '0')"),
        ("offer_id", "CASE WHEN o_orderpriority = '5-LOW' THEN 'none' ELSE cast(l_suppkey as string) END"),
        ("brand", "CASE WHEN o_orderstatus = 'F' THEN 'KartuHalo' ELSE 'simPATI' END"),
        ("pre_post_flag", "CASE o_orderpriority WHEN '1-URGENT' THEN '2' "
                          "WHEN '4-NOT SPECIFIED' THEN 'x' ELSE '1' END"),
        ("cust_type_desc", "o_orderpriority"),
        ("cust_subtype_desc", "o_orderstatus"),
        ("lac", "cast(l_linenumber as string)"),
        ("ci", "''"),
        ("lacci_id", "'L' || cast(l_suppkey % 10 as string)"),
        ("node_type", "'N' || o_orderstatus"),
        ("area_sales", "CASE WHEN l_linestatus = 'F' THEN '' ELSE 'AREA-' || l_returnflag END"),
        ("region_sales", "'REG-' || l_returnflag"),
        ("branch", "CASE WHEN l_linenumber = 7 THEN NULL ELSE 'BR-' || l_linestatus END"),
        ("subbranch", "'SB'"),
        ("cluster_sales", "'CL-' || o_orderstatus"),
        ("provinsi", "'PROV'"), ("kabupaten", "'KAB'"), ("kecamatan", "'KEC'"),
        ("kelurahan", "CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'KEL' END"),
        ("lacci_closing_flag", "CASE WHEN l_linestatus = 'O' THEN '1' ELSE '0' END"),
        ("content_id", "CASE WHEN l_returnflag = 'R' THEN lpad(cast(l_partkey as string), 8, '0') "
                       "ELSE lpad(cast(l_suppkey as string), 8, '0') || '-' || cast(l_linenumber as string) END"),
        ("pack_id", "lpad(cast(l_partkey as string), 8, '0') || lpad(cast(l_linenumber as string), 5, '0')"),
        ("l1_name", "CASE WHEN l_linenumber = 5 THEN 'Voice' ELSE 'Digital Services' END"),
        ("l2_name", "l_linestatus"),
        ("l3_name", "CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 'Phonebook Cloud Backup' "
                    "WHEN 3 THEN 'PHONEBOOK backup' ELSE 'Music ' || l_returnflag END"),
        ("rev", "cast(l_extendedprice as decimal(18,2))"),
        ("dur", "cast(l_quantity as int)"),
        ("trx", "cast(1 as int)"),
        ("vol", "cast(l_quantity * 100 as bigint)"),
        ("offer", "'OFFER-' || o_orderpriority"),
        ("activation_channel_id", "'ACH' || l_linestatus"),
        ("region_hlr", "'HLR-' || l_returnflag"),
        ("city_hlr", "'CITY-' || o_orderstatus"),
    ]),
    # product catalogue: one listing day per part, mixed-length ids and flags
    "catalogue": Feed("part", [
        ("event_date", "make_date(2024, 1, cast(p_partkey % 31 as int) + 1)"),
        ("business_id", "CASE WHEN p_type = 'PROMO' THEN lpad(cast(p_partkey as string), 8, '0') || 'X' "
                        "ELSE cast(p_partkey as string) END"),
        ("status_flag", "CASE WHEN p_type = 'ECONOMY' THEN 'N' ELSE 'Y' END"),
        ("ifrs_flag", "CASE WHEN p_size <= 10 THEN 'false' WHEN p_size <= 30 THEN 'True' ELSE 'TRUE' END"),
    ]),
    # voucher tables for the full-sync merge: target and source overlap on one
    # priority, and the source lacks a day
    "voucher_target": Feed("orders", [
        ("event_date", "make_date(2024, 1, day(o_orderdate))"),
        ("sne", "cast(o_orderkey as string)"),
        ("redeem_state", "CASE o_orderstatus WHEN 'F' THEN '3' WHEN 'O' THEN '1' ELSE '2' END"),
        ("dc_order_id", "'DC' || cast(o_orderkey as string)"),
        ("offer_id", "cast(o_custkey as string)"),
        ("status", "'3'"),
        ("bid_flag", "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Y' ELSE NULL END"),
    ], where="o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"),
    "voucher_source": Feed("orders", [
        ("event_date", "make_date(2024, 1, day(o_orderdate))"),
        ("sne", "cast(o_orderkey as string)"),
        ("redeem_state", "CASE o_orderstatus WHEN 'F' THEN '3' WHEN 'O' THEN '1' ELSE '2' END"),
        ("dc_order_id", "'DC' || cast(o_orderkey as string)"),
        ("offer_id", "cast(o_custkey + 7 as string)"),
        ("status", "'3'"),
        ("bid_flag", "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Y' ELSE NULL END"),
        ], where="o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW') AND day(o_orderdate) <> 7"),
    # subscriber key list: every customer of one segment (some have no ledger rows)
    "key_list": Feed("customer", [
        ("msisdn", "'628' || lpad(cast(c_custkey as string), 9, '0')"),
    ], where="c_mktsegment = 'HOUSEHOLD'"),
}

# Rate table: per region, four allowance classes x two dated snapshots.
RATE_CLASSES = ("DATA", "SMS", "VOICE", "NONUSAGE")
RATE_EXPRS = [
    ("event_date", "event_date"),
    ("allowance_type", "allowance_type"),
    ("region", "r_name"),
    ("seized_rate", f"cast(0.1 + 0.05 * r_regionkey + 0.01 * pos + CASE WHEN event_date = "
                    f"DATE '{RATE_SNAPSHOTS[1]}' THEN 0.1 ELSE 0 END as decimal(9,4))"),
    ("allocation_rate", f"cast(0.9 - 0.1 * r_regionkey + 0.02 * pos - CASE WHEN event_date = "
                        f"DATE '{RATE_SNAPSHOTS[1]}' THEN 0.05 ELSE 0 END as decimal(9,4))"),
]
# One (region, class) pair has no rate, so the inner rate join drops its rows.
RATE_GAP = "NOT (r_name = 'AFRICA' AND allowance_type = 'VOICE')"


# Partition columns of each derived feed table (the day the flows prune on).
FEED_PARTITIONS: dict[str, tuple[str, ...]] = {
    "expiry": ("expiry_date",),
    "overusage": ("load_date",),
}


class DriverFeeds:
    """Spark-side feeds over one scale factor's tables.

    Each feed is derived once per session and written as a day-partitioned
    parquet table under the shared work folder -- the shape the flows meet
    in production, where feeds are partitioned tables -- then read back with
    its schema, so scans show real partition pruning.  The key list is
    written as a text file (one key per line).  With ``materialize=False``
    the derivations are used directly as lazy DataFrames.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize
        self.t = read_tables(spark, sf_dir)
        self._cache: dict[str, DataFrame] = {}
        self._root: str | None = None
        # one writer per table even when queries run from several threads
        self.lock = threading.RLock()

    @property
    def root(self) -> str:
        if self._root is None:
            from tallyspark.session import scratch_path
            self._root = scratch_path(self.spark, "feeds")
        return self._root

    def path(self, name: str) -> str:
        """Where a feed is written; writes it if it is not there yet."""
        self.feed(name)
        return f"{self.root}/{name}"

    def _usage_rows(self) -> DataFrame:
        """Events with their customer's nation and region."""
        t = self.t
        e = t["events"]
        c = t["customer"].select("c_custkey", "c_nationkey", "c_mktsegment")
        n = t["nation"].select("n_nationkey", "n_name", "n_regionkey")
        r = t["region"].select("r_regionkey", "r_name")
        return (e.join(c, e["user_id"] == c["c_custkey"], "left")
                 .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
                 .join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left"))

    def _usage_table(self) -> DataFrame:
        """``_usage_rows`` written once, dealt to their days: the join and the
        dealing are paid once, whatever number of feeds is derived from it."""
        with self.lock:
            if "__usage" not in self._cache:
                from tallyspark.operators.sinks import overwrite_partitions, read_target
                rows = self._usage_rows().selectExpr(*USAGE_ROW, f"{dict(USAGE_BASE)['event_date']} AS {USAGE_DAY}")
                path = f"{self.root}/usage"
                overwrite_partitions(rows, path, [USAGE_DAY])
                self._cache["__usage"] = read_target(self.spark, path, rows.schema).select(*rows.columns)
            return self._cache["__usage"]

    def _rows(self, name: str) -> DataFrame:
        if name == "usage":
            return self._usage_rows()
        if name == "billing":
            li, o = self.t["lineitem"], self.t["orders"]
            return li.join(o, li["l_orderkey"] == o["o_orderkey"], "left")
        return self.t[{"part": "part", "orders": "orders", "customer": "customer"}[name]]

    def derive(self, name: str, dealt_by: tuple[str, ...] = (), rows: DataFrame | None = None) -> DataFrame:
        """The lazy derivation of one feed from the driver tables.

        ``dealt_by``: columns of the feed that its rows are to lie by, dealt
        and sorted while they are still the table's own narrow rows; the
        feed's wide ones are derived after the shuffle.  ``rows``: the narrow
        rows, where they lie by day already and need only be sorted."""
        if name == "rates":
            return self._rates()
        spec = FEEDS[name]
        dealt = rows is not None
        rows = rows if dealt else self._rows(spec.base)
        if spec.where:
            rows = rows.where(spec.where)
        base = dict(USAGE_BASE) if spec.base == "usage" else {}
        feed = dict(spec.expressions("spark"))
        keys = {c: f"__{c}" for c in dealt_by}
        if keys:
            rows = rows.selectExpr("*", *[f"{base.get(feed[c], feed[c])} AS {k}" for c, k in keys.items()])
            rows = rows if dealt else rows.hint("rebalance", *keys.values())
            rows = rows.sortWithinPartitions(*keys.values(), *([SUBSCRIBER[spec.base]] if spec.base in SUBSCRIBER else []))
        if base:
            rows = rows.selectExpr(*[f"{e} AS {n}" for n, e in USAGE_BASE],
                                   f"{EPOCH_SECONDS['spark']} AS epoch_s", *keys.values())
        df = rows.selectExpr(*[f"{keys.get(n, e)} AS {n}" for n, e in feed.items()])
        return df.distinct() if spec.distinct else df

    def feed(self, name: str) -> DataFrame:
        with self.lock:
            if name in self._cache:
                return self._cache[name]
            df = self._write(name) if self.materialize else self.derive(name)
            self._cache[name] = df
            return df

    def _write(self, name: str) -> DataFrame:
        from tallyspark.operators.sinks import overwrite_partitions, read_target
        path = f"{self.root}/{name}"
        if name == "key_list":
            df = self.derive(name)
            df.select(F.col("msisdn").alias("value")).write.mode("overwrite").text(path)
            from tallyspark.sources.scans import key_list
            return key_list(self.spark, path)
        parts = FEED_PARTITIONS.get(name, ("event_date",))
        rows = self._usage_table() if name in FEEDS and FEEDS[name].base == "usage" else None
        # distinct rows are shuffled after they are derived, and dealt then
        if name in FEEDS and not FEEDS[name].distinct:
            df, rebalance = self.derive(name, parts, rows), None
        else:
            df, rebalance = self.derive(name, rows=rows), "partitions"
        overwrite_partitions(df, path, parts, rebalance)
        return read_target(self.spark, path, df.schema).select(*df.columns)

    def _rates(self) -> DataFrame:
        r = self.t["region"]
        classes = F.array(*[F.lit(c) for c in RATE_CLASSES])
        snaps = F.array(*[F.lit(d).cast("date") for d in RATE_SNAPSHOTS])
        x = (r.select("r_regionkey", "r_name", F.posexplode(classes).alias("pos", "allowance_type"))
              .select("*", F.explode(snaps).alias("event_date"))
              .where(RATE_GAP))
        return x.selectExpr(*[f"{e} AS {n}" for n, e in RATE_EXPRS])

    def __getattr__(self, name: str) -> DataFrame:
        if name in FEEDS or name == "rates":
            return self.feed(name)
        raise AttributeError(name)
