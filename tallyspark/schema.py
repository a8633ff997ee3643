"""Ledger schema and the fixed values the flows must share with the original jobs.

Column order is the contract of the ledger table: writes are positional, so
``LEDGER_COLUMNS`` is the single source of truth for names, types and order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the 57 ledger columns, in table order, with plan types ---
LEDGER_COLUMNS: list[tuple[str, str]] = [
    ("trx_date", "date"),
    ("purchase_date", "string"),
    ("transaction_id", "string"),
    ("subs_id", "string"),
    ("msisdn", "string"),
    ("price_plan_id", "int"),
    ("brand", "string"),
    ("pre_post_flag", "int"),
    ("cust_type_desc", "string"),
    ("cust_subtype_desc", "string"),
    ("customer_sub_segment", "string"),
    ("lac", "string"),
    ("ci", "string"),
    ("lacci_id", "string"),
    ("node", "string"),
    ("area_sales", "string"),
    ("region_sales", "string"),
    ("branch", "string"),
    ("subbranch", "string"),
    ("cluster_sales", "string"),
    ("provinsi", "string"),
    ("kabupaten", "string"),
    ("kecamatan", "string"),
    ("kelurahan", "string"),
    ("lacci_closing_flag", "int"),
    ("sigma_business_id", "string"),
    ("sigma_rules_id", "string"),
    ("sku", "string"),
    ("l1_payu", "string"),
    ("l2_service_type", "string"),
    ("l3_allowance_type", "string"),
    ("l4_product_category", "string"),
    ("l5_product", "string"),
    ("l1_ias", "string"),
    ("l2_ias", "string"),
    ("l3_ias", "string"),
    ("commercial_name", "string"),
    ("channel", "string"),
    ("pack_validity", "string"),
    ("rev_per_usage", "decimal(38,15)"),
    ("rev_seized", "decimal(38,15)"),
    ("dur", "int"),
    ("trx", "int"),
    ("vol", "bigint"),
    ("cust_id", "int"),
    ("profile_name", "string"),
    ("quota_name", "string"),
    ("service_filter", "string"),
    ("price_plan_name", "string"),
    ("channel_id", "string"),
    ("site_id", "string"),
    ("site_name", "string"),
    ("region_hlr", "string"),
    ("city_hlr", "string"),
    ("load_date", "string"),
    ("event_date", "date"),
    ("source", "string"),
]

LEDGER_NAMES: list[str] = [name for name, _ in LEDGER_COLUMNS]
LEDGER_TYPES: dict[str, str] = dict(LEDGER_COLUMNS)
LEDGER_PARTITIONS: tuple[str, ...] = ("load_date", "event_date", "source")
LEDGER_MEASURES: tuple[str, ...] = ("rev_per_usage", "rev_seized", "dur", "trx", "vol")
LEDGER_KEYS: list[str] = [n for n in LEDGER_NAMES if n not in LEDGER_MEASURES]

# The nine geography columns that get the null-or-blank -> 'UNKNOWN' fill.
GEO_COLUMNS: tuple[str, ...] = (
    "area_sales", "region_sales", "branch", "subbranch", "cluster_sales",
    "provinsi", "kabupaten", "kecamatan", "kelurahan",
)

# Location attributes carried by the current / fallback location tables.
LOCATION_COLUMNS: tuple[str, ...] = ("lacci_id",) + GEO_COLUMNS + ("node_type",)

UNKNOWN = "UNKNOWN"
MONEY = "decimal(38,15)"
STAGE_MONEY = "decimal(38,2)"
# Amounts before a rate product: their digits and a rate's fit decimal(38).
WORK_MONEY = "decimal(28,8)"

# --- fixed values: feed tags written to the ledger `source` partition ---
TAG_CHG = "CHG"
TAG_PI = "PI"
TAG_SEIZED = "SEIZED"
TAG_UPCC_SEIZED = "UPCC-SEIZED"
TAG_UPCC_USAGE = "UPCC_USAGE"
TAG_WISDOM = "WISDOM"
TAG_ACCRUAL = "ACCRUAL"
TAG_OVERUSAGE = "OVERUSAGE"
TAG_PAYU = "PAYU"
TAG_WISDOM_NBP = "WISDOM-NBP"
TAG_BREAKAGE = "BREAKAGE"
TAG_BREAKAGE_SEIZED = "BREAKAGE-SEIZED"

# --- fixed values: filter lists and literals used by the flows ---
# quota-usage trigger codes kept by the quota flow
UPCC_TRIGGER_TYPES: tuple[int, ...] = (2, 3, 18, 100, 136, 138, 111, 119, 116)
# recharge processing codes that carry an offer id (compared upper-cased)
RECHARGE_PROCESSING_CODES: tuple[str, ...] = (
    "RESERVESTOCKPACKAGEWITHEMONEYTP",
    "RECHARGEREVERSAL",
    "RESERVESTOCKPACKAGEWITHEMONEY",
    "MODERNSTOCKRECHARGEPACKAGE",
    "STOCKRECHARGEPACKAGEFIXED",
    "STOCKRECHARGEPACKAGE",
)
# billing sources excluded from the unmatched-charge flow
PAYU_EXCLUDED_SOURCES: tuple[str, ...] = (
    "LOENA_GOOD_ACT", "LOENA_GOOD_PAY", "LOENA_REJECT_ACT", "LOENA_REJECT_PAY",
)
# billing sources read by the late-match flow
LATE_MATCH_SOURCES: tuple[str, ...] = ("CHG_GOOD", "CHG_REJECT")
# ledger tags that count as "already recognised" for the late-match flow
LATE_MATCH_RECOGNISED_TAGS: tuple[str, ...] = (
    "CHG", "SEIZED", "UPCC-SEIZED", "UPCC_USAGE", "PAYU", "WISDOM",
)
# ledger tags reversed by the breakage flow
SEIZED_TAGS: tuple[str, ...] = ("SEIZED", "UPCC-SEIZED")
LATE_MATCH_L1_NAME = "Digital Services"
EXCLUDED_L3_PATTERN = "phonebook%backup"
POSTPAID_BRAND = "kartuhalo"
NULL_BRAND_DEFAULT = "prepaid"
PACKAGE_OK_STATUS = "OK00"
SEIZED_CAP = 100000000000
OVERUSAGE_FLAG = "alloc_<_rev"
ACCRUAL_CHARGE_CODE = "SFEE"
VOUCHER_REDEEMED = "3"
ACCRUAL_TIMEZONE = "Asia/Jakarta"
TAX_DIVISOR = "1.11"
# allowance classes, first match wins; anything else (null too) is NONUSAGE
ALLOWANCE_PATTERNS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("DATA", ("DATA", "UPCC")),
    ("SMS", ("SMS",)),
    ("VOICE", ("VOICE",)),
)
ALLOWANCE_DEFAULT = "NONUSAGE"
# offer feed labels of the charge-id lookup union
OFFER_LABEL_USAGE = "chg"
OFFER_LABEL_VOUCHER = "evoucher"
OFFER_LABEL_RECHARGE = "ngrs"
# full-sync merge key of the voucher tables
VOUCHER_MERGE_KEYS: tuple[str, ...] = ("event_date", "sne", "redeem_state")


def spark_type(type_name: str) -> T.DataType:
    return T._parse_datatype_string(type_name)


def ledger_struct() -> T.StructType:
    return T.StructType([T.StructField(n, spark_type(t), True) for n, t in LEDGER_COLUMNS])


# --- fixed values: the stage tables' columns, in table order ---
# Package-charge stage (31 columns; `event_date` is its partition).
STAGE_COLUMNS: list[tuple[str, str]] = [
    ("trx_date", "date"),
    ("transaction_id", "string"),
    ("sku", "string"),
    ("business_id", "string"),
    ("rules_id", "string"),
    ("msisdn", "string"),
    ("brand", "string"),
    ("region_hlr", "string"),
    ("non_usage_flag", "string"),
    ("allowance_subtype", "string"),
    ("allowances_descriptions", "string"),
    ("quota_name", "string"),
    ("bonus_apps_id", "string"),
    ("profile_name", "string"),
    ("cust_type_desc", "string"),
    ("cust_subtype_desc", "string"),
    ("customer_sub_segment", "string"),
    ("lacci_id", "string"),
    ("area_sales", "string"),
    ("region_sales", "string"),
    ("branch", "string"),
    ("subbranch", "string"),
    ("cluster_sales", "string"),
    ("provinsi", "string"),
    ("kabupaten", "string"),
    ("kecamatan", "string"),
    ("kelurahan", "string"),
    ("node_type", "string"),
    ("charge", "string"),
    ("rev", "decimal(38,2)"),
    ("event_date", "date"),
]

# Breakage stage (31 columns, same partition).
BREAKAGE_STAGE_COLUMNS: list[tuple[str, str]] = [
    ("trx_date", "date"),
    ("transaction_id", "string"),
    ("sku", "string"),
    ("business_id", "string"),
    ("rules_id", "string"),
    ("msisdn", "string"),
    ("brand", "string"),
    ("region_hlr", "string"),
    ("non_usage_flag", "string"),
    ("allowance", "string"),
    ("allowance_sub_type", "string"),
    ("allowances_descriptions", "string"),
    ("quota_name", "string"),
    ("bonus_apps_id", "string"),
    ("profile_name", "string"),
    ("cust_type_desc", "string"),
    ("cust_subtype_desc", "string"),
    ("customer_sub_segment", "string"),
    ("lacci_id", "string"),
    ("area_sales", "string"),
    ("region_sales", "string"),
    ("branch", "string"),
    ("subbranch", "string"),
    ("cluster_sales", "string"),
    ("provinsi", "string"),
    ("kabupaten", "string"),
    ("kecamatan", "string"),
    ("kelurahan", "string"),
    ("node_type", "string"),
    ("breakage", "decimal(38,2)"),
    ("event_date", "date"),
]
