"""Every registered query against its DuckDB oracle, plus flow properties."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tallyspark import schema as S
from tallyspark.plans import flows
from tallyspark.plans.params import RunParams
from tallyspark.plans.queries import PARAMS, QUERIES, feeds
from tallyspark.sources import driver as D

from .conftest import SMOKE_SF
from tools.oracle_check import VIEWS, norm


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for v in VIEWS:
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{SMOKE_SF}/{v}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SMOKE_SF)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = sorted(sdf.columns)
    s_rows = Counter(tuple(norm(r[c]) for c in order) for r in sdf.collect())
    idx = [rel.columns.index(c) for c in order]
    d_rows = Counter(tuple(norm(r[i]) for i in idx) for r in rel.fetchall())
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == S.LEDGER_NAMES
    assert df.count() > 0


def test_daily_run_equals_backfill_restricted_to_that_day(spark):
    f = feeds(spark, SMOKE_SF)
    day = "2024-01-15"
    daily = RunParams(load_date=D.LOAD_DATE, days=day, fallback_date=D.FALLBACK_DATE,
                      purchase_month=D.PURCHASE_MONTH, run_date=D.RUN_DATE)
    for build in (lambda p: flows.flow_charge(f.charge, p),
                  lambda p: flows.flow_unmatched(f.billing, f.catalogue, p),
                  lambda p: flows.flow_stage(f.package, f.profile, f.location, f.location, p)):
        one = Counter(tuple(r) for r in build(daily).collect())
        all_days = build(PARAMS).where(F.col("event_date") == F.lit(day).cast("date"))
        assert one == Counter(tuple(r) for r in all_days.collect())
        assert sum(one.values()) > 0


def test_charge_rollup_conserves_revenue(spark):
    f = feeds(spark, SMOKE_SF)
    fed = f.charge.where("pre_post_flag = '1'").agg(F.sum("rev_per_usage")).first()[0]
    rolled = flows.flow_charge(f.charge, PARAMS).agg(F.sum("rev_per_usage")).first()[0]
    assert Decimal(rolled) == Decimal(fed)


def test_unmatched_plus_matched_is_all_filtered_billing(spark):
    f = feeds(spark, SMOKE_SF)
    base = f.billing.where("try_cast(pre_post_flag as int) = 1 "
                           "AND lower(l3_name) NOT LIKE 'phonebook%backup' "
                           "AND source NOT IN ('LOENA_GOOD_ACT','LOENA_GOOD_PAY',"
                           "'LOENA_REJECT_ACT','LOENA_REJECT_PAY')")
    total = base.agg(F.sum("rev")).first()[0]
    payu = flows.flow_unmatched(f.billing, f.catalogue, PARAMS).agg(F.sum("rev_per_usage")).first()[0]
    cat = (f.catalogue.where("status_flag = 'Y' AND lower(ifrs_flag) = 'true'")
           .select("event_date", F.lpad("business_id", 8, "0").alias("bid")).distinct())
    matched = (base.join(cat, (base.event_date == cat.event_date)
                         & (F.substring(base.pack_id, 1, 8) == cat.bid), "left_semi")
               .agg(F.sum("rev")).first()[0] or 0)
    assert Decimal(payu) + Decimal(matched) == Decimal(total)


def test_upcc_routes_null_seized_to_usage_tag(spark):
    out = E.queries()["flow_upcc"](spark, SMOKE_SF)
    tags = {r.source for r in out.select("source").distinct().collect()}
    assert tags <= {S.TAG_UPCC_SEIZED, S.TAG_UPCC_USAGE}
    bad = out.where((F.col("source") == S.TAG_UPCC_SEIZED) & ~(F.col("rev_seized") > 0)).count()
    assert bad == 0


def test_scans_prune_partitions_in_the_plan(spark):
    from tallyspark.plans.queries import q_latest_snapshot, q_scan_day
    day_plan = q_scan_day(spark, SMOKE_SF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in day_plan
    snap = q_latest_snapshot(spark, SMOKE_SF)._jdf.queryExecution().executedPlan().toString()
    # the newest day comes from the partition list, as a constant
    assert "Subquery" not in snap and "PartitionFilters: [isnotnull(event_date" in snap


def test_accrual_daily_helper():
    assert flows.accrual_days("2025-04-03") == "2025-04-02"


@pytest.mark.parametrize("flow,feed,where,measure", [
    ("flow_expiry", "expiry", "true", "pi_value_final"),
    ("flow_overusage", "overusage", "expiry_month > load_date AND flag = 'alloc_<_rev'",
     "pi_value_final"),
    ("flow_accrual", "accrual", "amdd_charge_code = 'SFEE'", "rev"),
    ("flow_seized", "seized", "rev_seized < 100000000000 AND pre_post_flag = '1'", "rev_seized"),
])
def test_rollups_conserve_revenue(spark, flow, feed, where, measure):
    f = feeds(spark, SMOKE_SF)
    fed = f.feed(feed).where(where).agg(F.sum(measure)).first()[0]
    col = "rev_seized" if flow == "flow_seized" else "rev_per_usage"
    rolled = E.queries()[flow](spark, SMOKE_SF).agg(F.sum(col)).first()[0]
    assert Decimal(rolled) == Decimal(fed)


def test_ledger_load_date_limits_reread_loads(spark):
    """A day loaded twice counts twice unless the load is pinned."""
    from tallyspark.plans.queries import ledger_table
    f = feeds(spark, SMOKE_SF)
    ledger = ledger_table(spark, SMOKE_SF)
    twice = ledger.unionByName(ledger.withColumn("load_date", F.lit("2024-02-03")))
    stage = E.queries()["flow_breakage_stage"](spark, SMOKE_SF)

    def seized_total(p):
        out = flows.flow_breakage(stage, twice, f.billing, f.rates, p)
        return out.where(F.col("source") == S.TAG_BREAKAGE_SEIZED).agg(F.sum("rev_per_usage")).first()[0]

    pinned = RunParams(**{**PARAMS.__dict__, "ledger_load_date": D.LOAD_DATE})
    assert seized_total(PARAMS) == 2 * seized_total(pinned)
    assert seized_total(pinned) != 0


def test_bindings_exercise_every_branch(spark):
    """Guard against vacuous parity: each flow branch gets rows at sf0.01."""
    sf = "/root/testdata/sf0.01"
    q = E.queries()
    upcc = {r.source for r in q["flow_upcc"](spark, sf).select("source").distinct().collect()}
    assert upcc == {S.TAG_UPCC_SEIZED, S.TAG_UPCC_USAGE}
    brk = {r.source for r in q["flow_breakage"](spark, sf).select("source").distinct().collect()}
    assert brk == {S.TAG_BREAKAGE, S.TAG_BREAKAGE_SEIZED}
    from tallyspark.plans.queries import ledger_table
    f = feeds(spark, sf)
    empty_ledger = spark.createDataFrame([], ledger_table(spark, sf).schema)
    unexcluded = flows.flow_late_match(f.billing, f.catalogue, empty_ledger, PARAMS).count()
    assert unexcluded > q["flow_late_match"](spark, sf).count() > 0
    acts = {r.merge_action for r in q["merge_full_sync"](spark, sf).select("merge_action").distinct().collect()}
    assert acts == {"insert", "update", "delete"}
    assert f.seized.where("rev_seized >= 100000000000").count() > 0
    assert flows.seized_outliers(f.seized, PARAMS).count() > 0
    # each predicate removes at least one row
    seized = ledger_table(spark, sf).where(F.col("source").isin(*S.SEIZED_TAGS) & (F.col("pre_post_flag") == 1))
    month = F.substring("purchase_date", 1, 7) == D.PURCHASE_MONTH
    assert 0 < seized.where(month).count() < seized.count()
    for feed in (f.voucher_offers, f.voucher_rejects):
        assert {r.status for r in feed.select("status").distinct().collect()} == {"2", "3"}
    assert f.package.where("msisdn IS NULL").count() > 0 and f.location.where("msisdn IS NULL").count() > 0
    keys = f.profile.groupBy("event_date", "msisdn").count().where("count > 1")
    assert keys.count() > 0
    window = RunParams(**{**PARAMS.__dict__, "offer_window": ("2024-01-10", "2024-01-20")})
    offers = [flows.offers_by_charge_id(f.usage_offers, f.usage_rejects, f.voucher_offers, f.voucher_rejects,
                                        f.recharge_offers, f.recharge_rejects, p).count() for p in (PARAMS, window)]
    assert offers[0] > offers[1] > 0
    days = [{r.event_date for r in x.select("event_date").distinct().collect()} for x in (f.voucher_target, f.voucher_source)]
    assert days[0] - days[1]
    for name, tag in (("daily_late_match", S.TAG_WISDOM_NBP), ("daily_breakage", S.TAG_BREAKAGE_SEIZED)):
        assert q[name](spark, sf).where(F.col("source") == tag).count() > 0
    assert f.package.where("alloc_tp != cast(alloc_tp as decimal(18,2))").count() > 0


@pytest.mark.parametrize("name", ["flow_accrual", "hex_epoch_day", "scan_day", "flow_charge"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")
    try:
        test_query_matches_oracle(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
