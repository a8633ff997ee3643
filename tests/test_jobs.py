"""Command-line jobs against catalog tables (the way the daily batches run)."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyspark import schema as S
from tallyspark.operators import overwrite_partitions
from tallyspark.plans import flows, jobs
from tallyspark.plans.params import RunParams
from tallyspark.plans.queries import PARAMS, feeds
from tallyspark.sources import driver as D

from .conftest import SMOKE_SF


def test_daily_jobs_fill_the_ledger_table(spark):
    f = feeds(spark, SMOKE_SF)
    for name in ("job_charge_feed", "job_seized_feed", "job_ledger"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    f.charge.write.partitionBy("event_date").format("parquet").saveAsTable("job_charge_feed")
    f.seized.write.partitionBy("event_date").format("parquet").saveAsTable("job_seized_feed")
    spark.createDataFrame([], S.ledger_struct()).write.partitionBy(*S.LEDGER_PARTITIONS) \
        .format("parquet").saveAsTable("job_ledger")
    day = "2024-01-15"
    for job, table in (("charge", "job_charge_feed"), ("seized", "job_seized_feed")):
        jobs.main([job, "--load-date", D.LOAD_DATE, "--event-date", day,
                   "--input", f"feed={table}", "--target", "job_ledger"], spark=spark)
    # a re-run replaces its own partitions only
    jobs.main(["charge", "--load-date", D.LOAD_DATE, "--event-date", day,
               "--input", "feed=job_charge_feed", "--target", "job_ledger"], spark=spark)
    ledger = spark.table("job_ledger")
    daily = _day_params(day)
    expected = flows.flow_charge(f.charge, daily).unionByName(flows.flow_seized(f.seized, daily))
    assert Counter(tuple(r) for r in ledger.select(*S.LEDGER_NAMES).collect()) == \
        Counter(tuple(r) for r in expected.collect())
    assert {r.source for r in ledger.select("source").distinct().collect()} == {"CHG", "SEIZED"}
    assert ledger.where(F.col("event_date") != F.lit(day).cast("date")).count() == 0


def _day_params(day):
    from tallyspark.plans.params import RunParams
    return RunParams(**{**PARAMS.__dict__, "days": day})


def test_every_job_names_its_inputs():
    for name, spec in jobs.JOBS.items():
        assert spec.inputs and spec.partitions, name


def test_promote_and_lookup_commands(spark, tmp_target):
    for name in ("job_staged", "job_target"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    f = feeds(spark, SMOKE_SF)
    f.location.where("event_date < DATE'2024-01-05'").write.partitionBy("event_date") \
        .format("parquet").saveAsTable("job_target")
    f.location.where("event_date >= DATE'2024-01-03'").write.partitionBy("event_date") \
        .format("parquet").saveAsTable("job_staged")
    assert jobs.main(["promote", "--input", "source=job_staged", "--target", "job_target",
                      "--partition", "event_date", "--clear-source"], spark=spark) == 0
    assert spark.table("job_target").count() == f.location.count()
    assert spark.table("job_staged").count() == 0
    keys = tmp_target("keys")
    f.key_list.write.text(keys)
    ledger = tmp_target("ledger")
    flows.flow_charge(f.charge, PARAMS).write.parquet(ledger)
    out = tmp_target("totals")
    assert jobs.main(["lookup", "--input", f"ledger={ledger}", "--keys", keys, "--target", out], spark=spark) == 0
    assert spark.read.parquet(out).count() == f.key_list.count()


def test_lookup_writes_every_key(spark, tmp_target):
    keys, ledger, out = tmp_target("keys"), tmp_target("ledger"), tmp_target("totals")
    spark.range(2500).selectExpr("concat('628', id) AS value").write.text(keys)
    flows.flow_charge(feeds(spark, SMOKE_SF).charge, PARAMS).write.parquet(ledger)
    jobs.main(["lookup", "--input", f"ledger={ledger}", "--keys", keys, "--target", out], spark=spark)
    assert spark.read.parquet(out).count() == 2500


@pytest.mark.parametrize("args,said", [
    (["charge", "--load-date", "2024-02-02", "--event-date", "2024-01-15", "--input", "feed=x"], "--target"),
    (["charge", "--event-date", "2024-01-15", "--input", "feed=x", "--target", "t"], "--load-date"),
    (["charge", "--load-date", "2024-02-02", "--input", "feed=x", "--target", "t"], "--all-days"),
    (["charge", "--load-date", "2024-02-02", "--first-date", "2024-01-15", "--input", "feed=x", "--target", "t"], "go together"),
    (["charge", "--load-date", "2024-02-02", "--event-date", "2024-01-15", "--all-days", "--input", "feed=x", "--target", "t"], "name the days"),
    (["accrual", "--event-date", "2024-01-15", "--input", "feed=x", "--target", "t"], "--load-date"),
    (["breakage", "--load-date", "2024-02-02", "--event-date", "2024-01-15", "--target", "t"], "--purchase-month"),
    (["package_stage", "--event-date", "2024-01-15", "--target", "t"], "--fallback-date"),
    (["package", "--load-date", "2024-02-02", "--event-date", "2024-01-15", "--target", "t"], "--all-offers"),
    (["package", "--load-date", "2024-02-02", "--event-date", "2024-01-15", "--offer-last-date", "2024-01-15", "--target", "t"], "go together"),
    (["package", "--load-date", "2024-02-02", "--event-date", "2024-01-15", "--offer-first-date", "2024-01-15", "--target", "t"], "go together"),
    (["lookup", "--input", "ledger=x", "--target", "t"], "--keys"),
    (["lookup", "--input", "ledger=x", "--keys", "k"], "--target"),
    (["merge", "--input", "source=x", "--target", "t"], "--key"),
    (["promote", "--input", "source=x", "--partition", "event_date"], "--target"),
])
def test_missing_and_half_given_arguments_are_errors(spark, capsys, args, said):
    with pytest.raises(SystemExit):
        jobs.main(args, spark=spark)
    assert said in capsys.readouterr().err


def test_breakage_without_its_month_is_an_error(spark):
    f = feeds(spark, SMOKE_SF)
    p = RunParams(load_date=D.LOAD_DATE)
    with pytest.raises(ValueError, match="purchase_month"):
        flows.flow_breakage(f.package, f.charge, f.billing, f.rates, p)


def test_accrual_day_follows_from_the_load_day(spark, tmp_target):
    feed, out = tmp_target("accrual"), tmp_target("ledger")
    feeds(spark, SMOKE_SF).accrual.write.partitionBy("event_date").parquet(feed)
    jobs.main(["accrual", "--load-date", "2024-01-17", "--event-date", "2024-01-15", "--input", f"feed={feed}",
               "--target", out], spark=spark)
    assert {str(r.event_date) for r in spark.read.parquet(out).select("event_date").distinct().collect()} == {"2024-01-15"}
    want = flows.flow_accrual(spark.read.parquet(feed), RunParams(load_date="2024-01-17", days="2024-01-16"))
    assert spark.read.parquet(out).count() == want.count() > 0


def test_a_rerun_that_loses_a_tag_leaves_no_stale_partition(spark, tmp_target):
    feed, again, out = tmp_target("quota"), tmp_target("quota"), tmp_target("ledger")
    rows = feeds(spark, SMOKE_SF).quota
    rows.write.partitionBy("event_date").parquet(feed)
    rows.where("NOT coalesce(rev_seized > 0, false)").write.partitionBy("event_date").parquet(again)
    args = ["quota", "--load-date", D.LOAD_DATE, "--event-date", "2024-01-15", "--target", out]
    tags = lambda: {r.source for r in spark.read.parquet(out).select("source").distinct().collect()}
    jobs.main([*args, "--input", f"feed={feed}"], spark=spark)
    assert tags() == {S.TAG_UPCC_SEIZED, S.TAG_UPCC_USAGE}
    jobs.main([*args, "--input", f"feed={again}"], spark=spark)
    assert tags() == {S.TAG_UPCC_USAGE}


def test_a_job_writes_into_the_ledger_it_reads(spark, tmp_target):
    f, ledger = feeds(spark, SMOKE_SF), tmp_target("ledger")
    overwrite_partitions(flows.flow_charge(f.charge, PARAMS), ledger, S.LEDGER_PARTITIONS)
    before = spark.read.parquet(ledger).count()
    every = flows.flow_late_match(f.billing, f.catalogue, spark.read.parquet(ledger), PARAMS)
    day = str(every.agg(F.min("event_date")).first()[0])
    paths = {r: tmp_target(r) for r in ("billing", "catalogue")}
    for role, path in paths.items():
        f.feed(role).write.partitionBy("event_date").parquet(path)
    jobs.main(["late_match", "--load-date", D.LOAD_DATE, "--event-date", day, "--target", ledger,
               "--input", f"ledger={ledger}", *[x for r, p in paths.items() for x in ("--input", f"{r}={p}")]], spark=spark)
    got = spark.read.parquet(ledger)
    assert got.where(F.col("source") != S.TAG_WISDOM_NBP).count() == before
    assert got.where(F.col("source") == S.TAG_WISDOM_NBP).count() == flows.flow_late_match(
        f.billing, f.catalogue, got.where(F.col("source") != S.TAG_WISDOM_NBP), _day_params(day)).count() > 0


def test_merge_command(spark):
    for name in ("job_merge_source", "job_merge_target"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    f = feeds(spark, SMOKE_SF)
    f.voucher_target.write.partitionBy("event_date").format("parquet").saveAsTable("job_merge_target")
    f.voucher_source.write.partitionBy("event_date").format("parquet").saveAsTable("job_merge_source")
    want = Counter(tuple(r) for r in f.voucher_source.collect())
    assert jobs.main(["merge", "--input", "source=job_merge_source", "--target", "job_merge_target", "--clear-source",
                      *[x for k in S.VOUCHER_MERGE_KEYS for x in ("--key", k)]], spark=spark) == 0
    got = spark.table("job_merge_target").select(*f.voucher_source.columns)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert spark.table("job_merge_source").count() == 0
