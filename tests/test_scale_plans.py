"""Plans at scale: pruned point lookups, reduced joins, salted rates, audits."""

from __future__ import annotations

from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from tallyspark import schema as S
from tallyspark.functions import equals_one
from tallyspark.operators import Audit, key_totals, overwrite_partitions, rate_join, reduce_to, unrated
from tallyspark.operators.enrich import _bytes
from tallyspark.operators.totals import key_ranges
from tallyspark.plans import flows, jobs
from tallyspark.plans.params import RunParams
from tallyspark.plans.queries import PARAMS, breakage_stage_table, feeds, ledger_table, with_rates
from tallyspark.sources import driver as D

from .conftest import SMOKE_SF


@pytest.fixture
def conf(spark):
    before = {}

    def put(**settings):
        for k, v in settings.items():
            k = k.replace("__", ".")
            before.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)
    yield put
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scanned(df) -> int:
    """Rows that came out of the file scans of a plan that ran."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())
               if leaves.apply(i).nodeName().startswith("Scan parquet"))


def test_point_lookups_read_few_rows_of_a_clustered_ledger(spark, tmp_target, conf):
    rows = spark.range(0, 200_000, 1, 4).select(
        F.concat(F.lit("628"), F.lpad((F.col("id") * 7919 % 50_000).cast("string"), 9, "0")).alias("msisdn"),
        (F.col("id") % 4).cast("string").alias("source"), F.col("id").cast("decimal(20,2)").alias("rev_per_usage"),
        F.lit(1).cast("decimal(20,2)").alias("rev_seized"))
    plain, clustered = tmp_target("plain"), tmp_target("clustered")
    overwrite_partitions(rows, plain, ["source"])
    overwrite_partitions(rows, clustered, ["source"], cluster_by=["msisdn"])
    conf(spark__sql__adaptive__enabled="false")
    few = spark.createDataFrame([(f"628{i:09d}",) for i in (5, 17_000, 49_999, 60_000)], "msisdn string")
    many = spark.createDataFrame([(f"628{i:09d}",) for i in range(20_000, 21_000)], "msisdn string")
    # three keys there are, in a page of some 4000 rows or two each; 250 keys in a row in each of four files
    for keys, share in ((few, 0.15), (many, 0.2)):
        want = {tuple(r) for r in key_totals(spark.read.parquet(plain), keys, ranges=0).collect()}
        pruned = key_totals(spark.read.parquet(clustered), keys)
        assert {tuple(r) for r in pruned.collect()} == want
        assert scanned(pruned) <= share * 200_000, scanned(pruned)
        assert sum(r[-1] for r in want) > 0


def test_absent_keys_are_told_apart_by_bloom_filters(spark, tmp_target, conf):
    """Keys inside every file's range, in none of the files."""
    conf(spark__sql__adaptive__enabled="false")
    rows = spark.range(0, 20_000, 1, 4).select(F.lpad((F.col("id") * 2).cast("string"), 9, "0").alias("msisdn"), (F.col("id") % 2).alias("p"), F.lit(1).alias("rev_per_usage"), F.lit(1).alias("rev_seized"))
    path = tmp_target("bloom")
    overwrite_partitions(rows, path, ["p"], cluster_by=["msisdn"])
    keys = spark.createDataFrame([(f"{i:09d}",) for i in (101, 2_001, 30_003)], "msisdn string")
    out = key_totals(spark.read.parquet(path), keys)
    assert [r.subscribers_found for r in out.collect()] == [0, 0, 0]
    assert scanned(out) == 0


def test_key_ranges_cover_every_key(spark):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    ranges = key_ranges(keys, "k", 16)
    assert 1 < len(ranges) <= 16
    assert all(any(lo <= str(i) <= hi for lo, hi in ranges) for i in range(1000))
    assert key_ranges(keys.where("k < '11'"), "k", 16) == [("0", "0"), ("1", "1"), ("10", "10"), ("100", "100"), ("101", "101"), ("102", "102"),
        ("103", "103"), ("104", "104"), ("105", "105"), ("106", "106"), ("107", "107"), ("108", "108"), ("109", "109")]
    assert key_ranges(keys.where("k = 'x'"), "k") == []


def test_reduction_happens_before_the_shuffle_and_only_while_small(spark, conf):
    big = spark.range(10_000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(i,) for i in (1, 2, 2, 5000)] + [(None,)], "k long")
    cut = reduce_to(big, small, ["k"])
    assert sorted({r.k for r in cut.collect()}) == [1, 2] and cut.count() == 20
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert reduce_to(big, small, ["k"], most_bytes=10) is big
    assert [_bytes(x) for x in ("10MB", "10485760b", "64k", "5", "-1")] == [10 << 20, 10 << 20, 64 << 10, 5, -1]


def test_breakage_offers_are_reduced_to_the_breakage_subscribers(spark, conf):
    f = feeds(spark, SMOKE_SF)
    p = with_rates(spark, SMOKE_SF, PARAMS)
    args = (breakage_stage_table(spark, SMOKE_SF), ledger_table(spark, SMOKE_SF), f.billing, f.rates, p)
    reduced = flows.flow_breakage(*args)
    plan = reduced._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan
    want = Counter(map(tuple, reduced.collect()))
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    assert Counter(map(tuple, flows.flow_breakage(*args).collect())) == want


def test_rate_join_without_broadcast_spreads_twenty_keys(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    rows = spark.range(0, 200_000, 1, 8).select(
        F.col("id").cast("string").alias("transaction_id"),
        # one class and region holds over a third of the rows
        F.when(F.col("id") % 5 < 2, "DATA").otherwise(F.concat(F.lit("C"), (F.col("id") % 4).cast("string"))).alias("allowance"),
        F.when(F.col("id") % 5 < 2, "R0").otherwise(F.concat(F.lit("R"), (F.col("id") % 3).cast("string"))).alias("region"), F.lit(1).alias("rev"))
    rates = spark.createDataFrame([(c, f"R{r}", 0.5) for c in ("DATA", "C0", "C1", "C2", "C3") for r in range(3)],
                                  "allowance_type string, region string, rate double").withColumnRenamed("region", "rate_region")
    out = rate_join(rows, rates, "allowance", "region", ("rate",), rate_region_col="rate_region")
    assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 200_000 and len(per_task) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(per_task) <= 2 * median(per_task), per_task


def test_flag_filter_is_pushed_and_exact(spark, tmp_target):
    texts = ["1", "01", " 1 ", "+1", "1.4", "10", "11", "2", "0", "x1", "", None, "0.9", "-1", "1e0"]
    path = tmp_target("flags")
    spark.createDataFrame([(t,) for t in texts], "f string").write.parquet(path)
    df = spark.read.parquet(path)
    out = df.where(equals_one("f"))
    assert sorted(map(str, (r.f for r in out.collect()))) == sorted(map(str, (r.f for r in df.where("try_cast(f AS int) = 1").collect())))
    assert "StringContains(f,1)" in out._jdf.queryExecution().executedPlan().toString()
    f = feeds(spark, SMOKE_SF)
    assert "StringContains(pre_post_flag,1)" in flows.flow_unmatched(f.billing, f.catalogue, PARAMS)._jdf.queryExecution().executedPlan().toString()


def test_job_audit_counts_without_another_pass(spark, tmp_target):
    f = feeds(spark, SMOKE_SF)
    paths = {n: f.path(n) for n in ("package", "profile", "location", "rates", "seized")}
    inputs = {"charges": paths["package"], "profile": paths["profile"], "location_current": paths["location"],
              "location_fallback": paths["location"], "rates": paths["rates"]}
    p = RunParams(load_date=D.LOAD_DATE, fallback_date=D.FALLBACK_DATE)
    audit = Audit()
    group = "audited"
    spark.sparkContext.setJobGroup(group, "breakage stage with an audit")
    jobs.run_job(spark, "breakage_stage", inputs, tmp_target("stage"), p, audit)
    jobs_run = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    report = audit.report()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == jobs_run  # no extra job
    spark.sparkContext._jsc.clearJobGroup()
    assert report["enriched_in"] == f.package.where(F.col("status") == S.PACKAGE_OK_STATUS).count()
    assert report["enriched_multiplied"] == report["enriched_out"] - report["enriched_in"] > 0
    assert report["unrated"] > 0 and report["rated"] > 0
    audit = Audit()
    jobs.run_job(spark, "seized", {"feed": paths["seized"]}, tmp_target("ledger"), p, audit)
    assert audit.counts() == {"seized_outliers": flows.seized_outliers(f.seized, p).count()}


def test_audited_and_plain_flows_agree(spark):
    f = feeds(spark, SMOKE_SF)
    p = with_rates(spark, SMOKE_SF, PARAMS)
    args = (breakage_stage_table(spark, SMOKE_SF), ledger_table(spark, SMOKE_SF), f.billing, f.rates, p)
    assert Counter(map(tuple, flows.flow_breakage(*args, Audit()).collect())) == Counter(map(tuple, flows.flow_breakage(*args).collect()))
    df = spark.createDataFrame([("t1", "MOON", "R"), ("t2", "SUN", "R"), ("t3", None, "R")], "transaction_id string, c string, r string")
    rates = spark.createDataFrame([("SUN", "R", 2), ("SUN", "R", 3)], "allowance_type string, region string, rate int")
    audit = Audit()
    out = rate_join(df, rates, "c", "r", ("rate",), audit=audit).select("transaction_id", "rate")
    assert sorted(tuple(r) for r in out.collect()) == [("t2", 2), ("t2", 3)]
    assert audit.counts() == {"unrated": unrated(df, rates, "c", "r").count(), "rated": 2}
    with pytest.raises(ValueError, match="counted already"):
        audit.watch(df, "rated")


def test_sessions_bound_what_a_task_reads_and_keep_smaller_sizes(spark, conf):
    from tallyspark.session import TASK_SIZES, ensure_session_defaults, size_of
    for given, kept in (("128MB", "16m"), ("8m", "8m")):
        conf(**{k.replace(".", "__"): given for k in TASK_SIZES})
        ensure_session_defaults(spark)
        assert [size_of(spark.conf.get(k)) for k in TASK_SIZES] == [size_of(kept)] * len(TASK_SIZES)


@pytest.mark.parametrize("name, day, wide", [("charge", "event_date", "transaction_id"), ("billing", "event_date", "pack_id"),
                                             ("overusage", "load_date", "transaction_id"), ("voucher_source", "event_date", "dc_order_id")])
def test_feeds_are_dealt_before_they_are_widened(spark, conf, name, day, wide):
    from tallyspark.sources.driver import DriverFeeds
    conf(spark__sql__debug__maxToStringFields="1000")
    feeds = DriverFeeds(spark, SMOKE_SF, materialize=False)
    dealt, plain = feeds.derive(name, (day,)), feeds.derive(name)
    assert dealt.schema == plain.schema
    assert Counter(map(tuple, dealt.collect())) == Counter(map(tuple, plain.collect()))
    below = dealt._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")
    assert len(below) == 2 and f" AS {wide}#" in below[0] and f" AS {wide}#" not in below[1]
    # the writer need not sort the wide rows again
    assert f"List({day}#" in dealt._jdf.queryExecution().optimizedPlan().outputOrdering().toString()


def test_copies_of_tables_that_lie_by_partition_are_not_shuffled(spark, monkeypatch):
    from tallyspark.plans import queries as Q
    dealt = []
    real = Q.overwrite_partitions

    def watched(df, target, keys, rebalance="partitions", **other):
        dealt.append((len(keys), rebalance))
        return real(df, target, keys, rebalance, **other)
    ledger = Q.ledger_table(spark, SMOKE_SF)
    monkeypatch.setattr(Q, "overwrite_partitions", watched)
    kept = ledger.where((F.col("source") != "PAYU") | (F.col("event_date") >= Q.PROMOTE_FROM))
    assert Q.q_promote_ledger(spark, SMOKE_SF).count() == kept.count()
    Q.handoff(spark, SMOKE_SF, "ledger_copy_test", lambda: [ledger], list(Q.S.LEDGER_PARTITIONS), rebalance=None)
    assert dealt == [(3, None)] * 3
    Q.q_promote_two_keys(spark, SMOKE_SF)
    assert dealt[3:] == [(2, "partitions")] * 2


def test_usage_rows_are_joined_and_dealt_once_for_all_feeds(spark, conf):
    """Every usage feed used to join events with customers and to deal them
    to their days by itself."""
    from tallyspark.sources.driver import USAGE_DAY, DriverFeeds
    conf(spark__sql__debug__maxToStringFields="1000", spark__sql__autoBroadcastJoinThreshold="-1")
    lazy, written = DriverFeeds(spark, SMOKE_SF, materialize=False), DriverFeeds(spark, SMOKE_SF)
    usage = written._usage_table()
    assert usage.columns[-1] == USAGE_DAY and usage.count() == lazy.t["events"].count()
    for name in ("charge", "package", "usage_rejects", "overusage"):
        day = D.FEED_PARTITIONS.get(name, ("event_date",))
        df = written.derive(name, day, usage)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "RebalancePartitions" not in plan and "Join" not in plan
        assert Counter(map(tuple, df.collect())) == Counter(map(tuple, lazy.derive(name).collect()))
        assert Counter(map(tuple, written.feed(name).collect())) == Counter(map(tuple, lazy.derive(name).collect()))


def test_the_ledger_is_dealt_once(spark, conf):
    """The roll-ups of a ledger leave its rows in ranges of day and
    subscriber, and it is written without another shuffle."""
    from dataclasses import replace

    from tallyspark.plans.queries import LEDGER_PARAMS
    conf(spark__sql__adaptive__enabled="false", spark__sql__debug__maxToStringFields="1000")
    feed = feeds(spark, SMOKE_SF).charge
    feed = feed.union(feed.limit(50)).union(feed.limit(20).withColumns({"msisdn": F.lit(None).cast("string"), "event_date": F.lit(None).cast("date")}))
    plain, ranged = flows.flow_charge(feed, PARAMS), flows.flow_charge(feed, LEDGER_PARAMS)
    assert LEDGER_PARAMS == replace(PARAMS, lie_by=LEDGER_PARAMS.lie_by) and ranged.schema == plain.schema
    assert Counter(map(tuple, ranged.collect())) == Counter(map(tuple, plain.collect()))
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    above = plan.split("HashAggregate")
    assert len(above) == 3 and "Exchange" not in above[1] and "rangepartitioning" in above[2]
    # a day and tag of the ledger lies in one file, or few where it is large
    files = ledger_table(spark, SMOKE_SF).select("event_date", "source", F.input_file_name().alias("f")).distinct()
    assert files.groupBy("event_date", "source").count().where("count > 2").isEmpty()
