"""Partition lists, newest partitions and loads, first loads of tables."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyspark import schema as S
from tallyspark.operators import ensure_table, newest_rates, overwrite_partitions
from tallyspark.plans import flows, jobs
from tallyspark.plans.queries import PARAMS, QUERIES, feeds, with_rates
from tallyspark.sources import driver as D
from tallyspark.sources.scans import latest_snapshot, newest_loads, newest_partition, scan_newest_loads
from tallyspark.sources.store import partition_specs

from .conftest import SMOKE_SF
from .test_sinks import frame


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_partition_specs_of_paths_and_tables_agree(spark, tmp_target):
    rows = spark.createDataFrame([(1, "2024-01-01", "A"), (2, "2024-01-09", "it's 5% a=b/c"), (3, None, "A"), (4, "2024-01-09", "")],
                                 "v int, day string, source string")
    path = tmp_target("specs")
    overwrite_partitions(rows, path, ["day", "source"])
    spark.sql("DROP TABLE IF EXISTS t_specs")
    rows.write.partitionBy("day", "source").format("parquet").saveAsTable("t_specs")
    want = Counter([("2024-01-01", "A"), ("2024-01-09", "it's 5% a=b/c"), (None, "A"), ("2024-01-09", None)])
    for name in (path, "t_specs"):
        assert Counter((s["day"], s["source"]) for s in partition_specs(spark, name)) == want, name
        assert newest_partition(spark, name, "day") == "2024-01-09"
        assert newest_partition(spark, name, "v") is None
    plain = tmp_target("plain")
    rows.write.parquet(plain)
    assert partition_specs(spark, plain) == [] and newest_partition(spark, f"{plain}-absent") is None


def test_an_emptied_folder_is_no_partition(spark, tmp_target):
    path = tmp_target("emptied")
    overwrite_partitions(frame(spark, [(1, "2024-01-01", "A"), (2, "2024-01-09", "A")]), path, ["event_date"])
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/event_date=2024-01-20")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    assert newest_partition(spark, path) == "2024-01-09"


@pytest.mark.parametrize("name", ["rate_allocate", "latest_snapshot", "flow_breakage_stage", "flow_breakage"])
def test_newest_snapshot_is_a_constant_partition_filter(spark, name):
    plan = plan_of(QUERIES[name](spark, SMOKE_SF))
    day = newest_partition(spark, feeds(spark, SMOKE_SF).path("catalogue" if name == "latest_snapshot" else "rates"))
    epoch = (dt.date.fromisoformat(day) - dt.date(1970, 1, 1)).days
    assert f"= {epoch})" in plan or f"= {day})" in plan, plan
    assert "scalar-subquery" not in plan and "max(event_date" not in plan, plan


def test_newest_rates_with_and_without_the_list(spark):
    f = feeds(spark, SMOKE_SF)
    day = with_rates(spark, SMOKE_SF, PARAMS).rate_day
    assert Counter(map(tuple, newest_rates(f.rates, newest=day).collect())) == Counter(map(tuple, newest_rates(f.rates).collect()))
    assert day == str(latest_snapshot(f.rates).first().event_date)


LOADS = [("L1", "2024-01-01", "A", 1), ("L2", "2024-01-01", "A", 2), ("L2", "2024-01-01", "A", 3), ("L1", "2024-01-01", "B", 4),
         ("L1", "2024-01-02", "A", 5), ("L3", None, "A", 6), ("L2", None, "A", 7), ("L1", "2024-01-03", None, 8)]


def test_newest_loads_of_each_day_and_tag(spark, tmp_target):
    rows = spark.createDataFrame([(lo, None if d is None else dt.date.fromisoformat(d), s, v) for lo, d, s, v in LOADS],
                                 "load_date string, event_date date, source string, v int")
    path = tmp_target("loads")
    overwrite_partitions(rows, path, ["load_date", "event_date", "source"])
    loads = newest_loads(spark, path)
    df = spark.read.schema(rows.schema).parquet(path)
    assert sorted(r.v for r in scan_newest_loads(df, loads).collect()) == [2, 3, 4, 5, 6, 8]
    assert scan_newest_loads(df, []).count() == 0
    named = [x for x in loads if None not in x.values()]
    kept = scan_newest_loads(df, named)
    assert sorted(r.v for r in kept.collect()) == [2, 3, 4, 5]
    assert "PartitionFilters: [concat_ws" in plan_of(kept)


def test_ledger_flows_read_a_day_loaded_twice_once(spark, tmp_target):
    f = feeds(spark, SMOKE_SF)
    from dataclasses import replace

    from tallyspark.plans.queries import breakage_stage_table
    once, twice = tmp_target("once"), tmp_target("twice")
    stage = breakage_stage_table(spark, SMOKE_SF)
    overwrite_partitions(flows.flow_seized(f.seized, PARAMS), once, S.LEDGER_PARTITIONS)
    overwrite_partitions(flows.flow_seized(f.seized, replace(PARAMS, load_date="2024-01-31")), twice, S.LEDGER_PARTITIONS)
    overwrite_partitions(flows.flow_seized(f.seized, PARAMS), twice, S.LEDGER_PARTITIONS)
    read = lambda path: spark.read.schema(S.ledger_struct()).parquet(path)
    p = with_rates(spark, SMOKE_SF, PARAMS)
    want = Counter(map(tuple, flows.flow_breakage(stage, read(once), f.billing, f.rates, p).collect()))
    p = replace(p, ledger_loads=tuple(newest_loads(spark, twice)))
    assert Counter(map(tuple, flows.flow_breakage(stage, read(twice), f.billing, f.rates, p).collect())) == want
    p = replace(p, ledger_loads=None)
    assert Counter(map(tuple, flows.flow_breakage(stage, read(twice), f.billing, f.rates, p).collect())) != want


def test_first_load_creates_the_ledger_and_checks_its_layout(spark):
    for t in ("job_first_ledger", "job_first_feed", "t_wrong_layout", "t_wrong_type"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    f = feeds(spark, SMOKE_SF)
    f.charge.write.partitionBy("event_date").format("parquet").saveAsTable("job_first_feed")
    args = ["charge", "--load-date", D.LOAD_DATE, "--event-date", "2024-01-15", "--input", "feed=job_first_feed", "--target"]
    for _ in range(2):
        assert jobs.main([*args, "job_first_ledger"], spark=spark) == 0
    table = spark.table("job_first_ledger")
    assert {c.name: c.dataType for c in table.schema} == {c.name: c.dataType for c in S.ledger_struct()}
    assert [c.name for c in spark.catalog.listColumns("job_first_ledger") if c.isPartition] == list(S.LEDGER_PARTITIONS)
    from dataclasses import replace
    want = flows.flow_charge(f.charge, replace(PARAMS, days="2024-01-15"))
    assert Counter(map(tuple, table.select(*S.LEDGER_NAMES).collect())) == Counter(map(tuple, want.collect()))
    want.write.partitionBy("event_date").format("parquet").saveAsTable("t_wrong_layout")
    want.withColumn("trx", F.col("trx").cast("string")).write.partitionBy(*S.LEDGER_PARTITIONS).format("parquet").saveAsTable("t_wrong_type")
    for t, said in (("t_wrong_layout", "partitioned by"), ("t_wrong_type", "trx is string")):
        with pytest.raises(ValueError, match=said):
            jobs.main([*args, t], spark=spark)
    assert not ensure_table(spark, "job_first_ledger", S.ledger_struct(), S.LEDGER_PARTITIONS)
