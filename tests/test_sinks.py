"""Sinks: dynamic overwrite, full-sync merge, promotion, key list."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import merge_full_sync, overwrite_partitions, promote, read_target
from tallyspark.operators.sinks import MergeCounts
from tallyspark.sources.scans import key_list, latest_snapshot, newest_partition

SCHEMA = "v int, event_date date, source string"


def frame(spark, data):
    return spark.createDataFrame(
        [(v, __import__("datetime").date.fromisoformat(d), s) for v, d, s in data], SCHEMA)


def content(spark, path):
    return sorted(tuple(r) for r in read_target(spark, path, frame(spark, []).schema)
                  .select("v", F.col("event_date").cast("string"), "source").collect())


def test_dynamic_overwrite_replaces_only_present_partitions(spark, tmp_target):
    path = tmp_target("ledger")
    overwrite_partitions(frame(spark, [(1, "2024-01-01", "A"), (2, "2024-01-02", "A"),
                                       (3, "2024-01-01", "B")]), path, ["event_date", "source"])
    overwrite_partitions(frame(spark, [(9, "2024-01-01", "A")]), path, ["event_date", "source"])
    assert content(spark, path) == [(2, "2024-01-02", "A"), (3, "2024-01-01", "B"),
                                    (9, "2024-01-01", "A")]
    # An empty result changes nothing
    overwrite_partitions(frame(spark, []), path, ["event_date", "source"])
    assert len(content(spark, path)) == 3
    # idempotent re-run
    overwrite_partitions(frame(spark, [(9, "2024-01-01", "A")]), path, ["event_date", "source"])
    assert len(content(spark, path)) == 3


def test_merge_full_sync_result_equals_source(spark, tmp_target):
    path = tmp_target("voucher")
    cols = "event_date string, sne string, redeem_state string, v int"
    spark.createDataFrame([("d", "1", "3", 1), ("d", "2", "3", 2)], cols).write.parquet(path)
    source = spark.createDataFrame([("d", "1", "3", 10), ("d", "7", "3", 70)], cols)
    counts = merge_full_sync(spark, source, path, ["event_date", "sne", "redeem_state"])
    assert counts == MergeCounts(update=1, insert=1, delete=1)
    after = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert after == [("d", "1", "3", 10), ("d", "7", "3", 70)]


def test_merge_refuses_empty_source_and_duplicate_matches(spark, tmp_target):
    path = tmp_target("voucher")
    cols = "event_date string, sne string, redeem_state string, v int"
    spark.createDataFrame([("d", "1", "3", 1)], cols).write.parquet(path)
    with pytest.raises(ValueError, match="empty"):  # T8
        merge_full_sync(spark, spark.createDataFrame([], cols), path, ["event_date", "sne", "redeem_state"])
    dup = spark.createDataFrame([("d", "1", "3", 5), ("d", "1", "3", 6)], cols)
    with pytest.raises(ValueError, match="several rows"):  # T9
        merge_full_sync(spark, dup, path, ["event_date", "sne", "redeem_state"])


def test_promote_selects_target_columns_by_name(spark, tmp_target):
    staged, target = tmp_target("staged"), tmp_target("target")
    overwrite_partitions(frame(spark, [(1, "2024-01-01", "A"), (2, "2024-01-02", "A")]), target,
                         ["event_date"])
    # staged columns in another order: written by name, not by position
    frame(spark, [(5, "2024-01-02", "S")]).select("source", "v", "event_date") \
        .write.partitionBy("event_date").parquet(staged)
    promote(spark, staged, target, ["event_date"], target_columns=["v", "source", "event_date"],
            schema=frame(spark, []).select("source", "v", "event_date").schema)
    assert content(spark, target) == [(1, "2024-01-01", "A"), (5, "2024-01-02", "S")]
    with pytest.raises(ValueError, match="lacks"):
        promote(spark, staged, target, ["event_date"], target_columns=["v", "missing"])


def test_key_list_skips_blank_lines_and_repeats(spark, tmp_target):
    path = tmp_target("keys")
    os.makedirs(path)
    with open(f"{path}/part-0.txt", "w") as fh:
        fh.write("628a\n\n628b\n   \n628a\n")
    assert sorted(r.msisdn for r in key_list(spark, path).collect()) == ["628a", "628b"]


def test_catalog_tables_overwrite_promote_truncate_and_merge(spark):
    """The same sinks on managed catalog tables (positional insertInto by the
    target's column order, TRUNCATE of the staged table, merge into a table)."""
    spark.sql("DROP TABLE IF EXISTS t_target")
    spark.sql("DROP TABLE IF EXISTS t_staged")
    frame(spark, [(1, "2024-01-01", "A"), (2, "2024-01-02", "A")]) \
        .write.partitionBy("event_date").format("parquet").saveAsTable("t_target")
    frame(spark, [(7, "2024-01-02", "S"), (8, "2024-01-03", "S")]) \
        .write.partitionBy("event_date").format("parquet").saveAsTable("t_staged")
    promote(spark, "t_staged", "t_target", ["event_date"], clear_source=True)
    got = sorted((r.v, str(r.event_date)) for r in spark.table("t_target").collect())
    assert got == [(1, "2024-01-01"), (7, "2024-01-02"), (8, "2024-01-03")]
    assert spark.table("t_staged").count() == 0  # K5
    promote(spark, "t_staged", "t_target", ["event_date"], drop_source=True)
    assert not spark.catalog.tableExists("t_staged")  # K6

    overwrite_partitions(frame(spark, [(9, "2024-01-03", "Z")]).select("event_date", "source", "v"),
                         "t_target", ["event_date"])
    got = sorted((r.v, str(r.event_date)) for r in spark.table("t_target").collect())
    assert got == [(1, "2024-01-01"), (7, "2024-01-02"), (9, "2024-01-03")]

    spark.sql("DROP TABLE IF EXISTS t_voucher")
    cols = "event_date string, sne string, redeem_state string, v int"
    spark.createDataFrame([("d", "1", "3", 1), ("d", "2", "3", 2)], cols).write.saveAsTable("t_voucher")
    source = spark.createDataFrame([("d", "2", "3", 20), ("d", "3", "3", 30)], cols)
    merge_full_sync(spark, source, "t_voucher", ["event_date", "sne", "redeem_state"])
    assert sorted(tuple(r) for r in spark.table("t_voucher").collect()) == \
        [("d", "2", "3", 20), ("d", "3", "3", 30)]


def test_merge_drops_days_the_source_lacks_and_keeps_the_layout(spark, tmp_target):
    keys = ["event_date", "v"]
    old = frame(spark, [(1, "2024-01-01", "A"), (2, "2024-01-02", "A"), (4, "2024-01-01", "A")])
    new = frame(spark, [(1, "2024-01-01", "B"), (3, "2024-01-03", "B")])
    want = [(1, "2024-01-01", "B"), (3, "2024-01-03", "B")]
    path = tmp_target("merged")
    overwrite_partitions(old, path, ["event_date"])
    assert merge_full_sync(spark, new, path, keys, ["event_date"], old.schema) == MergeCounts(1, 1, 2)
    assert content(spark, path) == want
    assert sorted(d for d in os.listdir(path.removeprefix("file://")) if "=" in d) == \
        ["event_date=2024-01-01", "event_date=2024-01-03"]
    for name in ("t_merged", "t_merge_source"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    old.write.partitionBy("event_date").format("parquet").saveAsTable("t_merged")
    new.write.format("parquet").saveAsTable("t_merge_source")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    merge_full_sync(spark, "t_merge_source", "t_merged", keys, clear_source=True)
    assert spark.conf.get(mode) == before
    got = sorted((r.v, str(r.event_date), r.source) for r in spark.table("t_merged").collect())
    assert got == want
    assert [r[0] for r in spark.sql("SHOW PARTITIONS t_merged").collect()] == \
        ["event_date=2024-01-01", "event_date=2024-01-03"]
    assert spark.table("t_merge_source").count() == 0


def test_merge_updates_every_target_row_of_a_key(spark, tmp_target):
    cols = "k string, v int"
    path = tmp_target("repeats")
    spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], cols).write.parquet(path)
    source = spark.createDataFrame([("a", 9), (None, 8), ("b", 7)], cols)
    assert merge_full_sync(spark, source, path, ["k"]) == MergeCounts(update=2, insert=2, delete=1)
    assert sorted((tuple(r) for r in spark.read.parquet(path).collect()), key=str) == \
        [("a", 9), ("a", 9), ("b", 7), (None, 8)]


def test_newest_partition_comes_from_the_partition_list(spark):
    spark.sql("DROP TABLE IF EXISTS t_days")
    frame(spark, [(1, "2024-01-01", "A"), (2, "2024-01-09", "A")]) \
        .write.partitionBy("event_date").format("parquet").saveAsTable("t_days")
    assert newest_partition(spark, "t_days") == "2024-01-09"
    assert newest_partition(spark, "t_days", "v") is None
    assert newest_partition(spark, "/some/path") is None
    assert [r.v for r in latest_snapshot(spark.table("t_days"), newest="2024-01-09").collect()] == [2]


def test_work_folder_must_be_shared_off_local_mode(spark, monkeypatch):
    from types import SimpleNamespace

    from tallyspark import session
    conf = SimpleNamespace(get=lambda *a: None)
    for master, fine in (("local[*]", True), ("local-cluster[2,1,1024]", False), ("yarn", False), ("spark://h:7077", False)):
        sc = SimpleNamespace(master=master, getConf=lambda: conf, getCheckpointDir=lambda: None, setCheckpointDir=lambda p: None)
        fake = SimpleNamespace(sparkContext=sc)
        if fine:
            assert session.work_dir(fake)
        else:
            with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
                session.work_dir(fake)


def test_hot_key_is_split_in_the_second_of_two_lookups(spark):
    """A key with 90 % of the rows, through two chained joins on it."""
    from tallyspark.operators import lookup
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
                "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        left = spark.range(0, 200000, 1, 8).select(
            F.when(F.col("id") % 10 != 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        sides = [spark.range(0, 200000, 1, 4).select(F.col("id").alias("k"), (F.col("id") * 2).alias(n)) for n in "ab"]
        out = lookup(lookup(left, sides[0], ["k"], ["k"]), sides[1], ["k"], ["k"])
        assert out.agg(F.count("a"), F.count("b")).first() == (200000, 200000)
        out.write.format("noop").mode("overwrite").save()
        rows = out.collect()
        assert len(rows) == 200000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("skew=true") >= 2, plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_expected_partitions_drop_stale_ones_on_catalog_tables(spark):
    """A re-run that lost all rows of a partition it owns removes it."""
    spark.sql("DROP TABLE IF EXISTS t_owned")
    frame(spark, [(1, "2024-01-01", "A"), (2, "2024-01-02", "A")]) \
        .write.partitionBy("event_date").format("parquet").saveAsTable("t_owned")
    rerun = frame(spark, [(5, "2024-01-01", "A")]).select("v", "source", "event_date")
    overwrite_partitions(rerun, "t_owned", ["event_date"],
                         expected_partitions=[{"event_date": "2024-01-01"},
                                              {"event_date": "2024-01-02"}])
    got = sorted((r.v, str(r.event_date)) for r in spark.table("t_owned").collect())
    assert got == [(5, "2024-01-01")]


def test_expected_partitions_drop_stale_ones_on_paths(spark, tmp_target):
    path = tmp_target("owned")
    overwrite_partitions(frame(spark, [(1, "2024-01-01", "A"), (2, "2024-01-01", "it's"), (3, "2024-01-02", "A")]),
                         path, ["event_date", "source"])
    owned = [{"event_date": "2024-01-01", "source": s} for s in ("A", "it's")]
    overwrite_partitions(frame(spark, [(5, "2024-01-01", "A")]), path, ["event_date", "source"], expected_partitions=owned)
    assert content(spark, path) == [(3, "2024-01-02", "A"), (5, "2024-01-01", "A")]
    # a run that lost every row
    overwrite_partitions(frame(spark, []), path, ["event_date", "source"], expected_partitions=owned)
    assert content(spark, path) == [(3, "2024-01-02", "A")]
