"""Crash-safe replacement: a run broken off after any step loses nothing."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import merge_full_sync, overwrite_partitions, publish, read_target

from .test_sinks import content, frame

KEYS = ["event_date", "v"]
OLD = [(1, "2024-01-01", "A"), (2, "2024-01-02", "A"), (4, "2024-01-01", "A")]
NEW = [(1, "2024-01-01", "B"), (3, "2024-01-03", "B")]


class BrokenOff(Exception):
    pass


def break_off_at(monkeypatch, step):
    def reached(now):
        if now == step:
            raise BrokenOff(step)
    monkeypatch.setattr(publish, "_reached", reached)


def leftovers(path):
    parent, _, name = path.removeprefix("file://").rpartition("/")
    return os.path.exists(f"{parent}/.replacing-{name}")


@pytest.mark.parametrize("step", ["staged", "recorded", "set_aside", "placed", "forgotten"])
def test_path_merge_broken_off_at_each_step(spark, tmp_target, monkeypatch, step):
    path = tmp_target("voucher")
    old, new = frame(spark, OLD), frame(spark, NEW)
    overwrite_partitions(old, path, ["event_date"])
    with monkeypatch.context() as m:
        break_off_at(m, step)
        with pytest.raises(BrokenOff):
            merge_full_sync(spark, new, path, KEYS, ["event_date"], old.schema)
    assert leftovers(path)
    # what is there, once what was decided is carried out, is one whole version
    assert publish.recover(spark, path) == (step in ("recorded", "set_aside", "placed"))
    assert content(spark, path) == sorted(OLD if step == "staged" else NEW)
    counts = merge_full_sync(spark, new, path, KEYS, ["event_date"], old.schema)
    assert content(spark, path) == sorted(NEW) and not leftovers(path)
    assert (counts.insert, counts.delete) == ((1, 2) if step == "staged" else (0, 0))
    folders = sorted(d for d in os.listdir(path.removeprefix("file://")) if "=" in d)
    assert folders == ["event_date=2024-01-01", "event_date=2024-01-03"]


@pytest.mark.parametrize("step", ["staged", "recorded", "placed", "forgotten"])
def test_table_merge_broken_off_at_each_step(spark, monkeypatch, step):
    spark.sql("DROP TABLE IF EXISTS t_replaced")
    old, new = frame(spark, OLD), frame(spark, NEW)
    old.write.partitionBy("event_date").format("parquet").saveAsTable("t_replaced")
    with monkeypatch.context() as m:
        break_off_at(m, step)
        with pytest.raises(BrokenOff):
            merge_full_sync(spark, new, "t_replaced", KEYS)
    merge_full_sync(spark, new, "t_replaced", KEYS)
    got = sorted((r.v, str(r.event_date), r.source) for r in spark.table("t_replaced").collect())
    assert got == sorted(NEW)
    assert [r[0] for r in spark.sql("SHOW PARTITIONS t_replaced").collect()] == ["event_date=2024-01-01", "event_date=2024-01-03"]
    assert not publish.recover(spark, "t_replaced")


def test_a_table_half_overwritten_is_written_again(spark, monkeypatch):
    """A driver lost inside the overwrite itself."""
    spark.sql("DROP TABLE IF EXISTS t_replaced")
    old, new = frame(spark, OLD), frame(spark, NEW)
    old.write.partitionBy("event_date").format("parquet").saveAsTable("t_replaced")
    with monkeypatch.context() as m:
        break_off_at(m, "recorded")
        with pytest.raises(BrokenOff):
            publish.replace(spark, new, "t_replaced")
    spark.sql("TRUNCATE TABLE t_replaced")
    assert spark.table("t_replaced").count() == 0
    assert publish.recover(spark, "t_replaced")
    assert sorted((r.v, str(r.event_date), r.source) for r in spark.table("t_replaced").collect()) == sorted(NEW)


def test_replacement_may_read_its_target(spark, tmp_target):
    path = tmp_target("self")
    old = frame(spark, OLD)
    overwrite_partitions(old, path, ["event_date"])
    for _ in range(2):
        rows = read_target(spark, path, old.schema).withColumn("v", F.col("v") + 10)
        publish.replace(spark, rows.select(*old.columns), path, ["event_date"])
    assert content(spark, path) == sorted((v + 20, d, s) for v, d, s in OLD)
