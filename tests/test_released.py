"""What a written table and the ledger's loads leave on the executors' disks."""

import time
import uuid

import pytest
from pyspark.sql import functions as F

from tallyspark.operators.enrich import handed_off
from tallyspark.operators.sinks import overwrite_partitions
from tallyspark.plans import queries as Q
from tallyspark.session import scratch_path
from tests.llm.test_stored import shuffle_files


@pytest.mark.parametrize("target", ["path", "table", "handed off"])
def test_a_write_leaves_no_shuffle_files(spark, target):
    before = shuffle_files(spark)
    rows = spark.range(500).select("id", (F.col("id") % 3).alias("day"))
    if target == "path":
        overwrite_partitions(rows, scratch_path(spark, "rows"), ["day"])
    elif target == "table":
        name = f"released_{uuid.uuid4().hex[:12]}"
        rows.limit(0).write.partitionBy("day").saveAsTable(name)
        overwrite_partitions(rows, name, ["day"])
        spark.sql(f"DROP TABLE {name}")
    else:
        handed_off(rows.repartition(3, "day"), "rows")
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before


def test_each_flow_of_the_ledger_is_written_by_itself(spark, monkeypatch):
    """One flow's shuffle files are gone before the next flow starts."""
    written = []
    monkeypatch.setattr(Q, "handoff", lambda spark, sf, name, build, *a, **b: written.extend(build()))
    for name in ("charge", "seized", "upcc", "unmatched", "package"):
        monkeypatch.setattr(Q, f"q_flow_{name}", lambda spark, sf, params, name=name: name)
    Q.ledger_table(spark, "nowhere")
    assert written == ["charge", "seized", "upcc", "unmatched", "package"]
