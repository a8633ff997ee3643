from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallyspark.session import build_session
    work = tempfile.mkdtemp(prefix="tallyspark-tests-")
    s = build_session("local[*]", 8, app_name="tallyspark-tests",
                      extra={"spark.checkpoint.dir": f"{work}/checkpoints",
                             "spark.sql.warehouse.dir": f"{work}/warehouse"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_target(spark):
    from tallyspark.session import scratch_path
    return lambda name: scratch_path(spark, name)
