"""Session settings and the shared work folder.

Library code never creates a session on its own: every operator takes the
caller's DataFrames.  ``build_session`` exists for tests, the bench and
command-line runs.  ``work_dir`` returns the folder used for written
hand-off tables and checkpoints: the cluster's ``spark.checkpoint.dir`` when
set, otherwise (local tests only) a fresh temporary folder registered as the
checkpoint dir.
"""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every run relies on.  Dynamic overwrite is what the ledger sinks
# need; UTC keeps date/time functions independent of the host.
CORE_CONF = {
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Chained joins on one key keep its partitioning; without this Spark gives
    # up splitting a hot key there, as the split changes that partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}

# Most bytes that one task of the ledger half should read, from files and
# from a shuffle.  Both are compressed: a ledger-wide row of 200 of them takes
# a kilobyte and more in a sort or a hash table, so Spark's own 64 and 128 MB
# make tasks outgrow their share of an executor, and spill.
TASK_BYTES = "16m"
TASK_SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")

#: Whether shuffle files are removed at the end of the query that wrote them.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Scratch folders by application, for ``drop_scratch``.
_SCRATCH: dict[str, list[str]] = {}
#: For each thread the open blocks of ``passing_scratch``, innermost last.
_PASSING = threading.local()


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tallyspark", extra: dict | None = None,
                  hive: bool = False) -> SparkSession:
    """Create (or reuse) a session with the settings the flows expect;
    ``hive`` makes the tables of the cluster's metastore visible."""
    builder = SparkSession.builder.appName(app_name)
    if hive:
        builder = builder.enableHiveSupport()
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate may hand back an existing session: apply the SQL settings
    # at runtime too (static ones are ignored there, which is fine).
    for key, value in conf.items():
        if key.startswith("spark.sql.") and "warehouse" not in key:
            try:
                spark.conf.set(key, value)
            except Exception:  # static conf on a live session
                pass
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_session_defaults(spark: SparkSession) -> None:
    """Apply the runtime SQL settings the sinks and joins rely on to a
    caller's session, and bound what a task reads (``TASK_SIZES``; a caller's
    smaller sizes stay).

    The session time zone is left alone: day columns are dates, the test
    feeds use ``timestamp_ntz`` and the epoch-to-local-day conversion is
    zone-free.
    """
    for key in ("spark.sql.sources.partitionOverwriteMode",
                "spark.sql.adaptive.forceOptimizeSkewedJoin"):
        spark.conf.set(key, CORE_CONF[key])
    for key in TASK_SIZES:
        if size_of(spark.conf.get(key)) > size_of(TASK_BYTES):
            spark.conf.set(key, TASK_BYTES)


def size_of(text: str) -> int:
    """Bytes of a size in Spark's notation, such as ``10MB`` or ``10485760b``."""
    digits, unit = re.fullmatch(r"\s*(-?[0-9]+)\s*([a-z]*)\s*", text.lower()).groups()
    return int(digits) * 1024 ** ("bkmgtp".index(unit[0]) if unit else 0)


@contextmanager
def overwrite_mode(spark: SparkSession, mode: str):
    """Run a block under one partition overwrite mode, then restore the
    caller's."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def released_shuffles(spark: SparkSession):
    """Shuffle files of what is run in the block go as soon as it has run,
    not when the driver's garbage collector finds them; for tables that are
    written and read back.  Rows asked for again would be shuffled again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written hand-off tables and checkpoints.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    (local tests) is a fresh temporary folder created and registered; on a
    cluster that folder would be another one on every machine, so there an
    unset checkpoint folder is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        # Spark registers it at start-up; set it only if that did not happen
        # (each setCheckpointDir call creates a new sub-folder).
        if not current:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        # Spark appends a per-application uuid folder; its parent is ours.
        return os.path.dirname(current.rstrip("/"))
    master = sc.master or ""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir is not set: under master {master!r} the work "
                           "folder has to be one that all machines share")
    local = tempfile.mkdtemp(prefix="tallyspark-work-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared work folder."""
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    if blocks := getattr(_PASSING, "blocks", None):
        blocks[-1].append(path)
    return path


@contextmanager
def passing_scratch(spark: SparkSession):
    """Scratch tables that this thread makes in the block go when it ends;
    what is to stay gets its path before."""
    if not hasattr(_PASSING, "blocks"):
        _PASSING.blocks = []
    _PASSING.blocks.append([])
    try:
        yield
    finally:
        made = _PASSING.blocks.pop()
        known = _SCRATCH.get(spark.sparkContext.applicationId, [])
        for path in made:
            delete_path(spark, path)
            if path in known:
                known.remove(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete every scratch table this application made; call it when no
    DataFrame read from one is needed any more."""
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        delete_path(spark, path)
