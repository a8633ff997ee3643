"""Replacing a whole path or table so that no crash loses both versions.

The new content is staged next to the target, whole, before anything is
touched.  A record then says where it is; from that moment the replacement is
decided, and whoever comes next (``recover``) carries it out:

1. ``staged``: content written beside the target.  A crash before the record
   leaves the target as it was; the next run clears the leftovers away.
2. ``recorded``: the record exists.
3. paths: the old folder is ``set_aside`` by a rename and the staged one
   renamed to the target (``placed``).  Catalog tables: the staged rows are
   written over the table, which can be done again after any crash, as they
   stay where they are until it is done.
4. ``forgotten``: the record is deleted, then staged and old content.

Only one run may replace a target at a time, as with any overwrite.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyspark.session import overwrite_mode
from tallyspark.sources.store import Store, is_path


def _reached(step: str) -> None:
    """Called after each step; a test breaks a run off here."""


def _home(spark: SparkSession, target: str) -> tuple[str, str]:
    """The target's folder, and the hidden one beside it that staged content
    and the record go to."""
    if is_path(target):
        folder = target.rstrip("/")
    else:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {target}").collect()
        folder = next(r.data_type for r in rows if r.col_name == "Location").rstrip("/")
    parent, _, name = folder.rpartition("/")
    return folder, f"{parent}/.replacing-{name}"


def stage(spark: SparkSession, rows: DataFrame, target: str, partition_cols=()) -> str:
    """Write ``rows`` beside ``target``; the folder they are in."""
    _, home = _home(spark, target)
    staged = f"{home}/{uuid.uuid4().hex}"
    writer = rows.write
    if is_path(target) and partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(staged)
    _reached("staged")
    return staged


def decide(spark: SparkSession, target: str, staged: str, schema: T.StructType) -> None:
    """Record that ``staged`` is to replace ``target``."""
    _, home = _home(spark, target)
    record = {"staged": staged, "old": f"{staged}-old", "schema": schema.json()}
    Store(spark, home).write_text(f"{home}/record", json.dumps(record))
    _reached("recorded")


def recover(spark: SparkSession, target: str) -> bool:
    """Carry out a replacement that was decided, if there is one, and clear
    away what runs that broke off left; whether there was one."""
    folder, home = _home(spark, target)
    store = Store(spark, home)
    if not store.exists(home):
        return False
    decided = store.exists(f"{home}/record")
    if decided:
        record = json.loads(store.read_text(f"{home}/record"))
        if is_path(target):
            if store.exists(record["staged"]):
                if store.exists(folder):
                    store.rename(folder, record["old"])
                    _reached("set_aside")
                store.rename(record["staged"], folder)
            _reached("placed")
            spark.catalog.refreshByPath(folder)
        else:
            rows = spark.read.schema(T.StructType.fromJson(json.loads(record["schema"]))).parquet(record["staged"])
            with overwrite_mode(spark, "static"):
                rows.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
            _reached("placed")
            spark.catalog.refreshTable(target)
        store.delete(f"{home}/record")
        _reached("forgotten")
    store.delete(home)
    return decided


def replace(spark: SparkSession, rows: DataFrame, target: str, partition_cols=()) -> None:
    """Make ``rows``, which may read ``target``, its whole content."""
    staged = stage(spark, rows, target, partition_cols)
    decide(spark, target, staged, rows.schema)
    recover(spark, target)
