"""Partition-aware scans.

Every scan is a plain filter on the partition column so Catalyst turns it
into ``PartitionFilters`` (directory pruning) for partitioned tables and
``PushedFilters`` (row-group skipping) for plain parquet.

``days`` arguments accept:

* ``None``: every partition (a backfill over the whole table),
* ``"yyyy-MM-dd"``: one business day,
* ``(first, last)``: an inclusive range.
"""

from __future__ import annotations

from typing import Sequence, Union

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.sources.store import partition_specs

Days = Union[None, str, tuple[str, str]]


def day_predicate(col: str | Column, days: Days) -> Column | None:
    c = F.col(col) if isinstance(col, str) else col
    if days is None:
        return None
    if isinstance(days, str):
        return c == F.lit(days).cast("date")
    first, last = days
    return c.between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def scan_days(df: DataFrame, days: Days, col: str = "event_date") -> DataFrame:
    """Rows of the selected partitions."""
    pred = day_predicate(col, days)
    return df if pred is None else df.where(pred)


def scan_day(df: DataFrame, day: str, col: str = "event_date") -> DataFrame:
    """Rows of one business day."""
    return scan_days(df, day, col)


def scan_range(df: DataFrame, first: str, last: str, col: str = "event_date") -> DataFrame:
    """Rows of an inclusive partition range."""
    return scan_days(df, (first, last), col)


def scan_reject(df: DataFrame, run_date: str | None, window: Days,
                partition_col: str = "event_date", trx_col: str = "trx_date") -> DataFrame:
    """Reject rows: they sit in the *run day's* partition and are chosen by
    transaction date (S4).  ``run_date=None`` means ``current_date()``."""
    run_day = F.current_date() if run_date is None else F.lit(run_date).cast("date")
    out = df.where(F.col(partition_col) == run_day)
    pred = day_predicate(F.col(trx_col).try_cast("date"), window)
    return out if pred is None else out.where(pred)


def newest_partition(spark: SparkSession, name: str, col: str = "event_date") -> str | None:
    """Newest value of a partition column of a path or catalog table, from
    the partition list alone (S11); None where nothing is partitioned by it.

    Values compare as text, as ISO days do."""
    return max((v for v in (s.get(col) for s in partition_specs(spark, name)) if v), default=None)


def newest_loads(spark: SparkSession, name: str, by: Sequence[str] = ("event_date", "source"),
                 load_col: str = "load_date") -> list[dict[str, str | None]]:
    """For every combination of the ``by`` partition columns the partition of
    its newest load, from the partition list alone."""
    newest: dict[tuple, str] = {}
    for spec in partition_specs(spark, name):
        key, load = tuple(spec.get(c) for c in by), spec.get(load_col)
        if load is not None and load > newest.get(key, ""):
            newest[key] = load
    return [dict(zip(by, key, strict=True)) | {load_col: load} for key, load in newest.items()]


def scan_newest_loads(df: DataFrame, loads: Sequence[dict[str, str | None]]) -> DataFrame:
    """Rows of the partitions ``newest_loads`` names (T7): a day loaded twice
    counts once.

    The condition is on partition columns alone, so it prunes folders:
    superseded loads are not read.  Null partition values match null."""
    if not loads:
        return df.where(F.lit(False))
    cols = list(loads[0])
    # neither character can stand in a partition folder's name unescaped
    named = ["\0".join("\1" if s[c] is None else s[c] for c in cols) for s in loads]
    key = F.concat_ws("\0", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\1")) for c in cols])
    return df.where(key.isin(named))


def latest_snapshot(df: DataFrame, col: str = "event_date", newest: str | None = None) -> DataFrame:
    """Rows of the newest partition.

    ``newest`` is that day where the caller has it from the partition list
    (``newest_partition``); then no file is opened to find it.

    Written as a scalar subquery ``col = (SELECT max(col) ...)`` so that for a
    partitioned table the value lands in ``PartitionFilters`` and only the
    newest directory is read (the ``IN (subquery)`` form plans a semi join
    that reads every partition).
    """
    if newest is not None:
        return df.where(F.col(col) == F.lit(newest).cast(df.schema[col].dataType))
    return df.where(F.col(col) == df.select(F.max(col)).scalar())


def key_list(spark: SparkSession, path: str, column: str = "msisdn") -> DataFrame:
    """One key per text line; blank lines skipped, repeats removed."""
    lines = spark.read.text(path)
    keys = lines.where(F.trim(F.col("value")) != "").select(F.col("value").alias(column))
    return keys.distinct()
