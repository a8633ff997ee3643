"""Sinks: dynamic-partition overwrite (K1/K2/K7), full-sync merge (K3) and
staged -> target promotion (K4-K6, S10).

Targets are parquet directories or catalog tables.  Writes are by column
*name* against the target's column list, never by position (T11).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators import publish
from tallyspark.session import delete_path, overwrite_mode, released_shuffles
from tallyspark.sources.store import is_path as _is_path

ACTION = "merge_action"
#: Rows of a page of a key-clustered file.
KEY_PAGE_ROWS = 4000


def overwrite_partitions(df: DataFrame, target: str, partition_cols: Sequence[str],
                         rebalance: str | None = "partitions",
                         expected_partitions: Sequence[dict] | None = None,
                         cluster_by: Sequence[str] = ()) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic overwrite).

    Partitions absent from ``df`` are untouched, and an empty ``df`` changes
    nothing (T6).  ``rebalance`` says how rows are dealt to the writers:

    * ``"partitions"``: by the partition columns, so that one partition meets
      in few writers; AQE splits one much larger than the rest;
    * ``"rows"``: evenly, for a load of one or few partitions, which the
      first way would send to one writer;
    * ``None``: as they come, without a shuffle, for rows that already lie by
      partition.

    ``expected_partitions``: partition specs such as ``{"load_date":
    "2025-04-03", "event_date": "2025-04-01", "source": "CHG"}`` that this run
    owns; any of them that received no rows is dropped, so a re-run that lost
    all its rows leaves no stale data.  Which ones were written is observed
    during the write itself; only distinct partition values reach the driver.

    ``cluster_by``: key columns that the rows of every file are sorted by; a
    path's files also get ``key_layout``, so that point lookups read few of
    the rows (``key_totals``).  A table has its layout from ``ensure_table``.
    """
    spark = df.sparkSession
    out = df
    if rebalance is not None:
        out = out.hint("rebalance", *(partition_cols if rebalance == "partitions" else ()))
    observed = Observation()
    if expected_partitions:
        values = F.collect_set(F.array(*[F.col(c).cast("string") for c in partition_cols]))
        out = out.observe(observed, values.alias("written"))
    if cluster_by:
        out = out.sortWithinPartitions(*partition_cols, *cluster_by)
    if _is_path(target):
        with released_shuffles(spark):
            (out.write.mode("overwrite")
                .options(**key_layout(cluster_by))
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*partition_cols)
                .parquet(target))
    else:
        with overwrite_mode(spark, "dynamic"), released_shuffles(spark):
            out.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
    if expected_partitions:
        written = {tuple(v) for v in observed.get["written"]}
        _drop_unwritten(spark, target, partition_cols, expected_partitions, written)


def key_layout(keys: Sequence[str]) -> dict[str, str]:
    """Parquet settings for rows sorted by ``keys``: a Bloom filter per row
    group, and pages short enough that their ranges tell keys apart."""
    if not keys:
        return {}
    return {"parquet.page.row.count.limit": str(KEY_PAGE_ROWS)} | {f"parquet.bloom.filter.enabled#{k}": "true" for k in keys}


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition_cols: Sequence[str],
                 cluster_by: Sequence[str] = ()) -> bool:
    """Create a partitioned Parquet catalog table from its declared schema
    where there is none (the first load), and say whether it was created.

    An existing table must have these columns, types and partition columns,
    in whatever order: a load into another layout would be written under the
    wrong partitions and is refused."""
    if not spark.catalog.tableExists(name):
        (spark.createDataFrame([], schema).write.format("parquet").options(**key_layout(cluster_by))
            .partitionBy(*partition_cols).saveAsTable(name))
        return True
    there = {f.name: f.dataType.simpleString() for f in spark.table(name).schema}
    wanted = {f.name: f.dataType.simpleString() for f in schema}
    layout = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    wrong = [f"{c} is {there.get(c)}, not {wanted.get(c)}" for c in {**wanted, **there} if there.get(c) != wanted.get(c)]
    if set(layout) != set(partition_cols):
        wrong.append(f"partitioned by {layout}, not {list(partition_cols)}")
    if wrong:
        raise ValueError(f"table {name} does not fit: {'; '.join(wrong)}")
    return False


def _drop_unwritten(spark: SparkSession, target: str, partition_cols: Sequence[str],
                    expected: Sequence[dict], written: set[tuple]) -> None:
    for spec in expected:
        key = tuple(str(spec[c]) for c in partition_cols)
        if key in written:
            continue
        if _is_path(target):
            name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
            folder = "/".join(name.getPartitionPathString(c, v) for c, v in zip(partition_cols, key))
            delete_path(spark, f"{target.rstrip('/')}/{folder}")
            continue
        parts = ", ".join(f"`{c}` = {_literal(v)}" for c, v in zip(partition_cols, key))
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({parts})")


def _literal(value: str) -> str:
    """A SQL string literal that means exactly ``value``."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def refresh(spark: SparkSession, name: str) -> None:
    """Forget cached file listings of a path or table."""
    if _is_path(name):
        spark.catalog.refreshByPath(name)
    elif spark.catalog.tableExists(name):
        spark.catalog.refreshTable(name)


def read_target(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a path or table back (with an explicit schema for paths, so
    partition values keep their declared types)."""
    if _is_path(target):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(target)
    return spark.table(target)


def merge_actions(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full-sync merge plan (K3/J12): every source row tagged ``update`` or
    ``insert``, every unmatched target row tagged ``delete``.

    Key equality is null-unsafe like SQL ``MERGE ... ON a = b``: a null-key
    source row is always an insert and a null-key target row always a delete
    (T9).  Output columns: the source columns (target values on deletes) and
    ``merge_action``.
    """
    cols = source.columns
    s = source.select(*[F.col(c).alias(f"__s_{c}") for c in cols], F.lit(True).alias("__in_s"))
    t = target.select(*[F.col(c).alias(f"__t_{c}") for c in cols], F.lit(True).alias("__in_t"))
    cond = None
    for k in keys:
        eq = F.col(f"__s_{k}") == F.col(f"__t_{k}")
        cond = eq if cond is None else cond & eq
    joined = s.join(t, cond, "full_outer")
    action = (F.when(F.col("__in_s") & F.col("__in_t"), F.lit("update"))
              .when(F.col("__in_s"), F.lit("insert"))
              .otherwise(F.lit("delete")))
    values = [F.when(F.col("__in_s").isNotNull(), F.col(f"__s_{c}"))
              .otherwise(F.col(f"__t_{c}")).alias(c) for c in cols]
    return joined.select(*values, action.alias(ACTION))


@dataclass(frozen=True)
class MergeCounts:
    """Rows a full-sync merge updated, inserted and deleted."""
    update: int
    insert: int
    delete: int


def merge_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many target rows a full-sync merge updates and deletes
    and how many source rows it inserts, the most target rows of a matched
    key, and a key with several source rows for its target row.

    Only keys travel, each once per side."""
    s = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_s")).alias("s")
    t = target.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_t")).alias("t")
    same = reduce(lambda a, b: a & b, [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys])
    matched = F.col("n_s").isNotNull() & F.col("n_t").isNotNull()
    total = lambda n, where: F.coalesce(F.sum(F.when(where, F.col(n))), F.lit(0))
    return s.join(t, same, "full_outer").agg(
        total("n_t", matched).alias("update"), total("n_s", F.col("n_t").isNull()).alias("insert"),
        total("n_t", F.col("n_s").isNull()).alias("delete"), F.max(F.when(matched, F.col("n_t"))).alias("repeats"),
        F.max(F.when(matched & (F.col("n_s") > 1), F.struct(*[F.col(f"s.{k}").cast("string") for k in keys]))).alias("twice"))


def merge_full_sync(spark: SparkSession, source: DataFrame | str, target: str, keys: Sequence[str],
                    partition_cols: Sequence[str] = (), schema: T.StructType | None = None,
                    allow_empty: bool = False, clear_source: bool = False) -> MergeCounts:
    """Apply update / insert / delete of a full-sync merge to ``target`` (K3).

    With all three clauses the new content is the source's rows (T10), one
    for every target row a key repeats on.  So only keys are joined, for the
    counts and the checks, and the source is written over the whole target:
    partitions that lost all their rows go with it and the layout by
    ``partition_cols`` (a table's own, for catalog tables) stays.

    The new content is staged whole and put in place by ``publish.replace``:
    wherever a run breaks off, the old or the new version is there, and the
    next run, or ``publish.recover``, finishes what was decided.

    Both sides are refreshed first (S10).  An empty source would delete the
    whole target and is refused unless ``allow_empty`` (T8); several source
    rows for one target row are refused (T9).  ``clear_source`` truncates a
    catalog source once the target is written (K5); until then a run that
    broke off can simply be repeated.
    """
    publish.recover(spark, target)
    for name in (source, target):
        if isinstance(name, str):
            refresh(spark, name)
    rows = read_target(spark, source, schema) if isinstance(source, str) else source
    current = read_target(spark, target, schema)
    found = merge_counts(current, rows, keys).first()
    if found.twice is not None:
        raise ValueError(f"merge source has several rows for one target row: {found.twice.asDict()}")
    if not allow_empty and not found["update"] and not found["insert"]:
        raise ValueError("empty merge source would delete every target row; pass allow_empty=True")
    rows = rows.select(*current.columns)
    if (found.repeats or 1) > 1:
        again = current.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        rows = rows.join(again, list(keys), "left").select(
            *current.columns, F.explode(F.sequence(F.lit(1), F.coalesce("__n", F.lit(1)))).alias("__i")).drop("__i")
    publish.replace(spark, rows, target, partition_cols)
    refresh(spark, target)
    if clear_source and isinstance(source, str) and not _is_path(source):
        spark.sql(f"TRUNCATE TABLE {source}")
    return MergeCounts(found["update"], found["insert"], found["delete"])


def promote(spark: SparkSession, source: str, target: str, partition_cols: Sequence[str],
            target_columns: Sequence[str] | None = None, schema: T.StructType | None = None,
            clear_source: bool = False, drop_source: bool = False,
            rebalance: str | None = None) -> None:
    """Move a staged feed into its target by dynamic partition overwrite (K4).

    A staged feed laid out like its target is copied partition by partition
    without a shuffle; ``rebalance`` deals the rows anew where it is not (see
    ``overwrite_partitions``).  Both sides are refreshed first (S10) so cached file listings are not
    stale.  Columns are selected by the target's names (T11).  With
    ``clear_source`` a catalog source is truncated afterwards (K5), with
    ``drop_source`` it is dropped (K6, off by default); path sources are
    left in place.
    """
    for name in (source, target):
        refresh(spark, name)
    staged = read_target(spark, source, schema)
    cols = list(target_columns) if target_columns else staged.columns
    missing = [c for c in cols if c not in staged.columns]
    if missing:
        raise ValueError(f"staged feed lacks target columns: {missing}")
    overwrite_partitions(staged.select(*cols), target, partition_cols, rebalance)
    if clear_source and not _is_path(source):
        spark.sql(f"TRUNCATE TABLE {source}")
    if drop_source and not _is_path(source):
        spark.sql(f"DROP TABLE IF EXISTS {source}")
