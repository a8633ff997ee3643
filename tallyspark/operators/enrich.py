"""Enrichment operators: de-duplication, top-ranked rows, lookups, fallbacks.

The joins here are always equi-joins (possibly on computed keys) so Spark can
pick broadcast-hash or sort-merge at runtime; none forces a broadcast.  With
AQE on, a side whose *measured* size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` is broadcast and anything
larger stays a shuffled join, so the size check is done by Spark on real
statistics rather than guessed here.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.session import released_shuffles, scratch_path
from tallyspark.session import size_of as _bytes
from tallyspark.sources.store import Store

_BEST = "__best_value"
_SALT = "__null_key_salt"


def dedup_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct rows over ``cols`` (``GROUP BY`` with no aggregate, A3).

    Plans as a partial + final hash aggregate, so repeats are removed on the
    map side before the shuffle.
    """
    return df.select(*cols).distinct()


def top_ranked(df: DataFrame, partition_cols: Sequence[str], order_col: str,
               ties: str = "all", method: str = "window") -> DataFrame:
    """Rows holding the highest ``order_col`` within each partition.

    ``ties="all"`` keeps every row that shares the top value, exactly like
    ``rank() OVER (PARTITION BY p ORDER BY o DESC) = 1`` (nulls sort last, so
    a partition whose values are all null keeps all its rows).

    ``method="window"`` (default) is that rank filter: Spark plans it with a
    partial ``WindowGroupLimit`` *before* the shuffle, so each map task only
    ships its own top-ranked rows per key -- a hot key costs a handful of
    rows per task, not its whole volume -- and the output stays hash
    partitioned on ``partition_cols`` for a following join on them.
    ``method="aggregate"`` computes a grouped ``max`` and joins it back
    null-safely on (partition, value); use it when one key can have a huge
    number of rows *tied* at the top value, since that join spreads them by
    value.

    ``ties="one"`` keeps a single row per partition with a deterministic
    tie-break on every remaining column (``row_number``).
    """
    if ties == "one":
        rest = [c for c in df.columns if c not in partition_cols and c != order_col]
        order = [F.col(order_col).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in rest]
        w = Window.partitionBy(*partition_cols).orderBy(*order)
        return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    if ties != "all":
        raise ValueError("ties must be 'all' or 'one'")
    if method == "window":
        w = Window.partitionBy(*partition_cols).orderBy(F.col(order_col).desc_nulls_last())
        return df.withColumn("__rnk", F.rank().over(w)).where("__rnk = 1").drop("__rnk")
    best = df.groupBy(*partition_cols).agg(F.max(order_col).alias(_BEST))
    b = best.alias("__b")
    d = df.alias("__d")
    cond = [F.col(f"__d.{k}").eqNullSafe(F.col(f"__b.{k}")) for k in partition_cols]
    cond.append(F.col(f"__d.{order_col}").eqNullSafe(F.col(f"__b.{_BEST}")))
    return d.join(b, reduce(lambda x, y: x & y, cond), "inner").select(
        *[F.col(f"__d.{c}").alias(c) for c in df.columns])


def lookup(left: DataFrame, right: DataFrame, left_on: Sequence[Column | str],
           right_on: Sequence[Column | str], how: str = "left",
           spread_null_keys: bool = False) -> DataFrame:
    """Equi-join ``left`` to ``right`` on (possibly computed) keys.

    Output: every ``left`` column, then every ``right`` column except the
    ones used as plain-name keys.  ``right`` must not share payload column
    names with ``left``.

    ``spread_null_keys`` (left/inner joins): a left row with a null key can
    never match, but it still hashes to one shuffle partition, and a feed
    with many missing keys would pile them into one task.  A salt derived
    from the row's own values (deterministic, so task retries reproduce the
    same shuffle) is added to the join key for exactly those rows; the right
    side carries salt 0, so matching is unchanged.  It widens the join key,
    so a right side already partitioned on the plain keys is re-shuffled:
    use it where null keys are expected to be frequent (offer lookups by
    subscriber and by charge-id prefix).  Elsewhere AQE splits an oversized
    partition of the left side; for the second of two joins that share one
    partitioning it does so only under
    ``spark.sql.adaptive.forceOptimizeSkewedJoin``, which the session settings
    of this library turn on.
    """
    plain = (all(isinstance(k, str) for k in left_on) and list(left_on) == list(right_on))
    if plain and not spread_null_keys:
        # Native join on the shared column names: the output stays hash
        # partitioned on them, so a following join on the same keys reuses
        # that partitioning instead of shuffling the left side again.
        return left.join(right, list(left_on), how).select(
            *left.columns, *[c for c in right.columns if c not in left_on])
    lk = [F.col(k) if isinstance(k, str) else k for k in left_on]
    rk_names = [k for k in right_on if isinstance(k, str)]
    rk = [F.col(k) if isinstance(k, str) else k for k in right_on]
    key_cols = [f"__lk{i}" for i in range(len(lk))]
    lft = left.select("*", *[e.alias(n) for e, n in zip(lk, key_cols)])
    rgt = right.select("*", *[e.alias(n + "_r") for e, n in zip(rk, key_cols)])
    rgt = rgt.drop(*rk_names)
    if spread_null_keys and how in ("left", "inner", "left_outer"):
        any_null = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in key_cols])
        lft = lft.withColumn(_SALT, F.when(any_null, F.xxhash64(*[F.col(c) for c in left.columns]))
                             .otherwise(F.lit(0).cast("bigint")))
        rgt = rgt.withColumn(_SALT + "_r", F.lit(0).cast("bigint"))
        key_cols = key_cols + [_SALT]
    cond = reduce(lambda a, b: a & b, [F.col(n) == F.col(n + "_r") for n in key_cols])
    joined = lft.join(rgt, cond, how)
    helper = set(key_cols) | {n + "_r" for n in key_cols}
    return joined.select(*[c for c in joined.columns if c not in helper])


def anti_lookup(left: DataFrame, right: DataFrame, left_on: Sequence[Column | str],
                right_on: Sequence[Column | str]) -> DataFrame:
    """Left rows with no equal key on the right (J8/J9 as a real anti join).

    Written as ``left_anti`` rather than "left join + IS NULL": Catalyst does
    not rewrite the latter, and the anti join never widens the row.  Null
    keys on either side never match, so null-key left rows are kept.
    """
    return _half_join(left, right, left_on, right_on, "left_anti")


def semi_lookup(left: DataFrame, right: DataFrame, left_on: Sequence[Column | str],
                right_on: Sequence[Column | str]) -> DataFrame:
    """Left rows having at least one equal key on the right (left semi join)."""
    return _half_join(left, right, left_on, right_on, "left_semi")


def _half_join(left: DataFrame, right: DataFrame, left_on, right_on, how: str) -> DataFrame:
    """Semi or anti join; with left keys given by name the output keeps their
    partitioning, so a second one on the same keys shuffles only its right."""
    names = [f"__hk{i}" for i in range(len(left_on))]
    rk = [F.col(k) if isinstance(k, str) else k for k in right_on]
    rgt = right.select(*[e.alias(n) for e, n in zip(rk, names)])
    if all(isinstance(k, str) for k in left_on):
        cond = [left[k] == rgt[n] for k, n in zip(left_on, names)]
        return left.join(rgt, reduce(lambda a, b: a & b, cond), how)
    lft = left.select("*", *[(F.col(k) if isinstance(k, str) else k).alias(n + "_l")
                             for k, n in zip(left_on, names)])
    cond = reduce(lambda a, b: a & b, [F.col(n + "_l") == F.col(n) for n in names])
    return lft.join(rgt, cond, how).select(*left.columns)


def handed_off(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared work folder and read back: worked out
    once however often it is used, with a size the planner knows."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with released_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def reduce_to(big: DataFrame, small: DataFrame, keys: Sequence[str], most_bytes: int | None = None) -> DataFrame:
    """The rows of ``big`` whose keys ``small`` has, if that pays: a semi join
    before ``big`` is shuffled.

    The distinct keys are handed off and measured.  Up to ``most_bytes``
    (Spark's broadcast threshold unless given) they are joined, which the
    planner, knowing the size, does by broadcast where ``big`` is read; beyond
    it the join would shuffle all of ``big`` itself, and ``big`` is returned as
    it is.  So this only ever serves a join on the same keys that follows.
    """
    spark = big.sparkSession
    if most_bytes is None:
        most_bytes = _bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    path = scratch_path(spark, "reducing-keys")
    wanted = small.select(*keys).dropna().distinct()
    with released_shuffles(spark):
        wanted.write.parquet(path)
    if Store(spark, path).size(path) > most_bytes:
        return big
    return semi_lookup(big, spark.read.schema(wanted.schema).parquet(path), list(keys), list(keys))


def coalesce_sources(df: DataFrame, current: DataFrame, fallback: DataFrame,
                     columns: Sequence[str], current_keys: Sequence[str],
                     fallback_keys: Sequence[str]) -> DataFrame:
    """Attach two candidate sources and keep, per column, the first non-null
    value: ``coalesce(current.x, fallback.x)`` (J2 + J3 + J4).

    Columns may mix sources when the current row has nulls.  Repeated keys on
    either side multiply rows, as in the original left joins.
    """
    cur = current.select(*current_keys, *[F.col(c).alias(f"__cur_{c}") for c in columns])
    fb = fallback.select(*fallback_keys, *[F.col(c).alias(f"__fb_{c}") for c in columns])
    out = lookup(df, cur, list(current_keys), list(current_keys))
    out = lookup(out, fb, list(fallback_keys), list(fallback_keys))
    merged = [F.coalesce(F.col(f"__cur_{c}"), F.col(f"__fb_{c}")).alias(c) for c in columns]
    keep = [c for c in out.columns if not c.startswith("__cur_") and not c.startswith("__fb_")
            and c not in columns]
    return out.select(*keep, *merged)


def repeated_keys(right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Audit for multiplying lookups (T2): the keys of a lookup side that
    occur more than once, with how many rows each one has.

    A left join against such a key repeats the left row once per match, so
    sums downstream count it several times -- faithful to the original
    joins, and made visible here.  A partial + final aggregate; nothing is
    collected.
    """
    return (right.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_per_key"))
            .where(F.col("rows_per_key") > 1))


def union_all(frames: Sequence[DataFrame], distinct: bool = False) -> DataFrame:
    """``UNION ALL`` by column name (U1/U2); ``distinct=True`` for UNION."""
    out = reduce(lambda a, b: a.unionByName(b), frames)
    return out.distinct() if distinct else out
