"""Per-subscriber totals for a whole key list in one job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.enrich import semi_lookup


#: Key ranges pushed into the scan at most; so many keys are pushed exactly.
RANGES = 128


def key_ranges(keys: DataFrame, key: str, most: int = RANGES) -> list[tuple[str, str]]:
    """At most ``most`` ranges that cover the keys, each key a range of its
    own where there are no more; only the ends reach the driver."""
    dealt = keys.select(key).where(F.col(key).isNotNull()).distinct()
    few = dealt.limit(most + 1).collect()
    if len(few) <= most:
        return sorted((r[0], r[0]) for r in few)
    ends = (dealt.repartitionByRange(most, key).groupBy(F.spark_partition_id())
            .agg(F.min(key).alias("low"), F.max(key).alias("high")))
    return sorted((r.low, r.high) for r in ends.collect())


def in_ranges(key: str, ranges: list[tuple[str, str]]) -> Column:
    """Whether a key lies in one of the ranges, as comparisons with literals,
    which scans push down: pages and row groups of a file sorted by the key
    are skipped by their ranges, and equalities by their Bloom filters too."""
    terms = [F.col(key) == low if low == high else F.col(key).between(low, high) for low, high in ranges]
    while len(terms) > 1:  # a shallow tree, whatever their number
        terms = [reduce(lambda a, b: a | b, terms[i:i + 2]) for i in range(0, len(terms), 2)]
    return terms[0] if terms else F.lit(False)


def key_totals(ledger: DataFrame, keys: DataFrame, key: str = "msisdn",
               measures: tuple[str, ...] = ("rev_per_usage", "rev_seized"), ranges: int = RANGES) -> DataFrame:
    """One row per distinct key: its revenue sums and ``subscribers_found``
    (1 when the ledger has rows for it, else 0 -- the per-key
    ``count(*) from (... group by msisdn)`` of the original lookup).

    Instead of one application per key, the ledger is semi-joined to the key
    list (the list is small, so Spark's runtime size check broadcasts it; it
    stays a shuffled join if it is not), then aggregated once.  The
    aggregate is partial + final, so a hot subscriber is combined map-side.

    Ranges that cover the keys are pushed into the scan (``key_ranges``), so
    of a ledger clustered by the key (``overwrite_partitions``) only pages
    and row groups that may hold one are read; 0 ``ranges`` leaves that out.
    """
    k = keys.select(key).distinct()
    if ranges:
        ledger = ledger.where(in_ranges(key, key_ranges(k, key, ranges)))
    hits = semi_lookup(ledger, k, [key], [key])
    sums = hits.groupBy(key).agg(*[F.sum(m).alias(m) for m in measures],
                                 F.max(F.lit(1)).alias("subscribers_found"))
    out = k.join(sums, key, "left")
    return out.select(key, *measures,
                      F.coalesce(F.col("subscribers_found"), F.lit(0)).alias("subscribers_found"))
