"""Operators against brute force on small hand-made frames (traps T1-T3, T9, T16, T18)."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark import schema as S
from tallyspark.operators import (
    anti_lookup,
    coalesce_sources,
    dedup_keys,
    ledger_project,
    ledger_rollup,
    lookup,
    merge_actions,
    rate_join,
    repeated_keys,
    semi_lookup,
    top_ranked,
    union_all,
    unrated,
)
from tallyspark.operators.totals import key_totals
from tallyspark.sources.scans import latest_snapshot, scan_days, scan_reject


def rows(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


def brute_rank1(data):
    """rank() over (partition by k order by v desc nulls last) = 1, by hand."""
    out = []
    for key in {(d, m) for d, m, _, _ in data}:
        group = [r for r in data if (r[0], r[1]) == key]
        vals = [r[2] for r in group if r[2] is not None]
        top = max(vals) if vals else None
        out += [r for r in group if r[2] == top]
    return Counter(out)


LOC = [("d1", "m1", "L2", "a"), ("d1", "m1", "L2", "b"), ("d1", "m1", "L1", "c"),
       ("d1", "m2", None, "x"), ("d1", "m2", None, "y"), ("d2", "m1", "L0", "z"),
       ("d1", None, "L5", "n"), ("d1", None, "L3", "n")]


@pytest.mark.parametrize("method", ["window", "aggregate"])
def test_top_ranked_keeps_ties_like_rank(spark, method):
    df = spark.createDataFrame(LOC, "d string, m string, lacci string, attr string")
    got = rows(top_ranked(df, ["d", "m"], "lacci", method=method), "d", "m", "lacci", "attr")
    assert got == brute_rank1(LOC)
    # The two tied top rows of (d1, m1) are both kept
    assert got[("d1", "m1", "L2", "a")] == 1 and got[("d1", "m1", "L2", "b")] == 1


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["d1", "d2"]), st.sampled_from(["m1", "m2", None]),
                          st.one_of(st.none(), st.sampled_from(["L0", "L1", "L2"])),
                          st.sampled_from(["a", "b"])), min_size=1, max_size=25))
def test_top_ranked_property(spark, data):
    df = spark.createDataFrame(data, "d string, m string, lacci string, attr string")
    got = rows(top_ranked(df, ["d", "m"], "lacci"), "d", "m", "lacci", "attr")
    assert got == brute_rank1(data)


def test_top_ranked_one_tie_is_deterministic(spark):
    df = spark.createDataFrame(LOC, "d string, m string, lacci string, attr string")
    got = rows(top_ranked(df, ["d", "m"], "lacci", ties="one"), "d", "m", "attr")
    assert got[("d1", "m1", "a")] == 1 and ("d1", "m1", "b") not in got


@pytest.mark.parametrize("spread", [False, True])
def test_lookup_multiplies_on_repeated_keys_and_keeps_null_keys(spark, spread):
    left = spark.createDataFrame([("m1", 10), ("m2", 20), (None, 30)], "msisdn string, amt int")
    right = spark.createDataFrame([("m1", "o1"), ("m1", "o2"), (None, "on")],
                                  "msisdn string, offer string")
    got = rows(lookup(left, right, ["msisdn"], ["msisdn"], spread_null_keys=spread),
               "msisdn", "amt", "offer")
    # Two offers for m1 double its row; null keys never match
    assert got == Counter({("m1", 10, "o1"): 1, ("m1", 10, "o2"): 1, ("m2", 20, None): 1,
                           (None, 30, None): 1})


def test_lookup_on_computed_prefix_keys(spark):
    left = spark.createDataFrame([("A" * 32 + "x",), ("B" * 32 + "y",)], "tid string")
    right = spark.createDataFrame([("A" * 32 + "zz", "7")], "cid string, offer string")
    out = lookup(left, right, [F.substring("tid", 1, 32)], [F.substring("cid", 1, 32)])
    got = rows(out, "tid", "offer")
    assert got == Counter({("A" * 32 + "x", "7"): 1, ("B" * 32 + "y", None): 1})


def test_anti_and_semi_lookup(spark):
    left = spark.createDataFrame([("d", "00000001"), ("d", "00000002"), ("d", None)],
                                 "day string, pid string")
    right = spark.createDataFrame([("d", "1"), ("d", None)], "day string, bid string")
    r = right.select("day", F.lpad("bid", 8, "0").alias("bid"))
    anti = rows(anti_lookup(left, r, ["day", "pid"], ["day", "bid"]), "pid")
    semi = rows(semi_lookup(left, r, ["day", "pid"], ["day", "bid"]), "pid")
    assert anti == Counter({("00000002",): 1, (None,): 1})
    assert semi == Counter({("00000001",): 1})


def test_coalesce_sources_mixes_columns_per_null(spark):
    base = spark.createDataFrame([("d1", "m1"), ("d1", "m2")], "event_date string, msisdn string")
    cur = spark.createDataFrame([("d1", "m1", None, "R1")],
                                "event_date string, msisdn string, lacci_id string, region string")
    fb = spark.createDataFrame([("m1", "LF", "RF"), ("m2", "LG", "RG")],
                               "msisdn string, lacci_id string, region string")
    out = coalesce_sources(base, cur, fb, ["lacci_id", "region"], ["event_date", "msisdn"],
                           ["msisdn"])
    got = rows(out, "msisdn", "lacci_id", "region")
    assert got == Counter({("m1", "LF", "R1"): 1, ("m2", "LG", "RG"): 1})


def test_union_all_keeps_cross_branch_repeats(spark):
    a = spark.createDataFrame([("c1", "7")], "charging_id string, offer_id string")
    b = spark.createDataFrame([("c1", "7")], "charging_id string, offer_id string")
    assert union_all([a, b]).count() == 2  # T3
    assert union_all([a, b], distinct=True).count() == 1


def test_dedup_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "k string, v int")
    assert dedup_keys(df, ["k", "v"]).count() == 2


def test_rate_join_drops_unrated_and_adds_up_repeats(spark):
    df = spark.createDataFrame([("DATA", "ASIA", Decimal("10.00")), ("SMS", "MOON", Decimal("5.00"))],
                               "allowance string, region_sales string, rev decimal(18,2)")
    rates = spark.createDataFrame([("DATA", "ASIA", Decimal("0.1000")),
                                   ("DATA", "ASIA", Decimal("0.2000"))],
                                  "allowance_type string, region string, seized_rate decimal(9,4)")
    out = rate_join(df, rates, "allowance", "region_sales", ("seized_rate",))
    total = out.agg(F.sum(F.col("rev") * F.col("seized_rate"))).first()[0]
    assert total == Decimal("3.000000")  # both rates add up; MOON dropped (T16)
    assert rows(unrated(df, rates, "allowance", "region_sales"), "region_sales") == Counter({("MOON",): 1})


def test_latest_snapshot_and_reject_scan(spark):
    rates = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-02", 3)],
                                  "d string, v int").select(F.col("d").cast("date").alias("event_date"), "v")
    assert sorted(r.v for r in latest_snapshot(rates).collect()) == [2, 3]
    rej = spark.createDataFrame([("2024-02-01", "2024-01-05"), ("2024-02-01", "2023-12-31"),
                                 ("2024-01-05", "2024-01-05")], "e string, t string")
    rej = rej.select(F.col("e").cast("date").alias("event_date"), F.col("t").alias("trx_date"))
    got = scan_reject(rej, "2024-02-01", ("2024-01-01", "2024-01-31")).count()
    assert got == 1
    assert scan_days(rej, ("2024-01-01", "2024-01-31")).count() == 1
    assert scan_days(rej, None).count() == 3


def test_ledger_rollup_groups_varying_keys_and_adds_constants(spark):
    feed = spark.createDataFrame(
        [("2024-01-01", "m1", "1", Decimal("1.50")), ("2024-01-01", "m1", "1", Decimal("2.25")),
         ("2024-01-01", "m2", "x", Decimal("4.00"))],
        "event_date string, msisdn string, flag string, rev decimal(18,2)")
    mapping = {"msisdn": F.col("msisdn"), "pre_post_flag": F.col("flag"),
               "event_date": F.col("event_date"), "load_date": "2024-01-03", "source": "T",
               "area_sales": S.UNKNOWN}
    out = ledger_rollup(feed, mapping, {"rev_per_usage": F.sum("rev"), "trx": F.count(F.lit(1))})
    assert out.columns == S.LEDGER_NAMES
    assert dict(out.dtypes)["rev_per_usage"] == "decimal(38,15)"
    got = {r.msisdn: (r.rev_per_usage, r.trx, r.pre_post_flag, r.rev_seized, r.lac, r.cust_id)
           for r in out.collect()}
    assert got["m1"] == (Decimal("3.75"), 2, 1, Decimal(0), "", None)
    assert got["m2"][2] is None  # junk flag -> null int, not an ANSI error
    projected = ledger_project(feed, mapping, {"rev_per_usage": F.col("rev")})
    assert projected.count() == 3 and projected.columns == S.LEDGER_NAMES


def test_ledger_mapping_rejects_unknown_columns(spark):
    feed = spark.createDataFrame([("a",)], "x string")
    with pytest.raises(KeyError):
        ledger_rollup(feed, {"not_a_column": F.col("x")}, {})


def test_merge_actions_null_unsafe_keys(spark):
    cols = "event_date string, sne string, redeem_state string, v int"
    target = spark.createDataFrame([("d", "1", "3", 1), ("d", "2", "3", 2), (None, "9", "3", 9)], cols)
    source = spark.createDataFrame([("d", "1", "3", 10), ("d", "5", "3", 50), (None, "9", "3", 90)], cols)
    acts = merge_actions(target, source, ["event_date", "sne", "redeem_state"])
    got = rows(acts, "sne", "v", "merge_action")
    # The null-key pair does not match: source inserts, target deletes
    assert got == Counter({("1", 10, "update"): 1, ("5", 50, "insert"): 1, ("9", 90, "insert"): 1,
                           ("2", 2, "delete"): 1, ("9", 9, "delete"): 1})
    # What survives is exactly the source
    kept = acts.where("merge_action != 'delete'").drop("merge_action")
    assert rows(kept, "sne", "v") == rows(source, "sne", "v")


def test_key_totals_counts_found_subscribers_and_dedups_keys(spark):
    ledger = spark.createDataFrame(
        [("m1", Decimal("1.0"), Decimal("0")), ("m1", Decimal("2.0"), Decimal("1")),
         ("m3", Decimal("5.0"), Decimal("0"))],
        "msisdn string, rev_per_usage decimal(38,15), rev_seized decimal(38,15)")
    keys = spark.createDataFrame([("m1",), ("m1",), ("m2",)], "msisdn string")
    got = {r.msisdn: (r.rev_per_usage, r.subscribers_found) for r in key_totals(ledger, keys).collect()}
    assert got == {"m1": (Decimal("3.0"), 1), "m2": (None, 0)}


def test_repeated_keys_reports_multiplying_lookup_keys(spark):
    right = spark.createDataFrame([("d", "m1", "o1"), ("d", "m1", "o2"), ("d", "m2", "o1")],
                                  "event_date string, msisdn string, offer string")
    got = {(r.msisdn, r.rows_per_key) for r in repeated_keys(right, ["event_date", "msisdn"]).collect()}
    assert got == {("m1", 2)}
