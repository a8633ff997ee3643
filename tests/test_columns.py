"""Column helpers, with the null / blank / junk cases the feeds carry."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tallyspark.functions import (
    classify_patterns,
    day_shift,
    hex_epoch_day,
    hex_epoch_millis,
    not_like_folded,
    nth_token,
    null_default_not_equal,
    padded_id,
    stamp_to_day_text,
    tax_net,
    to_int,
    unknown_if_blank,
)


def one_col(spark, values, expr, type_name="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {type_name}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_unknown_if_blank_tests_null_and_exact_empty_only(spark):
    assert one_col(spark, [None, "", " ", "A"], unknown_if_blank) == ["UNKNOWN", "UNKNOWN", " ", "A"]


def test_classify_first_match_wins_and_null_is_nonusage(spark):
    got = one_col(spark, ["Data SMS", "upcc voice", "sms", "Voice", "other", None],
                  classify_patterns)
    assert got == ["DATA", "DATA", "SMS", "VOICE", "NONUSAGE", "NONUSAGE"]


def test_stamp_to_day_text_propagates_null(spark):
    assert one_col(spark, ["20250401123000", None], stamp_to_day_text) == ["2025-04-01", None]


def test_to_int_gives_null_for_blank_and_junk_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") in ("true", None)
    assert one_col(spark, ["12", "", "x1", None], to_int) == [12, None, None, None]


def test_nth_token_defaults_when_out_of_range(spark):
    tokens = "$".join(f"p{i}" for i in range(12))
    got = one_col(spark, [tokens, "a$b", None], lambda c: nth_token(c, 9))
    assert got == ["p9", "0", "0"]


def test_padded_id_pads_and_cuts(spark):
    assert one_col(spark, ["123", "123456789"], padded_id) == ["00000123", "12345678"]


def test_hex_epoch_both_shapes_give_the_same_local_day(spark):
    # seconds shape (hex field starts with 000) and milliseconds shape
    ids = ["AB00067EB2A80XYZ", "AB195F0BE2200XYZ"]
    days = one_col(spark, ids, hex_epoch_day)
    assert days == ["2025-04-01", "2025-04-01"]
    ms = one_col(spark, ids, hex_epoch_millis)
    assert ms[0] == int("67EB2A80", 16) * 1000
    assert ms[1] == int("195F0BE2200", 16)


def test_hex_epoch_day_is_independent_of_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        day = one_col(spark, ["AB00067EB2A80XYZ"], hex_epoch_day)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert day == ["2025-04-01"]


def test_day_shift_on_text_dates(spark):
    got = one_col(spark, ["2025-04-01"], lambda c: day_shift(c, -1))
    assert str(got[0]) == "2025-03-31"


def test_null_default_not_equal_keeps_null_brand(spark):
    df = spark.createDataFrame([("KartuHalo",), (None,), ("simPATI",)], "b string")
    kept = [r.b for r in df.where(null_default_not_equal("b", "kartuhalo")).collect()]
    assert kept == [None, "simPATI"]


def test_not_like_folded_drops_null_rows(spark):
    df = spark.createDataFrame([("Phonebook Cloud Backup",), (None,), ("Music",)], "l string")
    kept = [r.l for r in df.where(not_like_folded("l", "phonebook%backup")).collect()]
    assert kept == ["Music"]


def test_tax_net_is_an_exact_decimal_division(spark):
    df = spark.createDataFrame([(Decimal("111.00"),)], "r decimal(18,2)")
    row = df.select(tax_net("r").alias("n")).first()
    assert row.n == Decimal("100.000000")
