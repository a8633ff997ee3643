"""Column helpers: each returns a built-in Spark Column expression.

All of them stay inside whole-stage codegen (no Python UDFs).  Parsing
helpers use ``try_cast`` / ``get`` exactly where the original jobs relied on
legacy null-on-error behaviour, so the session can keep ANSI mode on.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark import schema as S


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def unknown_if_blank(col: str | Column, unknown: str = S.UNKNOWN) -> Column:
    """Null or exactly-empty text becomes ``unknown``; blanks are not trimmed."""
    c = _c(col)
    return F.when(c.isNull() | (c == F.lit("")), F.lit(unknown)).otherwise(c)


def classify_patterns(col: str | Column,
                      patterns=S.ALLOWANCE_PATTERNS,
                      default: str = S.ALLOWANCE_DEFAULT) -> Column:
    """First-match classification of free text by upper-cased substrings.

    ``patterns`` is ``((label, (needle, ...)), ...)``; null text falls to
    ``default`` like every other non-match.
    """
    up = F.upper(_c(col))
    expr = None
    for label, needles in patterns:
        cond = None
        for needle in needles:
            hit = up.contains(needle)
            cond = hit if cond is None else (cond | hit)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def stamp_to_day_text(col: str | Column) -> Column:
    """``yyyyMMdd...`` text stamp -> ``yyyy-MM-dd`` text (null in, null out)."""
    c = _c(col)
    return F.concat(F.substring(c, 1, 4), F.lit("-"), F.substring(c, 5, 2),
                    F.lit("-"), F.substring(c, 7, 2))


def to_int(col: str | Column) -> Column:
    """Text id -> int; blank or junk text gives null instead of an ANSI error."""
    return _c(col).try_cast("int")


def equals_one(col: str | Column) -> Column:
    """Text that reads as the integer 1 (F1b), with a form of it that scans
    can push down: whatever casts to 1 contains the digit."""
    return _c(col).contains("1") & (to_int(col) == 1)


def nth_token(col: str | Column, index: int, delimiter_regex: str = "[$]",
              default: str | None = "0") -> Column:
    """Zero-based token of a delimited string; out of range gives ``default``."""
    token = F.get(F.split(_c(col), delimiter_regex), index)
    return F.coalesce(token, F.lit(default)) if default is not None else token


def prefix(col: str | Column, length: int) -> Column:
    """First ``length`` characters (the computed join key of prefix joins)."""
    return F.substring(_c(col), 1, length)


def padded_id(col: str | Column, width: int = 8, pad: str = "0") -> Column:
    """Left-pad to ``width``; longer ids are cut to ``width`` like SQL lpad."""
    return F.lpad(_c(col).cast("string"), width, pad)


def hex_epoch_millis(col: str | Column, start: int = 3, length: int = 11) -> Column:
    """Epoch milliseconds hidden as hex in characters ``start..start+length-1``.

    Ids whose hex field starts with ``000`` carry epoch *seconds* and are
    scaled by 1000; the others already carry milliseconds.
    """
    field = F.substring(_c(col), start, length)
    value = F.conv(field, 16, 10).try_cast("bigint")
    return F.when(F.substring(field, 1, 3) == F.lit("000"), value * F.lit(1000)).otherwise(value)


def hex_epoch_day(col: str | Column, tz: str = S.ACCRUAL_TIMEZONE) -> Column:
    """Local calendar day (``yyyy-MM-dd`` text) of the epoch hidden in an id.

    The UTC wall clock is built as a ``timestamp_ntz`` from whole days and
    seconds of the epoch, then moved to ``tz`` with ``convert_timezone``, so
    the result does not depend on the session time zone.
    """
    secs = F.floor(hex_epoch_millis(col) / F.lit(1000))
    days = F.floor(secs / F.lit(86400))
    utc = (F.date_from_unix_date(days.cast("int")).cast("timestamp_ntz")
           + F.make_dt_interval(secs=(secs - days * F.lit(86400)).cast("decimal(18,6)")))
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)
    return F.date_format(local, "yyyy-MM-dd")


def day_shift(col: str | Column, days: int) -> Column:
    """Calendar day shift of a date (or date text)."""
    return F.date_add(_c(col).try_cast("date"), days)


def tax_net(col: str | Column, divisor: str = S.TAX_DIVISOR) -> Column:
    """Amount net of tax: ``amount / divisor`` as an exact decimal division."""
    return _c(col) / F.lit(Decimal(divisor))


def null_default_not_equal(col: str | Column, value: str,
                           null_default: str = S.NULL_BRAND_DEFAULT) -> Column:
    """Case-folded inequality that treats null as ``null_default`` (kept)."""
    return F.coalesce(F.lower(_c(col)), F.lit(null_default)) != F.lit(value)


def not_like_folded(col: str | Column, pattern: str) -> Column:
    """``lower(col) NOT LIKE pattern``; null rows drop like in SQL."""
    return ~F.lower(_c(col)).like(pattern)


def present_flag(col: str | Column) -> Column:
    """1 when the value is present, else 0.

    Replaces ``count(distinct id)`` when ``id`` is itself a group key: the
    distinct count is then 0 or 1, and a plain max avoids the extra
    aggregation phases a distinct count plans.
    """
    return F.when(_c(col).isNotNull(), F.lit(1)).otherwise(F.lit(0))
