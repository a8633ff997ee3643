"""Ledger projection (P1-P3, P9) and the wide roll-up.

A flow describes itself as a *mapping*: ledger column -> Column expression
over the feed, or a Python constant.  Unmapped key columns take the
type default (``''`` for text, null otherwise).  Constants never enter the
``GROUP BY``: they are added after the aggregate, so the shuffle key only
carries the columns that actually vary.
"""

from __future__ import annotations

from decimal import Decimal
from typing import Mapping, Sequence, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import schema as S

Value = Union[Column, str, int, float, Decimal, None]


def _is_const(value: Value) -> bool:
    return not isinstance(value, Column)


def _typed(value: Value, type_name: str) -> Column:
    if _is_const(value):
        return F.lit(value).cast(type_name)
    if type_name == "string":
        return value.cast("string")
    # Text ids and flags land in int/date columns: junk becomes null, as the
    # original positional inserts did, instead of failing the batch.
    return value.try_cast(type_name)


def _default(name: str) -> Value:
    return "" if S.LEDGER_TYPES[name] == "string" else None


def _key_values(mapping: Mapping[str, Value]) -> dict[str, Value]:
    unknown = set(mapping) - set(S.LEDGER_NAMES)
    if unknown:
        raise KeyError(f"not ledger columns: {sorted(unknown)}")
    return {n: mapping.get(n, _default(n)) for n in S.LEDGER_KEYS}


def ledger_project(df: DataFrame, mapping: Mapping[str, Value],
                   measures: Mapping[str, Value]) -> DataFrame:
    """Row-level projection of any feed onto the 57 ledger columns, in order."""
    keys = _key_values(mapping)
    cols = []
    for name in S.LEDGER_NAMES:
        t = S.LEDGER_TYPES[name]
        if name in S.LEDGER_MEASURES:
            value = measures.get(name, 0)
            cols.append(_typed(value, t).alias(name) if _is_const(value)
                        else value.cast(t).alias(name))
        else:
            cols.append(_typed(keys[name], t).alias(name))
    return df.select(*cols)


def ledger_rollup(df: DataFrame, mapping: Mapping[str, Value],
                  measures: Mapping[str, Value], lie_by: Sequence[str] = ()) -> DataFrame:
    """``GROUP BY`` every non-measure ledger column, aggregate the measures.

    ``measures`` maps a measure to an aggregate Column (``F.sum(...)``) or a
    constant (``0``), which is added after the group like ``sum(0)``.
    The aggregate is a partial + final hash aggregate: repeated keys are
    combined on the map side before the shuffle, so a hot subscriber or tag
    cannot flood one reducer with raw rows.

    ``lie_by``: key columns by whose ranges the rows are dealt instead.  The
    groups are then made where their rows lie, and the result, in ranges of
    these columns, can be written by the first of them without another
    shuffle.  Rows are not combined before this one; give enough columns that
    no value of all of them is frequent.
    """
    keys = _key_values(mapping)
    varying = [n for n in S.LEDGER_KEYS if not _is_const(keys[n])]
    ranges = [_typed(keys[n], S.LEDGER_TYPES[n]) for n in lie_by if n in varying]
    if ranges:
        df = df.repartitionByRange(*ranges)
    aggs = [v.alias(m) for m, v in measures.items() if not _is_const(v)]
    if not aggs:
        aggs = [F.count(F.lit(1)).alias("__rows")]
    grouped = df.groupBy(*[_typed(keys[n], S.LEDGER_TYPES[n]).alias(n) for n in varying]).agg(*aggs)
    cols = []
    for name in S.LEDGER_NAMES:
        t = S.LEDGER_TYPES[name]
        if name in S.LEDGER_MEASURES:
            value = measures.get(name, 0)
            cols.append(_typed(value, t).alias(name) if _is_const(value)
                        else F.col(name).cast(t).alias(name))
        elif name in varying:
            cols.append(F.col(name))
        else:
            cols.append(_typed(keys[name], t).alias(name))
    return grouped.select(*cols)
