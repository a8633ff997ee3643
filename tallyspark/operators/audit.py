"""What a flow drops and multiplies, counted in the flow's own pass.

A flow given an ``Audit`` watches some of its DataFrames: the counts are
gathered by Spark while the rows pass (``Observation``) and are there once
the flow's result has been written; no rows are read a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Audit:
    """Counts of one run, by name."""

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str, condition: Column | None = None) -> DataFrame:
        """``df``, with its rows (those meeting ``condition``) counted under
        ``name``."""
        if name in self._seen:
            raise ValueError(f"{name} is counted already")
        self._seen[name] = Observation(name)
        what = F.count(F.lit(1)) if condition is None else F.count_if(condition)
        return df.observe(self._seen[name], what.alias("n"))

    def counts(self) -> dict[str, int]:
        """The counts; call it after the run's action, for which it waits."""
        return {name: o.get["n"] for name, o in self._seen.items()}

    def report(self) -> dict[str, int]:
        """``counts`` with, for every pair ``x_in`` and ``x_out``, what a
        lookup added by repeated keys as ``x_multiplied``."""
        out = self.counts()
        for name in [n for n in out if n.endswith("_out")]:
            stem = name.removesuffix("_out")
            out[f"{stem}_multiplied"] = out[name] - out[f"{stem}_in"]
        return out


def watched(audit: Audit | None, df: DataFrame, name: str, condition: Column | None = None) -> DataFrame:
    """``audit.watch`` where there is an audit, else ``df``."""
    return df if audit is None else audit.watch(df, name, condition)
