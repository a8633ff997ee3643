"""Run parameters shared by the flows.

Arguments are passed as values, never spliced into SQL text (T20).
"""

from __future__ import annotations

from dataclasses import dataclass

from tallyspark.schema import SEIZED_CAP
from tallyspark.sources.scans import Days


@dataclass(frozen=True)
class RunParams:
    # text value written to the ledger ``load_date`` partition
    load_date: str
    # feed partitions to process: None = all (backfill), a day, or (first, last)
    days: Days = None
    # prior-period partition of the fallback location table
    fallback_date: str | None = None
    # purchase month ``yyyy-MM`` whose seized rows the breakage flow reverses
    purchase_month: str | None = None
    # inclusive transaction window of the charge-id offer feeds; None = all
    offer_window: Days = None
    # partition holding today's rejects; None = current_date()
    run_date: str | None = None
    # read only this load of the ledger in the flows that read it back (T7);
    # None keeps the original behaviour: every load of the day counts
    ledger_load_date: str | None = None
    # partitions of the newest loads of the ledger, from its partition list
    # (newest_loads); a day loaded twice then counts once
    ledger_loads: tuple | None = None
    # have a job find them
    newest_ledger_loads: bool = False
    # newest rate snapshot, from the partition list; None: found by a scan
    rate_day: str | None = None
    # seized amounts from here on are outliers and left out (D3)
    seized_cap: int = SEIZED_CAP
    # ledger columns by whose ranges a roll-up's rows lie, for flows whose
    # results are written together without another shuffle; () = no order
    lie_by: tuple[str, ...] = ()
