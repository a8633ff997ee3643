"""Command-line batch jobs: one flow per run, tables named by the caller.

    python -m tallyspark.plans.jobs charge --load-date 2025-04-03 --event-date 2025-04-01 \\
        --input feed=db.usage_charges --target db.ledger

Inputs and targets are catalog table names or parquet paths (anything with a
``/`` or ``:``).  Ledger jobs replace their own ``(load_date, event_date,
source)`` partitions of the target, those that received no rows this time
included; stage jobs replace ``event_date`` partitions; ``promote`` moves a
staged table into its target; ``merge`` makes a target equal to its source;
``lookup`` writes the totals of every subscriber of a key list.

A run names what it does: days by ``--event-date``, by ``--first-date`` with
``--last-date`` or by ``--all-days``, and a ``--target`` or, to look at a few
rows only, ``--preview N``.  Half-given or missing arguments are errors.

The session is the caller's (``spark-submit`` or ``build_session``); job
arguments are passed as values, never spliced into SQL text.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import dataclass, replace
from datetime import date, timedelta
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyspark import schema as S
from tallyspark.operators import key_totals, merge_full_sync, overwrite_partitions, promote
from tallyspark.operators.audit import Audit
from tallyspark.operators.sinks import ensure_table, refresh
from tallyspark.plans import flows
from tallyspark.plans.params import RunParams
from tallyspark.sources.scans import key_list, newest_loads, newest_partition
from tallyspark.sources.store import is_path


@dataclass(frozen=True)
class JobSpec:
    run: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    partitions: tuple[str, ...]
    doc: str
    # ledger tags the job writes
    tags: tuple[str, ...] = ()
    # arguments of RunParams it cannot do without
    needs: tuple[str, ...] = ()
    # days between a feed day and the ledger day it is written under
    shift: int = 0


def _offers(i: dict[str, DataFrame], p: RunParams) -> DataFrame:
    return flows.offers_by_charge_id(i["usage_offers"], i["usage_rejects"], i["voucher_offers"],
                                     i["voucher_rejects"], i["recharge_offers"],
                                     i["recharge_rejects"], p)


JOBS: dict[str, JobSpec] = {
    "charge": JobSpec(lambda i, p, a: flows.flow_charge(i["feed"], p), ("feed",),
                      S.LEDGER_PARTITIONS, "usage charges -> ledger CHG", (S.TAG_CHG,)),
    "expiry": JobSpec(lambda i, p, a: flows.flow_expiry(i["feed"], p), ("feed",),
                      S.LEDGER_PARTITIONS, "expiry-dated value -> ledger PI", (S.TAG_PI,)),
    "seized": JobSpec(lambda i, p, a: flows.flow_seized(i["feed"], p, a), ("feed",),
                      S.LEDGER_PARTITIONS, "seized balance -> ledger SEIZED", (S.TAG_SEIZED,)),
    "quota": JobSpec(lambda i, p, a: flows.flow_upcc(i["feed"], p), ("feed",),
                     S.LEDGER_PARTITIONS, "quota usage -> ledger UPCC-SEIZED / UPCC_USAGE", (S.TAG_UPCC_SEIZED, S.TAG_UPCC_USAGE)),
    "accrual": JobSpec(lambda i, p, a: flows.flow_accrual(i["feed"], p), ("feed",),
                       S.LEDGER_PARTITIONS, "daily accrual -> ledger ACCRUAL", (S.TAG_ACCRUAL,), shift=-1),
    "overusage": JobSpec(lambda i, p, a: flows.flow_overusage(i["feed"], p), ("feed",),
                         S.LEDGER_PARTITIONS, "over-usage -> ledger OVERUSAGE", (S.TAG_OVERUSAGE,)),
    "unmatched": JobSpec(lambda i, p, a: flows.flow_unmatched(i["billing"], i["catalogue"], p),
                         ("billing", "catalogue"), S.LEDGER_PARTITIONS,
                         "billed charges not in the catalogue -> ledger PAYU", (S.TAG_PAYU,)),
    "late_match": JobSpec(lambda i, p, a: flows.flow_late_match(i["billing"], i["catalogue"],
                                                             i["ledger"], p),
                          ("billing", "catalogue", "ledger"), S.LEDGER_PARTITIONS,
                          "catalogued digital charges not yet recognised -> ledger WISDOM-NBP", (S.TAG_WISDOM_NBP,)),
    "package_stage": JobSpec(lambda i, p, a: flows.flow_stage(i["charges"], i["profile"],
                                                           i["location_current"],
                                                           i["location_fallback"], p, a),
                             ("charges", "profile", "location_current", "location_fallback"),
                             ("event_date",), "package-charge stage", needs=("fallback_date",)),
    "package": JobSpec(lambda i, p, a: flows.flow_package(i["stage"], i["subscriber_offers"],
                                                       _offers(i, p), p, a),
                       ("stage", "subscriber_offers", "usage_offers", "usage_rejects",
                        "voucher_offers", "voucher_rejects", "recharge_offers",
                        "recharge_rejects"), S.LEDGER_PARTITIONS,
                       "package-charge stage -> ledger WISDOM", (S.TAG_WISDOM,)),
    "breakage_stage": JobSpec(lambda i, p, a: flows.flow_breakage_stage(
        i["charges"], i["profile"], i["location_current"], i["location_fallback"],
        i["rates"], p, a),
        ("charges", "profile", "location_current", "location_fallback", "rates"),
        ("event_date",), "breakage stage", needs=("fallback_date",)),
    "breakage": JobSpec(lambda i, p, a: flows.flow_breakage(i["stage"], i["ledger"], i["billing"],
                                                         i["rates"], p, a),
                        ("stage", "ledger", "billing", "rates"), S.LEDGER_PARTITIONS,
                        "breakage -> ledger BREAKAGE / BREAKAGE-SEIZED", (S.TAG_BREAKAGE, S.TAG_BREAKAGE_SEIZED),
                        needs=("purchase_month",)),
}


def read_input(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(name) if is_path(name) else spark.table(name)


def run_job(spark: SparkSession, job: str, inputs: dict[str, str], target: str | None,
            params: RunParams, audit: Audit | None = None) -> DataFrame:
    """Run one flow; write it to ``target`` when given, and return it.

    The newest rate snapshot and, with ``newest_ledger_loads``, the newest
    load of each day of the ledger come from the inputs' partition lists.  A
    catalog target that does not exist is created; one of another layout is
    refused.  What the flow drops and multiplies is counted in ``audit``.
    """
    spec = JOBS[job]
    missing = [r for r in spec.inputs if r not in inputs]
    missing += [n for n in spec.needs if getattr(params, n) is None]
    if spec.tags and params.load_date is None:
        missing.append("load_date")
    if missing:
        raise ValueError(f"job {job} needs {missing}")
    frames = {role: read_input(spark, inputs[role]) for role in spec.inputs}
    if "rates" in inputs and params.rate_day is None:
        params = replace(params, rate_day=newest_partition(spark, inputs["rates"]))
    if "ledger" in spec.inputs and params.newest_ledger_loads:
        params = replace(params, ledger_loads=tuple(newest_loads(spark, inputs["ledger"])))
    out = spec.run(frames, params, audit)
    if target:
        one_day = isinstance(params.days, str)
        cluster = ("msisdn",) if spec.tags else ()
        if not is_path(target):
            ensure_table(spark, target, out.schema, spec.partitions, cluster)
        overwrite_partitions(out, target, spec.partitions, "rows" if one_day else "partitions",
                             owned_partitions(spec, params), cluster)
        refresh(spark, target)
    return out


def owned_partitions(spec: JobSpec, params: RunParams) -> list[dict] | None:
    """The partitions a run over named days owns, rows or none; None for a
    back-fill of all days, which cannot name them."""
    if params.days is None:
        return None
    first, last = (params.days, params.days) if isinstance(params.days, str) else params.days
    first, last = date.fromisoformat(first), date.fromisoformat(last)
    days = [str(first + timedelta(days=k + spec.shift)) for k in range((last - first).days + 1)]
    if not spec.tags:
        return [{"event_date": d} for d in days]
    return [{"load_date": params.load_date, "event_date": d, "source": t} for d in days for t in spec.tags]


def _pairs(values: Sequence[str]) -> dict[str, str]:
    out = {}
    for v in values:
        role, _, name = v.partition("=")
        if not name:
            raise ValueError(f"--input needs role=table, got {v!r}")
        out[role] = name
    return out


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tallyspark.plans.jobs")
    ap.add_argument("job", choices=[*JOBS, "promote", "merge", "lookup"])
    ap.add_argument("--load-date")
    ap.add_argument("--event-date", help="one feed day")
    ap.add_argument("--first-date", help="with --last-date: a day range instead of one day")
    ap.add_argument("--last-date")
    ap.add_argument("--all-days", action="store_true", help="back-fill every partition")
    ap.add_argument("--fallback-date", help="prior-period location partition")
    ap.add_argument("--purchase-month", help="yyyy-MM reversed by the breakage job")
    ap.add_argument("--offer-first-date", help="first day of the charge-id offers (package)")
    ap.add_argument("--offer-last-date")
    ap.add_argument("--all-offers", action="store_true", help="read all history of the offer feeds")
    ap.add_argument("--run-date", help="partition holding today's rejects (default: today)")
    ap.add_argument("--ledger-load-date")
    ap.add_argument("--newest-ledger-loads", action="store_true", help="count only the newest load of each ledger day and tag")
    ap.add_argument("--input", action="append", default=[], help="role=table-or-path")
    ap.add_argument("--target")
    ap.add_argument("--preview", type=int, help="show so many rows instead of writing")
    ap.add_argument("--partition", action="append", default=[], help="promote, merge: partition column")
    ap.add_argument("--key", action="append", default=[], help="merge: key column")
    ap.add_argument("--clear-source", action="store_true")
    ap.add_argument("--keys", help="lookup: key-list text file")
    ap.add_argument("--hive", action="store_true", help="use the cluster's metastore")
    a = ap.parse_args(argv)
    try:
        inputs = _pairs(a.input)
        params = run_params(a) if a.job in JOBS else None
        _check(a, inputs)
    except ValueError as e:
        ap.error(str(e))
    if spark is None:
        from tallyspark.session import build_session
        spark = build_session(app_name=f"tallyspark-{a.job}", hive=a.hive)
    if a.job == "promote":
        promote(spark, inputs["source"], a.target, a.partition, clear_source=a.clear_source)
        return 0
    if a.job == "merge":
        print(merge_full_sync(spark, inputs["source"], a.target, a.key, a.partition,
                              clear_source=a.clear_source))
        return 0
    if a.job == "lookup":
        out = key_totals(read_input(spark, inputs["ledger"]), key_list(spark, a.keys))
        if a.target and is_path(a.target):
            out.write.mode("overwrite").parquet(a.target)
        elif a.target:
            out.write.mode("overwrite").saveAsTable(a.target)
    else:
        audit = Audit()
        out = run_job(spark, a.job, inputs, a.target, params, audit)
        if a.target:
            print(json.dumps(audit.report()))
    if a.preview:
        out.show(a.preview, False)
    return 0


def run_params(a: argparse.Namespace) -> RunParams:
    """The run's parameters; ValueError where arguments are missing, half
    given or contradict each other."""
    spec = JOBS[a.job]
    span = _both(a.first_date, a.last_date, "--first-date and --last-date")
    offers = _both(a.offer_first_date, a.offer_last_date, "--offer-first-date and --offer-last-date")
    day = a.event_date
    if a.job == "accrual" and not span and not a.all_days:
        if not a.load_date:
            raise ValueError("accrual needs --load-date, from which its day follows")
        # whatever --event-date says, the day is the one before the load
        day = flows.accrual_days(a.load_date)
    if sum(map(bool, (day, span, a.all_days))) != 1:
        raise ValueError("name the days: --event-date, --first-date with --last-date, or --all-days")
    if a.job == "package" and bool(offers) == a.all_offers:
        raise ValueError("package needs --offer-first-date with --offer-last-date, or --all-offers")
    if spec.tags and not a.load_date:
        raise ValueError(f"{a.job} needs --load-date")
    for name in spec.needs:
        if getattr(a, name) is None:
            raise ValueError(f"{a.job} needs --{name.replace('_', '-')}")
    return RunParams(load_date=a.load_date, days=day or span, fallback_date=a.fallback_date,
                     purchase_month=a.purchase_month, offer_window=offers,
                     run_date=a.run_date, ledger_load_date=a.ledger_load_date,
                     newest_ledger_loads=a.newest_ledger_loads)


def _both(first: str | None, last: str | None, names: str) -> tuple[str, str] | None:
    if bool(first) != bool(last):
        raise ValueError(f"{names} go together")
    return (first, last) if first and last else None


def _check(a: argparse.Namespace, inputs: dict[str, str]) -> None:
    spec = JOBS.get(a.job)
    roles = spec.inputs if spec else ("ledger",) if a.job == "lookup" else ("source",)
    missing = [f"--input {r}=" for r in roles if r not in inputs]
    if a.job in ("promote", "merge"):
        missing += [] if a.target else ["--target"]
        missing += ["--partition"] if a.job == "promote" and not a.partition else []
        missing += ["--key"] if a.job == "merge" and not a.key else []
    elif not a.target and not a.preview:
        missing.append("--target (or --preview)")
    if a.job == "lookup" and not a.keys:
        missing.append("--keys")
    if missing:
        raise ValueError(f"{a.job} needs {', '.join(missing)}")


if __name__ == "__main__":
    sys.exit(main())
