"""End to end: repaired case tables -> stored per-case reports -> dashboard tables."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobspark.operators.joins import attach_case_rows
from mobspark.plans.common import Tables
from mobspark.plans.dashboard import dashboard_tables
from mobspark.plans.repair import LEFT_OVER, cases_with_requests, flagged_requests, flagged_trips, repaired_tables
from mobspark.registry import Registry, default_registry
from mobspark.sources.store import ReportStore, combined, fingerprints, write_csv


class _OnlyCases(dict):
    """Case tables cut down to some folders, table by table on first use."""

    def __init__(self, tables: Tables, folders: DataFrame):
        super().__init__()
        self._tables, self._folders = tables, folders

    def __missing__(self, name: str) -> DataFrame:
        self[name] = attach_case_rows(self._tables[name], self._folders, "left_semi")
        return self[name]


class _Used(dict):
    """Case tables as they are; its keys tell which of them a report asked for."""

    def __init__(self, tables: Tables):
        super().__init__()
        self._tables = tables

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._tables[name]
        return self[name]


class _Inputs:
    """Fingerprints of the inputs by case: raw tables once, stored helper reports as they come."""

    def __init__(self, store: ReportStore, tables: Tables, params: DataFrame, names: Iterable[str]):
        store.replace("_inputs", fingerprints({n: tables[n] for n in names} | {PARAMS: params}))
        self.marks = store.read("_inputs")

    def add(self, name: str, finished: DataFrame) -> None:
        self.marks = self.marks.unionByName(finished.select("folder", F.lit(name).alias("table"), "fingerprint"))

    def of(self, cases: DataFrame, names: Iterable[str]) -> DataFrame:
        return cases.select("folder").distinct().join(combined(self.marks, [*names, PARAMS]), "folder", "left")


PARAMS = "case_params"
#: The repaired table is made from both.
REPAIRED_FROM = {"tnc_trip": ("tnc_trip", "tnc_request"), "tnc_request": ("tnc_request",)}


def run_reports(
    tables: Tables, params: DataFrame, store: ReportStore, names: Iterable[str] | None = None,
    registry: Registry | None = None, force: bool = False, csv_root: str | None = None, skip_bad: bool = False,
) -> Mapping[str, DataFrame]:
    """Compute and store the chosen reports for every case that is new or whose inputs changed; return the stored tables.

    Cases without ride-hail requests are left out. Passengers on repositioning rows are cleared; the repaired tables are
    stored, so that the repair runs once for all reports, and while they are written every row is checked. A case that
    fails the check is left out of everything, and when all others are stored ValueError is raised (not with ``skip_bad``).
    Helper reports are stored before the reports that read them by name. What a report reads, its tables, parameters and
    helpers, is known by fingerprints, so that a changed input recomputes only its case; a changed report needs ``force``.
    With ``csv_root`` every report is also written there as CSV, sorted by case.
    """
    registry = registry or default_registry()
    chosen = list(names if names is not None else registry.names())
    order = registry.needed(chosen)
    done: dict[str, DataFrame] = {}
    cases = attach_case_rows(params.select("folder"), cases_with_requests(tables), "left_semi")

    lazy = repaired_tables(tables)
    used: dict[str, list[str]] = {}
    for name in order:
        asked = _Used(lazy)
        registry.build(asked, params, registry.needed([name]))
        used[name] = sorted(asked)
    raw = {n for asked in used.values() for n in asked}
    inputs = _Inputs(store, tables, params, sorted(raw | {o for n in raw for o in REPAIRED_FROM.get(n, ())}))

    rejected: set[str] = set()
    repaired: dict[str, DataFrame] = {}
    for table, repair in (("tnc_request", flagged_requests), ("tnc_trip", flagged_trips)):
        if table in raw:
            repaired[table] = store.refresh(
                f"_repaired_{table}", inputs.of(cases, REPAIRED_FROM[table]),
                lambda todo, repair=repair: repair(_OnlyCases(tables, todo)), force, F.col(LEFT_OVER), rejected)
    if rejected:
        cases = cases.where(~F.col("folder").isin(*rejected))

    def compute(name: str) -> Callable[[DataFrame], DataFrame]:
        return lambda todo: registry.build(
            _OnlyCases(ChainMap(done, repaired, tables), todo), attach_case_rows(params, todo, "left_semi"), [name])[name]

    for name in order:
        read = [o for n in used[name] for o in REPAIRED_FROM.get(n, (n,))]
        done[name] = store.refresh(name, inputs.of(cases, [*read, *registry.helpers_of(name)]), compute(name), force)
        finished = store.finished(name)
        if finished is not None:
            inputs.add(name, finished)
        if csv_root is not None:
            write_csv(done[name], f"{csv_root.rstrip('/')}/{name}", [c for c in ("folder",) if c in done[name].columns])
    if rejected and not skip_bad:
        raise ValueError(f"repositioning rows still carry passengers in {len(rejected)} cases, of which the first is {min(rejected)}")
    return {name: done[name] for name in order if name in chosen}


def run_dashboard(reports: Mapping[str, DataFrame], zones: DataFrame, store: ReportStore, **options: Any) -> Mapping[str, DataFrame]:
    """Build every dashboard table from stored reports and store it under its name."""
    out = {}
    for name, table in dashboard_tables(reports, zones, **options).items():
        store.replace(name, table)
        out[name] = store.read(name)
    return out
