"""Report registry: name -> function or SQL statement over the case tables and other reports.

User reports are added with ``register`` (a function) or ``register_sql`` (a statement with names in braces). A report may
read other reports by name, to any depth and registered in any order: what a statement refers to is read from it, what a
function reads is declared (``needs``) for the order and resolved when it asks. Reports that depend on each other raise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from string import Formatter

from pyspark.sql import DataFrame

from mobspark.plans import demographics, finance, repositioning, ridehail, modes, transit
from mobspark.plans.common import Tables

Build = Callable[[Tables, DataFrame], DataFrame]


@dataclass(frozen=True)
class Report:
    name: str
    build: Build
    helper: bool = False
    needs: tuple[str, ...] = ()


def references(statement: str) -> list[str]:
    """Names in braces, each once, in the order in which they appear; doubled braces are plain ones."""
    fields = [field for _, field, _, _ in Formatter().parse(statement) if field is not None]
    for field in fields:
        if not field.isidentifier():
            raise ValueError(f"{{{field}}} is no name of a table or report")
    return list(dict.fromkeys(fields))


class _Resolved(dict):
    """Names as one build sees them: reports of this build first, then the tables given, then other reports."""

    def __init__(self, registry: Registry, t: Tables, params: DataFrame, chosen: Iterable[str]):
        super().__init__()
        self.registry, self.t, self.params, self.chosen = registry, t, params, set(chosen)
        self.open: list[str] = []

    def report(self, name: str) -> DataFrame:
        if name in self.open:
            raise ValueError("reports depend on each other: " + " -> ".join([*self.open[self.open.index(name):], name]))
        if name not in self.keys():
            self.open.append(name)
            self[name] = self.registry[name].build(self, self.params)
            self.open.pop()
        return self[name]

    def __missing__(self, name: str) -> DataFrame:
        # a report that reads a table of its own name means the table
        own = self.open and self.open[-1] == name
        if name in self.chosen and not own:
            return self.report(name)
        try:
            return self.t[name]
        except KeyError:
            if name not in self.registry:
                raise
        return self.report(name)


class Registry:
    def __init__(self, reports: Iterable[Report] = ()):
        self._reports: dict[str, Report] = {r.name: r for r in reports}

    def __contains__(self, name: object) -> bool:
        return name in self._reports

    def __getitem__(self, name: str) -> Report:
        return self._reports[name]

    def register(self, name: str, build: Build, helper: bool = False, needs: Iterable[str] = ()) -> None:
        """``needs``: the reports that ``build`` reads."""
        self._reports[name] = Report(name, build, helper, tuple(needs))

    def register_sql(self, name: str, statement: str, inputs: Iterable[str] = (), helper: bool = False) -> None:
        """``statement`` refers to tables and reports as ``{name}``; ``{case_params}`` is always available.

        ``inputs`` are further names that it should get; those it refers to need not be repeated.
        """
        wanted = list(dict.fromkeys([*references(statement), *inputs]))

        def build(t: Tables, params: DataFrame) -> DataFrame:
            frames = {n: params if n == "case_params" else t[n] for n in wanted}
            return params.sparkSession.sql(statement, **frames)

        self.register(name, build, helper, [n for n in wanted if n != name])

    def names(self) -> list[str]:
        return list(self._reports)

    def helpers_of(self, name: str) -> list[str]:
        """Reports that the given one reads itself."""
        return [n for n in self._reports[name].needs if n in self._reports]

    def needed(self, names: Iterable[str]) -> list[str]:
        """The reports with all that they need, those that are read before those that read them.

        Helpers come first among reports that don't depend on each other, else the order is that of ``names``.
        """
        out: list[str] = []
        open_: list[str] = []

        def visit(name: str) -> None:
            if name in open_:
                raise ValueError("reports depend on each other: " + " -> ".join([*open_[open_.index(name):], name]))
            if name in out:
                return
            open_.append(name)
            for other in self.helpers_of(name):
                visit(other)
            open_.pop()
            out.append(name)

        for name in sorted(names, key=lambda n: not self._reports[n].helper):
            visit(name)
        return out

    def ordered(self, names: Iterable[str] | None = None) -> list[str]:
        """The chosen reports, each after those of them that it reads."""
        chosen = list(names if names is not None else self._reports)
        return [n for n in self.needed(chosen) if n in set(chosen)]

    def build(self, t: Tables, params: DataFrame, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
        """Lazy DataFrames of the chosen reports. A report that several of them read is built once."""
        order = self.ordered(names)
        resolved = _Resolved(self, t, params, order)
        return {name: resolved.report(name) for name in order}


def default_registry() -> Registry:
    """Every per-case report."""
    return Registry([
        Report("tnc_stat_summary_helper", ridehail.tnc_stat_summary_helper, helper=True),
        Report("transit_trip_max_load_helper", transit.transit_trip_max_load_helper, helper=True),
        Report("requests", ridehail.requests_report, helper=True),
        Report("transit_trip_max_load", transit.transit_trip_max_load),
        Report("mode_Distribution_ADULT_Counts", modes.mode_distribution_counts),
        Report("mode_Distribution_ADULT_Distance", modes.mode_distribution_distance),
        Report("mode_Distribution_ADULT", modes.mode_distribution_zones),
        Report("bus_avo", transit.bus_avo),
        Report("pr_avo", ridehail.pr_avo),
        Report("fare_sensitivity_results", ridehail.fare_sensitivity_results),
        Report("distance_tnc_dist", ridehail.distance_tnc_dist),
        Report("fare_sensitivity_results_zonal", ridehail.fare_sensitivity_results_zonal),
        Report("fare_sensitivity_demograpic_tnc_stats", ridehail.demographic_tnc_stats),
        Report("fare_sensitivity_results_vo", lambda t, p: ridehail.vehicle_ownership_stats(t)),
        Report("tnc_results_discount", ridehail.tnc_results_discount),
        Report("elder_demo", lambda t, p: demographics.elder_demo(t)),
        Report("activity_times", lambda t, p: demographics.activity_times(t)),
        Report("closest_stops", lambda t, p: demographics.closest_stops(t)),
        Report("requests_sum", ridehail.requests_sum),
        Report("tnc_skim_demo", ridehail.tnc_skim_demo),
        Report("tnc_stat_summary", ridehail.tnc_stat_summary),
        Report("demo_financial_case_data", finance.demo_financial_case_data),
        Report("repositioning_success_rate", repositioning.repositioning_success_rate),
    ])
