"""The standard reports by name, and their export.

The two metric views are written once to the shared folder; all reports read them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from ..functions.storage import materialise
from ..operators import bottlenecks, kpis, provenance, quality
from ..operators.sequence import ordered_log
from ..operators.views import case_metrics, transition_metrics
from ..sources.raw import slug
from ..spec import MilestonePatterns


class Views:
    """A log with its metric views, each computed on first use and then kept."""

    def __init__(
        self,
        log: DataFrame,
        patterns: MilestonePatterns = MilestonePatterns(),
        chunks: int | None = None,
    ):
        self.log = log
        self._patterns = patterns
        self._chunks = chunks

    @cached_property
    def ordered(self) -> DataFrame:
        """The log in chunks along case and time: cut once, read by all that need order."""
        return ordered_log(self.log, self._chunks)

    @cached_property
    def paths(self) -> DataFrame:
        return materialise(provenance.case_paths(self.ordered), "paths")

    @cached_property
    def cases(self) -> DataFrame:
        return materialise(
            case_metrics(self.ordered, self._patterns), "case_metrics"
        )

    @cached_property
    def transitions(self) -> DataFrame:
        return materialise(
            transition_metrics(self.ordered), "transition_metrics"
        )

    def register(self) -> None:
        """Temp views, for SQL over the same tables."""
        self.log.createOrReplaceTempView("event_log")
        self.cases.createOrReplaceTempView("case_metrics")
        self.transitions.createOrReplaceTempView("transition_metrics")


@dataclass(frozen=True)
class Report:
    name: str
    group: str
    title: str
    run: Callable[[Views], DataFrame]
    # False for a list that grows with the log: it is exported as many files.
    small: bool = True


REPORTS = [
    Report("kpi_overall", "kpis", "Overall process KPIs", lambda v: kpis.kpi_overall(v.cases)),
    Report("kpi_by_issue_type", "kpis", "Cycle time by issue type", lambda v: kpis.kpi_by(v.cases, "issue_type")),
    Report("kpi_by_variant", "kpis", "Cycle time by variant", lambda v: kpis.kpi_by(v.cases, "variant", wide=True)),
    Report("kpi_by_channel", "kpis", "Cycle time by intake channel", lambda v: kpis.kpi_by(v.cases, "report_channel")),
    Report("escalation_impact", "kpis", "Escalation impact", lambda v: kpis.escalation_impact(v.cases)),
    Report("priority_sla", "kpis", "Cycle time and SLA breach by priority", lambda v: kpis.sla_by(v.cases)),
    Report("time_by_state", "kpis", "Where the elapsed time sits", lambda v: kpis.time_by_state(v.transitions)),
    Report("slowest_cases", "kpis", "The 10 slowest cases", lambda v: kpis.slowest_cases(v.cases)),
    Report("transition_bottlenecks", "bottlenecks", "Transition bottlenecks", lambda v: bottlenecks.transition_bottlenecks(v.transitions, v.log)),
    Report("variant_bottlenecks", "bottlenecks", "Bottlenecks of one variant", lambda v: bottlenecks.variant_bottlenecks(v.transitions)),
    Report("rework_events", "bottlenecks", "Repeated events", lambda v: bottlenecks.rework_events(v.log)),
    Report("escalation_funnel", "bottlenecks", "Escalation funnel", lambda v: bottlenecks.escalation_funnel(v.cases)),
    Report("completeness", "quality", "Completeness by column", lambda v: quality.completeness(v.log)),
    Report("null_events", "quality", "Rows without an event name", lambda v: quality.null_events(v.log), small=False),
    Report("resolver_nulls", "quality", "Resolver nulls by event", lambda v: quality.resolver_nulls(v.log)),
    Report("score_ceiling", "quality", "Score ceiling by variant", lambda v: quality.score_ceiling(v.cases)),
    Report("ordering_defects", "quality", "Out-of-order and negative intervals", lambda v: quality.ordering_defects(v.transitions)),
    Report("path_determinism", "provenance", "Sequences per variant", lambda v: provenance.path_determinism(v.paths)),
    Report("event_count_spread", "provenance", "Event counts within a variant", lambda v: provenance.event_count_spread(v.cases)),
    Report("priority_multiplier", "provenance", "Priority against time per state", lambda v: provenance.priority_multiplier(v.transitions)),
    Report("label_by_variant", "provenance", "Level 3 by variant", lambda v: provenance.label_by_variant(v.cases)),
    Report("outside_variant_set", "provenance", "Cases outside the level-3 variants", lambda v: provenance.outside_variant_set(v.cases)),
    Report("provenance_verdict", "provenance", "Verdict", lambda v: provenance.provenance_verdict(v.paths, v.cases)),
]

GROUPS = list(dict.fromkeys(r.group for r in REPORTS))


def select_reports(names: Iterable[str] | None = None, group: str | None = None) -> list[Report]:
    """Reports of one group, or of the given names, in registry order."""
    wanted = set(names) if names is not None else None
    unknown = (wanted or set()) - {r.name for r in REPORTS}
    if unknown:
        raise KeyError(f"no such report: {sorted(unknown)}")
    if group is not None and group not in GROUPS:
        raise KeyError(f"no such group: {group}")
    return [
        r
        for r in REPORTS
        if (wanted is None or r.name in wanted) and (group is None or r.group == group)
    ]


def export_reports(
    views: Views,
    out: str,
    names: Iterable[str] | None = None,
    group: str | None = None,
    fmt: str = "csv",
) -> dict[str, str]:
    """One folder per report, named after its title; returns name -> path.

    A title that occurs twice gets ``_2``, ``_3`` and so on.  A small report becomes a
    single CSV file in report order.
    """
    taken: dict[str, int] = {}
    paths = {}
    for report in select_reports(names, group):
        name = slug(report.title)
        taken[name] = taken.get(name, 0) + 1
        if taken[name] > 1:
            name = f"{name}_{taken[name]}"
        path = f"{out}/{name}"
        rows = report.run(views)
        if fmt == "csv":
            rows = rows.coalesce(1) if report.small else rows
            rows.write.mode("overwrite").csv(path, header=True)
        else:
            rows.write.mode("overwrite").format(fmt).save(path)
        paths[report.name] = path
    return paths
