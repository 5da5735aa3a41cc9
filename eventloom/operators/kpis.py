"""Headline figures per case, by dimension, and where elapsed time sits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import hour_parts, mean_hours, percent, sum_hours, tidy
from ..functions.quantiles import summarise
from ..spec import SLA_HOURS

HOURS = "cycle_time_hours"
MEDIAN = {"median": 0.5}
MEDIAN_P95 = {"median": 0.5, "p95": 0.95}
ALL_QUANTILES = {"median": 0.5, "p75": 0.75, "p95": 0.95}


def _mean(c: str, name: str) -> Column:
    return tidy(F.avg(c), 2).alias(name)


def _cycle(name: str) -> Column:
    return tidy(F.col(name), 2).alias(f"{name}_cycle_hours")


def kpi_overall(cases: DataFrame) -> DataFrame:
    row = summarise(
        cases,
        [],
        [
            F.count("*").alias("incidents"),
            tidy(mean_hours(HOURS), 2).alias("mean_cycle_hours"),
            tidy(F.max(HOURS), 2).alias("max_cycle_hours"),
            _mean("event_count", "mean_events"),
            _mean("unique_resolvers", "mean_resolvers"),
            _mean("customer_satisfaction", "mean_satisfaction"),
        ],
        HOURS,
        ALL_QUANTILES,
    )
    return row.select(
        "incidents",
        "mean_cycle_hours",
        *[_cycle(q) for q in ALL_QUANTILES],
        "max_cycle_hours",
        "mean_events",
        "mean_resolvers",
        "mean_satisfaction",
    )


def kpi_by(cases: DataFrame, by: str | Sequence[str], wide: bool = False) -> DataFrame:
    """Cycle time by one or more dimensions; ``wide`` adds p75 and mean resolvers."""
    by = [by] if isinstance(by, str) else list(by)
    probs = ALL_QUANTILES if wide else MEDIAN_P95
    rows = summarise(
        cases,
        by,
        [
            F.count("*").alias("incidents"),
            tidy(mean_hours(HOURS), 2).alias("mean_cycle_hours"),
            _mean("event_count", "mean_events"),
            _mean("unique_resolvers", "mean_resolvers"),
            _mean("customer_satisfaction", "mean_satisfaction"),
        ],
        HOURS,
        probs,
    )
    return rows.select(
        *by,
        "incidents",
        "mean_cycle_hours",
        *[_cycle(q) for q in probs],
        "mean_events",
        *(["mean_resolvers"] if wide else []),
        "mean_satisfaction",
    ).orderBy(F.col("median_cycle_hours").desc_nulls_first(), *by)


def escalation_impact(cases: DataFrame, flag: str = "escalated") -> DataFrame:
    everything = Window.partitionBy()  # over the few rows of the aggregate
    rows = summarise(
        cases,
        [flag],
        [
            F.count("*").alias("incidents"),
            tidy(mean_hours(HOURS), 2).alias("mean_cycle_hours"),
            _mean("customer_satisfaction", "mean_satisfaction"),
        ],
        HOURS,
        MEDIAN,
    )
    return rows.select(
        flag,
        "incidents",
        percent(F.col("incidents"), F.sum("incidents").over(everything)).alias("pct_of_incidents"),
        "mean_cycle_hours",
        _cycle("median"),
        "mean_satisfaction",
    ).orderBy(F.col(flag).asc_nulls_last())


def sla_by(cases: DataFrame, by: str = "priority", hours: float = SLA_HOURS) -> DataFrame:
    """The limit is tested on the four-decimal hours, not on the raw seconds."""
    name = f"pct_over_{hours:g}h"
    rows = summarise(
        cases,
        [by],
        [
            F.count("*").alias("incidents"),
            tidy(mean_hours(HOURS), 2).alias("mean_cycle_hours"),
            percent(F.count_if(F.col(HOURS) > hours), F.count("*")).alias(name),
            _mean("customer_satisfaction", "mean_satisfaction"),
        ],
        HOURS,
        MEDIAN,
    )
    return rows.select(
        by, "incidents", "mean_cycle_hours", _cycle("median"), name, "mean_satisfaction"
    ).orderBy(F.col("mean_cycle_hours").desc_nulls_first(), by)


def time_by_state(transitions: DataFrame) -> DataFrame:
    everything = Window.partitionBy()
    states = transitions.groupBy("from_event").agg(
        F.sum(hour_parts("duration_hours")).alias("_parts"),
        tidy(mean_hours("duration_hours"), 3).alias("mean_hours"),
        F.countDistinct("case_id").alias("cases"),
    )
    return states.select(
        "from_event",
        tidy(F.col("_parts") / 1e4, 0).alias("total_hours"),
        percent(F.col("_parts"), F.nullif(F.sum("_parts").over(everything), F.lit(0)), 1).alias(
            "pct_of_all_time"
        ),
        "mean_hours",
        "cases",
    ).orderBy(F.col("total_hours").desc(), "from_event")


def slowest_cases(cases: DataFrame, n: int = 10) -> DataFrame:
    return (
        cases.orderBy(F.col("cycle_time_seconds").desc(), "case_id")
        .limit(n)
        .select(
            "case_id",
            "variant",
            "issue_type",
            "priority",
            "event_count",
            tidy(F.col(HOURS), 2).alias(HOURS),
            tidy(F.col("max_step_seconds") / 3600.0, 2).alias("worst_step_hours"),
            "customer_satisfaction",
        )
    )
