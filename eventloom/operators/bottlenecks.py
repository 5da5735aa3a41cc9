"""Where cycle time is lost: transitions, rework, escalation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exact import mean_hours, percent, tidy
from ..functions.quantiles import summarise
from ..spec import FOCUS_VARIANT

HOURS = "duration_hours"
QUANTILES = {"median": 0.5, "p75": 0.75, "p95": 0.95}


def _transition_stats(transitions: DataFrame, all_cases: DataFrame) -> DataFrame:
    """``all_cases`` is one row with the column ``_all``, the percentage's base."""
    rows = summarise(
        transitions,
        ["transition"],
        [
            F.count("*").alias("occurrences"),
            F.countDistinct("case_id").alias("cases"),
            tidy(mean_hours(HOURS), 3).alias("mean_hours"),
            tidy(F.max(HOURS), 3).alias("max_hours"),
        ],
        HOURS,
        QUANTILES,
    )
    return rows.withColumns(
        {
            "case_percentage": percent(F.col("cases"), all_cases.scalar()),
            **{f"{q}_hours": tidy(F.col(q), 3) for q in QUANTILES},
        }
    )


def transition_bottlenecks(transitions: DataFrame, log: DataFrame) -> DataFrame:
    """Percentages are of all cases of the log, with or without transitions."""
    rows = _transition_stats(transitions, log.agg(F.countDistinct("case_id").alias("_all")))
    return rows.select(
        "transition",
        "occurrences",
        "cases",
        "case_percentage",
        "mean_hours",
        "median_hours",
        "p75_hours",
        "p95_hours",
        "max_hours",
    ).orderBy(F.col("mean_hours").desc(), "transition")


def variant_bottlenecks(transitions: DataFrame, variant: str = FOCUS_VARIANT) -> DataFrame:
    """Percentages are of the variant's cases that have a transition."""
    own = transitions.where(F.col("variant") == variant)
    rows = _transition_stats(own, own.agg(F.countDistinct("case_id").alias("_all")))
    return rows.select(
        "transition",
        "cases",
        "case_percentage",
        "occurrences",
        "mean_hours",
        "median_hours",
        "p75_hours",
        "p95_hours",
        "max_hours",
    ).orderBy(F.col("median_hours").desc(), "transition")


def rework_events(
    log: DataFrame, variant: str | None = FOCUS_VARIANT, with_variant: bool = True
) -> DataFrame:
    """How often each event occurs in the cases that have it; NULL is an event here."""
    if variant is not None:
        log = log.where(F.col("variant") == variant)
    group = ["variant", "event"] if with_variant else ["event"]
    per_case = log.groupBy("variant", "case_id", "event").agg(F.count("*").alias("occurrences"))
    return (
        per_case.groupBy(*group)
        .agg(
            F.count("*").alias("cases"),
            F.sum("occurrences").alias("total_occurrences"),
            tidy(F.avg("occurrences"), 2).alias("mean_occurrences"),
            F.max("occurrences").alias("max_occurrences"),
        )
        .orderBy(
            F.col("max_occurrences").desc(),
            F.col("mean_occurrences").desc(),
            F.col("event").asc_nulls_last(),
            *group[:-1],
        )
    )


def escalation_funnel(cases: DataFrame, by: str = "issue_type") -> DataFrame:
    """A case whose flag is NULL counts as an incident but on neither side."""
    hours, up = F.col("cycle_time_hours"), F.col("escalated")
    return (
        cases.groupBy(by)
        .agg(
            F.count("*").alias("incidents"),
            F.count_if("escalated").alias("escalated"),
            percent(F.count_if("escalated"), F.count("*")).alias("escalation_rate_pct"),
            F.count_if("reached_level_3").alias("reached_l3"),
            percent(F.count_if("reached_level_3"), F.count("*")).alias("l3_rate_pct"),
            _mean_where(~up, hours).alias("mean_hours_no_escalation"),
            _mean_where(up, hours).alias("mean_hours_with_escalation"),
        )
        .orderBy(F.col("escalation_rate_pct").desc(), by)
    )


def _mean_where(flag, hours):
    kept = F.when(flag, hours)
    some = F.nullif(F.count(kept), F.lit(0))
    return tidy(F.sum(F.round(kept * 10_000).cast("bigint")) / (some * 1e4), 2)
