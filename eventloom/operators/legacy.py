"""Superseded analyses, kept because their results are still compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import any_true, matches, micros_between, tidy
from ..functions.quantiles import exact_quantiles, summarise
from ..spec import FOCUS_VARIANT
from .bottlenecks import rework_events, variant_bottlenecks
from .sequence import chunked, with_neighbours

SECOND = 1e6


def backward_bottlenecks(
    log: DataFrame, n: int | None = 3, chunks: int | None = None
) -> DataFrame:
    """Charges a wait to the event after it: the opposite of ``transition_metrics``."""
    steps = with_neighbours(
        chunked(log, ["case_id", "event_timestamp", "event_id", "event"], chunks=chunks),
        before=["event_timestamp"],
    ).where(F.col("prev_event_timestamp").isNotNull())
    wait = micros_between("prev_event_timestamp", "event_timestamp")
    ranked = (
        steps.groupBy(F.col("event").alias("bottleneck_event"))
        .agg(
            tidy(F.sum(wait) / F.count("*") / SECOND, 2).alias("average_duration_seconds"),
            F.count("*").alias("event_count"),
        )
        .orderBy(F.col("average_duration_seconds").desc(), "bottleneck_event")
    )
    return ranked if n is None else ranked.limit(n)


def _case_cycles(log: DataFrame) -> DataFrame:
    """Every event is a step; the mean is over the gaps between them.

    The gaps of a case add up to its cycle time, so no window is needed.
    """
    cases = log.groupBy("case_id", "issue_type").agg(
        F.min("event_timestamp").alias("_from"),
        F.max("event_timestamp").alias("_to"),
        F.count("*").alias("total_steps"),
    )
    cycle = micros_between("_from", "_to")
    gaps = F.nullif(F.col("total_steps") - 1, F.lit(0))
    return cases.select(
        F.col("case_id").alias("incident_id"),
        "issue_type",
        (cycle / SECOND).alias("total_cycle_time_seconds"),
        tidy(cycle / gaps / SECOND, 2).alias("average_step_duration_seconds"),
        "total_steps",
    )


def legacy_case_cycle(log: DataFrame, n: int | None = 10) -> DataFrame:
    rows = _case_cycles(log).orderBy(F.col("total_cycle_time_seconds").desc(), "incident_id")
    return rows if n is None else rows.limit(n)


def legacy_step_kpis(log: DataFrame) -> DataFrame:
    cycle, step = "total_cycle_time_seconds", "average_step_duration_seconds"
    hundredths = F.round(F.col(step) * 100).cast("bigint")
    micros = F.round(F.col(cycle) * SECOND).cast("bigint")
    return (
        _case_cycles(log)
        .groupBy("issue_type")
        .agg(
            tidy(F.sum(micros) / F.count("*") / SECOND, 2).alias("average_total_cycle_seconds"),
            tidy(F.sum(hundredths) / F.count(step) / 100, 2).alias("avg_step_duration_seconds"),
            tidy(F.avg("total_steps"), 2).alias("avg_total_steps"),
            tidy(F.max(cycle), 2).alias("max_cycle_seconds"),
        )
        .orderBy(F.col("average_total_cycle_seconds").desc(), "issue_type")
    )


def involvement_flag(log: DataFrame, pattern: str = "%level 2%", name: str = "level_2_involvement") -> DataFrame:
    return log.groupBy("case_id").agg(any_true(matches("event", pattern)).alias(name))


DURATION = "duration_hours"


def _performance(case_table: DataFrame, by: list[str], probs: dict[str, float], means: dict[str, str]) -> DataFrame:
    """Figures are not rounded; cases without a variant or duration are left out."""
    usable = case_table.na.drop(subset=[DURATION, "variant"])
    # Durations are sums of microseconds, so the mean does not depend on row order.
    micros = F.round(F.col(DURATION) * 3.6e9).cast("bigint")
    return summarise(
        usable,
        by,
        [
            F.countDistinct("case_id").alias("incidents"),
            (F.sum(micros) / F.count("*") / 3.6e9).alias("mean_duration_hours"),
            *[F.avg(c).alias(name) for name, c in means.items()],
        ],
        DURATION,
        {f"{q}_duration_hours": p for q, p in probs.items()},
    )


def variant_performance(case_table: DataFrame) -> DataFrame:
    rows = _performance(
        case_table,
        ["variant"],
        {"median": 0.5, "p75": 0.75, "p95": 0.95},
        {
            "mean_events": "event_count",
            "mean_unique_events": "unique_events",
            "mean_unique_resolvers": "unique_resolvers",
            "mean_satisfaction": "customer_satisfaction",
        },
    )
    usable = case_table.na.drop(subset=[DURATION, "variant"])
    median = exact_quantiles(usable, ["variant"], "event_count", {"median_events": 0.5})
    return (
        rows.join(median, "variant")
        .select(
            "variant",
            "incidents",
            "mean_duration_hours",
            "median_duration_hours",
            "p75_duration_hours",
            "p95_duration_hours",
            "mean_events",
            "median_events",
            "mean_unique_events",
            "mean_unique_resolvers",
            "mean_satisfaction",
        )
        .orderBy(F.col("median_duration_hours").desc(), "variant")
    )


def dimension_performance(case_table: DataFrame, by: str) -> DataFrame:
    return (
        _performance(
            case_table,
            [by],
            {"median": 0.5, "p95": 0.95},
            {
                "mean_events": "event_count",
                "mean_resolvers": "unique_resolvers",
                "mean_satisfaction": "customer_satisfaction",
            },
        )
        .select(
            by,
            "incidents",
            "mean_duration_hours",
            "median_duration_hours",
            "p95_duration_hours",
            "mean_events",
            "mean_resolvers",
            "mean_satisfaction",
        )
        .orderBy(F.col("median_duration_hours").desc(), by)
    )


def overall_percentiles(case_table: DataFrame) -> DataFrame:
    rows = _performance(case_table, [], {"median": 0.5, "p75": 0.75, "p95": 0.95}, {})
    return rows.select(
        "incidents",
        *[tidy(F.col(f"{q}_{DURATION}"), 2).alias(f"{q}_{DURATION}") for q in ("mean", "median", "p75", "p95")],
    )


def ranked_bottlenecks(transitions: DataFrame, variant: str = FOCUS_VARIANT) -> DataFrame:
    """Bottlenecks of one variant, numbered by median (over the few report rows)."""
    by_median = Window.orderBy(F.col("median_hours").desc(), "transition")
    return variant_bottlenecks(transitions, variant).select(
        F.row_number().over(by_median).cast("bigint").alias("bottleneck_rank"), "*"
    )


def repetition_table(log: DataFrame, variant: str = FOCUS_VARIANT) -> DataFrame:
    """``rework_events`` without the variant column and without NULL events."""
    return rework_events(log.where(F.col("event").isNotNull()), variant, with_variant=False)


def example_trace(log: DataFrame, case_id) -> DataFrame:
    return (
        log.where(F.col("case_id") == case_id)
        .select("case_id", "event_timestamp", "event_id", "event", "resolver")
        .orderBy("event_timestamp", "event_id")
    )
