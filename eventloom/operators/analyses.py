"""Single-question analyses on top of the metric views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import hour_parts, mean_hours, micros_between, percent, tidy
from ..functions.quantiles import summarise
from ..spec import BASE_PRIORITY, FOCUS_VARIANT, LEVEL3_VARIANTS
from .sequence import chunked, with_neighbours
from .validate import check_constant
from .views import CASE_TABLE_ATTRIBUTES

# Groups of states whose dwell times are compared.
DWELL_GROUPS = {
    "intake": ["Ticket created"],
    "level 1 work": ["WIP - level 1 support", "Ticket assigned to level 1 support"],
}


def attribute_variation(log: DataFrame, columns: Sequence[str] = tuple(CASE_TABLE_ATTRIBUTES)) -> DataFrame:
    """Cases in which an attribute changes, for all seven attributes."""
    return check_constant(log, columns)


def dwell_multiplier(
    transitions: DataFrame,
    groups: Mapping[str, Sequence[str]] = DWELL_GROUPS,
    base: str = BASE_PRIORITY,
) -> DataFrame:
    """Mean over cases of the time each spent in a group of states, against the base.

    Cases that never were in the group are not part of its mean.
    """
    group = F.lit(None).cast("string")
    for name, states in groups.items():
        group = F.when(F.col("from_event").isin(*states), name).otherwise(group)
    per_case = (
        transitions.withColumn("state_group", group)
        .where(F.col("state_group").isNotNull())
        .groupBy("state_group", "priority", "case_id")
        .agg(F.sum(hour_parts("duration_hours")).alias("_parts"))
    )
    means = per_case.groupBy("state_group", "priority").agg(
        F.count("*").alias("cases"),
        (F.sum("_parts") / (F.count("*") * 1e4)).alias("_mean"),
    )
    baseline = means.where(F.col("priority") == base).select(
        "state_group", F.col("_mean").alias("_base")
    )
    return (
        means.join(baseline, "state_group")
        .select(
            "state_group",
            "priority",
            "cases",
            tidy(F.col("_mean"), 3).alias("mean_hours"),
            tidy(F.col("_mean") / F.nullif(F.col("_base"), F.lit(0.0)), 3).alias("multiplier"),
        )
        .orderBy("state_group", "priority")
    )


def dimension_mix(cases: DataFrame, a: str = "issue_type", b: str = "priority") -> DataFrame:
    """Share of each value of ``b`` inside each value of ``a``, with mean hours."""
    within = Window.partitionBy(a)  # over the few rows of the aggregate
    pairs = cases.groupBy(a, b).agg(
        F.count("*").alias("cases"),
        tidy(mean_hours("cycle_time_hours"), 2).alias("mean_cycle_hours"),
    )
    return pairs.select(
        a,
        b,
        "cases",
        percent(F.col("cases"), F.sum("cases").over(within)).alias("pct_within"),
        "mean_cycle_hours",
    ).orderBy(a, b)


def mean_hours_in_segment(cases: DataFrame, segment: Column, by: str = "priority") -> DataFrame:
    return (
        cases.where(segment)
        .groupBy(by)
        .agg(
            F.count("*").alias("cases"),
            tidy(mean_hours("cycle_time_hours"), 2).alias("mean_cycle_hours"),
        )
        .orderBy(by)
    )


def top_state_share(transitions: DataFrame, k: int = 3) -> DataFrame:
    """Share of all time that the ``k`` longest states hold."""
    states = transitions.groupBy("from_event").agg(
        F.sum(hour_parts("duration_hours")).alias("_parts")
    )
    total = states.agg(F.sum("_parts")).scalar()
    top = states.orderBy(F.col("_parts").desc(), "from_event").limit(k)
    return top.agg(
        F.count("*").alias("states"),
        tidy(F.sum("_parts") / 1e4, 0).alias("hours"),
    ).withColumn(
        "pct_of_all_time",
        percent(top.agg(F.sum("_parts")).scalar(), F.nullif(total, F.lit(0)), 1),
    )


def _gaps(log: DataFrame, variant: str | None, chunks: int | None) -> DataFrame:
    if variant is not None:
        log = log.where(F.col("variant") == variant)
    needed = chunked(log, ["case_id", "variant", "event_timestamp", "event_id"], chunks=chunks)
    steps = with_neighbours(needed, before=["event_timestamp"], position=True).where(
        F.col("prev_event_timestamp").isNotNull()
    )
    gap = micros_between("prev_event_timestamp", "event_timestamp") / F.lit(3.6e9)
    return steps.withColumn("gap_hours", gap)


def gap_spread_by_case(
    log: DataFrame, variant: str | None = FOCUS_VARIANT, chunks: int | None = None
) -> DataFrame:
    """Per variant: how the standard deviation of a case's gaps is spread over cases."""
    per_case = (
        _gaps(log, variant, chunks)
        .groupBy("variant", "case_id")
        .agg(F.stddev_samp("gap_hours").alias("sd"))
        .where(F.col("sd").isNotNull())
    )
    return (
        per_case.groupBy("variant")
        .agg(
            F.count("*").alias("cases"),
            tidy(F.min("sd"), 2).alias("min_gap_sd"),
            tidy(F.avg("sd"), 2).alias("mean_gap_sd"),
            tidy(F.max("sd"), 2).alias("max_gap_sd"),
        )
        .orderBy("variant")
    )


def gap_spread_by_position(
    log: DataFrame, variant: str | None = FOCUS_VARIANT, chunks: int | None = None
) -> DataFrame:
    """Per variant and step number: spread of the gap before that step."""
    return (
        _gaps(log, variant, chunks)
        .groupBy("variant", "position")
        .agg(
            F.count("*").alias("cases"),
            tidy(F.avg("gap_hours"), 2).alias("mean_gap_hours"),
            tidy(F.stddev_samp("gap_hours"), 2).alias("gap_sd"),
        )
        .orderBy("variant", "position")
    )


def label_covered_by(
    cases: DataFrame, variants: Sequence[str] = LEVEL3_VARIANTS, label: str = "reached_level_3"
) -> DataFrame:
    """Does every case with the label belong to the set, and all of the set have it?"""
    inside = F.coalesce(F.col("variant").isin(*variants), F.lit(False))
    return cases.agg(
        F.count_if(label).alias("positives"),
        F.count_if(F.col(label) & inside).alias("positives_inside"),
        F.count_if(inside).alias("cases_inside"),
        (F.count_if(label) == F.count_if(F.col(label) & inside)).alias("covers_all_positives"),
        (F.count_if(inside) == F.count_if(F.col(label) & inside)).alias("all_inside_positive"),
    )


def always_seen_transitions(transitions: DataFrame, share: float = 100.0) -> DataFrame:
    """Per variant, the transitions that at least this share of its cases go through."""
    sizes = transitions.groupBy("variant").agg(F.countDistinct("case_id").alias("_all"))
    seen = transitions.groupBy("variant", "transition").agg(
        F.count("*").alias("occurrences"), F.countDistinct("case_id").alias("cases")
    )
    return (
        seen.join(sizes, "variant")
        .withColumn("case_percentage", percent(F.col("cases"), F.col("_all")))
        .where(F.col("case_percentage") >= share)
        .select("variant", "transition", "occurrences", "cases", "case_percentage")
        .orderBy("variant", "transition")
    )


def what_if(
    transitions: DataFrame,
    cases: DataFrame,
    shorten: str = "Ticket created",
    by_hours: float = 1.0,
    cut: str = "WIP - level 1 support",
    by_share: float = 0.20,
) -> DataFrame:
    """Saving per case if the time in one state were shorter by up to some hours, and
    the time in another smaller by a share; also relative to mean and median cycle."""
    parts = hour_parts("duration_hours")
    limit = int(round(by_hours * 10_000))
    per_case = (
        transitions.where(F.col("from_event").isin(shorten, cut))
        .groupBy("case_id")
        .agg(
            F.sum(F.when(F.col("from_event") == shorten, parts).otherwise(0)).alias("_first"),
            F.sum(F.when(F.col("from_event") == cut, parts).otherwise(0)).alias("_second"),
        )
    )
    saved = per_case.agg(
        F.coalesce(F.sum(F.least("_first", F.lit(limit))), F.lit(0)).alias("_flat"),
        F.coalesce(F.sum("_second"), F.lit(0)).alias("_share"),
    )
    cycle = summarise(
        cases,
        [],
        [F.count("*").alias("cases"), mean_hours("cycle_time_hours").alias("_mean")],
        "cycle_time_hours",
        {"_median": 0.5},
    )
    total = saved.select((F.col("_flat") + F.col("_share") * by_share) / 1e4).scalar()
    return cycle.withColumn("_saving", total / F.col("cases")).select(
        "cases",
        tidy(F.col("_saving"), 3).alias("saving_hours_per_case"),
        percent(F.col("_saving"), F.nullif(F.col("_mean"), F.lit(0.0)), 1).alias("pct_of_mean_cycle"),
        percent(F.col("_saving"), F.nullif(F.col("_median"), F.lit(0.0)), 1).alias("pct_of_median_cycle"),
    )


def dwell_by_state(transitions: DataFrame, over_hours: float = 4.0) -> DataFrame:
    """Length of stays per state, and the share of stays over a limit."""
    rows = summarise(
        transitions,
        ["from_event"],
        [
            F.count("*").alias("stays"),
            tidy(mean_hours("duration_hours"), 3).alias("mean_hours"),
            percent(F.count_if(F.col("duration_hours") > over_hours), F.count("*")).alias(
                "pct_over_limit"
            ),
        ],
        "duration_hours",
        {"median": 0.5, "p95": 0.95},
    )
    return rows.select(
        "from_event",
        "stays",
        "mean_hours",
        tidy(F.col("median"), 3).alias("median_hours"),
        tidy(F.col("p95"), 3).alias("p95_hours"),
        "pct_over_limit",
    ).orderBy(F.col("mean_hours").desc(), "from_event")


def label_by_dimension(
    cases: DataFrame, by: str = "issue_type", label: str = "reached_level_3"
) -> DataFrame:
    """Rate of a label per value, and the value's share of all cases with the label."""
    everything = Window.partitionBy()
    rows = cases.groupBy(by).agg(
        F.count("*").alias("cases"), F.count_if(F.col(label).cast("boolean")).alias("positives")
    )
    return rows.select(
        by,
        "cases",
        "positives",
        percent(F.col("positives"), F.col("cases")).alias("label_rate_pct"),
        percent(
            F.col("positives"), F.nullif(F.sum("positives").over(everything), F.lit(0))
        ).alias("pct_of_positives"),
    ).orderBy(F.col("positives").desc(), by)


def compare_metrics(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two tables ``(metric, value)`` side by side; metrics of either one are kept."""
    a = old.select("metric", F.col("value").alias("old_value"))
    b = new.select("metric", F.col("value").alias("new_value"))
    return (
        a.join(b, "metric", "full_outer")
        .withColumn("difference", tidy(F.col("new_value") - F.col("old_value"), 4))
        .orderBy("metric")
    )
