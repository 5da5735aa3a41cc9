"""The two metric views and the case table: what all reports are built on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import (
    MICROS_PER_HOUR,
    MICROS_PER_SECOND,
    any_true,
    hours,
    matches,
    micros_between,
    tidy,
)
from ..functions.ordered import key_of, split_at_borders
from ..functions.quantiles import planned_quantile
from ..spec import CASE_DIMS, EVENT_ORDER, MilestonePatterns
from .sequence import by_case, by_chunks, chunked, with_neighbours

CASE_KEY = ["case_id", *CASE_DIMS]


def step_gaps(log: DataFrame, chunks: int | None = None) -> DataFrame:
    """Seconds since the previous event of the case; NULL on the first event."""
    gaps = with_neighbours(log, before=["event_timestamp"], chunks=chunks)
    return gaps.select(
        "case_id",
        "event_id",
        "event_timestamp",
        "event",
        (_gap() / F.lit(MICROS_PER_SECOND)).alias("step_seconds"),
    )


def _gap() -> Column:
    return micros_between("prev_event_timestamp", "event_timestamp")


def case_metrics(
    log: DataFrame,
    patterns: MilestonePatterns = MilestonePatterns(),
    chunks: int | None = None,
) -> DataFrame:
    """One row per case and combination of its attributes.

    An attribute that varies inside a case splits the case; ``check_constant``
    finds such cases.  Milestones are NULL when every event of the case is NULL.

    Cases within a chunk of the ordered log need one shuffle: the window and the grouping
    share it, and sets and medians hold a chunk's rows at most.  Cases that reach over
    chunks are counted value by value.
    """
    needed = chunked(log, [*CASE_KEY, "event_timestamp", "event_id", "event", "resolver"], chunks=chunks)
    whole, reaching = split_at_borders(needed, ["case_id"])
    grouped = by_case(whole, before=["event_timestamp"]).withColumn("_gap", _gap()).groupBy(*CASE_KEY).agg(
        *_measures(patterns),
        F.size(F.collect_set("event")).cast("bigint").alias("unique_events"),
        F.size(F.collect_set("resolver")).cast("bigint").alias("unique_resolvers"),
        F.percentile("_gap", F.lit(0.5)).alias("_median"),
    )
    gaps = by_chunks(reaching, before=["event_timestamp"]).withColumn("_gap", _gap())
    wide = gaps.groupBy(*CASE_KEY).agg(
        *_measures(patterns),
        F.countDistinct("event").alias("unique_events"),
        F.countDistinct("resolver").alias("unique_resolvers"),
    )
    medians = planned_quantile(gaps, CASE_KEY, "_gap", "_median", 0.5)
    wide = wide.withColumn("_key", key_of(CASE_KEY)).join(
        medians.select(key_of(CASE_KEY).alias("_key"), "_median"), "_key", "left"
    )
    grouped = grouped.unionByName(wide.drop("_key"))
    cycle = micros_between("started_at", "ended_at")
    return grouped.select(
        *CASE_KEY,
        "event_count",
        "unique_events",
        "unique_resolvers",
        "started_at",
        "ended_at",
        (cycle / F.lit(MICROS_PER_SECOND)).alias("cycle_time_seconds"),
        hours(cycle).alias("cycle_time_hours"),
        tidy(F.col("_total") / F.col("_steps") / F.lit(MICROS_PER_SECOND), 2).alias("mean_step_seconds"),
        (F.col("_longest") / F.lit(MICROS_PER_SECOND)).alias("max_step_seconds"),
        (F.col("_median") / F.lit(MICROS_PER_SECOND)).alias("median_step_seconds"),
        *[name for name, _ in patterns.items()],
    )


def _measures(patterns: MilestonePatterns) -> list[Column]:
    return [
        F.count("*").alias("event_count"),
        F.min("event_timestamp").alias("started_at"),
        F.max("event_timestamp").alias("ended_at"),
        F.sum("_gap").alias("_total"),
        # Without steps there is no mean: NULL, not a division by zero.
        F.nullif(F.count("_gap"), F.lit(0)).alias("_steps"),
        F.max("_gap").alias("_longest"),
        *[F.bool_or(matches("event", p)).alias(name) for name, p in patterns.items()],
    ]


def transition_metrics(
    log: DataFrame,
    null_event: str = "drop",
    chunks: int | None = None,
) -> DataFrame:
    """One row per observed step A -> B; the time between is charged to A.

    A NULL event breaks the chain: the transitions into and out of it are lost
    (``null_event='drop'``).  ``'bridge'`` removes such rows first, so that their
    neighbours are joined by one transition.
    """
    if null_event not in ("drop", "bridge"):
        raise ValueError("null_event must be 'drop' or 'bridge'")
    columns = ["case_id", "variant", "issue_type", "priority", "report_channel", *EVENT_ORDER, "event"]
    needed = chunked(log, columns, chunks=chunks)
    if null_event == "bridge":
        needed = needed.where(F.col("event").isNotNull())
    steps = with_neighbours(
        needed,
        after=["event", "event_timestamp"],
    ).where(
        F.col("event").isNotNull()
        & F.col("next_event").isNotNull()
        & (F.col("next_event_timestamp") >= F.col("event_timestamp"))
    )
    spent = micros_between("event_timestamp", "next_event_timestamp")
    return steps.select(
        "case_id",
        "variant",
        "issue_type",
        "priority",
        "report_channel",
        F.col("event").alias("from_event"),
        F.col("next_event").alias("to_event"),
        F.concat("event", F.lit(" -> "), "next_event").alias("transition"),
        F.col("event_timestamp").alias("from_timestamp"),
        F.col("next_event_timestamp").alias("to_timestamp"),
        (spent / F.lit(MICROS_PER_SECOND)).alias("duration_seconds"),
        hours(spent).alias("duration_hours"),
    )


CASE_TABLE_ATTRIBUTES = [
    "variant",
    "priority",
    "reporter",
    "issue_type",
    "report_channel",
    "short_description",
    "customer_satisfaction",
]


def case_table(
    log: DataFrame,
    patterns: MilestonePatterns = MilestonePatterns(),
    chunks: int | None = None,
) -> DataFrame:
    """One row per case; each attribute is its first non-null value in event order.

    Flags are 0/1, and 0 for a case whose events are all NULL.
    """
    at = F.struct(*EVENT_ORDER)
    shared = [
        *[
            F.min_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c)
            for c in CASE_TABLE_ATTRIBUTES
        ],
        F.count("*").alias("event_count"),
        F.min("event_timestamp").alias("start_time"),
        F.max("event_timestamp").alias("end_time"),
        *[any_true(matches("event", p)).alias(name) for name, p in patterns.items()],
    ]
    needed = ["case_id", *CASE_TABLE_ATTRIBUTES, *EVENT_ORDER, "event", "resolver"]
    whole, reaching = split_at_borders(chunked(log, needed, chunks=chunks), ["case_id"])
    grouped = whole.groupBy("case_id").agg(
        *shared,
        F.size(F.collect_set("event")).cast("bigint").alias("unique_events"),
        F.size(F.collect_set("resolver")).cast("bigint").alias("unique_resolvers"),
    )
    grouped = grouped.unionByName(
        reaching.groupBy("case_id").agg(
            *shared,
            F.countDistinct("event").alias("unique_events"),
            F.countDistinct("resolver").alias("unique_resolvers"),
        )
    )
    return grouped.select(
        "case_id",
        *CASE_TABLE_ATTRIBUTES,
        "event_count",
        "unique_events",
        "unique_resolvers",
        "start_time",
        "end_time",
        (micros_between("start_time", "end_time") / F.lit(MICROS_PER_HOUR)).alias("duration_hours"),
        *[name for name, _ in patterns.items()],
    )
