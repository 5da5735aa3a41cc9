"""What is known when a case is opened, and how it ended.

Features come from the first event only; labels come from the case metrics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import EVENT_ORDER, FIRST_EVENT, SLA_HOURS

LABELS = ["reached_level_3", "escalated", "slow_24h"]

FIRST_EVENT_COLUMNS = [
    "variant",
    "priority",
    "reporter",
    "report_channel",
    "issue_type",
    "short_description",
    "customer_satisfaction",
]


def first_event(log: DataFrame) -> DataFrame:
    """The earliest event of each case: a partial aggregate, not a sort."""
    first = log.groupBy("case_id").agg(
        F.min_by(
            F.struct(*FIRST_EVENT_COLUMNS, "event_timestamp", "event"), F.struct(*EVENT_ORDER)
        ).alias("_f")
    )
    return first.select(
        "case_id",
        *[F.col(f"_f.{c}").alias(c) for c in FIRST_EVENT_COLUMNS],
        F.col("_f.event_timestamp").alias("created_at"),
        F.col("_f.event").alias("first_event"),
    )


def intake_frame(log: DataFrame, cases: DataFrame, slow_hours: float = SLA_HOURS) -> DataFrame:
    """A milestone flag that is NULL (no named event at all) becomes 0."""
    outcome = cases.select(
        "case_id", "cycle_time_hours", "reached_level_3", "escalated", "is_completed"
    )

    def flag(c: str):
        return F.coalesce(F.col(c), F.lit(False)).cast("int").alias(c)

    day = F.weekday("created_at")  # Monday is 0
    return first_event(log).join(outcome, "case_id").select(
        "case_id",
        "variant",
        "priority",
        "reporter",
        "report_channel",
        "issue_type",
        "short_description",
        "customer_satisfaction",
        "created_at",
        "first_event",
        "cycle_time_hours",
        flag("reached_level_3"),
        flag("escalated"),
        flag("is_completed"),
        F.hour("created_at").alias("created_hour"),
        day.alias("created_dow"),
        (day >= 5).cast("int").alias("created_is_weekend"),
        F.month("created_at").alias("created_month"),
        F.dayofyear("created_at").alias("created_dayofyear"),
        F.length(F.coalesce("short_description", F.lit(""))).alias("desc_length"),
        (F.col("cycle_time_hours") > slow_hours).cast("int").alias("slow_24h"),
    )


def intake_checks(frame: DataFrame, expected: str = FIRST_EVENT) -> DataFrame:
    return frame.agg(
        F.count("*").alias("cases"),
        F.count_if(~F.col("first_event").eqNullSafe(F.lit(expected))).alias("other_first_event"),
        F.min("created_at").alias("created_at_min"),
        F.max("created_at").alias("created_at_max"),
    )


def require_cases(frame: DataFrame) -> DataFrame:
    if frame.isEmpty():
        raise ValueError("intake frame is empty: does the log hold any events?")
    return frame
