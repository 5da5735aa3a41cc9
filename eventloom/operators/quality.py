"""Known defects of a log, and how large they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exact import percent, tidy
from ..spec import SCORE_CAP
from .sequence import with_neighbours

# Column -> name of its null count.
NULL_COUNTS = {
    "variant": "null_variant",
    "priority": "null_priority",
    "reporter": "null_reporter",
    "event": "null_event",
    "issue_type": "null_issue_type",
    "resolver": "null_resolver",
    "report_channel": "null_channel",
    "short_description": "null_description",
    "customer_satisfaction": "null_satisfaction",
}


def completeness(log: DataFrame) -> DataFrame:
    return log.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(n) for c, n in NULL_COUNTS.items()],
    )


def null_events(log: DataFrame) -> DataFrame:
    return (
        log.where(F.col("event").isNull())
        .select("case_id", "event_timestamp", "resolver")
        .orderBy("case_id", "event_timestamp")
    )


def resolver_nulls(log: DataFrame) -> DataFrame:
    missing = F.count_if(F.col("resolver").isNull())
    return (
        log.groupBy("event")
        .agg(
            F.count("*").alias("rows"),
            missing.alias("null_resolver"),
            percent(missing, F.count("*")).alias("null_pct"),
        )
        .orderBy(F.col("rows").desc(), "event")
    )


def score_ceiling(cases: DataFrame, cap: int = SCORE_CAP) -> DataFrame:
    score = "customer_satisfaction"
    return (
        cases.groupBy("variant")
        .agg(
            F.count("*").alias("incidents"),
            F.min(score).alias("min_score"),
            F.max(score).alias("max_score"),
            tidy(F.avg(score), 2).alias("mean_score"),
            (F.max(score) == cap).alias(f"appears_capped_at_{cap}"),
        )
        .orderBy(F.col("mean_score").asc_nulls_last(), "variant")
    )


def ordering_defects(
    transitions: DataFrame,
    log: DataFrame | None = None,
    source_order: str = "event_id",
    chunks: int | None = None,
) -> DataFrame:
    """Transitions are built in time order, so the first two counts should be zero.

    With ``log``, also counts events that come after a later event of the same case
    in source order, which is what clock skew in the source looks like.
    """
    counts = transitions.agg(
        F.count_if(F.col("to_timestamp") < F.col("from_timestamp")).alias("out_of_order"),
        F.count_if(F.col("duration_hours") < 0).alias("negative_durations"),
        F.count("*").alias("total_transitions"),
    )
    if log is None:
        return counts
    steps = with_neighbours(
        log.select("case_id", source_order, "event_timestamp"),
        before=["event_timestamp"],
        order=[source_order],
        chunks=chunks,
    )
    late = steps.agg(F.count_if(F.col("event_timestamp") < F.col("prev_event_timestamp")))
    return counts.withColumn("source_out_of_order", late.scalar())
