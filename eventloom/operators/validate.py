"""Checks that must hold before a log is worth analysing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exact import col, micros_between
from ..spec import CASE_DIMS

EVENT_KEY = ["case_id", "event_timestamp", "event"]
MIN_EVENTS = 2


class ValidationError(ValueError):
    """A check found rows that would corrupt the metrics."""


def dealt_by_event(log: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """The event key and ``columns``, in partitions of a bounded size, for groupings by that key.

    Nearly every event is a group of its own, so the map of a task's groups is as large as its
    rows, and files that compress well have many rows a split.  The row's identity is dealt by
    as well: Spark then adds up within these partitions before it brings a key together, and
    may cut one that many copies of a key have filled.
    """
    by = [c for c in (*EVENT_KEY, "event_id") if c in log.columns]
    return log.select(*dict.fromkeys([*by, *columns])).hint("rebalance", *by)


def duplicate_events(log: DataFrame) -> DataFrame:
    """Keys that occur more than once, and by how many rows; NULL events are equal."""
    return (
        dealt_by_event(log)
        .groupBy(*EVENT_KEY)
        .agg((F.count("*") - 1).alias("surplus_rows"))
        .where(F.col("surplus_rows") > 0)
    )


def _varies(c: str):
    return F.min(c) < F.max(c)


def check_constant(log: DataFrame, columns: Sequence[str] = tuple(CASE_DIMS)) -> DataFrame:
    """Per attribute, the number of cases in which it has more than one value.

    All attributes are tested in one grouping; NULL is not a value.
    """
    varying = log.groupBy("case_id").agg(*[_varies(c).alias(c) for c in columns])
    counts = varying.agg(*[F.count_if(c).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "attribute", "varying_cases")


def short_cases(log: DataFrame, least: int = MIN_EVENTS) -> DataFrame:
    sizes = log.groupBy("case_id").agg(F.count("*").alias("events"))
    return sizes.agg(
        F.count("*").alias("cases"),
        F.min("events").alias("min_events"),
        F.count_if(F.col("events") < least).alias("short_cases"),
    )


def validation_summary(
    log: DataFrame, dims: Sequence[str] = tuple(CASE_DIMS), least: int = MIN_EVENTS
) -> DataFrame:
    """Every check in one pass: ``(check, failures, passed)``.

    Events are first counted per (case, time, event).  That spreads a large case over
    many tasks, and leaves one partial row per task and case for the second step.
    """
    keys = dealt_by_event(log, dims).groupBy(*EVENT_KEY).agg(
        F.count("*").alias("_n"),
        *[F.min(c).alias(f"_lo_{c}") for c in dims],
        *[F.max(c).alias(f"_hi_{c}") for c in dims],
    )
    cases = keys.groupBy("case_id").agg(
        F.sum("_n").alias("_events"),
        F.sum(F.col("_n") - 1).alias("_surplus"),
        F.sum(F.when(F.col("event_timestamp").isNull(), F.col("_n")).otherwise(0)).alias("_bad"),
        *[(F.min(f"_lo_{c}") < F.max(f"_hi_{c}")).alias(c) for c in dims],
    )
    checks = {
        "unparseable timestamps": F.sum("_bad"),
        "missing case_id": F.sum(F.when(F.col("case_id").isNull(), F.col("_events")).otherwise(0)),
        "duplicate events": F.sum("_surplus"),
        **{f"varying {c}": F.count_if(c) for c in dims},
        f"cases with fewer than {least} events": F.count_if(F.col("_events") < least),
    }
    counts = cases.agg(*[F.coalesce(n, F.lit(0)).alias(c) for c, n in checks.items()])
    long = counts.unpivot([], [F.col(f"`{c}`") for c in checks], "check", "failures")
    return long.withColumn("passed", F.col("failures") == 0)


def require_valid(log: DataFrame, **options) -> DataFrame:
    """The log itself, or an error that names every failed check and its count."""
    failed = validation_summary(log, **options).where(~F.col("passed")).collect()
    if failed:
        raise ValidationError(
            "; ".join(f"{r['check']}: {r['failures']}" for r in failed)
        )
    return log


def case_count_differences(source: DataFrame, written: DataFrame) -> DataFrame:
    """Cases whose number of events differs between the two logs."""
    a = source.groupBy("case_id").agg(F.count("*").alias("source_events"))
    b = written.groupBy("case_id").agg(F.count("*").alias("written_events"))
    return a.join(b, "case_id", "full_outer").where(
        ~F.col("source_events").eqNullSafe(F.col("written_events"))
    )


EPOCH = "1970-01-01 00:00:00"


def _extent(log: DataFrame):
    """One value: number of variants, first and last event in microseconds."""
    ends = log.groupBy("variant").agg(
        F.min("event_timestamp").alias("lo"), F.max("event_timestamp").alias("hi")
    )
    zero = F.lit(EPOCH).cast("timestamp_ntz")
    return ends.agg(
        F.struct(
            F.count("variant").alias("variants"),
            micros_between(zero, F.min("lo")).alias("first"),
            micros_between(zero, F.max("hi")).alias("last"),
        ).alias("extent")
    ).scalar()


def parity(source: DataFrame, written: DataFrame) -> DataFrame:
    """Rows, cases, cases of unequal size, variants and time range, as
    ``(check, source, written, passed)``; times are microseconds since 1970."""
    a = source.groupBy("case_id").agg(F.count("*").alias("s"))
    b = written.groupBy("case_id").agg(F.count("*").alias("w"))
    one = (
        a.join(b, "case_id", "full_outer")
        .agg(
            F.coalesce(F.sum("s"), F.lit(0)).alias("s_rows"),
            F.coalesce(F.sum("w"), F.lit(0)).alias("w_rows"),
            F.count("s").alias("s_cases"),
            F.count("w").alias("w_cases"),
            F.count_if(~F.col("s").eqNullSafe(F.col("w"))).alias("unequal"),
        )
        .withColumns({"s_extent": _extent(source), "w_extent": _extent(written)})
    )
    pairs = {
        "rows": ("s_rows", "w_rows"),
        "cases": ("s_cases", "w_cases"),
        "cases of unequal size": (F.lit(0).cast("bigint"), "unequal"),
        "variants": ("s_extent.variants", "w_extent.variants"),
        "first event": ("s_extent.first", "w_extent.first"),
        "last event": ("s_extent.last", "w_extent.last"),
    }
    lines = F.array(
        *[
            F.struct(F.lit(name).alias("check"), col(x).alias("source"), col(y).alias("written"))
            for name, (x, y) in pairs.items()
        ]
    )
    return one.select(F.inline(lines)).withColumn("passed", F.col("source").eqNullSafe(F.col("written")))
