"""What to know about the intake frame before any model is trained on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import hour_parts, tidy
from ..functions.quantiles import summarise
from ..spec import FOCUS_VARIANT
from .intake import LABELS

# How many values the report lists, and how many still mean boilerplate.
TOP_VALUES = 15
BOILERPLATE_VALUES = 50
NO_TEXT = "(null)"


def templating(frame: DataFrame, text: str = "short_description") -> DataFrame:
    """Is the text free, or a fixed vocabulary?  NULL counts as one more value."""
    values = frame.groupBy(F.coalesce(text, F.lit(NO_TEXT)).alias("_t")).agg(
        F.count("*").alias("_n"),
        F.count_if(F.col(text).isNull()).alias("_nulls"),
        F.sum("desc_length").alias("_length"),
        F.max("desc_length").alias("_longest"),
    )
    return values.agg(
        F.sum("_n").alias("n_cases"),
        F.count("*").alias("n_distinct"),
        tidy(F.lit(100.0) * F.count("*") / F.sum("_n"), 4).alias("distinct_pct"),
        F.sum("_nulls").alias("null_count"),
        tidy(F.sum("_length") / F.sum("_n"), 2).alias("mean_length_chars"),
        F.max("_longest").alias("max_length_chars"),
        (F.count("*") <= BOILERPLATE_VALUES).alias("is_boilerplate"),
    )


def top_values(frame: DataFrame, text: str = "short_description", n: int = TOP_VALUES) -> DataFrame:
    return (
        frame.groupBy(F.coalesce(text, F.lit(NO_TEXT)).alias("value"))
        .agg(F.count("*").alias("cases"))
        .orderBy(F.col("cases").desc(), "value")
        .limit(n)
    )


def crosstab(frame: DataFrame, a: str = "short_description", b: str = "issue_type") -> DataFrame:
    """Counts of value pairs in long form; pairs that do not occur are absent."""
    return frame.groupBy(
        F.coalesce(a, F.lit(NO_TEXT)).alias(a), F.col(b)
    ).agg(F.count("*").alias("cases"))


def mutual_information(
    frame: DataFrame, a: str = "short_description", b: str = "issue_type"
) -> DataFrame:
    """Mutual information over the mean of both entropies; 1 when both are constant."""
    pairs = crosstab(frame.where(F.col(b).isNotNull()), a, b).select(
        F.col(a).alias("_a"), F.col(b).alias("_b"), F.col("cases").alias("_n")
    )
    left = pairs.groupBy("_a").agg(F.sum("_n").alias("_na"))
    right = pairs.groupBy("_b").agg(F.sum("_n").alias("_nb"))
    total = pairs.agg(F.sum("_n")).scalar()

    def entropy(side: DataFrame, n: str):
        p = F.col(n) / total
        return side.agg(F.coalesce(-F.sum(p * F.ln(p)), F.lit(0.0))).scalar()

    joined = pairs.join(left, "_a").join(right, "_b")
    information = joined.agg(
        F.coalesce(
            F.sum(
                F.col("_n") / total * F.ln(F.col("_n") / F.col("_na") * (total / F.col("_nb")))
            ),
            F.lit(0.0),
        ).alias("_mi")
    )
    parts = information.select(
        "_mi", entropy(left, "_na").alias("_ha"), entropy(right, "_nb").alias("_hb")
    )
    mean = (F.col("_ha") + F.col("_hb")) / 2
    return parts.select(
        tidy(F.when(mean < 1e-15, 1.0).otherwise(F.col("_mi") / mean), 4).alias("nmi")
    )


def score_timing(frame: DataFrame, score: str = "customer_satisfaction") -> DataFrame:
    """Is the score there on the first event of every case?"""
    return frame.agg(
        F.count_if(F.col(score).isNull()).alias("null_at_intake"),
        F.countDistinct(score).alias("n_distinct"),
        (F.count(score) == F.count("*")).alias("present_on_every_row"),
    )


def score_by_label(
    frame: DataFrame, label: str = "reached_level_3", score: str = "customer_satisfaction"
) -> DataFrame:
    return frame.groupBy(label).agg(tidy(F.avg(score), 4).alias("mean_score")).orderBy(label)


def class_balance(frame: DataFrame, labels: Sequence[str] = tuple(LABELS)) -> DataFrame:
    """Base rate of each label, in one pass over the frame."""
    counts = frame.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in labels])
    long = counts.unpivot("n", list(labels), "label_name", "positives")
    n, positives = F.col("n"), F.col("positives")
    rate = tidy(positives / n, 6)
    return long.select(
        "label_name",
        "n",
        "positives",
        (n - positives).alias("negatives"),
        rate.alias("base_rate"),
        tidy(F.greatest(positives, n - positives) / n, 6).alias("trivial_majority_accuracy"),
        F.when(positives == 0, 1.0).otherwise(rate).alias(
            "trivial_majority_precision_if_predict_positive"
        ),
    )


def cycle_time_profile(frame: DataFrame, hours: str = "cycle_time_hours") -> DataFrame:
    row = summarise(
        frame,
        [],
        [
            tidy(F.sum(hour_parts(hours)) / (F.count(hours) * 1e4), 4).alias("mean"),
            tidy(F.max(hours), 4).alias("max"),
            tidy(F.stddev_samp(hours), 4).alias("std"),
        ],
        hours,
        {"median": 0.5, "p75": 0.75, "p95": 0.95},
    )
    return row.select(
        "mean", *[tidy(F.col(q), 4).alias(q) for q in ("median", "p75", "p95")], "max", "std"
    )


def segment_profile(
    frame: DataFrame,
    variants: Sequence[str] = (FOCUS_VARIANT,),
    label: str = "reached_level_3",
) -> DataFrame:
    """Each listed variant, and the rest, side by side."""
    segment = F.when(F.col("variant").isin(*variants), F.col("variant")).otherwise("rest")
    everything = Window.partitionBy()
    sums = frame.groupBy(segment.alias("segment")).agg(
        F.count("*").alias("cases"),
        F.sum(label).alias("positives"),
        F.sum(hour_parts("cycle_time_hours")).alias("_parts"),
    )
    return sums.select(
        "segment",
        "cases",
        tidy(F.col("cases") / F.sum("cases").over(everything), 4).alias("share_of_data"),
        "positives",
        tidy(F.col("positives") / F.col("cases"), 4).alias("label_rate"),
        tidy(
            F.col("positives") / F.greatest(F.lit(1), F.sum("positives").over(everything)), 4
        ).alias("share_of_positives"),
        tidy(F.col("_parts") / (F.col("cases") * 1e4), 3).alias("mean_cycle_hours"),
    ).orderBy("segment")


def segment_issue_types(frame: DataFrame, variant: str = FOCUS_VARIANT) -> DataFrame:
    return (
        frame.where(F.col("variant") == variant)
        .groupBy("issue_type")
        .agg(F.count("*").alias("cases"))
        .orderBy(F.col("cases").desc(), "issue_type")
    )
