"""Evaluation of scored rows ``(by..., label 0/1, score)`` without collecting them.

Scores are first counted per distinct value; running totals over those counts give
the curve, and everything else is an aggregate of the curve's points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import tidy
from ..functions.ordered import key_of, running_totals
from ..functions.quantiles import summarise
from ..spec import SLA_HOURS


def curve_points(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    by: Sequence[str] = (),
    chunks: int | None = None,
) -> DataFrame:
    """One row per distinct score, from the highest: what flagging ``>= threshold`` gives."""
    counts = scored.groupBy(*by, F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum(1 - F.col(label).cast("bigint")).alias("neg"),
    )
    points = running_totals(
        counts, by, [F.col("threshold").desc()], {"tp": "pos", "fp": "neg"}, chunks
    )
    tp, fp = F.col("tp"), F.col("fp")
    return points.select(
        *by,
        "threshold",
        "pos",
        "neg",
        "tp",
        "fp",
        F.col("tp_all").alias("positives"),
        F.col("fp_all").alias("negatives"),
        (tp / (tp + fp)).alias("precision"),
        (tp / _some("tp_all")).alias("recall"),
        (fp / _some("fp_all")).alias("fpr"),
    )


def _some(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(0))


def _auc() -> Column:
    """Area under ROC; a tie between a positive and a negative counts half."""
    above = F.col("tp") - F.col("pos") + F.col("pos") / 2
    pairs = F.max("positives").cast("double") * F.max("negatives").cast("double")
    return F.sum(F.col("neg") * above) / F.nullif(pairs, F.lit(0.0))


def _average_precision() -> Column:
    """Sum over points of (gain in recall) x precision: steps, not trapezoids."""
    return F.sum(F.col("pos") * F.col("precision")) / F.nullif(F.max("positives"), F.lit(0))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return 2.0 * tp / (2 * tp + fp + fn)


def _best_point() -> Column:
    """Point with the highest F1; of equals, the one with the lowest threshold."""
    tp, fp = F.col("tp"), F.col("fp")
    f1 = F.coalesce(_f1(tp, fp, F.col("positives") - tp), F.lit(0.0))
    return F.max_by(
        F.struct("threshold", "tp", "fp"), F.struct(f1, -F.col("threshold"))
    )


def ranking_metrics(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return points.groupBy(*by).agg(
        tidy(_auc(), 6).alias("roc_auc"), tidy(_average_precision(), 6).alias("pr_auc")
    )


def best_f1(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    best = points.groupBy(*by).agg(
        _best_point().alias("_p"),
        F.max("positives").alias("_pos"),
        F.max("negatives").alias("_neg"),
    )
    counts = best.select(
        *by,
        F.col("_p.threshold").alias("threshold"),
        (F.col("_neg") - F.col("_p.fp")).alias("tn"),
        F.col("_p.fp").alias("fp"),
        (F.col("_pos") - F.col("_p.tp")).alias("fn"),
        F.col("_p.tp").alias("tp"),
    )
    return counts.withColumns(_rates())


def confusion(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    threshold: float = 0.5,
    by: Sequence[str] = (),
) -> DataFrame:
    return scored.groupBy(*by).agg(*_confusion(label, score, threshold))


def _confusion(label: str, score: str, threshold: float) -> list[Column]:
    yes, flagged = F.col(label) == 1, F.col(score) >= threshold
    return [
        F.count_if(~yes & ~flagged).alias("tn"),
        F.count_if(~yes & flagged).alias("fp"),
        F.count_if(yes & ~flagged).alias("fn"),
        F.count_if(yes & flagged).alias("tp"),
    ]


def _ratio(part: Column, whole: Column) -> Column:
    """0 where nothing is divided by nothing."""
    return F.when(whole == 0, 0.0).otherwise(part / whole)


def _rates(tn="tn", fp="fp", fn="fn", tp="tp", suffix="") -> dict[str, Column]:
    fp, fn, tp = F.col(fp), F.col(fn), F.col(tp)
    return {
        f"precision{suffix}": tidy(_ratio(tp, tp + fp), 6),
        f"recall{suffix}": tidy(_ratio(tp, tp + fn), 6),
        f"f1{suffix}": tidy(_ratio(2.0 * tp, 2 * tp + fp + fn), 6),
    }


def _balanced_accuracy(tn, fp, fn, tp) -> Column:
    """Mean recall of the classes that occur."""
    sides = F.array_compact(
        F.array(tp / F.nullif(tp + fn, F.lit(0)), tn / F.nullif(tn + fp, F.lit(0)))
    )
    return F.aggregate(sides, F.lit(0.0), lambda a, x: a + x) / F.size(sides)


def _mcc(tn, fp, fn, tp) -> Column:
    tn, fp, fn, tp = (c.cast("double") for c in (tn, fp, fn, tp))
    spread = (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)
    return F.when(spread == 0, 0.0).otherwise((tp * tn - fp * fn) / F.sqrt(spread))


def evaluate_binary(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    by: Sequence[str] = (),
    chunks: int | None = None,
) -> DataFrame:
    """All figures of a binary model, one row per ``by`` group.

    Two passes: one over the rows (counts at 0.5, Brier score) and one over the
    curve (areas and the best threshold).
    """
    error = F.col(score) - F.col(label)
    at_half = scored.groupBy(*by).agg(
        F.count("*").alias("n_test"),
        F.sum(F.col(label).cast("bigint")).alias("positives_test"),
        tidy(F.avg(error * error), 6).alias("brier"),
        *_confusion(label, score, 0.5),
    )
    points = curve_points(scored, label, score, by, chunks)
    curve = points.groupBy(*by).agg(
        tidy(_auc(), 6).alias("roc_auc"),
        tidy(_average_precision(), 6).alias("pr_auc"),
        _best_point().alias("_best"),
    )
    both = (
        at_half.withColumn("_key", key_of(by))
        .join(curve.withColumn("_key", key_of(by)).drop(*by), "_key")
        .drop("_key")
    )
    cells = [F.col(c) for c in ("tn", "fp", "fn", "tp")]
    base = F.col("positives_test") / F.col("n_test")
    negatives = F.col("n_test") - F.col("positives_test")
    with_best = both.withColumns(
        {
            "best_tn": negatives - F.col("_best.fp"),
            "best_fp": F.col("_best.fp"),
            "best_fn": F.col("positives_test") - F.col("_best.tp"),
            "best_tp": F.col("_best.tp"),
            "best_n_flagged": F.col("_best.tp") + F.col("_best.fp"),
        }
    ).withColumns(
        {
            **_rates(suffix="_at_half"),
            **{
                f"best_{n}": c
                for n, c in _rates("best_tn", "best_fp", "best_fn", "best_tp").items()
            },
        }
    )
    return with_best.select(
        *by,
        "n_test",
        "positives_test",
        tidy(base, 6).alias("base_rate_test"),
        "roc_auc",
        "pr_auc",
        "brier",
        tidy(_balanced_accuracy(*cells), 6).alias("balanced_accuracy"),
        tidy(_mcc(*cells), 6).alias("mcc"),
        tidy(F.col("pr_auc") / F.nullif(base, F.lit(0.0)), 4).alias("lift_over_base_rate"),
        "tn",
        "fp",
        "fn",
        "tp",
        "precision_at_half",
        "recall_at_half",
        "f1_at_half",
        tidy(F.col("_best.threshold"), 6).alias("best_threshold"),
        "best_precision",
        "best_recall",
        "best_f1",
        "best_tn",
        "best_fp",
        "best_fn",
        "best_tp",
        "best_n_flagged",
        tidy(100.0 * F.col("best_n_flagged") / F.col("n_test"), 3).alias(
            "best_n_flagged_pct_of_test"
        ),
    )


def always_negative(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """``pr_auc`` is the train base rate, as published; the test rate stands beside it."""
    rate = train.agg(F.avg(F.col(label))).scalar()
    return test.agg(
        tidy(F.avg(1 - F.col(label)), 6).alias("accuracy"),
        F.lit(0.0).alias("recall"),
        F.lit(0.5).alias("roc_auc"),
        tidy(F.avg(F.col(label)), 6).alias("base_rate_test"),
    ).withColumn("pr_auc", tidy(rate, 6))


def stratified_random(
    train: DataFrame, test: DataFrame, label: str, repeats: int = 20, key: str = "case_id"
) -> DataFrame:
    """Mean figures of guessing with the train base rate.

    The guess of a row in a repeat depends on a hash of both, so it is the same on
    every run.  All repeats are counted in one pass.
    """
    rate = train.agg(F.avg(F.col(label))).scalar()
    draws = test.withColumn("_rate", rate).select(
        F.col(label).alias("_y"),
        *[
            (_uniform(key, r) < F.col("_rate")).alias(f"_g{r}") for r in range(repeats)
        ],
    )
    yes = F.col("_y") == 1
    totals = draws.agg(
        F.count("*").alias("n"),
        F.count_if(yes).alias("p"),
        F.array(
            *[
                F.struct(
                    F.count_if(F.col(f"_g{r}") & yes).alias("tp"),
                    F.count_if(F.col(f"_g{r}") & ~yes).alias("fp"),
                )
                for r in range(repeats)
            ]
        ).alias("_r"),
    ).select("n", "p", F.inline("_r"))
    tp, fp, p, n = (F.col(c) for c in ("tp", "fp", "p", "n"))
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, p)
    return totals.agg(
        tidy(F.avg(precision), 6).alias("precision_mean"),
        tidy(F.avg(recall), 6).alias("recall_mean"),
        tidy(F.avg(_ratio(2.0 * tp, tp + fp + p)), 6).alias("f1_mean"),
        tidy(F.avg((1 + recall - _ratio(fp, n - p)) / 2), 6).alias("roc_auc_mean"),
        tidy(F.avg(recall * precision + (1 - recall) * p / n), 6).alias("pr_auc_mean"),
        F.count("*").alias("n_repeats"),
    )


def _uniform(key: str, repeat: int) -> Column:
    """A number in [0, 1) from the first eight hex digits of a hash."""
    text = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(repeat))))
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def evaluate_regression(
    scored: DataFrame, train_mean: float | Column, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """Error of the prediction, and of always predicting the train mean."""
    mean = train_mean if isinstance(train_mean, Column) else F.lit(float(train_mean))
    rows = scored.select(
        F.col(actual).cast("double").alias("y"), F.col(predicted).cast("double").alias("p")
    ).withColumn("m", mean)
    y, p, m = F.col("y"), F.col("p"), F.col("m")
    spread = F.nullif(F.var_pop(y) * F.count("*"), F.lit(0.0))
    figures = rows.agg(
        F.count("*").alias("n_test"),
        tidy(F.avg(F.abs(y - p)), 4).alias("mae"),
        tidy(1 - F.sum((y - p) * (y - p)) / spread, 6).alias("r2"),
        tidy(F.avg(F.abs(y - m)), 4).alias("baseline_mae"),
        tidy(1 - F.sum((y - m) * (y - m)) / spread, 6).alias("baseline_r2"),
    )
    return figures.withColumn("spearman", spearman(rows, "y", "p").scalar()).select(
        "n_test", "mae", "r2", "spearman", "baseline_mae", "baseline_r2"
    )


def average_ranks(df: DataFrame, value: str, chunks: int | None = None) -> DataFrame:
    """Rank of each distinct value; equal values share the mean of their places."""
    counts = df.groupBy(value).agg(F.count("*").alias("_n"))
    upto = running_totals(counts, [], [value], {"_upto": "_n"}, chunks)
    return upto.select(
        value, (F.col("_upto") - (F.col("_n") - 1) / 2.0).alias("rank"), F.col("_upto_all").alias("n")
    )


def spearman(df: DataFrame, a: str, b: str, chunks: int | None = None) -> DataFrame:
    """Rank correlation; pairs are counted first, so repeated values are joined once."""
    pairs = df.groupBy(a, b).agg(F.count("*").alias("_c"))
    ra = average_ranks(df, a, chunks).select(a, F.col("rank").alias("_ra"), F.col("n").alias("_n"))
    rb = average_ranks(df, b, chunks).select(b, F.col("rank").alias("_rb"))
    centre = (F.col("_n") + 1) / 2.0
    x, y, c = F.col("_ra") - centre, F.col("_rb") - centre, F.col("_c")
    both = pairs.join(ra, a).join(rb, b)
    scale = F.sqrt(F.sum(c * x * x)) * F.sqrt(F.sum(c * y * y))
    return both.agg(tidy(F.sum(c * x * y) / F.nullif(scale, F.lit(0.0)), 6).alias("spearman"))


def histogram(frame: DataFrame, value: str = "cycle_time_hours", bins: int = 80) -> DataFrame:
    """Equal-width bins between the extremes; the maximum belongs to the last bin."""
    ends = frame.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    placed = frame.where(F.col(value).isNotNull()).select(F.col(value).alias("_v"), ends.alias("_e"))
    lo, hi = F.col("_e.lo"), F.col("_e.hi")
    width = (hi - lo) / bins
    slot = F.least(F.floor((F.col("_v") - lo) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    counts = placed.groupBy(F.coalesce(slot, F.lit(0)).cast("int").alias("bin"), "_e").agg(
        F.count("*").alias("cases")
    )
    return counts.select(
        "bin",
        tidy(lo + F.col("bin") * width, 6).alias("from_hours"),
        tidy(lo + (F.col("bin") + 1) * width, 6).alias("to_hours"),
        "cases",
    ).orderBy("bin")


def histogram_lines(
    frame: DataFrame, value: str = "cycle_time_hours", limit: float = SLA_HOURS
) -> DataFrame:
    row = summarise(frame, [], [F.avg(value).alias("mean")], value, {"median": 0.5, "p95": 0.95})
    return row.select(
        *[tidy(F.col(c), 4).alias(c) for c in ("median", "p95", "mean")],
        F.lit(float(limit)).alias("limit_hours"),
    )


def rule_metrics(frame: DataFrame, rule: Column, label: str) -> DataFrame:
    """A yes/no rule judged like a model; NULL is no."""
    marked = frame.select(
        F.col(label).alias("label"), F.coalesce(rule, F.lit(False)).cast("int").alias("score")
    )
    cells = confusion(marked).withColumns(_rates())
    return cells.withColumn("n_flagged", F.col("tp") + F.col("fp"))


def at_matched(
    points: DataFrame, recall: float | None = None, flagged: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """The curve's first point with at least this recall, or this many flagged rows.

    Without such a point there is no row.
    """
    if (recall is None) == (flagged is None):
        raise ValueError("give either recall or flagged")
    n = F.col("tp") + F.col("fp")
    reached = F.col("recall") >= recall if recall is not None else n >= flagged
    first = points.where(reached).groupBy(*by).agg(
        F.max_by(F.struct("threshold", "tp", "fp", "precision", "recall"), "threshold").alias("_p")
    )
    return first.where(F.col("_p").isNotNull()).select(
        *by,
        F.col("_p.threshold").alias("threshold"),
        (F.col("_p.tp") + F.col("_p.fp")).alias("n_flagged"),
        tidy(F.col("_p.precision"), 6).alias("precision"),
        tidy(F.col("_p.recall"), 6).alias("recall"),
    )
