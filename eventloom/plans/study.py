"""The whole prediction study: diagnostics, splits, models, ablations, regression."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exact import tidy
from ..functions.storage import materialise
from ..study import diagnostics, importance, metrics, models
from ..study.intake import LABELS, intake_checks, intake_frame, require_cases
from ..study.splits import chrono_split, held_out, random_split, split_report, train_of

PRIMARY = "reached_level_3"


def long_form(rows: DataFrame, section: str, keys: Sequence[str] = ()) -> DataFrame:
    """Any small result as ``(section, metric, value)`` with text values."""
    prefix = F.concat_ws("/", F.lit(section), *[F.col(k).cast("string") for k in keys])
    names = [c for c in rows.columns if c not in keys]
    cells = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in names]
    )
    return rows.select(prefix.alias("section"), F.inline(cells))


def split_sensitivity(evaluation: DataFrame, label: str = PRIMARY, model: str = "boosted_trees") -> DataFrame:
    """ROC-AUC of the random split minus that of the chronological split."""
    own = evaluation.where((F.col("label_name") == label) & (F.col("model") == model))

    def auc(split: str):
        return F.max(F.when(F.col("split") == split, F.col("roc_auc")))

    return own.agg(
        auc("chronological").alias("chronological_auc"),
        auc("random").alias("random_auc"),
        tidy(auc("random") - auc("chronological"), 6).alias("delta_random_minus_chrono"),
    )


def run_study(
    log: DataFrame,
    cases: DataFrame,
    out: str | None = None,
    labels: Sequence[str] = tuple(LABELS),
    primary: str = PRIMARY,
    learners: dict | None = None,
    n_repeats: int = 5,
) -> DataFrame:
    """Every figure as ``(section, metric, value)``.

    With ``out`` also as JSON, with the models refitted on all cases and the data behind
    the usual figures: curves, histogram, and the table of descriptions by issue type.
    """
    frame = require_cases(materialise(intake_frame(log, cases), "intake"))
    splits = {
        "chronological": materialise(chrono_split(frame), "chronological"),
        "random": materialise(random_split(frame), "random"),
    }
    chrono = splits["chronological"]
    train, test = train_of(chrono), held_out(chrono)

    grid = models.fit_grid(splits, labels, learners)
    scores = models.score_grid(grid, splits)
    by = ["split", "label_name", "model"]
    evaluation = materialise(metrics.evaluate_binary(scores, by=by), "evaluation")
    ablations = models.ablation_scores(chrono, label=primary)
    linear = grid["chronological", primary, "logistic_regression"]
    forest = grid["chronological", primary, "boosted_trees"]
    regressor = models.gbt_regressor(train)
    train_mean = train.agg(F.avg("cycle_time_hours")).scalar()

    parts = [
        long_form(intake_checks(frame), "intake_frame"),
        long_form(diagnostics.templating(frame), "short_description_templating"),
        long_form(diagnostics.mutual_information(frame), "short_description_templating"),
        long_form(diagnostics.top_values(frame), "short_description_templating/top", ["value"]),
        long_form(diagnostics.score_timing(frame), "customer_satisfaction_timing"),
        long_form(diagnostics.score_by_label(frame, primary), "customer_satisfaction_timing", [primary]),
        long_form(diagnostics.class_balance(frame, labels), "class_balance", ["label_name"]),
        long_form(diagnostics.cycle_time_profile(frame), "class_balance/cycle_time_hours"),
        long_form(diagnostics.segment_profile(frame), "segment_profile", ["segment"]),
        *[long_form(split_report(s), f"splits/{n}", ["is_test"]) for n, s in splits.items()],
        long_form(evaluation, "results", by),
        long_form(metrics.evaluate_binary(ablations, by=["ablation"]), "ablation", ["ablation"]),
        long_form(
            importance.permutation_importance(forest, test, primary, n_repeats=n_repeats),
            "permutation_importance",
            ["feature"],
        ),
        long_form(linear.coefficients(frame), "coefficients", ["feature"]),
        long_form(
            metrics.evaluate_regression(
                regressor.predicted(test, "cycle_time_hours"), train_mean
            ),
            "cycle_time_regression",
        ),
        long_form(split_sensitivity(evaluation, primary), "split_sensitivity"),
    ]
    for name, split in splits.items():
        for label in labels:
            sides = train_of(split), held_out(split)
            section = f"baselines/{name}/{label}"
            parts.append(long_form(metrics.always_negative(*sides, label), f"{section}/always_negative"))
            parts.append(long_form(metrics.stratified_random(*sides, label), f"{section}/stratified_random"))
    report = materialise(reduce(DataFrame.unionByName, parts), "study")
    if out is not None:
        # A few hundred lines, already written: one file for people to read.
        report.coalesce(1).write.mode("overwrite").json(f"{out}/metrics")
        metrics.curve_points(scores, by=by).write.mode("overwrite").parquet(f"{out}/curves")
        metrics.histogram(frame).write.mode("overwrite").parquet(f"{out}/cycle_time_histogram")
        diagnostics.crosstab(frame).write.mode("overwrite").parquet(f"{out}/descriptions_by_issue_type")
        models.logreg(frame, primary).save(f"{out}/model_logistic_regression")
        models.gbt_classifier(frame, primary).save(f"{out}/model_boosted_trees")
    return report
