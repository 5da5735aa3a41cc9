"""

``user`` queries run on a log built from the ``events`` table, ``shipment`` queries on
one built from ``orders`` and ``lineitem``; the text queries read ``documents``.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle  # noqa: E402
from eventloom.functions.exact import micros_between, tidy  # noqa: E402
from eventloom.functions.storage import materialise, shared_dir  # noqa: E402
from eventloom.operators import analyses, kpis, legacy, provenance, quality, validate, views  # noqa: E402
from eventloom.plans.registry import REPORTS, Views, export_reports  # noqa: E402
from eventloom.plans.reload import reload  # noqa: E402
from eventloom.plans.study import long_form, split_sensitivity  # noqa: E402
from eventloom.sources import dates, raw, sinks  # noqa: E402
from eventloom.sources.adapters import ROW, raw_export, shipment_log, table, user_log  # noqa: E402
from eventloom.spec import COLUMN_MAP  # noqa: E402
from eventloom.study import (  # noqa: E402
    boosting,
    diagnostics,
    features,
    importance,
    intake,
    levels,
    metrics,
    models,
    scorecard,
    splits,
)

try:  # the training-data operators are an optional part
    import corpus_pipeline
    from eventloom.llm import registry as llm
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "eventloom.llm"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
LOG_COLUMNS = list(COLUMN_MAP.values())


def _user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_log(table(spark, sf_dir, "events"))


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shipment_log(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))


def _over(source: Callable[[SparkSession, str], DataFrame], run: Callable[[Views], DataFrame]) -> Query:
    return lambda spark, sf_dir: run(Views(source(spark, sf_dir)))


def _frame(v: Views) -> DataFrame:
    return intake.intake_frame(v.log, views.case_metrics(v.log))


def _on_frame(run: Callable[[DataFrame], DataFrame]) -> Query:
    return _over(_user, lambda v: run(_frame(v)))


def _scored(frame: DataFrame) -> DataFrame:
    """A score without a model: how much of the 72-hour period the case took."""
    return frame.select(
        "case_id",
        "priority",
        F.col("reached_level_3").alias("label"),
        (F.col("cycle_time_hours") / 72.0).alias("score"),
    )


def _on_scores(run: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_frame(lambda f: run(_scored(f)))


def _on_parts(run: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """Train and held-out rows of the chronological split."""

    def query(frame: DataFrame) -> DataFrame:
        split = splits.chrono_split(frame)
        return run(splits.train_of(split), splits.held_out(split))

    return _on_frame(query)


def _rounded(points: DataFrame) -> DataFrame:
    figures = [c for c in ("threshold", "precision", "recall", "fpr") if c in points.columns]
    return points.withColumns({c: tidy(F.col(c), 6) for c in figures})


# Ingest.


def _typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = raw_export(_user(spark, sf_dir), mixed=True)
    typed = raw.type_events(raw.normalize_columns(text, COLUMN_MAP | {ROW: "source_row"}))
    return typed.select("source_row", *LOG_COLUMNS)


def _event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = raw_export(_user(spark, sf_dir))
    typed = raw.type_events(raw.normalize_columns(text, COLUMN_MAP | {ROW: "source_row"}))
    numbered = raw.assign_event_ids(typed, ["source_row"])
    return numbered.select("event_id", "case_id", "event_timestamp", "event")


def _reloaded_case_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out to delimited text, back in, written as a published log, read again."""
    folder = f"{shared_dir(spark).rstrip('/')}/reload/{uuid.uuid4().hex}"
    text = raw_export(_user(spark, sf_dir), mixed=True)
    ordered = text.repartitionByRange(ROW).sortWithinPartitions(ROW).drop(ROW)
    # Texts hold quotes and delimiters.
    ordered.write.csv(f"{folder}/raw", sep=";", header=True, quote='"', escape='"')
    log = sinks.write_log(raw.load_log(spark, f"{folder}/raw"), f"{folder}/log")
    return views.case_table(log)


def _load_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _user(spark, sf_dir)
    folder = f"{shared_dir(spark).rstrip('/')}/parity/{uuid.uuid4().hex}"
    return validate.parity(log, sinks.write_log(log, folder))


def _short_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _user(spark, sf_dir)
    return validate.parity(log, log.where(F.col("resolver").isNotNull()))


def _median_imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _user(spark, sf_dir).select("event_id", F.col("customer_satisfaction").alias("score"))
    return raw.impute_median(scores, ["score"])


def _exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every exported report file."""
    folder = f"{shared_dir(spark).rstrip('/')}/reports/{uuid.uuid4().hex}"
    export_reports(Views(_user(spark, sf_dir)), folder)
    lines = spark.read.text(folder, recursiveFileLookup=True)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    return lines.select(name.alias("report"), F.col("value").alias("line"))


def _counted_exports(spark: SparkSession, sf_dir: str, group: str | None = None) -> DataFrame:
    """Rows of each exported report, of one group or of all."""
    folder = f"{shared_dir(spark).rstrip('/')}/reports/{uuid.uuid4().hex}"
    paths = export_reports(Views(_user(spark, sf_dir)), folder, group=group, fmt="parquet")
    counts = [spark.read.parquet(p).agg(F.lit(name).alias("report"), F.count("*").alias("n")) for name, p in paths.items()]
    return reduce(DataFrame.unionByName, counts)


def _unloaded_case_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The case table of an export that is not stored as a log.

    A reload refuses logs with cases of a single event, so those are left to ``min_events``.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/reload/{uuid.uuid4().hex}"
    log = _user(spark, sf_dir)
    alone = log.groupBy("case_id").agg(F.count("*").alias("n")).where("n < 2")
    text = raw_export(log.join(alone, "case_id", "left_anti"), mixed=True)
    ordered = text.repartitionByRange(ROW).sortWithinPartitions(ROW).drop(ROW)
    ordered.write.csv(folder, sep=";", header=True, quote='"', escape='"')
    return reload(spark, folder)


def _cleaned_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export with untidy headers, by the names that cleaning gives them."""
    text = raw_export(_user(spark, sf_dir))
    untidy = text.toDF(*[f" {c.upper()} " for c in text.columns])
    wanted = ["row", "case_id", "issue_type", "report_channel", "short_description"]
    return raw.require_columns(raw.clean_headers(untidy), wanted).select(*wanted)


def _log_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log after two loads, a load that was overtaken, and one that was never published."""
    log = _user(spark, sf_dir)
    folder = f"{shared_dir(spark).rstrip('/')}/versions/{uuid.uuid4().hex}"
    sinks.write_log(log, folder, after=0)
    sinks.write_log(log.where(F.col("resolver").isNotNull()), folder, after=1)
    try:
        sinks.write_log(log.where("priority = 'High'"), folder, after=1)
    except sinks.Overtaken:
        sinks.write_version(log.where("priority = 'Low'"), folder, uuid.uuid4().hex)
    return sinks.audit(spark, folder).drop("version", "published_at")


def _loose_clock(ts: Column, kind: Column) -> Column:
    """A time in one of six spellings that no exact format reads."""
    day, month, year = F.dayofmonth(ts), F.month(ts), F.year(ts)
    hour, minute = F.hour(ts), F.minute(ts)
    second = F.floor(F.extract(F.lit("SECOND"), ts)).cast("int")
    name = F.element_at(F.array(*[F.lit(m) for m in dates.MONTHS]), month)
    half = F.when(hour < 12, "am").otherwise("PM")
    of_twelve = (hour + 11) % 12 + 1
    return (
        F.when(kind == 0, F.format_string("%d %s %d %d:%02d %s", day, F.initcap(name), year, of_twelve, minute, half))
        .when(kind == 1, F.format_string("%s %dth, %d at %02d:%02d:%02d", name, day, year, hour, minute, second))
        .when(kind == 2, F.format_string("%d/%d/%02d %d:%02d", day, month, year % 100, hour, minute))
        .when(kind == 3, F.format_string("Friday, %d-%s-%02d %d%s", day, F.upper(name), year % 100, of_twelve, half))
        .when(kind == 4, F.format_string("%04d%02d%02d %02d:%02d:%02d", year, month, day, hour, minute, second))
        .otherwise(F.format_string("%d %s %d %d:%02d UTC", day, name, year, hour, minute))
    )


def _lenient_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _user(spark, sf_dir)
    text = log.select("event_id", _loose_clock(F.col("event_timestamp"), F.col("event_id") % 6).alias("text"))
    return text.select("event_id", raw.parse_ts("text").alias("event_timestamp"))


def _timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop mode: rows whose time no spelling explains go."""
    text = raw_export(_user(spark, sf_dir), mixed=True)
    typed = raw.normalize_columns(text, COLUMN_MAP | {ROW: "source_row"})
    spoilt = F.when(F.col("source_row") % 11 == 0, "some day").otherwise(F.col("event_timestamp"))
    rows = raw.type_events(typed.withColumn("event_timestamp", spoilt), bad_timestamps="drop")
    return rows.select("source_row", "event_timestamp")


def _used_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the columns that hold any value."""
    log = _user(spark, sf_dir).withColumn("notes", F.lit(None).cast("string"))
    kept = raw.drop_empty_columns(log)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).isNotNull().cast("long").alias("n")) for c in kept.columns])
    return kept.select(F.inline(cells)).groupBy("column").agg(F.sum("n").alias("n"))


# Analyses that need more than one view.


def _example_trace(v: Views) -> DataFrame:
    slowest = kpis.slowest_cases(v.cases, 1).first()["case_id"]
    return legacy.example_trace(v.log, slowest)


def _attribution_compared(v: Views) -> DataFrame:
    """Mean time charged to a state forward, against backward."""
    forward = v.transitions.groupBy(F.col("from_event").alias("metric")).agg(
        tidy(F.avg("duration_hours"), 3).alias("value")
    )
    steps = views.with_neighbours(v.log, before=["event_timestamp"])
    wait = micros_between("prev_event_timestamp", "event_timestamp")
    backward = (
        steps.where(F.col("prev_event_timestamp").isNotNull())
        .groupBy(F.col("event").alias("metric"))
        .agg(tidy(F.sum(wait) / F.count("*") / 3.6e9, 3).alias("value"))
    )
    return analyses.compare_metrics(forward, backward)


def _regression(v: Views) -> DataFrame:
    predicted = materialise(
        v.cases.select(
            "case_id",
            F.col("cycle_time_hours").alias("actual"),
            (F.col("event_count") * 8.0).alias("predicted"),
        ),
        "predicted",
    )
    return metrics.evaluate_regression(predicted, predicted.agg(F.avg("actual")).scalar())


# Features of the models, as tables.


def _entries_of(fitted: features.FittedFeatures, rows: DataFrame) -> DataFrame:
    names = fitted.name_table(rows.sparkSession)
    cells = features.entries(fitted.transform(rows), ["case_id"]).join(names, "position")
    return cells.select("case_id", F.col("name").alias("feature"), tidy(F.col("value"), 6).alias("value")).where("value <> 0")


def _one_hot(train: DataFrame, test: DataFrame) -> DataFrame:
    return _entries_of(features.fit_features(train, features.FeatureSet(features.CATEGORICAL)), test)


def _scaled(train: DataFrame, test: DataFrame) -> DataFrame:
    return _entries_of(features.fit_features(train, features.FeatureSet(numeric=features.NUMERIC)), test)


def _feature_rows(train: DataFrame, test: DataFrame) -> DataFrame:
    """Places in the assembled vector: levels first, then numbers."""
    fitted = features.fit_features(train, features.FeatureSet(features.CATEGORICAL, features.NUMERIC))
    cells = features.entries(fitted.transform(test), ["case_id"])
    return cells.select("case_id", "position", tidy(F.col("value"), 6).alias("value")).where("value <> 0")


def _ordinal(train: DataFrame, test: DataFrame) -> DataFrame:
    fitted = features.fit_ordinal(train)
    cells = fitted.transform(test).select("case_id", F.posexplode(vector_to_array("features")).alias("position", "code"))
    names = fitted.name_table(test.sparkSession)
    return cells.join(F.broadcast(names), "position").select("case_id", F.col("name").alias("feature"), "code")


def _level_table(train: DataFrame, test: DataFrame) -> DataFrame:
    return levels.learn_levels(train, features.CATEGORICAL).table


def _first_tree(train: DataFrame, test: DataFrame) -> DataFrame:
    """The first splits of a boosted model: all train rows, four leaves."""
    growth = boosting.Growth(rounds=1, leaves=4)
    fitted = features.fit_ordinal(train)
    rows = fitted.transform(train).withColumn("values", vector_to_array("features"))
    grown = boosting.boost(rows, "values", MODEL_LABEL, "logistic", F.lit(False), growth, len(fitted.named))
    nodes = models.Trees(fitted, grown).nodes(train.sparkSession)
    return nodes.select("node", "feature", "threshold", "left", "right", tidy(F.col("value"), 8).alias("value"), "rows")


def _logistic_gradient(train: DataFrame, test: DataFrame) -> DataFrame:
    """What the fitted model's objective still gains along each feature: nothing."""
    fitted = models.logreg(train, MODEL_LABEL, features.FeatureSet(features.CATEGORICAL, features.NUMERIC))
    slopes = fitted.gradient(train, MODEL_LABEL)
    return slopes.select("feature", F.abs(F.round("gradient", 1)).alias("gradient"))


def _model_round_trip(train: DataFrame, test: DataFrame) -> DataFrame:
    """Scores of models that were saved and read in another session, against their own."""
    spark = train.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    few = features.FeatureSet(features.CATEGORICAL, features.NUMERIC)
    both = {"logistic_regression": models.logreg(train, MODEL_LABEL, few), "boosted_trees": models.leafwise_classifier(train, MODEL_LABEL, growth=boosting.Growth(rounds=2))}
    parts = []
    for name, fitted in both.items():
        fitted.save(f"{folder}/{name}")
        again = type(fitted).load(spark.newSession(), f"{folder}/{name}")
        own = fitted.scored(test, MODEL_LABEL).withColumnRenamed("score", "own")
        apart = own.join(again.scored(test, MODEL_LABEL).select("case_id", "score"), "case_id")
        parts.append(apart.agg(F.lit(name).alias("model"), F.count("*").alias("cases"), F.max(F.abs(F.col("own") - F.col("score"))).alias("difference")))
    return parts[0].unionByName(parts[1])


# Models: no SQL says what they should score.

MODEL_LABEL = "reached_level_3"


def _logreg_evaluation(train: DataFrame, test: DataFrame) -> DataFrame:
    scores = models.logreg(train, MODEL_LABEL).scored(test, MODEL_LABEL)
    return metrics.evaluate_binary(materialise(scores, "scores"))


def _coefficients(train: DataFrame, test: DataFrame) -> DataFrame:
    return models.logreg(train, MODEL_LABEL).coefficients(train)


def _boosted_evaluation(train: DataFrame, test: DataFrame) -> DataFrame:
    scores = models.gbt_classifier(train, MODEL_LABEL).scored(test, MODEL_LABEL)
    return metrics.evaluate_binary(materialise(scores, "scores"))


def _leafwise_evaluation(train: DataFrame, test: DataFrame) -> DataFrame:
    """Twelve rounds of trees grown leaf by leaf."""
    scores = models.leafwise_classifier(train, MODEL_LABEL, growth=boosting.Growth(rounds=12)).scored(test, MODEL_LABEL)
    return metrics.evaluate_binary(materialise(scores, "scores"))


def _cycle_time_regression(train: DataFrame, test: DataFrame) -> DataFrame:
    predicted = materialise(
        models.gbt_regressor(train).predicted(test, "cycle_time_hours"), "predicted"
    )
    return metrics.evaluate_regression(predicted, train.agg(F.avg("cycle_time_hours")).scalar())


def _permutation_importance(train: DataFrame, test: DataFrame) -> DataFrame:
    fitted = models.gbt_classifier(train, MODEL_LABEL)
    return importance.permutation_importance(fitted, test, MODEL_LABEL)


def _grid(frame: DataFrame) -> DataFrame:
    frame = materialise(frame, "intake")
    both = {"chronological": splits.chrono_split(frame), "random": splits.random_split(frame)}
    scores = models.train_grid(both, [MODEL_LABEL])
    return metrics.evaluate_binary(scores, by=["split", "label_name", "model"])


def _sensitivity(frame: DataFrame) -> DataFrame:
    return split_sensitivity(materialise(_grid(frame), "grid"), MODEL_LABEL)


def _ablations(frame: DataFrame) -> DataFrame:
    scores = models.ablation_scores(splits.chrono_split(frame), label=MODEL_LABEL)
    return metrics.evaluate_binary(scores, by=["ablation"])


def _single_feature(frame: DataFrame) -> DataFrame:
    scores = models.segment_auc_scores(
        splits.chrono_split(frame), "created_hour", F.col("issue_type") == "Bug", MODEL_LABEL
    )
    return metrics.evaluate_binary(materialise(scores, "scores"))


# The same with scores that SQL can say.


def _scorecard_points(train: DataFrame, test: DataFrame) -> DataFrame:
    card = scorecard.learn_scorecard(train, MODEL_LABEL, features.INTAKE)
    return card.points.select("feature", "level", F.col("points").cast("double").alias("points"))


def _scorecard_grid(frame: DataFrame) -> DataFrame:
    frame = materialise(frame, "intake")
    both = {"chronological": splits.chrono_split(frame), "random": splits.random_split(frame)}
    scores = models.train_grid(both, [MODEL_LABEL], scorecard.scorecard_learner(features.INTAKE))
    return metrics.evaluate_binary(scores, by=["split", "label_name", "model"])


def _scorecard_evaluation(frame: DataFrame) -> DataFrame:
    return _scorecard_grid(frame).drop("label_name", "model")


def _scorecard_sensitivity(frame: DataFrame) -> DataFrame:
    return split_sensitivity(materialise(_scorecard_grid(frame), "grid"), MODEL_LABEL, "scorecard")


def _scorecard_ablations(frame: DataFrame) -> DataFrame:
    split = materialise(splits.chrono_split(frame), "chronological")
    scores = models.ablation_scores(split, label=MODEL_LABEL, learn=scorecard.learn_scorecard)
    return metrics.evaluate_binary(scores, by=["ablation"])


def _scorecard_in_segment(frame: DataFrame) -> DataFrame:
    split = materialise(splits.chrono_split(frame), "chronological")
    scores = models.segment_auc_scores(
        split, "created_hour", F.col("issue_type") == "Bug", MODEL_LABEL, scorecard.learn_scorecard
    )
    points = metrics.curve_points(materialise(scores, "scores"))
    return metrics.ranking_metrics(points)


def _scorecard_importance(train: DataFrame, test: DataFrame) -> DataFrame:
    card = scorecard.learn_scorecard(train, MODEL_LABEL, features.INTAKE)
    return importance.permutation_importance(card, test, MODEL_LABEL)


def _text_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of a document from its words: TF-IDF and logistic regression."""
    labelled = (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id")
        .select(F.col("doc_id").alias("case_id"), "text", "quality")
    )
    split = splits.random_split(labelled)
    words = features.FeatureSet(text="text")
    fitted = models.logreg(splits.train_of(split), "quality", words)
    return metrics.evaluate_binary(materialise(fitted.scored(splits.held_out(split), "quality"), "scores"))


def _study_long_form(frame: DataFrame) -> DataFrame:
    return long_form(diagnostics.class_balance(frame), "class_balance", ["label_name"])


def entry(spark: SparkSession) -> DataFrame:
    """Cycle time and SLA breach by priority, from raw events."""
    return kpis.sla_by(views.case_metrics(_user(spark, SMOKE_DIR)))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {r.name: _over(_user, r.run) for r in REPORTS}
    q |= {
        # Metric views and the case table.
        "case_metrics": _over(_user, lambda v: views.case_metrics(v.log)),
        "transition_metrics": _over(_user, lambda v: views.transition_metrics(v.log)),
        "transition_metrics_bridged": _over(
            _user, lambda v: views.transition_metrics(v.log, null_event="bridge")
        ),
        "step_gaps": _over(_user, lambda v: views.step_gaps(v.log)),
        "case_table": _over(_user, lambda v: views.case_table(v.log)),
        # Variants of standard reports.
        "ordering_defects": _over(_user, lambda v: quality.ordering_defects(v.transitions, v.log)),
        "priority_multiplier_mean": _over(
            _user, lambda v: provenance.priority_multiplier(v.transitions, stat="mean")
        ),
        # Ingest and validation.
        "typed_events": _typed_events,
        "lenient_timestamps": _lenient_timestamps,
        "timed_events": _timed_events,
        "used_columns": _used_columns,
        "filled_text": _over(_user, lambda v: raw.fill_unknown(v.log, ["event"], "Unknown").select("event_id", "event")),
        "complete_transitions": _over(
            _user, lambda v: raw.drop_incomplete(v.transitions).select("case_id", "from_event", "to_event", "duration_hours")
        ),
        "event_ids": _event_ids,
        "reloaded_case_table": _reloaded_case_table,
        "profile": _over(_user, lambda v: raw.profile(v.log)),
        "duplicate_events": _over(_shipments, lambda v: validate.duplicate_events(v.log)),
        "constant_dims": _over(_user, lambda v: validate.check_constant(v.log)),
        "attribute_variation": _over(
            _user,
            lambda v: analyses.attribute_variation(
                v.log, [*views.CASE_DIMS, "short_description", "resolver"]
            ),
        ),
        "min_events": _over(_user, lambda v: validate.short_cases(v.log)),
        "validation_summary": _over(_shipments, lambda v: validate.validation_summary(v.log)),
        "load_parity": _load_parity,
        "parity_of_short_load": _short_load,
        "median_imputed": _median_imputed,
        "resolver_missing_flag": _over(
            _user,
            lambda v: raw.flag_missing_resolver(v.log).select("event_id", "resolver", "resolver_missing"),
        ),
        "exported_reports": _exported,
        "exported_rows": _counted_exports,
        "exported_group": lambda spark, d: _counted_exports(spark, d, "bottlenecks"),
        "unloaded_case_table": _unloaded_case_table,
        "cleaned_headers": _cleaned_headers,
        "log_versions": _log_versions,
        # Superseded analyses.
        "backward_bottlenecks": _over(_user, lambda v: legacy.backward_bottlenecks(v.log)),
        "legacy_case_cycle": _over(_user, lambda v: legacy.legacy_case_cycle(v.log)),
        "legacy_step_kpis": _over(_user, lambda v: legacy.legacy_step_kpis(v.log)),
        "level_2_involvement": _over(_user, lambda v: legacy.involvement_flag(v.log)),
        "variant_performance": _over(_user, lambda v: legacy.variant_performance(views.case_table(v.log))),
        "issue_type_performance": _over(
            _user, lambda v: legacy.dimension_performance(views.case_table(v.log), "issue_type")
        ),
        "report_channel_performance": _over(
            _user, lambda v: legacy.dimension_performance(views.case_table(v.log), "report_channel")
        ),
        "overall_percentiles": _over(_user, lambda v: legacy.overall_percentiles(views.case_table(v.log))),
        "ranked_bottlenecks": _over(_user, lambda v: legacy.ranked_bottlenecks(v.transitions)),
        "repetition_table": _over(_user, lambda v: legacy.repetition_table(v.log)),
        "example_trace": _over(_user, _example_trace),
        # Single-question analyses.
        "dwell_multiplier": _over(_user, lambda v: analyses.dwell_multiplier(v.transitions)),
        "segment_profile": _on_frame(
            lambda f: diagnostics.segment_profile(f, ["Variant 6", "Variant 7"])
        ),
        "segment_issue_types": _on_frame(diagnostics.segment_issue_types),
        "dimension_mix": _over(_user, lambda v: analyses.dimension_mix(v.cases)),
        "mean_hours_in_segment": _over(
            _user, lambda v: analyses.mean_hours_in_segment(v.cases, F.col("issue_type") == "Bug")
        ),
        "top_state_share": _over(_user, lambda v: analyses.top_state_share(v.transitions)),
        "gap_spread_by_case": _over(_user, lambda v: analyses.gap_spread_by_case(v.log)),
        "gap_spread_by_position": _over(_user, lambda v: analyses.gap_spread_by_position(v.log)),
        "label_covered_by": _over(_user, lambda v: analyses.label_covered_by(v.cases)),
        "always_seen_transitions": _over(
            _user, lambda v: analyses.always_seen_transitions(v.transitions, 25.0)
        ),
        "what_if": _over(_user, lambda v: analyses.what_if(v.transitions, v.cases)),
        "dwell_by_state": _over(_user, lambda v: analyses.dwell_by_state(v.transitions)),
        "label_by_dimension": _over(_user, lambda v: analyses.label_by_dimension(v.cases)),
        "compare_metrics": _over(_user, _attribution_compared),
        # Intake frame and diagnostics.
        "first_event": _over(_user, lambda v: intake.first_event(v.log)),
        "intake_frame": _on_frame(lambda f: f),
        "intake_checks": _on_frame(intake.intake_checks),
        "templating": _on_frame(diagnostics.templating),
        "top_values": _on_frame(diagnostics.top_values),
        "crosstab": _on_frame(diagnostics.crosstab),
        "mutual_information": _on_frame(diagnostics.mutual_information),
        "score_timing": _on_frame(diagnostics.score_timing),
        "score_by_label": _on_frame(diagnostics.score_by_label),
        "class_balance": _on_frame(diagnostics.class_balance),
        "class_balance_long_form": _on_frame(_study_long_form),
        "cycle_time_profile": _on_frame(diagnostics.cycle_time_profile),
        "chrono_split": _on_frame(splits.chrono_split),
        "random_split": _on_frame(splits.random_split),
        "split_report": _on_frame(lambda f: splits.split_report(splits.chrono_split(f))),
        # Evaluation.
        "curve_points": _on_scores(lambda s: _rounded(metrics.curve_points(s))),
        "ranking_metrics": _on_scores(
            lambda s: metrics.ranking_metrics(metrics.curve_points(s, by=["priority"]), ["priority"])
        ),
        "best_f1": _on_scores(lambda s: _rounded(metrics.best_f1(metrics.curve_points(s)))),
        "confusion": _on_scores(lambda s: metrics.confusion(s, by=["priority"])),
        "evaluate_binary": _on_scores(lambda s: metrics.evaluate_binary(s, by=["priority"])),
        "always_negative": _on_parts(lambda a, b: metrics.always_negative(a, b, "reached_level_3")),
        "stratified_random": _on_parts(lambda a, b: metrics.stratified_random(a, b, "reached_level_3")),
        "evaluate_regression": _over(_user, _regression),
        "cycle_histogram": _on_frame(metrics.histogram),
        "histogram_lines": _on_frame(metrics.histogram_lines),
        "rule_vs_model": _on_frame(
            lambda f: metrics.rule_metrics(f, F.col("priority") == "Low", "slow_24h")
        ),
        "two_predicate_rule": _on_frame(
            lambda f: metrics.rule_metrics(
                f, (F.col("issue_type") == "Bug") & (F.col("priority") == "Low"), "reached_level_3"
            )
        ),
        "matched_recall": _on_scores(
            lambda s: _rounded(metrics.at_matched(metrics.curve_points(s), recall=0.5))
        ),
        "matched_flags": _on_scores(
            lambda s: _rounded(metrics.at_matched(metrics.curve_points(s), flagged=300))
        ),
        # Text features over whole documents.
        "tfidf_vocabulary": lambda spark, d: features.vocabulary(table(spark, d, "documents"), "text"),
        "tfidf_weights": lambda spark, d: features.tfidf_weights(
            table(spark, d, "documents"), "doc_id", "text"
        ),
        # Features of the models.
        "category_levels": _on_parts(_level_table),
        "one_hot_features": _on_parts(_one_hot),
        "scaled_features": _on_parts(_scaled),
        "ordinal_codes": _on_parts(_ordinal),
        "feature_rows": _on_parts(_feature_rows),
        # Models.
        "boosted_first_tree": _on_parts(_first_tree),
        "logistic_gradient": _on_parts(_logistic_gradient),
        "model_round_trip": _on_parts(_model_round_trip),
        "logistic_regression": _on_parts(_logreg_evaluation),
        "coefficients": _on_parts(_coefficients),
        "boosted_trees": _on_parts(_boosted_evaluation),
        "leafwise_trees": _on_parts(_leafwise_evaluation),
        "cycle_time_regression": _on_parts(_cycle_time_regression),
        "permutation_importance": _on_parts(_permutation_importance),
        "train_grid": _on_frame(_grid),
        "split_sensitivity": _on_frame(_sensitivity),
        "ablations": _on_frame(_ablations),
        "single_feature_in_segment": _on_frame(_single_feature),
        "text_model": _text_model,
        "scorecard_points": _on_parts(_scorecard_points),
        "scorecard_evaluation": _on_frame(_scorecard_evaluation),
        "scorecard_sensitivity": _on_frame(_scorecard_sensitivity),
        "scorecard_ablations": _on_frame(_scorecard_ablations),
        "scorecard_in_segment": _on_frame(_scorecard_in_segment),
        "scorecard_importance": _on_parts(_scorecard_importance),
        # The same operators on the larger log of shipments.
        "shipment_case_metrics": _over(_shipments, lambda v: views.case_metrics(v.log)),
        "shipment_transition_metrics": _over(_shipments, lambda v: views.transition_metrics(v.log)),
    }
    for name in (
        "kpi_overall",
        "kpi_by_variant",
        "priority_sla",
        "time_by_state",
        "transition_bottlenecks",
        "path_determinism",
        "rework_events",
    ):
        report = next(r for r in REPORTS if r.name == name)
        q[f"shipment_{name}"] = _over(_shipments, report.run)
    if llm:
        q |= llm.QUERIES | {"pipeline": corpus_pipeline.run}
    return q


def oracle_sql() -> dict[str, str]:
    sql = oracle.oracle_sql()
    if llm:
        sql |= llm.ORACLES
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
