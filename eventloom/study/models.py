"""Models on the intake frame, and the rows they score.

Scored rows have the columns ``case_id, split, label_name, model, label, score``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import materialise
from ..spec import FOCUS_VARIANT
from .boosting import Boosted, Growth, boost
from .features import (
    CATEGORICAL,
    INTAKE,
    NUMERIC,
    TEMPORAL,
    TEXT,
    FeatureSet,
    FittedFeatures,
    entries,
    fit_features,
    fit_ordinal,
    named_values,
    read_json,
    write_json,
)
from .intake import LABELS
from .splits import SEED, held_out, train_of

VALIDATION_SHARE = 0.15


@dataclass
class Fitted:
    features: FittedFeatures
    model: Model

    def scored(self, frame: DataFrame, label: str, keep: Sequence[str] = ("case_id",)) -> DataFrame:
        rows = self.model.transform(self.features.transform(frame))
        return rows.select(
            *keep,
            F.col(label).cast("int").alias("label"),
            vector_to_array("probability")[1].alias("score"),
        )

    def predicted(self, frame: DataFrame, target: str, keep: Sequence[str] = ("case_id",)) -> DataFrame:
        rows = self.model.transform(self.features.transform(frame))
        return rows.select(
            *keep, F.col(target).alias("actual"), F.col("prediction").alias("predicted")
        )

    def save(self, path: str) -> None:
        self.features.save(f"{path}/features")
        PipelineModel([self.model]).write().overwrite().save(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Fitted:
        return Fitted(FittedFeatures.load(spark, f"{path}/features"), PipelineModel.load(f"{path}/model").stages[0])

    def coefficients(self, frame: DataFrame) -> DataFrame:
        names = self.features.name_table(frame.sparkSession)
        return named_values(names, self.model.coefficients.toArray(), "coefficient")

    def gradient(self, train: DataFrame, label: str) -> DataFrame:
        """``feature, gradient`` of what ``logreg`` minimises, over its train rows: sums of
        weight x (probability - label) x value, plus the coefficient; zero at the solution."""
        weight = balanced_weight(label, *class_sizes(train, label))
        rows = self.model.transform(self.features.transform(train))
        missed = weight * (vector_to_array("probability")[1] - F.col(label))
        rows = materialise(rows.select("features", missed.alias("missed")), "missed")
        sums = entries(rows, ["missed"]).groupBy("position").agg(F.sum(F.col("missed") * F.col("value")).alias("sum"))
        own = self.coefficients(train).join(self.features.name_table(train.sparkSession).withColumnRenamed("name", "feature"), "feature")
        slope = F.coalesce("sum", F.lit(0.0)) + F.col("coefficient")
        parts = own.join(sums, "position", "left").select("feature", slope.alias("gradient"))
        return parts.unionByName(rows.select(F.lit("(intercept)").alias("feature"), "missed").groupBy("feature").agg(F.sum("missed").alias("gradient")))


@dataclass
class Trees:
    """Boosted trees with the features they are grown on."""

    features: FittedFeatures
    model: Boosted

    def _with_score(self, frame: DataFrame, name: str) -> DataFrame:
        values = self.features.transform(frame).withColumn("_values", vector_to_array("features"))
        return values.withColumn(name, self.model.score("_values"))

    def scored(self, frame: DataFrame, label: str, keep: Sequence[str] = ("case_id",)) -> DataFrame:
        rows = self._with_score(frame, "score")
        return rows.select(*keep, F.col(label).cast("int").alias("label"), "score")

    def predicted(self, frame: DataFrame, target: str, keep: Sequence[str] = ("case_id",)) -> DataFrame:
        rows = self._with_score(frame, "predicted")
        return rows.select(*keep, F.col(target).alias("actual"), "predicted")

    def nodes(self, spark: SparkSession) -> DataFrame:
        """All nodes of the trees, their features by name."""
        rows = self.model.node_table(spark)
        names = self.features.name_table(spark).select(F.col("position").alias("feature"), "name")
        return rows.join(F.broadcast(names), "feature", "left").withColumn("feature", F.col("name")).drop("name")

    def save(self, path: str) -> None:
        self.features.save(f"{path}/features")
        write_json(vars(self.model), f"{path}/trees")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Trees:
        return Trees(FittedFeatures.load(spark, f"{path}/features"), Boosted(**read_json(spark, f"{path}/trees")))


def class_sizes(train: DataFrame, label: str) -> tuple[int, int]:
    n, positives = train.agg(F.count("*"), F.sum(F.col(label).cast("bigint"))).first()
    if not n or positives in (0, n):
        raise ValueError(f"{label} has a single class in the train rows")
    return n, positives


def balanced_weight(label: str, n: int, positives: int) -> Column:
    """Both classes weigh the same, and all weights add up to the number of rows."""
    return F.when(F.col(label) == 1, n / (2.0 * positives)).otherwise(n / (2.0 * (n - positives)))


def logreg(
    train: DataFrame,
    label: str,
    features: FeatureSet | FittedFeatures = INTAKE,
    max_iter: int = 2000,
) -> Fitted:
    """L2 with unit strength and balanced classes.

    Spark divides the loss by the sum of weights (= n), so the penalty is 1/n.
    """
    n, positives = class_sizes(train, label)
    fitted = features if isinstance(features, FittedFeatures) else fit_features(train, features)
    rows = fitted.transform(train).select(
        "features",
        F.col(label).cast("double").alias("label"),
        balanced_weight(label, n, positives).alias("weight"),
    )
    learner = LogisticRegression(
        weightCol="weight",
        regParam=1.0 / n,
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
    )
    return Fitted(fitted, learner.fit(rows))


def _validation(key: str = "case_id", seed: int = SEED) -> Column:
    """About one row in seven, picked by a hash of its key."""
    place = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10_000))
    return place < int(VALIDATION_SHARE * 10_000)


ORDINAL = FeatureSet(CATEGORICAL, TEMPORAL)


def _ordinal(train: DataFrame, features: FeatureSet | FittedFeatures) -> FittedFeatures:
    if isinstance(features, FittedFeatures):
        return features
    return fit_ordinal(train, features.categorical, features.numeric)


# Enough for a bin per day of the year or per level of most columns.
MAX_BINS = 256


def gbt_classifier(
    train: DataFrame,
    label: str,
    features: FeatureSet | FittedFeatures = ORDINAL,
    max_iter: int = 300,
    step: float = 0.08,
    seed: int = SEED,
) -> Fitted:
    """Boosted trees on ordinal codes; stops when the validation rows stop improving.

    These are Spark's, grown level by level; ``leafwise_classifier`` grows leaf by leaf.
    """
    class_sizes(train, label)
    fitted = _ordinal(train, features)
    rows = fitted.transform(train).select(
        "features", F.col(label).cast("double").alias("label"), _validation().alias("held_back")
    )
    return Fitted(fitted, GBTClassifier(**_settings(max_iter, step, seed)).fit(rows))


def gbt_regressor(
    train: DataFrame,
    target: str = "cycle_time_hours",
    features: FeatureSet | FittedFeatures = ORDINAL,
    max_iter: int = 400,
    step: float = 0.06,
    seed: int = SEED,
) -> Fitted:
    fitted = _ordinal(train, features)
    rows = fitted.transform(train).select(
        "features", F.col(target).cast("double").alias("label"), _validation().alias("held_back")
    )
    return Fitted(fitted, GBTRegressor(**_settings(max_iter, step, seed)).fit(rows))


def _settings(max_iter: int, step: float, seed: int) -> dict:
    return {
        "maxIter": max_iter,
        "stepSize": step,
        "maxDepth": 5,
        "maxBins": MAX_BINS,
        "minInstancesPerNode": 40,
        "validationIndicatorCol": "held_back",
        "validationTol": 0.0,
        "seed": seed,
    }


def leafwise_classifier(
    train: DataFrame,
    label: str,
    features: FeatureSet | FittedFeatures = ORDINAL,
    growth: Growth = Growth(),
    seed: int = SEED,
) -> Trees:
    """Boosted trees on ordinal codes: 31 leaves of at least 40 rows, L2 of one; they stop
    when the rows held back no longer improve.  A tree takes about ten short jobs."""
    class_sizes(train, label)
    return _boosted(train, label, "logistic", _ordinal(train, features), growth, seed)


def leafwise_regressor(
    train: DataFrame,
    target: str = "cycle_time_hours",
    features: FeatureSet | FittedFeatures = ORDINAL,
    growth: Growth = Growth(rounds=400, rate=0.06),
    seed: int = SEED,
) -> Trees:
    """As ``leafwise_classifier``, for a number."""
    return _boosted(train, target, "squared", _ordinal(train, features), growth, seed)


def _boosted(train: DataFrame, target: str, loss: str, fitted: FittedFeatures, growth: Growth, seed: int) -> Trees:
    rows = fitted.transform(train).withColumn("_values", vector_to_array("features"))
    return Trees(fitted, boost(rows, "_values", target, loss, _validation(seed=seed), growth, len(fitted.named)))


# model name -> (what learns the features, what learns from them)
LEARNERS = {
    "logistic_regression": (fit_features, logreg),
    "boosted_trees": (lambda train: _ordinal(train, ORDINAL), gbt_classifier),
}


def fit_grid(
    splits: dict[str, DataFrame],
    labels: Sequence[str] = tuple(LABELS),
    learners: dict | None = None,
) -> dict[tuple[str, str, str], Fitted]:
    """A model per split, label and learner.  Features do not depend on the label, so
    they are learnt once per split."""
    models = {}
    for split_name, split in splits.items():
        train = train_of(split)
        for model_name, (prepare, learn) in (learners or LEARNERS).items():
            fitted = prepare(train)
            for label in labels:
                models[split_name, label, model_name] = learn(train, label, fitted)
    return models


def score_grid(
    models: dict[tuple[str, str, str], Fitted], splits: dict[str, DataFrame]
) -> DataFrame:
    """Scores of the held-out rows of each model's split."""
    parts = [
        fitted.scored(held_out(splits[split_name]), label).select(
            "case_id",
            F.lit(split_name).alias("split"),
            F.lit(label).alias("label_name"),
            F.lit(model_name).alias("model"),
            "label",
            "score",
        )
        for (split_name, label, model_name), fitted in models.items()
    ]
    return materialise(reduce(DataFrame.unionByName, parts), "scores")


def train_grid(
    splits: dict[str, DataFrame],
    labels: Sequence[str] = tuple(LABELS),
    learners: dict | None = None,
) -> DataFrame:
    return score_grid(fit_grid(splits, labels, learners), splits)


# name -> features; the last one leaves out cases instead
ABLATIONS = {
    "with_variant": FeatureSet([*CATEGORICAL, "variant"], NUMERIC, TEXT),
    "with_satisfaction": FeatureSet(
        CATEGORICAL, [*NUMERIC, "customer_satisfaction"], TEXT, ngrams=(1, 1)
    ),
    "text_only": FeatureSet(text=TEXT),
    "categorical_only": FeatureSet(CATEGORICAL),
    "temporal_only": FeatureSet(numeric=TEMPORAL),
    "without_focus_variant": INTAKE,
}


def ablate(
    split: DataFrame,
    name: str,
    label: str = "reached_level_3",
    focus_variant: str = FOCUS_VARIANT,
    learn: Callable[[DataFrame, str, FeatureSet], Fitted] = logreg,
) -> DataFrame:
    """Scores of one ablation: other features, or without the cases of one variant."""
    if name == "without_focus_variant":
        split = split.where(~F.col("variant").eqNullSafe(F.lit(focus_variant)))
    fitted = learn(train_of(split), label, ABLATIONS[name])
    return fitted.scored(held_out(split), label).select(
        "case_id", F.lit(name).alias("ablation"), "label", "score"
    )


def ablation_scores(
    split: DataFrame,
    names: Sequence[str] = tuple(ABLATIONS),
    label: str = "reached_level_3",
    learn: Callable[[DataFrame, str, FeatureSet], Fitted] = logreg,
) -> DataFrame:
    together = reduce(DataFrame.unionByName, [ablate(split, name, label, learn=learn) for name in names])
    return materialise(together, "ablations")


def segment_auc_scores(
    split: DataFrame,
    feature: str,
    condition: Column,
    label: str,
    learn: Callable[[DataFrame, str, FeatureSet], Fitted] = logreg,
) -> DataFrame:
    """Scores from a single numeric feature inside a segment of the cases."""
    inside = split.where(condition)
    fitted = learn(train_of(inside), label, FeatureSet(numeric=[feature]))
    return fitted.scored(held_out(inside), label)
