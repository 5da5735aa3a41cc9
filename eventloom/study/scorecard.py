"""Scores as sums of points: a model of which every step is a join or a sum.

A level of a column is worth its log-odds of the label among the train rows, less those of
all train rows, each with one more case of both classes.  Points have six decimals and are
added up exactly, so scores depend neither on the order of rows nor on how they are dealt.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import tidy
from ..functions.storage import materialise
from .features import FeatureSet
from .models import class_sizes

POINTS = "decimal(18,6)"


@dataclass
class Names:
    names: list[str]


@dataclass
class Scorecard:
    """``points`` is a table ``feature, level, points``; a NULL level is a level too."""

    features: Names
    points: DataFrame
    base: float
    key: str = "case_id"

    def scored(self, frame: DataFrame, label: str, keep: Sequence[str] = ("case_id",)) -> DataFrame:
        """The chance of the label; ``key`` and ``keep`` together name a row.

        Levels that no train row has are worth nothing.
        """
        row = list(dict.fromkeys([self.key, *keep]))
        cells = frame.select(
            *row, F.col(label).cast("int").alias("_label"), F.inline(_cells(self.features.names, "_feature", "_level"))
        )
        worth = self.points.select(F.col("feature").alias("_of"), F.col("level").alias("_value"), F.col("points").alias("_points"))
        same = (F.col("_feature") == F.col("_of")) & F.col("_level").eqNullSafe(F.col("_value"))
        known = cells.join(worth, same, "left")
        total = F.coalesce(F.sum("_points"), F.lit(0)).cast("double") + F.lit(self.base)
        sums = known.groupBy(*row, F.col("_label").alias("label")).agg((1 / (1 + F.exp(-total))).alias("score"))
        return sums.select(*keep, "label", "score")


def _cells(columns: Sequence[str], feature: str = "feature", level: str = "level") -> Column:
    """The named columns as an array of ``(feature, level)``."""
    return F.array(*[F.struct(F.lit(c).alias(feature), F.col(c).cast("string").alias(level)) for c in columns])


def columns_of(features: FeatureSet) -> list[str]:
    """Every column once; a text counts as a level, as a whole."""
    return list(dict.fromkeys([*features.categorical, *features.numeric, *([features.text] if features.text else [])]))


def learn_scorecard(train: DataFrame, label: str, features: FeatureSet, key: str = "case_id") -> Scorecard:
    """Points from one pass over the train rows; both classes must occur in them."""
    n, positives = class_sizes(train, label)
    base = math.log((positives + 1) / (n - positives + 1))
    columns = columns_of(features)
    cells = train.select(F.col(label).cast("bigint").alias("label"), F.inline(_cells(columns)))
    counts = cells.groupBy("feature", "level").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    odds = F.log((F.col("pos") + 1) / (F.col("neg") + 1)) - F.lit(base)
    points = counts.select("feature", "level", tidy(odds, 6).cast(POINTS).alias("points"))
    return Scorecard(Names(columns), materialise(points, "points"), round(base, 6), key)


def scorecard_learner(features: FeatureSet) -> dict:
    """A learner of scorecards on ``features`` for ``models.train_grid``."""
    return {"scorecard": (lambda train: features, learn_scorecard)}
