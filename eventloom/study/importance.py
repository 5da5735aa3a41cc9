"""How much a model's ranking suffers when one feature is shuffled."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exact import tidy
from ..functions.ordered import global_rank
from ..functions.storage import materialise
from .metrics import curve_points, ranking_metrics
from .models import Fitted
from .splits import SEED


def placed_rows(frame: DataFrame, key: str = "case_id") -> DataFrame:
    """The rows numbered by key: the same for all repeats."""
    return global_rank(frame, [key], "_place").drop("_place_all")


def shuffled_copies(
    frame: DataFrame,
    features: Sequence[str],
    repeat: int,
    seed: int = SEED,
    key: str = "case_id",
    placed: DataFrame | None = None,
) -> DataFrame:
    """One copy of the rows per feature, in which that column comes from another row.

    Rows are numbered in two orders, by key and by a hash of key, seed and repeat; the
    row at place i of the first order takes the value at place i of the second.  All
    features of a repeat share the permutation, so it costs one join.  ``placed`` is
    ``placed_rows`` of the frame, where several repeats share it.
    """
    chance = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)), F.lit(str(repeat))))
    fixed = placed_rows(frame, key) if placed is None else placed
    donors = global_rank(frame.withColumn("_chance", chance), ["_chance", key], "_place").select(
        "_place", F.struct(*features).alias("_donor")
    )
    paired = fixed.join(donors, "_place").withColumn(
        "feature", F.explode(F.array(*[F.lit(c) for c in features]))
    )
    return paired.withColumns(
        {
            c: F.when(F.col("feature") == c, F.col(f"_donor.{c}")).otherwise(F.col(c))
            for c in features
        }
    ).select(*frame.columns, "feature", F.lit(repeat).alias("repeat"))


def permutation_importance(
    model: Fitted,
    frame: DataFrame,
    label: str,
    features: Sequence[str] | None = None,
    n_repeats: int = 5,
    seed: int = SEED,
) -> DataFrame:
    """Mean and spread of the loss in average precision, per feature."""
    features = list(features or model.features.names)
    frame = materialise(frame, "importance")
    whole = ranking_metrics(curve_points(materialise(model.scored(frame, label), "scores"))).first()["pr_auc"]
    placed = placed_rows(frame)
    scores = reduce(
        DataFrame.unionByName,
        [
            model.scored(
                shuffled_copies(frame, features, repeat, seed, placed=placed), label, keep=["feature", "repeat"]
            )
            for repeat in range(n_repeats)
        ],
    )
    # Ranking reads its rows several times; the model should score them once.
    scores = materialise(scores, "scores")
    by = ["feature", "repeat"]
    shuffled = ranking_metrics(curve_points(scores, by=by), by)
    drop = F.lit(float(whole)) - F.col("pr_auc")
    return (
        shuffled.groupBy("feature")
        .agg(
            tidy(F.avg(drop), 6).alias("permutation_importance_mean"),
            tidy(F.stddev_pop(drop), 6).alias("permutation_importance_std"),
        )
        .orderBy(F.col("permutation_importance_mean").desc(), "feature")
    )
