"""Train and test rows of exact sizes, without a sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import global_rank

TEST_SHARE = 0.30
SEED = 42


def _cut(frame: DataFrame, order: list, test: float, chunks: int | None) -> DataFrame:
    ranked = global_rank(frame, order, "_rank", chunks)
    # Half-way sizes go to the even number: 0.3 * 15 rows are 4.
    size = F.bround(F.col("_rank_all") * F.lit(float(test)), 0).cast("bigint")
    return ranked.withColumn("is_test", F.col("_rank") > F.col("_rank_all") - size).drop(
        "_rank", "_rank_all"
    )


def chrono_split(frame: DataFrame, test: float = TEST_SHARE, chunks: int | None = None) -> DataFrame:
    """The latest cases are the test rows; equal times are ordered by case."""
    return _cut(frame, ["created_at", "case_id"], test, chunks)


def random_split(
    frame: DataFrame, test: float = TEST_SHARE, seed: int = SEED, chunks: int | None = None
) -> DataFrame:
    """Order by a hash of case and seed: the same rows however data is partitioned."""
    place = F.md5(F.concat_ws("|", F.col("case_id").cast("string"), F.lit(str(seed))))
    split = _cut(frame.withColumn("_place", place), ["_place", "case_id"], test, chunks)
    return split.drop("_place")


def split_report(split: DataFrame) -> DataFrame:
    """Sizes and time range of both parts, and cases that share the cut's timestamp."""
    parts = split.groupBy("is_test").agg(
        F.count("*").alias("cases"),
        F.min("created_at").alias("created_at_min"),
        F.max("created_at").alias("created_at_max"),
    )
    cut = split.where("is_test").agg(F.min("created_at")).scalar()
    ties = split.groupBy("is_test").agg(F.count_if(F.col("created_at") == cut).alias("cases_at_cut"))
    return parts.join(ties, "is_test").orderBy("is_test")


def train_of(split: DataFrame) -> DataFrame:
    return split.where(~F.col("is_test")).drop("is_test")


def held_out(split: DataFrame) -> DataFrame:
    return split.where("is_test").drop("is_test")
