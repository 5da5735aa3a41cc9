"""Exact interpolated quantiles by selection; memory and exchanges do not grow with the data.

Values are counted per fine logarithmic bucket, with the bucket's smallest and largest value.
Running counts over the buckets of a group tell which bucket holds each wanted rank.  A bucket
of one distinct value is the answer; one with several is cut into finer ones, for which only
the rows in it are looked at again, until each wanted rank has a bucket of one value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import FROM_START, key_of
from .storage import materialise

# Buckets are 1/4096 wide relative to the value; values below 1e-4 share few of them.
BUCKETS_PER_E = 4096.0
SMALLEST_STEP = 1e-4
# Parts that a bucket with several values is cut into.
PARTS = 4096
# So many buckets are sent to all tasks; more are joined by a shuffle.
SMALL = 100_000


def _bucket(v: Column) -> Column:
    """Whole number that never falls as ``v`` grows."""
    size = F.log1p(F.abs(v) / F.lit(SMALLEST_STEP)) * F.lit(BUCKETS_PER_E)
    return F.floor(F.signum(v) * size).cast("bigint")


def _part(v: Column, low: Column, high: Column) -> Column:
    """The part of a bucket; its ends never share one, so each cut leaves less."""
    place = F.floor((v - low) / (high - low) * F.lit(float(PARTS - 1))).cast("bigint")
    return F.when(v == high, F.lit(PARTS - 1)).when(v == low, F.lit(0)).otherwise(F.least(place, F.lit(PARTS - 2)))


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """One row per group: the ``by`` columns and one column per entry of ``probs``.

    Groups without any non-null value are absent.  Counts are taken while the plan is made.
    """
    src = df.where(F.col(value).isNotNull()).select(
        key_of(by).alias("_key"), F.col(value).cast("double").alias("_v")
    )
    ends = [F.count("*").alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high")]
    buckets = src.groupBy("_key", _bucket(F.col("_v")).alias("_b")).agg(*ends)
    group = Window.partitionBy("_key")
    before = F.coalesce(F.sum("_c").over(group.orderBy("_b").rowsBetween(FROM_START, -1)), F.lit(0))
    placed = buckets.select(
        "_key", "_c", "_low", "_high", before.alias("_start"), F.sum("_c").over(group).alias("_n")
    )
    spot = {n: F.lit(float(p)) * (F.col("_n") - 1) for n, p in probs.items()}
    ranks = F.array(*[F.struct(F.lit(n).alias("name"), F.floor(at).alias("rank")) for n, at in spot.items()])
    higher = F.array(*[F.struct(F.lit(n).alias("name"), F.ceil(at).alias("rank")) for n, at in spot.items()])

    def held(rank: Column) -> Column:
        return (F.col("_start") <= rank) & (rank < F.col("_start") + F.col("_c"))

    asked = F.explode(F.filter(F.array_distinct(F.concat(ranks, higher)), lambda x: held(x["rank"])))
    found = materialise(placed.withColumn("_at", asked), "quantiles")
    done = found.where("_low = _high")
    while True:
        wide = found.where("_low < _high")
        spans = wide.select("_key", "_low", "_high", "_start").distinct()
        count = spans.count()
        if count == 0:
            break
        spans = F.broadcast(spans) if count <= SMALL else spans
        inside = src.join(spans.withColumnRenamed("_key", "_of"), (F.col("_key") == F.col("_of")) & F.col("_v").between(F.col("_low"), F.col("_high")))
        cut = inside.select("_key", F.col("_low").alias("_from"), "_start", "_v", _part(F.col("_v"), F.col("_low"), F.col("_high")).alias("_b"))
        finer = cut.groupBy("_key", "_from", "_start", "_b").agg(*ends)
        along = Window.partitionBy("_key", "_from").orderBy("_b").rowsBetween(FROM_START, -1)
        finer = finer.withColumn("_start", F.col("_start") + F.coalesce(F.sum("_c").over(along), F.lit(0)))
        asked = wide.select("_key", F.col("_low").alias("_from"), "_n", "_at")
        refined = finer.join(asked, ["_key", "_from"]).where(held(F.col("_at.rank")))
        found = materialise(refined.select(*found.columns), "quantiles")
        done = done.unionByName(found.where("_low = _high"))

    def value_at(name: str, rank: Column) -> Column:
        return F.max(F.when((F.col("_at.name") == name) & (F.col("_at.rank") == rank), F.col("_low")))

    picked = done.groupBy("_key", "_n").agg(
        *[value_at(n, F.floor(at)).alias(f"{n}_lo") for n, at in spot.items()],
        *[value_at(n, F.ceil(at)).alias(f"{n}_hi") for n, at in spot.items()],
    )
    lo, hi = (lambda n: F.col(f"{n}_lo")), (lambda n: F.col(f"{n}_hi"))
    return picked.select(
        *[F.col(f"_key.{c}").alias(c) for c in by],
        *[
            (lo(n) + (hi(n) - lo(n)) * (at - F.floor(at))).alias(n)
            for n, at in spot.items()
        ],
    )


def planned_quantile(df: DataFrame, by: Sequence[str], value: str, name: str, prob: float) -> DataFrame:
    """One exact quantile of whole numbers, without a job while the plan is made.

    The wanted ranks are followed through blocks of values, 16 bits at a time, so that no
    window holds more than 65,536 rows.  Groups without any non-null value are absent.
    """
    src = df.where(F.col(value).isNotNull()).select(key_of(by).alias("_key"), F.col(value).cast("bigint").alias("_v"))
    at = F.lit(float(prob)) * (F.col("_n") - 1)
    ranks = F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at))))
    zero = F.lit(0).cast("bigint")
    asked = src.groupBy("_key").agg(F.count("*").alias("_n")).select("_key", "_n", ranks.alias("_at"), zero.alias("_start"), zero.alias("_in"))
    along = Window.partitionBy("_key", "_in").orderBy("_b").rowsBetween(FROM_START, -1)
    for bits in (48, 32, 16, 0):
        block = F.shiftright("_v", bits + 16) if bits < 48 else zero
        counted = src.groupBy("_key", block.alias("_in"), F.shiftright("_v", bits).alias("_b")).agg(F.count("*").alias("_c"))
        placed = counted.withColumn("_before", F.coalesce(F.sum("_c").over(along), zero))
        start = F.col("_start") + F.col("_before")
        held = (start <= F.col("_at")) & (F.col("_at") < start + F.col("_c"))
        asked = asked.join(placed, ["_key", "_in"]).where(held).select("_key", "_n", "_at", start.alias("_start"), F.col("_b").alias("_in"))
    ends = asked.groupBy("_key", "_n").agg(*[f("_in").cast("double").alias(n) for f, n in ((F.min, "_lo"), (F.max, "_hi"))])
    picked = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (at - F.floor(at))
    return ends.select(*[F.col(f"_key.{c}").alias(c) for c in by], picked.alias(name))


def summarise(
    df: DataFrame,
    by: Sequence[str],
    aggregates: Sequence[Column],
    value: str | None = None,
    probs: dict[str, float] | None = None,
) -> DataFrame:
    """Plain aggregates and exact quantiles of the same groups, side by side."""
    plain = df.groupBy(*by).agg(*aggregates)
    if not probs:
        return plain
    quantiles = exact_quantiles(df, by, value, probs)
    left = plain.withColumn("_key", key_of(by))
    right = quantiles.select(key_of(by).alias("_key"), *probs)
    return left.join(right, "_key", "left").drop("_key")
