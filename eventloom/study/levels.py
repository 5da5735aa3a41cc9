"""Category levels as a table, numbered in alphabetical order, however many there are."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordered import running_totals
from ..functions.storage import materialise

# A column's levels are sent to all tasks up to this many and this many bytes; beyond, rows
# and levels are joined by a shuffle.
SMALL_LEVELS, SMALL_BYTES = 100_000, 16 << 20


@dataclass
class Levels:
    """``table`` has ``column, level, code``; a null counts as the level ``missing``, or as
    none if that is None.  On the driver are a count and a size for each column."""

    table: DataFrame
    columns: list[str]
    counts: dict[str, int]
    sizes: dict[str, int]
    missing: str | None = None

    def _value(self, column: str) -> Column:
        text = F.col(column).cast("string")
        return text if self.missing is None else F.coalesce(text, F.lit(self.missing))

    def coded(self, frame: DataFrame, unseen: dict[str, float] | None = None) -> DataFrame:
        """Adds ``<column>_code``; values without a code get ``unseen``, by default the
        number of levels."""
        for c in self.columns:
            own = self.table.where(F.col("column") == c).select(F.col("level").alias("_level"), F.col("code").alias("_code"))
            if self.counts[c] <= SMALL_LEVELS and self.sizes[c] <= SMALL_BYTES:
                own = F.broadcast(own)
            other = float(self.counts[c]) if unseen is None else unseen[c]
            joined = frame.join(own, self._value(c) == F.col("_level"), "left")
            frame = joined.withColumn(f"{c}_code", F.coalesce(F.col("_code").cast("double"), F.lit(other))).drop("_level", "_code")
        return frame

    def names(self) -> DataFrame:
        """``position, name`` of one dimension per level, column by column."""
        start = F.lit(0).cast("long")
        for c in reversed(self.columns):
            before = sum(self.counts[x] for x in self.columns[: self.columns.index(c)])
            start = F.when(F.col("column") == c, F.lit(before).cast("long")).otherwise(start)
        return self.table.select(
            (start + F.col("code")).alias("position"), F.concat(F.lit("cat__"), "column", F.lit("_"), "level").alias("name")
        )

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").option("compression", "zstd").parquet(path)


def learn_levels(frame: DataFrame, columns: Sequence[str], missing: str | None = None) -> Levels:
    """The distinct values of each column, numbered from 0 by one range-partitioned sort."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns]
    values = frame.select(F.inline(F.array(*cells)))
    if missing is not None:
        values = values.withColumn("level", F.coalesce("level", F.lit(missing)))
    distinct = values.where(F.col("level").isNotNull()).distinct().withColumn("_one", F.lit(1))
    ranked = running_totals(distinct, ["column"], ["level"], {"_rank": "_one"})
    table = materialise(ranked.select("column", "level", (F.col("_rank") - 1).alias("code")), "levels")
    return known_levels(table, columns, missing)


def known_levels(table: DataFrame, columns: Sequence[str], missing: str | None) -> Levels:
    sizes = table.groupBy("column").agg(F.count("*").alias("n"), F.sum(F.octet_length("level")).alias("bytes")).collect()
    found = {r["column"]: r for r in sizes}
    counts = {c: found[c]["n"] if c in found else 0 for c in columns}
    return Levels(table, list(columns), counts, {c: found[c]["bytes"] if c in found else 0 for c in columns}, missing)


def read_levels(spark: SparkSession, path: str, columns: Sequence[str], missing: str | None) -> Levels:
    return known_levels(spark.read.parquet(path), columns, missing)
