"""Order-dependent computations that never put one group into one task.

Rows are range-partitioned on (key, order), which cuts a large group into many
chunks of similar size; the chunk number is written down with the rows.  Work
inside a chunk is an ordinary window, and what crosses chunk borders is a table
with about one row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialise

FROM_START = Window.unboundedPreceding
# Rows in one chunk, about: easy work for one task.
CHUNK_ROWS = 1_000_000
# monotonically_increasing_id: the partition number stands above this many row bits.
ROW_BITS = 33


def key_of(by: Sequence[str]) -> Column:
    """Grouping columns as one value that compares equal when parts are NULL."""
    return F.struct(*by) if by else F.lit(0)


def sorted_chunks(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column | str],
    chunks: int | None = None,
) -> DataFrame:
    """``df`` plus ``_chunk``, which grows with (key, order).

    Unless given, the number of chunks follows from the number of rows, so that no chunk
    outgrows a task however much data there is.
    """
    if chunks is None:
        chunks = max(-(-df.count() // CHUNK_ROWS), df.sparkSession.sparkContext.defaultParallelism)
    ranged = df.repartitionByRange(chunks, *key, *order)
    return materialise(ranged.withColumn("_chunk", F.spark_partition_id()), "chunks")


def split_at_borders(rows: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(rows of keys within one chunk, rows of keys that reach over a border)``.

    Only the first and the last key of a chunk can reach over, so the table of those keys
    has at most two rows per chunk and is broadcast; a NULL key is a key like others.
    """
    at = key_of(key)
    ends = rows.groupBy("_chunk").agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    edge_keys = ends.select("_chunk", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("_key"))
    reaching = F.broadcast(edge_keys.groupBy("_key").agg(F.count("*").alias("n")).where("n > 1").select("_key"))
    keyed = rows.withColumn("_key", at)
    return tuple(keyed.join(reaching, "_key", how).drop("_key") for how in ("left_anti", "left_semi"))


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column | str],
    totals: dict[str, str],
    chunks: int | None = None,
) -> DataFrame:
    """Adds running sums: ``totals`` maps new column -> summed column.

    Sums include the current row.  ``<new>_all`` holds the sum of the whole group.
    """
    rows = sorted_chunks(
        df.withColumn("_key", key_of(by)), ["_key"], order, chunks
    )
    per_chunk = rows.groupBy("_key", "_chunk").agg(
        *[F.sum(c).alias(f"_{n}") for n, c in totals.items()]
    )
    group = Window.partitionBy("_key")
    earlier = group.orderBy("_chunk").rowsBetween(FROM_START, -1)
    carried = per_chunk.select(
        "_key",
        "_chunk",
        *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in totals],
        *[F.sum(f"_{n}").over(group).alias(f"{n}_all") for n in totals],
    )
    inside = (
        Window.partitionBy("_key", "_chunk").orderBy(*order).rowsBetween(FROM_START, 0)
    )
    summed = rows.withColumns(
        {n: F.sum(c).over(inside) for n, c in totals.items()}
    ).join(carried, ["_key", "_chunk"])
    return summed.withColumns({n: F.col(n) + F.col(f"_{n}") for n in totals}).drop(
        "_key", "_chunk", *[f"_{n}" for n in totals]
    )


def global_rank(
    df: DataFrame,
    order: Sequence[Column | str],
    name: str = "rank",
    chunks: int | None = None,
) -> DataFrame:
    """Adds 1..N in the given order, and ``<name>_all`` = N.

    One range-partitioned sort.  The row's place in its partition is written with it;
    the rows in earlier partitions are then added from a table with one row per
    partition, so nothing is shuffled a second time.
    """
    ranged = df.repartitionByRange(chunks, *order) if chunks else df.repartitionByRange(*order)
    numbered = ranged.sortWithinPartitions(*order).withColumn(
        "_row", F.monotonically_increasing_id()
    )
    rows = materialise(numbered, "ranked").withColumns(
        {
            "_chunk": F.shiftright("_row", ROW_BITS),
            "_place": F.col("_row").bitwiseAND((1 << ROW_BITS) - 1) + 1,
        }
    )
    sizes = rows.groupBy("_chunk").agg(F.count("*").alias("_size"))
    along = Window.orderBy("_chunk")
    skipped = sizes.select(
        "_chunk",
        F.coalesce(F.sum("_size").over(along.rowsBetween(FROM_START, -1)), F.lit(0)).alias("_skip"),
        F.sum("_size").over(Window.partitionBy()).alias(f"{name}_all"),
    )
    return (
        rows.join(F.broadcast(skipped), "_chunk")  # one row per partition
        .withColumn(name, F.col("_place") + F.col("_skip"))
        .select(*df.columns, name, f"{name}_all")
    )
