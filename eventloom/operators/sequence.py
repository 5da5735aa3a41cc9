"""The event before and after each event of a case."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import FROM_START, key_of, sorted_chunks, split_at_borders
from ..spec import EVENT_ORDER

CHUNK = "_chunk"


def ordered_log(log: DataFrame, chunks: int | None = None) -> DataFrame:
    """The log cut along (case, time, id) into chunks of about equal size, written once.

    Whatever needs the order of events takes this table as its log and then sorts nothing
    but what lies within a chunk.
    """
    return chunked(log, log.columns, chunks=chunks)


def chunked(
    log: DataFrame,
    columns: Sequence[str],
    order: Sequence[str] = tuple(EVENT_ORDER),
    chunks: int | None = None,
) -> DataFrame:
    """Some columns of the log and the chunk; the log is cut only if it is not yet."""
    if CHUNK in log.columns and tuple(order) == tuple(EVENT_ORDER):
        return log.select(*[c for c in columns if c != CHUNK], CHUNK)
    return sorted_chunks(log.select(*[c for c in columns if c != CHUNK]), ["case_id"], order, chunks)


def with_neighbours(
    log: DataFrame,
    before: Sequence[str] = (),
    after: Sequence[str] = (),
    position: bool = False,
    order: Sequence[str] = tuple(EVENT_ORDER),
    chunks: int | None = None,
) -> DataFrame:
    """Adds ``prev_<c>``, ``next_<c>`` and, on request, ``position`` (1 = first).

    A case within one chunk is one window, and no larger than a chunk.  A case that
    reaches over chunks has a window in each, and what crosses the borders is joined.
    """
    rows = chunked(log, log.columns, order, chunks)
    whole, reaching = split_at_borders(rows, ["case_id"])
    result = by_case(whole, before, after, position, order)
    return result.unionByName(by_chunks(reaching, before, after, position, order))


def by_case(rows: DataFrame, before=(), after=(), position=False, order=tuple(EVENT_ORDER)) -> DataFrame:
    w = Window.partitionBy("case_id").orderBy(*order)
    added: dict[str, Column] = {f"prev_{c}": F.lag(c).over(w) for c in before}
    added |= {f"next_{c}": F.lead(c).over(w) for c in after}
    if position:
        added["position"] = F.row_number().over(w).cast("bigint")
    return rows.withColumns(added)


def by_chunks(rows: DataFrame, before=(), after=(), position=False, order=tuple(EVENT_ORDER)) -> DataFrame:
    """The same columns, with a case spread over as many tasks as it has chunks."""
    rows = rows.withColumn("_case", key_of(["case_id"]))
    at = F.struct(*order)
    ends = rows.groupBy("_case", CHUNK).agg(
        F.min_by(F.struct(F.lit(1).alias("_"), *after), at).alias("head"),
        F.max_by(F.struct(F.lit(1).alias("_"), *before), at).alias("tail"),
        F.count("*").alias("size"),
    )
    along = Window.partitionBy("_case").orderBy(CHUNK)
    # At most two rows per chunk.
    borders = ends.select(
        "_case",
        CHUNK,
        F.lead("head").over(along).alias("_head"),
        F.lag("tail").over(along).alias("_tail"),
        F.coalesce(F.sum("size").over(along.rowsBetween(FROM_START, -1)), F.lit(0)).alias("_skip"),
        F.col("size").alias("_size"),
    )
    w = Window.partitionBy("_case", CHUNK).orderBy(*order)
    inside = rows.withColumns(
        {
            "_no": F.row_number().over(w),
            **{f"prev_{c}": F.lag(c).over(w) for c in before},
            **{f"next_{c}": F.lead(c).over(w) for c in after},
        }
    ).join(F.broadcast(borders), ["_case", CHUNK])
    first, last = F.col("_no") == 1, F.col("_no") == F.col("_size")
    fixed = {
        f"prev_{c}": F.when(first, F.col(f"_tail.{c}")).otherwise(F.col(f"prev_{c}")) for c in before
    }
    fixed |= {
        f"next_{c}": F.when(last, F.col(f"_head.{c}")).otherwise(F.col(f"next_{c}")) for c in after
    }
    if position:
        fixed["position"] = (F.col("_no") + F.col("_skip")).cast("bigint")
    kept = [c for c in rows.columns if c != "_case"]
    return inside.withColumns(fixed).select(*kept, *fixed)
