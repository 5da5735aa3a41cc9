"""Weighted rendezvous hashing of stable keys over shards.

Every pair of key and shard has a hash u in (0, 1); a key goes to the shard with the
largest ``-weight / ln(u)``.  The choice depends on the key and the shards alone, so a new
shard only takes rows into itself, and a shard's weight is its expected share.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.ordered import CHUNK_ROWS, global_rank
from eventloom.functions.storage import materialise
from eventloom.llm.base import documents, text_or_empty

SHARDS = 24
#: Rows of a shard are numbered in order of so many hex digits of a hash, then of the id.
PARTS_DIGITS = 2


def _unit(key: Column, shard: int) -> Column:
    digest = F.md5(F.concat(key, F.lit(f":{shard}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of ``key`` among ``len(weights)`` shards; the first of equal scores."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive and not empty")
    scores = [
        F.struct((F.lit(-float(w)) / F.log(_unit(key, s))).alias("score"), F.lit(-s).alias("shard"))
        for s, w in enumerate(weights)
    ]
    return -(scores[0] if len(scores) == 1 else F.greatest(*scores))["shard"]


def shard_documents(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, grown: float = 1.0) -> DataFrame:
    """One row per document: its shard, its place there, its shard if one more were added.

    A null doc_id is the empty key, a null text has no bytes and checksum 0.  Rows with
    equal ids share a shard; repeated rows keep a row and a slot each.  An empty table
    gives an empty result; further columns of ``docs`` are ignored.

    Slots follow from one range-partitioned sort by (shard, hash, doc_id, checksum, size, row
    number), in ranges of about a million rows.  The row number tells equal rows apart, so
    neither a shard nor an id that many rows share is ever one task.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    size = F.octet_length(text_or_empty()).cast("long") + 8
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        size.alias("size"),
        F.crc32(F.encode(text_or_empty(), "UTF-8")).alias("text_crc32"),
        rendezvous(key, weights).alias("shard"),
        rendezvous(key, [*weights, grown]).alias("grown_shard"),
        F.substring(F.md5(key), 1, PARTS_DIGITS).alias("part"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = materialise(narrow, "sharded")
    sizes = dict(placed.groupBy("shard").count().collect())  # one row a shard
    starts = accumulate((sizes.get(s, 0) for s in range(len(weights) - 1)), initial=0)
    chunks = max(-(-sum(sizes.values()) // CHUNK_ROWS), docs.sparkSession.sparkContext.defaultParallelism)
    ranked = global_rank(placed, ["shard", "part", "doc_id", "text_crc32", "size", "row"], chunks=chunks)
    start = F.array(*map(F.lit, starts))[F.col("shard")]
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("rank") - 1 - start).cast("long").alias("slot"),
        F.col("grown_shard").cast("int").alias("grown_shard"),
    )


def op3_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))


# The score grows with the hash, so with equal weights the largest hash wins.  DuckDB has no
# CRC-32: it is computed byte by byte from its table.
ORACLE = f"""
WITH crc AS (
  SELECT list(v ORDER BY n) AS step FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)),
                          lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS n))
), docs AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS key, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                        lambda x: CAST('0x' || x AS BIGINT)) AS bytes
  FROM documents
), summed AS (
  SELECT doc_id, key, size,
         xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, step[xor(c & 255, x) + 1])),
             4294967295) AS text_crc32
  FROM docs, crc
), hashed AS (
  SELECT *, list_transform(range({SHARDS + 1}),
                           lambda s: CAST('0x' || substr(md5(key || ':' || s), 1, 13) AS BIGINT)) AS h
  FROM summed
), placed AS (
  SELECT *, CAST(list_position(h, list_max(h[1:{SHARDS}])) - 1 AS INTEGER) AS shard,
         CAST(list_position(h, list_max(h)) - 1 AS INTEGER) AS grown_shard
  FROM hashed
)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY substr(md5(key), 1, {PARTS_DIGITS}), doc_id, text_crc32, size) - 1 AS slot,
       grown_shard
FROM placed
"""
