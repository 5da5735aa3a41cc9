"""Quality rules: plain counts of a text, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word n-grams (one and two words) are estimated: one from
documents that are trusted, one from the whole raw corpus.  A document's score is the mean
over its n-grams of ``ln(p_trusted / p_raw)``; it is kept if the score reaches a threshold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.base import documents, text_or_empty

#: Buckets of the hashed n-grams: bounds the statistics whatever the corpus.
BUCKETS = 1 << 14
#: Labelled documents of good quality used as the trusted target, at most; chosen by hash.
TRUSTED_ROWS = 20_000
#: Mean log ratio that a document must reach.
THRESHOLD = -0.06
#: Additive smoothing of each bucket's count.
SMOOTHING = 1.0

_BLANK = r"[\x20\x09-\x0D]+"
_SYMBOLS = "[#*$%&|<>]"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, _BLANK), "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _pairs(hashes: Column) -> Column:
    """A hash for each two neighbours, from the words' hashes."""
    most = F.greatest(F.size(hashes) - 1, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, most), F.slice(hashes, 2, most), lambda a, b: F.xxhash64(a, b))


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """Ids of labelled documents of good quality: all, or the ``rows`` smallest by hash."""
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
    return (
        good.select(F.col("doc_id").cast("long").alias("trusted_id"))
        .distinct()
        .orderBy(F.xxhash64("trusted_id"), "trusted_id")
        .limit(rows)
    )


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """``ln(p_trusted / p_raw)`` for each bucket, from counts over all documents.

    Only ``buckets`` counts are sent to the driver.  Without trusted n-grams all are 0.
    """
    hashed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _hashes(words_of(text_or_empty())).alias("hashes")
    )
    bucket = F.pmod(F.col("gram"), F.lit(buckets))
    # explode_outer: for explode, Spark would compute the array once more to test its size.
    counts = (
        hashed.join(F.broadcast(trusted), hashed["doc_id"] == trusted["trusted_id"], "left")
        .select(
            F.col("trusted_id").isNotNull().alias("good"),
            F.explode_outer(F.concat("hashes", _pairs(F.col("hashes")))).alias("gram"),
        )
        .groupBy(bucket.alias("bucket"))
        .agg(F.count("gram").alias("raw"), F.count_if(F.col("good") & F.col("gram").isNotNull()).alias("good"))
        .filter(F.col("bucket").isNotNull())
        .collect()
    )
    raw, good = [0] * buckets, [0] * buckets
    for bucket, n, g in counts:
        raw[bucket], good[bucket] = n, g
    if not sum(good):
        return [0.0] * buckets
    all_raw, all_good = sum(raw) + SMOOTHING * buckets, sum(good) + SMOOTHING * buckets
    return [math.log((g + SMOOTHING) / all_good) - math.log((n + SMOOTHING) / all_raw) for n, g in zip(raw, good, strict=True)]


def _windows(hashes: Column) -> Column:
    """A hash for each three neighbours."""
    return F.transform(
        F.sequence(F.lit(0), F.size(hashes) - 3),
        lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)),
    )


def measured(docs: DataFrame, ratios: list[float], buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """Each row of ``docs`` as struct ``row``, with its counts and the verdict.

    A null or blank text has no words and fails the base rules; copies get equal results.
    Three-word windows are told apart by 64-bit hashes.
    """
    text, words, hashes, n = F.col("text"), F.col("words"), F.col("hashes"), F.col("n_words")
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    first = docs.select(F.struct("*").alias("row"), text_or_empty().alias("text")).withColumns(
        {"words": words_of(text), "lines": lines}
    )
    second = first.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(_SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _hashes(words).alias("hashes"),
    ).withColumns({"windows": F.when(n >= 3, _windows(hashes)), "pairs": _pairs(hashes)})
    # Sorted by (hash, place), a window found again stands beside its like.
    windows, ranked = F.col("windows"), F.col("ranked")
    third = second.withColumn(
        "ranked",
        F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    again = F.filter(
        ranked,
        lambda x, i: (x["h"] == F.get(ranked, i - 1)["h"]) | (x["h"] == F.get(ranked, i + 1)["h"]),
    )
    fourth = third.withColumn("places", F.sort_array(F.transform(again, lambda x: x["i"])))
    covered = F.aggregate(
        "places",
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )


    def summed(grams: str) -> Column:
        return F.aggregate(grams, F.lit(0.0), lambda a, g: a + F.get(table, F.pmod(g, F.lit(buckets)).cast("int")))

    total = summed("hashes") + summed("pairs")
    fifth = fourth.select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        (total / F.greatest(2 * n - 1, F.lit(1))).alias("score"),
    )
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    return fifth.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold))
    )


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return measured(docs, log_ratios(docs, trusted_ids(labels)))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass, with their own columns.

    A filter on ``kept`` would be pushed below the steps that compute it and repeat them for
    every word; a generator is not, and passes on the row or nothing.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    passed = F.explode_outer(F.when(F.col("kept"), F.array("row")))
    return judge(docs, labels).select(passed.alias("row")).filter("row IS NOT NULL").select("row.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document of ``documents``; repeated rows stay, further columns are ignored."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(documents(spark, sf_dir), labels).select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "score",
    )
