"""A training corpus from raw documents: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventloom.functions.storage import materialise
from eventloom.llm import jaccard, language, packing, quality, repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality.quality_stage),
    ("language_id", language.language_stage),
    ("ngram_jaccard_join", jaccard.jaccard_stage),
    ("suffix_array_dedup", repeats.repeats_stage),
    ("best_fit_packing", packing.packing_stage),
]

#: Language ID, the similarity join and packing are beyond SQL; the tests hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
