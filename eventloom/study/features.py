"""Feature vectors: one-hot categories, scaled numbers, TF-IDF of a short text.

Everything is learnt from the train rows by Spark.  Category levels stay a table that rows are
joined to; what comes to the driver is the text vocabulary, of bounded size.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    Normalizer,
    OneHotEncoder,
    RegexTokenizer,
    SQLTransformer,
    StandardScaler,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import materialise
from .levels import Levels, learn_levels, read_levels

# The inputs of the models.
CATEGORICAL = ["issue_type", "priority", "report_channel", "reporter", "short_description"]
NUMERIC = ["created_hour", "created_dow", "created_month", "created_dayofyear", "desc_length"]
TEMPORAL = [
    "created_hour",
    "created_dow",
    "created_is_weekend",
    "created_month",
    "created_dayofyear",
    "desc_length",
]
TEXT = "short_description"
TERMS = 200

# Runs of two or more letters, digits or underscores, in any script.
TOKEN = r"[\p{L}\p{N}_]{2,}"
MISSING = "(missing)"


@dataclass(frozen=True)
class FeatureSet:
    categorical: Sequence[str] = ()
    numeric: Sequence[str] = ()
    text: str | None = None
    ngrams: tuple[int, int] = (1, 2)
    terms: int = TERMS


INTAKE = FeatureSet(CATEGORICAL, NUMERIC, TEXT)


@dataclass
class FittedFeatures:
    """Levels that rows are joined to, then the stages that make the vector.

    ``named`` are the dimensions after those of the levels; ``ordinal`` features have one
    dimension a column and no dimension a level.
    """

    pipeline: PipelineModel
    named: list[str] = field(default_factory=list)
    levels: Levels | None = None
    ordinal: bool = False

    def transform(self, frame: DataFrame) -> DataFrame:
        if self.levels:
            unseen = dict.fromkeys(self.levels.columns, -1.0) if self.ordinal else None
            frame = self.levels.coded(frame, unseen)
        return self.pipeline.transform(frame)

    @property
    def one_hot(self) -> int:
        """How many dimensions are levels; they come first."""
        return 0 if self.ordinal or not self.levels else sum(self.levels.counts.values())

    def name_table(self, spark: SparkSession) -> DataFrame:
        """``position, name`` of every dimension."""
        rows = [(self.one_hot + i, n) for i, n in enumerate(self.named)]
        table = spark.createDataFrame(rows, "position long, name string")
        return self.levels.names().unionByName(table) if self.one_hot else table

    @property
    def names(self) -> list[str]:
        """All names in order, brought to the driver."""
        return [r["name"] for r in self.name_table(SparkSession.active()).orderBy("position").collect()]

    def save(self, path: str) -> None:
        about = {"named": self.named, "ordinal": self.ordinal}
        if self.levels:
            about |= {"columns": self.levels.columns, "missing": self.levels.missing}
            self.levels.save(f"{path}/levels")
        self.pipeline.write().overwrite().save(f"{path}/stages")
        write_json(about, f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FittedFeatures:
        about = read_json(spark, f"{path}/about")
        levels = read_levels(spark, f"{path}/levels", about["columns"], about["missing"]) if "columns" in about else None
        return FittedFeatures(PipelineModel.load(f"{path}/stages"), about["named"], levels, about["ordinal"])


def write_json(value: dict, path: str) -> None:
    """A small description beside a model's tables."""
    SparkSession.active().createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def entries(rows: DataFrame, keep: Sequence[str], vector: str = "features") -> DataFrame:
    """``keep, position, value`` of the entries that are not zero."""
    raw = F.unwrap_udt(vector)
    at = F.when(raw["type"] == 0, raw["indices"]).otherwise(F.sequence(F.lit(0), F.size(raw["values"]) - 1))
    cells = rows.select(*keep, F.inline(F.arrays_zip(at.alias("position"), raw["values"].alias("value"))))
    return cells.select(*keep, F.col("position").cast("long").alias("position"), "value").where(F.col("value") != 0.0)


def words_of(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({TOKEN})"), F.lit(1))


def _runs(words: Column, n: int) -> Column:
    """Every ``n`` neighbouring words joined by blanks; none in a shorter text."""
    if n == 1:
        return words
    left, count = _runs(words, n - 1), F.greatest(F.size(words) - (n - 1), F.lit(0))
    return F.zip_with(
        F.slice(left, F.lit(1), count),
        F.slice(words, F.lit(n), count),
        lambda head, word: F.concat(head, F.lit(" "), word),
    )


def with_terms(
    frame: DataFrame, text: str, ngrams: tuple[int, int] = (1, 2), out: str = "terms"
) -> DataFrame:
    """Adds the text's words and runs of words, in lower case, as an array.

    The words are a column of their own first, so that a text is split only once.
    """
    low, high = ngrams
    runs = [_runs(F.col("_words"), n) for n in range(low, high + 1)]
    split = frame.withColumn("_words", words_of(text))
    return split.withColumn(out, F.concat(*runs)).drop("_words")


def term_counts(frame: DataFrame, text: str, ngrams: tuple[int, int] = (1, 2)) -> DataFrame:
    """Total occurrences of every term in the whole texts."""
    return (
        with_terms(frame.select(text), text, ngrams)
        .select(F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("occurrences"))
    )


def vocabulary(
    frame: DataFrame, text: str, ngrams: tuple[int, int] = (1, 2), terms: int = TERMS
) -> DataFrame:
    """The most frequent terms; equal counts go by the alphabet.

    No run of words is more frequent than its rarest word.  So words are counted first,
    and only runs of words that reach the count of the last of the ``terms`` most frequent
    words are counted at all; the others could not enter the list.
    """
    low, high = ngrams
    if low != 1 or high == 1:
        return _most_frequent(term_counts(frame, text, ngrams), terms)
    words = materialise(term_counts(frame, text, (1, 1)), "words")
    least, found = _most_frequent(words, terms).agg(F.min("occurrences"), F.count("*")).first()
    frequent = words.where(F.col("occurrences") >= (least if found == terms else 1)).select("term")
    if frequent.count() <= 10 * terms:  # else ties at the least count: left to Spark's estimate
        frequent = F.broadcast(frequent)
    counts = words
    for n in range(2, high + 1):
        split = frame.select(words_of(text).alias("_words"))
        count = F.greatest(F.size("_words") - (n - 1), F.lit(0))
        parts = [F.slice("_words", F.lit(i + 1), count).alias(f"w{i}") for i in range(n)]
        runs = split.select(F.inline_outer(F.arrays_zip(*parts))).toDF(*[f"w{i}" for i in range(n)])
        for i in range(n):
            runs = runs.join(frequent, runs[f"w{i}"] == frequent["term"], "left_semi")
        counted = runs.groupBy(*runs.columns).agg(F.count("*").alias("occurrences"))
        counts = counts.unionByName(counted.select(F.concat_ws(" ", *runs.columns).alias("term"), "occurrences"))
    return _most_frequent(counts, terms)


def _most_frequent(counts: DataFrame, terms: int) -> DataFrame:
    return counts.orderBy(F.col("occurrences").desc(), "term").limit(terms)


def tfidf_weights(
    frame: DataFrame, key: str, text: str, ngrams: tuple[int, int] = (1, 2), terms: int = TERMS
) -> DataFrame:
    """``(key, term, weight)`` of the vocabulary's terms, each row of length one.

    The table form of ``text_stages``: weight = count x (1 + ln((1+N)/(1+df))), divided
    by the row's Euclidean norm.
    """
    chosen = vocabulary(frame, text, ngrams, terms).select("term")
    counts = (
        with_terms(frame.select(key, text), text, ngrams)
        .select(key, F.explode("terms").alias("term"))
        .join(F.broadcast(chosen), "term")  # at most `terms` rows
        .groupBy(key, "term")
        .agg(F.count("*").alias("tf"))
    )
    rows = frame.agg(F.count("*")).scalar()
    spread = counts.groupBy("term").agg(F.count("*").alias("df"))  # at most `terms` rows
    weighted = counts.join(F.broadcast(spread), "term").select(
        key, "term", (F.col("tf") * (1 + F.ln((1 + rows) / (1 + F.col("df"))))).alias("w")
    )
    # At most `terms` rows per key, so the norm is a small grouping per row.
    norms = weighted.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norms, key).select(
        key, "term", F.round(F.col("w") / F.col("norm"), 6).alias("weight")
    )


def _statement(columns: dict[str, str]) -> SQLTransformer:
    added = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return SQLTransformer(statement=f"SELECT *, {added} FROM __THIS__")


def text_stages(
    frame: DataFrame, text: str, ngrams: tuple[int, int], terms: int, out: str = "text_weights"
) -> tuple[list[Transformer], list[str]]:
    words = [r[0] for r in vocabulary(frame, text, ngrams, terms).select("term").collect()]
    if not words:
        raise ValueError(f"{text} holds no words to learn from")
    low, high = ngrams
    filled = _statement({"text_filled": f"coalesce({text}, '')"})
    tokens = RegexTokenizer(
        inputCol="text_filled", outputCol="text_n1", pattern=TOKEN, gaps=False, toLowercase=True
    )
    grams = [NGram(n=n, inputCol="text_n1", outputCol=f"text_n{n}") for n in range(max(2, low), high + 1)]
    all_terms = _statement(
        {"text_terms": "concat(" + ", ".join(f"text_n{n}" for n in range(low, high + 1)) + ")"}
    )
    counter = CountVectorizerModel.from_vocabulary(words, inputCol="text_terms", outputCol="text_counts")
    stages: list[Transformer] = [filled, tokens, *grams, all_terms, counter]
    counted = PipelineModel(stages).transform(frame)
    idf = IDF(inputCol="text_counts", outputCol="text_idf").fit(counted).idf.toArray()
    scale = ElementwiseProduct(
        inputCol="text_counts", outputCol="text_scaled", scalingVec=Vectors.dense(idf + 1.0)
    )
    norm = Normalizer(p=2.0, inputCol="text_scaled", outputCol=out)
    return [*stages, scale, norm], [f"tfidf__{w}" for w in words]


def fit_features(train: DataFrame, features: FeatureSet = INTAKE, out: str = "features") -> FittedFeatures:
    """A value that the train rows did not have becomes all zeros."""
    stages: list[Transformer] = []
    parts: list[str] = []
    names: list[str] = []
    levels = None
    if features.categorical:
        cats = list(features.categorical)
        levels = learn_levels(train, cats, MISSING)
        # The encoder learns a size for each column from its last code; it drops what is beyond.
        last = train.sparkSession.createDataFrame(
            [tuple(float(levels.counts[c] - 1) for c in cats)], ", ".join(f"`{c}_code` double" for c in cats)
        )
        encoder = OneHotEncoder(
            inputCols=[f"{c}_code" for c in cats],
            outputCols=[f"{c}_onehot" for c in cats],
            handleInvalid="keep",
            dropLast=True,
        ).fit(last)
        stages.append(encoder)
        parts += [f"{c}_onehot" for c in cats]
    if features.numeric:
        nums = list(features.numeric)
        raw = VectorAssembler(inputCols=nums, outputCol="numbers")
        scaler = StandardScaler(
            inputCol="numbers", outputCol="numbers_scaled", withMean=True, withStd=True
        ).fit(raw.transform(train))
        stages += [raw, scaler]
        parts.append("numbers_scaled")
        names += [f"num__{c}" for c in nums]
    if features.text:
        more, words = text_stages(train, features.text, features.ngrams, features.terms)
        stages += more
        parts.append("text_weights")
        names += words
    stages.append(VectorAssembler(inputCols=parts, outputCol=out))
    return FittedFeatures(PipelineModel(stages), names, levels)


def fit_ordinal(
    train: DataFrame,
    categorical: Sequence[str] = tuple(CATEGORICAL),
    numeric: Sequence[str] = tuple(TEMPORAL),
    out: str = "features",
) -> FittedFeatures:
    """Alphabetical codes, learnt once on the train rows; missing and unseen are -1."""
    cats = list(categorical)
    levels = learn_levels(train, cats) if cats else None
    together = VectorAssembler(inputCols=[f"{c}_code" for c in cats] + list(numeric), outputCol=out)
    return FittedFeatures(PipelineModel([together]), cats + list(numeric), levels, ordinal=True)


def named_values(names: DataFrame, values: Sequence[float], column: str) -> DataFrame:
    """One row per dimension of a model, largest size first."""
    spark = names.sparkSession
    rows = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], f"position long, {column} double")
    table = names.join(rows, "position").select(F.col("name").alias("feature"), column)
    return table.orderBy(F.abs(column).desc(), "feature")
