"""Language identification by cross-parsing against suffix automata.

Each language has a suffix automaton of words from labelled texts.  A document's words are
parsed left to right into the longest phrases that occur in the language's text; a letter
that does not occur is a phrase of its own.  Phrases never cross words.  The language that
needs the fewest phrases a letter wins: a text costs least where its own language is known.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.llm.base import (
    Memo,
    arrays,
    documents,
    id_and_text,
    remembers,
    ship_package,
    text_or_empty,
    turn_of,
)

#: Bounds of the labelled sample: documents a language (smallest hashes first), and
#: characters of distinct words a language that go into its automaton.
TRAIN_DOCS, TRAIN_CHARS = 64, 40_000
#: The remainder of crc32(doc_id) modulo 4 that is held out from training.
HELD_OUT = 2
#: Words whose costs a task remembers.
REMEMBERED = 200_000
#: The pipeline lets documents go whose two best languages are closer than this.
LEAST_SCORE = 0.01
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
_LANE = 32


class SuffixAutomaton:
    """The smallest automaton of all substrings of a text."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            state = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = state
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[q] == length[p] + 1:
                    link[state] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = clone
                        p = link[p]
                    link[q] = link[state] = clone
            last = state

    def phrases(self, word: str) -> int:
        """Longest-match phrases that ``word`` needs."""
        count, at, size = 0, 0, len(word)
        while at < size:
            state, begin = 0, at
            while at < size and (to := self.next[state].get(word[at])) is not None:
                state, at = to, at + 1
            if at == begin:
                at += 1
            count += 1
        return count


class CrossParser:
    """Phrases of a text in each language, and its letters.

    A word's counts are packed as lanes of one integer, so that a text's counts are a sum.
    """

    def __init__(self, training: dict[str, str]):
        self.languages = sorted(training)
        self.automata = [SuffixAutomaton(training[x]) for x in self.languages]
        self.memo = Memo(self._unit, REMEMBERED)

    def _unit(self, unit: str) -> int:
        packed = 0
        for run in _LETTERS.findall(unit.lower()):
            if not any(map(str.isalpha, run)):  # numerals that are no digits
                continue
            word = f" {run} "
            packed += len(run)
            for lane, automaton in enumerate(self.automata, 1):
                packed += automaton.phrases(word) << (_LANE * lane)
        return packed

    def __call__(self, text: str) -> tuple[str, float]:
        packed = sum(map(self.memo.__getitem__, text.split()))
        mask = (1 << _LANE) - 1
        letters = packed & mask
        if not letters or not self.languages:
            return UNKNOWN, 0.0
        costs = sorted(
            ((packed >> (_LANE * lane)) & mask, language) for lane, language in enumerate(self.languages, 1)
        )
        if len(costs) == 1:
            return costs[0][1], 1.0
        return costs[0][1], 1.0 - costs[0][0] / costs[1][0]


def training_words(texts: Iterable[str], chars: int = TRAIN_CHARS) -> str:
    """The distinct words of the texts in order, blanks between, ``chars`` long at most."""
    words = dict.fromkeys(w for t in texts for w in _LETTERS.findall(t.lower()))
    return (" " + " ".join(words) + " ")[:chars]


def held_out() -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == HELD_OUT


def learn(docs: DataFrame, per_language: int = TRAIN_DOCS, chars: int = TRAIN_CHARS) -> dict[str, str]:
    """Training text of each language, from a bounded sample of labelled, not held-out rows.

    Distinct ids are chosen first, ``per_language`` smallest hashes for each language; Spark
    keeps no more than that of each language per task.  Of rows that share an id and a
    language the text with the smallest hash counts, cut to ``chars`` characters of words on the
    executors, so at most that much of each chosen id comes to the driver.
    """
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        text_or_empty().alias("text"),
        held_out().alias("out"),
    ).filter(~F.col("out") & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        known.groupBy("lang", "doc_id")
        .agg(F.min(F.xxhash64("text")).alias("hash"))
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= per_language)
    )

    def words(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(text=[training_words([t], chars).strip() for t in frame["text"]])

    # Repeated rows meet before their texts are cut or sent.
    rows = known.withColumn("hash", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "lang", "hash"])
    one = rows.groupBy("lang", "place").agg(F.first("text").alias("text"))
    ship_package(docs.sparkSession)
    texts: dict[str, list[str]] = {}
    for row in one.mapInPandas(words, "lang string, place int, text string").orderBy("lang", "place").collect():
        texts.setdefault(row["lang"], []).append(row["text"])
    return {lang: training_words(found, chars) for lang, found in texts.items()}


@functools.lru_cache(maxsize=1)
def _parser(training: tuple[tuple[str, str], ...]) -> CrossParser:
    """One for each Python worker and training text."""
    return CrossParser(dict(training))


remembers("language", _parser.cache_clear)


def predicted(docs: DataFrame, training: dict[str, str]) -> DataFrame:
    """``docs`` (with a text) and lang_pred, score; no shuffle, whole texts."""
    model = tuple(sorted(training.items()))

    def predict(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn_of("language")
        parse = _parser(model)
        for frame in frames:
            found = [parse(t) for (t,) in arrays([frame], "text")]
            out = frame.drop(columns="text")
            out["lang_pred"] = [x for x, _ in found]
            out["score"] = pd.Series([s for _, s in found], dtype="float64", index=out.index)
            yield out

    kept = [f"`{n}` {t}" for n, t in docs.dtypes if n != "text"]
    return docs.mapInPandas(predict, ", ".join([*kept, "lang_pred string", "score double"]))


def predict_documents(docs: DataFrame, training: dict[str, str] | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    A null text, or one without letters, is ``und`` with score 0, and so is every text if
    no labelled row is left to learn from.  Of equal languages the first by name is taken,
    with score 0.  Copies get equal results; repeated rows stay; further columns are ignored.
    """
    model = learn(docs) if training is None else training
    rows = id_and_text(docs).withColumn("held_out", held_out())
    return predicted(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is known with some certainty, with their own columns.

    The text takes part once: it comes back from the Python task beside the verdict.
    """
    model = tuple(sorted(learn(docs).items()))
    at = docs.columns.index("text")

    def keep(batches: Iterable) -> Iterator:
        turn_of("language")
        parse = _parser(model)
        for batch in batches:
            found = [parse(t or "") for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([x != UNKNOWN and s >= LEAST_SCORE for x, s in found], pa.bool_()))

    ship_package(spark)
    return docs.mapInArrow(keep, docs.schema)


def op9_cross_parsing_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_documents(documents(spark, sf_dir))
