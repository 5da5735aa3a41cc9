"""Language-model scores with stupid backoff, against counts of the whole corpus.

The corpus becomes batches of documents.  Each batch sends its distinct n-grams, by hash,
to the partitions of the count table; there their counts are summed, joined back to each
batch that asked, and summed per document.  An n-gram is sent once a batch however often it
occurs there, so a word that a third of the corpus consists of makes no hot key.

A document is scored by the other documents: its own occurrences are taken off the counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.storage import materialise
from eventloom.llm.base import Memo, arrays, documents, id_and_text, remembers, shingle_hashes, turn_of
from eventloom.llm.batches import in_batches, unpack

#: Longest n-gram, and the factor of each step to shorter ones.
ORDER, BACKOFF = 2, 0.4
#: A word that no other document has counts as this much of an occurrence.
UNSEEN = 0.5
#: Bytes of text in a batch; n-grams in a partition of the count table.
BATCH_BYTES, TABLE_GRAMS = 4 << 20, 3_000_000
#: Words whose hashes a task remembers.
REMEMBERED = 150_000

_words = Memo(xxhash.xxh64_intdigest, REMEMBERED)
remembers("scoring", _words.clear)


class Batch:
    """The n-grams of a batch's documents, as hashes."""

    def __init__(self, packed: bytes, order: int):
        self.ids, texts, _ = unpack(packed)
        self.grams: list[list[np.ndarray]] = []  # by document, then by order
        for text in texts:
            units = text.split()  # bytes: the six ASCII blanks
            words = np.fromiter(map(_words.__getitem__, units), np.uint64, len(units))
            self.grams.append([shingle_hashes(words, n) if len(words) >= n else words[:0] for n in range(1, order + 1)])
        everything = [g for doc in self.grams for g in doc]
        self.distinct, self.counts = np.unique(
            np.concatenate(everything) if everything else np.zeros(0, np.uint64), return_counts=True
        )

    def by_part(self, parts: int) -> Iterator[tuple[int, np.ndarray]]:
        """Places of the distinct n-grams, by part of the count table."""
        part = (self.distinct % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        for i in range(parts):
            if cuts[i] < cuts[i + 1]:
                yield i, order[cuts[i] : cuts[i + 1]]


def _squeeze(values: np.ndarray) -> bytes:
    """Bytes of equal weight lie together, so that zeros and runs compress."""
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def _unsqueeze(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, -1).T).view(kind).ravel()


def _asked(batches: DataFrame, order: int, parts: int) -> DataFrame:
    def ask(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn_of("scoring")
        for number, packed in arrays(frames, "batch", "docs"):
            batch = Batch(packed, order)
            rows = []
            for part, at in batch.by_part(parts):
                grams = batch.distinct[at]
                steps = np.diff(grams, prepend=np.uint64(0))
                rows.append((part, number, _squeeze(steps), _squeeze(batch.counts[at].astype(np.uint32))))
            yield pd.DataFrame(rows, columns=["part", "batch", "grams", "counts"])

    return batches.mapInPandas(ask, "part int, batch long, grams binary, counts binary")


def _answered(asked: DataFrame, parts: int) -> DataFrame:
    """Counts over the corpus for each batch's n-grams; one part of the table at a time."""

    def answer(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held = None, []
        for now, *row in arrays(frames, "part", "batch", "grams", "counts"):
            if held and now != part:
                yield joined(part, held)
                held = []
            part = now
            held.append(row)
        if held:
            yield joined(part, held)

    def joined(part: int, held: list) -> pd.DataFrame:
        grams = [np.cumsum(_unsqueeze(g, np.uint64), dtype=np.uint64) for _, g, _ in held]
        table, place = np.unique(np.concatenate(grams), return_inverse=True)
        counts = np.concatenate([_unsqueeze(c, np.uint32) for *_, c in held])
        totals = np.bincount(place, counts, len(table)).astype(np.uint64)[place]
        ends = np.cumsum([len(g) for g in grams])[:-1]
        rows = [(b, part, _squeeze(t)) for (b, *_), t in zip(held, np.split(totals, ends), strict=True)]
        return pd.DataFrame(rows, columns=["batch", "part", "totals"])

    dealt = asked.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "batch")
    return dealt.mapInPandas(answer, "batch long, part int, totals binary")


def _scored(batch: Batch, totals: np.ndarray, corpus: int, order: int) -> pd.DataFrame:
    rows = []
    for doc, grams in zip(batch.ids, batch.grams, strict=True):
        n = len(grams[0])
        others = []  # by order, at each place: occurrences in other documents
        for g in grams:
            own, place, times = np.unique(g, return_inverse=True, return_counts=True)
            left = totals[np.searchsorted(batch.distinct, own)].astype(np.int64) - times
            others.append(left[place])
        score = np.full(n, np.nan)
        steps = np.zeros(n, np.int64)
        for k in range(order, 1, -1):
            # The word at i ends the n-gram that begins at i - k + 1.
            ends = np.arange(k - 1, n)
            above, below = others[k - 1], others[k - 2][: len(ends)]
            use = (above > 0) & np.isnan(score[ends])
            score[ends[use]] = np.log(above[use] / below[use]) + np.log(BACKOFF) * steps[ends[use]]
            steps[ends[~use & np.isnan(score[ends])]] += 1
        left = np.isnan(score)
        seen = np.maximum(others[0][left], UNSEEN)
        score[left] = np.log(seen / max(corpus - n, 1)) + np.log(BACKOFF) * steps[left]
        rows.append((doc, n, int((steps > 0).sum()), float(score.sum())))
    return pd.DataFrame(rows, columns=["doc_id", "n_words", "n_backoff", "log_score"]).astype({"doc_id": "Int64"})


def score_documents(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """One row per document: words, places that backed off, sum and mean of log scores.

    Words are runs of anything but the six ASCII blanks, case kept.  A document without
    words (null or blank text) has score 0 and a null mean.  Copies and repeated rows count
    as other documents.  An empty table gives an empty result; further columns are ignored.
    """
    batches = materialise(in_batches(id_and_text(docs), BATCH_BYTES, lambda text: len(text.split())), "batches")
    corpus = int(batches.agg(F.sum("measure")).first()[0] or 0)
    parts = max(1, -(-corpus * order // TABLE_GRAMS))
    answers = _answered(_asked(batches, order, parts), parts)

    def score(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = []
        for packed in rows["docs"]:
            batch = Batch(packed, order)
            totals = np.zeros(len(batch.distinct), np.uint64)
            blobs = dict(zip(found["part"], found["totals"], strict=True))
            for part, at in batch.by_part(parts):
                totals[at] = _unsqueeze(blobs[part], np.uint64)
            out.append(_scored(batch, totals, corpus, order))
        return pd.concat(out)

    result = (
        batches.groupBy("batch")
        .cogroup(answers.groupBy("batch"))
        .applyInPandas(score, "doc_id long, n_words long, n_backoff long, log_score double")
    )
    return result.withColumn("mean_log_score", F.col("log_score") / F.nullif(F.col("n_words"), F.lit(0)))


def op5_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "n_backoff",
        F.round("log_score", 4).alias("log_score"),
        F.round("mean_log_score", 6).alias("mean_log_score"),
    )


ORACLE = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), tokens AS (
  SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM docs
), places AS (
  SELECT doc_id, i, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS v FROM tokens
), one AS (SELECT w, count(*) AS n FROM tokens GROUP BY w
), own_one AS (SELECT doc_id, w, count(*) AS n FROM tokens GROUP BY ALL
), two AS (SELECT v, w, count(*) AS n FROM places WHERE v IS NOT NULL GROUP BY ALL
), own_two AS (SELECT doc_id, v, w, count(*) AS n FROM places WHERE v IS NOT NULL GROUP BY ALL
), counted AS (
  SELECT p.doc_id, p.v,
         b.n - ob.n AS pair, a.n - oa.n AS before, u.n - ou.n AS word,
         (SELECT count(*) FROM tokens) AS corpus, d.n_words
  FROM places p
  JOIN (SELECT doc_id, len(words) AS n_words FROM docs) d USING (doc_id)
  JOIN one u ON u.w = p.w JOIN own_one ou ON ou.doc_id = p.doc_id AND ou.w = p.w
  LEFT JOIN one a ON a.w = p.v LEFT JOIN own_one oa ON oa.doc_id = p.doc_id AND oa.w = p.v
  LEFT JOIN two b ON b.v = p.v AND b.w = p.w LEFT JOIN own_two ob ON ob.doc_id = p.doc_id AND ob.v = p.v AND ob.w = p.w
), scored AS (
  SELECT doc_id, v IS NOT NULL AND pair = 0 AS backed,
         CASE WHEN pair > 0 THEN ln(pair / before)
              ELSE ln(greatest(word, {UNSEEN}) / greatest(corpus - n_words, 1))
                   + CASE WHEN v IS NULL THEN 0 ELSE ln({BACKOFF}) END END AS s
  FROM counted
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(count(*) FILTER (backed) AS BIGINT) AS n_backoff,
       round(coalesce(sum(s), 0), 4) AS log_score, round(sum(s) / len(d.words), 6) AS mean_log_score
FROM docs d LEFT JOIN scored c USING (doc_id) GROUP BY d.doc_id, d.words
"""
