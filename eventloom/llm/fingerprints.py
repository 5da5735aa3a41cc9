"""SpotSigs fingerprints: chains of content words that follow common words.

At each common word (an anchor) the next content words form a chain; anchor and chain are a
signature, and a text's set of signatures is its fingerprint.  Sets are compared by
Jaccard's coefficient, after a test of their lengths: sets whose lengths differ too much
cannot be as similar as asked, so only neighbouring length partitions need comparing.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.base import Memo, documents, id_and_text, mix, remembers, shingle_hashes, turn_of

# Common words of English, German, French and Spanish.
ANCHORS = frozenset(
    "a an and are as at be but by for from had has have he her his i in is it its not of on or our she that the their "
    "them then there these they this to was we were which who will with would you your "
    "aber als am auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich im ist "
    "mit nach nicht oder sich sie sind so um und uns von vor war wie wir wird zu zum zur "
    "au aux avec ce ces cette dans de du elle en est et il ils je la le les leur lui mais ne nous ou où par pas plus "
    "pour qu que qui sa sans se ses si son sur un une vous "
    "al como con del el ella ellos era esta este esto fue ha hay lo los las más me mi muy no nos o para pero por "
    "porque ser sin sobre su sus también te tiene todo una uno y ya".split()
)
#: Content words in a chain.
CHAIN = 2
#: Jaccard coefficient from which successors count as similar; it sets the length partitions.
SIMILAR = 0.8
#: Words whose hashes a task remembers.
REMEMBERED = 400_000
#: Smallest signature hashes shown in the fingerprint, besides the digest of all.
SHOWN = 16

_EDGE = re.compile(r"^\W+|\W+$")


def _word(unit: str) -> int:
    """Hash of a word without its punctuation, odd for anchors; 0 if nothing is left."""
    word = _EDGE.sub("", unit.lower())
    if not word:
        return 0
    return (xxhash.xxh64_intdigest(word) | 3) ^ (2 if word in ANCHORS else 1)


_words = Memo(_word, REMEMBERED)
remembers("fingerprints", _words.clear)


def signatures(text: str) -> np.ndarray:
    """Hashes of the text's signatures, sorted and distinct.

    A text with words but no anchor that a whole chain follows has its runs of three words
    as signatures, or all its words if there are fewer; without words the set is empty.
    """
    units = text.split()
    words = np.fromiter(map(_words.__getitem__, units), np.uint64, len(units))
    words = words[words != 0]
    anchor = (words & np.uint64(1)).astype(bool)
    content, at = np.flatnonzero(~anchor), np.flatnonzero(anchor)
    first = np.searchsorted(content, at)
    whole = first + CHAIN <= len(content)
    if not whole.any():
        return np.unique(shingle_hashes(words, 3))
    first = first[whole]
    h = mix(words[at[whole]])
    for i in range(CHAIN):
        h = mix(h + words[content[first + i]])
    return np.unique(h)


def length_partition(size: int, least: float) -> int:
    """Sets as similar as ``least`` lie in the same partition or in neighbouring ones."""
    return int(math.floor(math.log(size) / -math.log(least) + 1e-9)) if size else -1


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard's coefficient of two sets, or 0 if their lengths alone rule ``least`` out.
    Two empty sets are alike."""
    if not len(a) and not len(b):
        return 1.0
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    place = np.searchsorted(b, a)
    place[place == len(b)] = 0
    shared = int((b[place] == a).sum()) if len(b) else 0
    return shared / (len(a) + len(b) - shared)


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILAR) -> bool:
    """Whether two sets are as similar as ``least``; only sets of the same or neighbouring
    length partitions are compared."""
    if abs(length_partition(len(a), least) - length_partition(len(b), least)) > 1:
        return False
    return jaccard(a, b, least) >= least


def fingerprint(found: np.ndarray) -> str:
    """Number of signatures, digest of all, and the smallest hashes among them."""
    shown = "".join(f"{int(x) >> 32:08x}" for x in found[:SHOWN])
    return f"{len(found)}:{hashlib.sha256(found.tobytes()).hexdigest()[:32]}:{shown}"


def _first_ids(ids: DataFrame, parts: int) -> list[int]:
    """The smallest id of each of at most ``parts`` ranges of about equal size."""

    def smallest(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [f["place"].min() for f in frames if len(f)]
        yield pd.DataFrame({"place": [min(found)] if found else []}, dtype="int64")

    ranges = ids.repartitionByRange(parts, "place").mapInPandas(smallest, "place long")
    return sorted({r[0] for r in ranges.collect()})


def with_following(docs: DataFrame, bytes_each: int = 32 << 20) -> DataFrame:
    """``part, border, place, doc_id, text`` in order of ``doc_id`` within each part.

    Parts are ranges of ids.  The first documents of a part also go to the end of the part
    before as border rows (the very first to the last part), so that each document's
    successor is at hand after one shuffle of the texts.  Null ids come first; rows with
    equal ids are ordered by text.
    """
    rows = id_and_text(docs).withColumn("place", F.coalesce("doc_id", F.lit(-(1 << 63))))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // bytes_each))
    starts = np.array(_first_ids(rows.select("place"), parts), np.int64)
    schema = pa.schema(
        [("part", pa.int32()), ("border", pa.bool_()), ("place", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string())]
    )

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy()
            part = np.searchsorted(starts, place, "right").astype(np.int32) - 1
            first = np.flatnonzero(starts[part] == place)
            again = batch.take(pa.array(first))
            before = (part[first] - 1) % len(starts)
            for rows, where, border in ((batch, part, False), (again, before.astype(np.int32), True)):
                if rows.num_rows:
                    columns = [pa.array(where), pa.array(np.full(rows.num_rows, border))]
                    columns += [rows.column(c) for c in ("place", "doc_id", "text")]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    dealt = rows.mapInArrow(deal, "part int, border boolean, place long, doc_id long, text string")
    return dealt.repartitionById(max(1, len(starts)), F.col("part")).sortWithinPartitions("part", "border", "place", "text")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """One row per document, beside its edited text and its successor; then the partition of
    its set's length and whether the successor's set is similar.

    A null text is empty.  The only document of a table follows itself; repeated rows follow
    each other; an empty table gives an empty result; further columns are ignored.
    """
    columns = (
        "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next "
        "length_partition similar_next"
    ).split()

    def compared(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn_of("fingerprints")
        part, held = None, None
        for frame in frames:
            rows = []
            for now, border, doc, text in zip(frame["part"], frame["border"], frame["doc_id"], frame["text"], strict=True):
                if border and (held is None or part != now):
                    continue
                found = signatures(text)
                if held is not None and part == now:
                    rows.append(_compare(*held, text, found))
                part, held = now, None if border else (doc, text, found)
            out = pd.DataFrame(rows, columns=columns)
            yield out.astype({"doc_id": "Int64", "near_edited": "float64", "near_next": "float64"})

    return with_following(docs).mapInPandas(
        compared,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, length_partition int, similar_next boolean",
    )


def _compare(doc, text: str, own: np.ndarray, after: str, following: np.ndarray) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + after[:half]
    changed = signatures(edited)
    digest = hashlib.sha256(edited.encode("utf-8")).hexdigest()
    return (
        doc,
        len(text),
        digest,
        fingerprint(own),
        fingerprint(changed),
        jaccard(own, changed),
        jaccard(own, following),
        length_partition(len(own), SIMILAR),
        similar(own, following),
    )


def op8_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))
