"""Removal of long repeated passages by bucket-pointer refinement of suffixes.

Two suffixes belong together if they agree in their first ``LENGTH`` bytes.  Suffixes are
put in buckets by a q-gram and buckets are refined by the identifiers of strings at later
offsets, until each suffix is known to stand alone or to have an equal:

* The initial bucket of a suffix is the smallest q-gram, by hash, of its first ``LENGTH``
  bytes, and the offset of that q-gram.  Equal strings have equal buckets.  Neighbouring
  suffixes share a q-gram, so one row stands for a run of suffixes.
* A run's *core* is the string that all its suffixes share, its *hull* the one that covers
  them all.  If no other run has the core, none of its suffixes has an equal; if another
  run has the hull, all have.  Else the run is split by offset, and the parts are put in
  new buckets by their own cores; what was decided is not looked at again.  A decided hull
  stays in play by one representative while others in its bucket are undecided.

The last level has runs of one suffix, whose core and hull are the string itself, so the
result is exact.  Identifiers are two independent 64-bit hashes instead of ranks, which
need no global order.  Groups of any size are only counted, never gathered in a task.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.storage import materialise
from eventloom.llm.base import arrays, documents, id_and_text, mix, turn_of
from eventloom.llm.batches import bucketed, in_batches, unpack

#: Bytes of a repeated string; bytes of the q-grams of the first buckets.
LENGTH, GRAM = 400, 32
#: The stage cuts spans of repeated strings of this many bytes if they have more than so many
#: words or at least ``LENGTH`` bytes; 51 words reach it at a mean of 5 bytes, blanks included.
PASSAGE_BYTES, PASSAGE_WORDS = 256, 50
#: Suffixes in a run after each refinement; the last must be 1.
REFINEMENTS = (16, 1)
#: Bytes of text in a batch and in a file of batches, and places hashed at a time.
BATCH_BYTES, BUCKET_BYTES, SEGMENT = 2 << 20, 32 << 20, 1 << 18

#: ``place`` packs where a run is in its batch: anchor, anchor - first start, last - first.
RUN = "bucket long, hull long, batch long, place long"


class Hasher:
    """Hashes of any substring of a text, from prefix sums of a polynomial in 2^64."""

    def __init__(self, seed: int, size: int):
        with np.errstate(over="ignore"):
            self.values = mix(np.arange(256, dtype=np.uint64) + np.uint64(seed * 1000 + 1))
            base = int(mix(np.array([seed], np.uint64))[0]) | 1
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            back = np.full(size, pow(base, -1, 1 << 64), np.uint64)
            back[0] = 1
            self.powers, self.inverse = np.cumprod(steps), np.cumprod(back)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, begin, end) -> np.ndarray:
        return mix((sums[end] - sums[begin]) * self.inverse[begin])


@functools.cache
def hashers(length: int) -> tuple[Hasher, Hasher]:
    size = SEGMENT + 4 * length
    return Hasher(1, size), Hasher(2, size)


def _packed(anchor: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return (anchor << 32) | ((anchor - first) << 16) | (last - first)


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    anchor = place >> 32
    first = anchor - ((place >> 16) & 0xFFFF)
    return anchor, first, first + (place & 0xFFFF)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from minima within blocks of that width."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: len(values) - width + 1], ahead[width - 1 : len(values)])


def _hull(hasher: Hasher, sums: np.ndarray, first, last, length: int, tag: np.ndarray) -> np.ndarray:
    return mix(hasher.of(sums, first, last + length) + mix(tag))


def initial_runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> Iterator[tuple]:
    """``bucket, hull, place`` of the runs of all suffixes of at least ``length`` bytes, in
    a buffer of texts that end at ``ends``."""
    one, two = hashers(length)
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(data))  # bytes to the text's end
    for at in range(0, max(len(data) - length + 1, 0), SEGMENT):
        part = data[at : at + SEGMENT + length - 1]
        sums = one.sums(part)
        begin = np.arange(len(part) - gram + 1)
        key = (one.of(sums, begin, begin + gram) & np.uint64(0xFFFFFFFF00000000)) | begin.astype(np.uint64)
        anchor = (sliding_min(key, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        start = np.flatnonzero(left[at : at + len(anchor)] >= length)
        if not len(start):
            continue
        anchor = anchor[start]
        new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(start, prepend=-2) != 1))
        first, last, anchor = start[new], start[np.append(new[1:], len(start)) - 1], anchor[new]
        tag = ((anchor - first) << 16 | (last - first)).astype(np.uint64)
        bucket = one.of(sums, anchor, anchor + gram)
        hull = _hull(two, two.sums(part), first, last, length, tag)
        yield bucket, hull, _packed(anchor + at, first + at, last + at)


def refined_runs(data: np.ndarray, places: np.ndarray, length: int, width: int) -> Iterator[tuple]:
    """``bucket, hull, place`` of the given runs, split by offset into ``width`` suffixes."""
    one, two = hashers(length)
    anchor, first, last = _unpacked(np.sort(places))
    segment = first // SEGMENT
    for s in np.unique(segment):
        at = int(s) * SEGMENT
        part = data[at : at + SEGMENT + 3 * length]
        of = segment == s
        a, f, e = anchor[of] - at, first[of] - at, last[of] - at
        low, high = (a - e) // width, (a - f) // width  # blocks of the offset from the anchor
        count = high - low + 1
        run = np.repeat(np.arange(len(a)), count)
        block = low[run] + np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
        a, f, e = a[run], f[run], e[run]
        latest = a - block * width  # the block's last start, whether or not the run has it
        last_own, first_own = np.minimum(e, latest), np.maximum(f, latest - width + 1)
        bucket = mix(one.of(one.sums(part), latest, latest - width + 1 + length) + mix(block.astype(np.uint64)))
        tag = ((latest - first_own) << 16 | (latest - last_own)).astype(np.uint64)
        hull = _hull(two, two.sums(part), first_own, last_own, length, tag)
        yield bucket, hull, _packed(a + at, first_own + at, last_own + at)


def _buffer(packed: bytes) -> tuple[list, np.ndarray, np.ndarray, list]:
    ids, texts, rests = unpack(packed)
    return ids, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts], dtype=np.int64), rests


def _run_frame(batch: int, runs: Iterable[tuple]) -> Iterator[pd.DataFrame]:
    for bucket, hull, place in runs:
        yield pd.DataFrame(
            {"bucket": bucket.view(np.int64), "hull": hull.view(np.int64), "batch": batch, "place": place}
        )


def _decided(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs whose hull occurs again; and the runs, one of each hull, of the buckets in which
    some hull occurs once beside others.

    Counts are written before they are joined: Spark can then split a bucket that holds a
    large part of all runs, since both sides of the join come straight from a shuffle.
    """
    again = runs.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    again = materialise(again, "repeated_buckets")
    candidates = materialise(runs.join(again, "bucket").select(runs.columns), "candidates")
    hulls = candidates.groupBy("bucket", "hull").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("batch", "place")).alias("one")
    )
    hulls = materialise(hulls, "hulls")
    open_buckets = (
        hulls.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("classes"), F.count_if(F.col("n") == 1).alias("singles"))
        .filter("classes > 1 AND singles > 0")
    )
    open_buckets = materialise(open_buckets, "open_buckets")
    repeated = candidates.join(hulls.filter("n > 1").select("bucket", "hull"), ["bucket", "hull"])
    undecided = hulls.join(open_buckets, "bucket")
    return repeated.select("batch", "place"), undecided.select("one.batch", "one.place")


def repeated_runs(batches: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``batch, place`` of runs all of whose suffixes have an equal elsewhere."""

    def initial(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn_of("repeats")
        for batch, packed in arrays(frames, "batch", "docs"):
            _, data, ends, _ = _buffer(packed)
            yield from _run_frame(batch, initial_runs(data, ends, length, gram))

    runs, found = batches.mapInPandas(initial, RUN), []
    for level, width in enumerate(REFINEMENTS):
        repeated, undecided = _decided(materialise(runs, f"runs{level}"))
        found.append(repeated)
        runs = _refined(batches, undecided, length, width)
    last = materialise(runs, "runs")
    equal = last.groupBy("bucket", "hull").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found.append(last.join(equal, ["bucket", "hull"]).select("batch", "place"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _refined(batches: DataFrame, undecided: DataFrame, length: int, width: int) -> DataFrame:
    def refine(own: pd.DataFrame, runs: pd.DataFrame) -> pd.DataFrame:
        frames = []
        for batch, packed in arrays([own], "batch", "docs"):
            if len(runs):
                _, data, _, _ = _buffer(packed)
                frames += _run_frame(batch, refined_runs(data, runs["place"].to_numpy(), length, width))
        return pd.concat(frames) if frames else _no_runs()

    return batches.groupBy("batch").cogroup(undecided.groupBy("batch")).applyInPandas(refine, RUN)


def _no_runs() -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("bucket", "hull", "batch", "place")})


def repeated_mask(size: int, places: np.ndarray, length: int) -> np.ndarray:
    """Which bytes of a batch are covered by the runs' strings."""
    _, first, last = _unpacked(places)
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, last + length, -1)
    return np.cumsum(steps[:-1]) > 0


def without_repeats(docs: DataFrame, make, schema: str, length: int = LENGTH) -> DataFrame:
    """``make(doc_id, text, covered, rest)`` of each document, as rows of ``schema``.

    ``docs`` is ``doc_id, text[, rest]``; ``covered`` marks the bytes of the UTF-8 text that
    belong to a repeated string.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = bucketed(in_batches(docs, BATCH_BYTES), "batch", max(1, -(-total // BUCKET_BYTES)))
    found = repeated_runs(batches, length)
    columns = [c.split()[0].strip("`") for c in schema.split(", ")]

    def finish(own: pd.DataFrame, runs: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for packed in own["docs"]:
            ids, data, ends, rests = _buffer(packed)
            covered = repeated_mask(len(data), runs["place"].to_numpy(np.int64), length)
            begin = 0
            for doc, end, rest in zip(ids, ends, rests, strict=True):
                rows.append(make(doc, data[begin:end], covered[begin:end], rest))
                begin = end
        return pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    return batches.groupBy("batch").cogroup(found.groupBy("batch")).applyInPandas(finish, schema)


def _digest(doc, data: np.ndarray, covered: np.ndarray, rest) -> tuple:
    spans = int(covered[:1].sum()) + int((covered[1:] & ~covered[:-1]).sum())
    return doc, len(data), int(covered.sum()), spans, hashlib.sha256(data[~covered].tobytes()).hexdigest()


def digest_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: bytes, bytes removed, spans removed, digest of the rest.

    A null text is empty; texts shorter than ``length`` keep all; exact copies of longer
    ones lose all; repeated rows count as copies.  An empty table gives an empty result;
    further columns are ignored.
    """
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return without_repeats(id_and_text(docs), _digest, schema, length)


def passages(data: np.ndarray, covered: np.ndarray) -> np.ndarray:
    """Which bytes belong to spans that are long enough, in words or in bytes."""
    ends = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
    out = covered.copy()
    for first, after in zip(ends[::2].tolist(), ends[1::2].tolist(), strict=True):
        if after - first < LENGTH and len(data[first:after].tobytes().split()) <= PASSAGE_WORDS:
            out[first:after] = False
    return out


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without repeated passages, with their own columns; n_chars is the new
    length.  A character of which a byte was removed goes whole; a null text stays null.

    A passage is a span covered by strings of ``PASSAGE_BYTES`` bytes that also start anywhere
    else, with over ``PASSAGE_WORDS`` words or at least ``LENGTH`` bytes.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.encode(F.to_json(F.struct(F.col("text").isNull().alias("no text"), F.struct(*others).alias("row"))), "UTF-8").alias("rest"),
    )

    def kept(doc, data: np.ndarray, covered: np.ndarray, rest) -> tuple:
        left = data[~passages(data, covered)].tobytes().decode("utf-8", "ignore")
        return doc, left, bytes(rest).decode("utf-8")

    out = without_repeats(rows, kept, "doc_id long, text string, rest string", PASSAGE_BYTES)
    kinds = dict(docs.dtypes)
    shape = ", ".join(f"`{c}`: {kinds[c]}" for c in others)
    row = F.from_json("rest", f"`no text` boolean, `row` struct<{shape}>")
    fields = {
        "doc_id": F.col("doc_id").cast(kinds["doc_id"]),
        "text": F.when(~F.col("r")["no text"], F.col("text")),
    }
    if "n_chars" in others:
        fields["n_chars"] = F.when(~F.col("r")["no text"], F.length("text")).cast(kinds["n_chars"])
    own = [fields.get(c, F.col("r")["row"][c]).alias(c) for c in docs.columns]
    return out.withColumn("r", row).select(own)


def op7_bucket_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_repeats(documents(spark, sf_dir))


# Every string of LENGTH bytes by its MD5; the hexadecimal text has two characters a byte.
ORACLE = f"""
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), starts AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, {2 * LENGTH})) AS m
  FROM (SELECT doc_id, h, unnest(range(greatest(len(h) // 2 - {LENGTH - 1}, 0))) AS i FROM docs)
), again AS (
  SELECT doc_id, i FROM starts WHERE m IN (SELECT m FROM starts GROUP BY m HAVING count(*) > 1)
), steps AS (
  SELECT *, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > {LENGTH}, TRUE) AS opens FROM again
), spans AS (
  SELECT doc_id, min(i) AS first, max(i) + {LENGTH} AS after
  FROM (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM steps)
  GROUP BY doc_id, span
), edges AS (
  SELECT doc_id, first, after FROM spans
  UNION ALL SELECT doc_id, len(h) // 2, len(h) // 2 FROM docs
), holes AS (
  SELECT *, coalesce(lag(after) OVER (PARTITION BY doc_id ORDER BY first, after), 0) AS kept_from FROM edges
)
SELECT d.doc_id, CAST(len(any_value(d.h)) // 2 AS BIGINT) AS n_bytes, CAST(sum(x.after - x.first) AS BIGINT) AS n_removed,
       count(*) - 1 AS n_spans,
       sha256(unhex(string_agg(substr(d.h, 2 * x.kept_from + 1, 2 * (x.first - x.kept_from)), '' ORDER BY x.first, x.after))) AS kept_sha256
FROM docs d JOIN holes x ON x.doc_id = d.doc_id GROUP BY d.doc_id
"""
