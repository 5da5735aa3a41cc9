"""Similarity join of documents on word n-grams by chosen paths.

Each text is the set of its n-grams of words; min-hashing embeds a set in tokens, of which
two sets share as large a part as their Jaccard coefficient says.  A run splits all sets
recursively: every node of its tree samples a few coordinates, by a hash of the path to it,
and a set follows the tokens it has there.  Buckets that are small enough are compared by
brute force on sketches, and what looks similar is then verified on the full sets.  A larger
bucket is split again as long as that leaves clearly fewer pairs to compare.  Where it does
not, as in a family of documents that all resemble each other, the bucket is compared
completely, block against block, on the full sets; of such a bucket only counts and links
that span it are written.  Several runs with other samples bring the recall to its target.
Verified links make classes.

Recall of a run for a pair at the threshold s, with ``BRANCHES`` coordinates a node: a node
that holds both passes them on together unless no sampled token is shared, so the pair is
lost with a probability below the smallest root of q = (1 - s + s q)^BRANCHES, 0.0625 for
s = 0.8, and in all ``RUNS`` runs with 0.0625^4 = 0.00002.  The tree has no last level, and a
bucket that is compared completely loses no pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.storage import materialise
from eventloom.llm.base import (
    Memo,
    arrays,
    documents,
    id_and_text,
    mix,
    remembers,
    shingle_hashes,
    ship_package,
    text_or_empty,
    turn_of,
)
from eventloom.llm.batches import LEVEL, bucketed

#: Words in an n-gram, and the least Jaccard coefficient of a link.
WORDS, LEAST = 5, 0.8
#: Tokens of the embedding (a power of two), runs, coordinates sampled at a node.
TOKENS, RUNS, BRANCHES = 128, 4, 2
#: Sets in a bucket that are compared by brute force; sets in a block of a larger bucket.
BRUTE, SPLIT = 64, 1024
#: A larger bucket is split if that leaves at most this share of its pairs.
FEWER = 0.75
#: n-grams of a block, after which another one is begun.
BLOCK_GRAMS = 2_000_000
#: Share of equal sketch bytes from which a pair is verified: five standard deviations
#: below the threshold for 128 tokens.
SKETCH_LEAST = 0.62
#: Words whose hashes a task remembers.
REMEMBERED = 100_000

#: Columns beside those of the table.
KEY, SKETCH = "chosen path key", "chosen path tokens"

_words = Memo(xxhash.xxh64_intdigest, REMEMBERED)
remembers("jaccard", _words.clear)
_odd = mix(np.arange(1, TOKENS + 1, dtype=np.uint64)) | np.uint64(1)
_add = mix(np.arange(1001, TOKENS + 1001, dtype=np.uint64))


def ngram_set(text: str, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of the lower-case words between white space;
    of all words, if there are fewer than ``n``."""
    units = text.lower().split()
    return np.unique(shingle_hashes(np.fromiter(map(_words.__getitem__, units), np.uint64, len(units)), n))


def set_key(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def min_hashes(grams: np.ndarray) -> np.ndarray:
    best = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 2048):
        part = grams[at : at + 2048, None] * _odd + _add
        np.minimum(best, part.min(axis=0), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard's coefficient of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return float(not len(b))
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    shared = int((b[place] == a).sum())
    return shared / (len(a) + len(b) - shared)


def _shingled(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with their set's ``key`` and min-hash ``tokens``, written once.

    Both have names of their own beside the table's columns.  Tokens are left out of texts
    without n-grams and of copies within an Arrow batch.
    """
    at = docs.columns.index("text")

    def shingle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_of("jaccard")
        for batch in batches:
            keys, tokens, seen = [], [], set()
            for i in range(batch.num_rows):
                grams = ngram_set(batch.column(at)[i].as_py() or "")
                key = set_key(grams)
                keys.append(key)
                tokens.append(min_hashes(grams).tobytes() if len(grams) and key not in seen else None)
                seen.add(key)
            batch = batch.append_column(KEY, pa.array(keys, pa.binary()))
            yield batch.append_column(SKETCH, pa.array(tokens, pa.binary()))

    ship_package(docs.sparkSession)
    added = [T.StructField(KEY, T.BinaryType()), T.StructField(SKETCH, T.BinaryType())]
    return materialise(docs.mapInArrow(shingle, T.StructType([*docs.schema.fields, *added])), "shingled", "zstd")


def _sets(shingled: DataFrame) -> DataFrame:
    """``key, tokens, packed``: one row per set, with its text; sets without n-grams not.

    Copies meet in their own tasks first, so a text that a third of all rows share crosses
    the network once a task.
    """

    def pack(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["packed"] = [zstandard.compress(t.encode("utf-8"), LEVEL) for t in frame.pop("text")]
            yield frame

    rows = shingled.filter(F.col(SKETCH).isNotNull())
    rows = rows.select(F.col(KEY).alias("key"), F.col(SKETCH).alias("tokens"), text_or_empty().alias("text"))
    made = rows.mapInPandas(pack, "key binary, tokens binary, packed binary")
    return made.groupBy("key").agg(F.first("tokens").alias("tokens"), F.first("packed").alias("packed"))


def _tokens(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(len(column), TOKENS)


def _children(paths: np.ndarray, used: list[np.ndarray], tokens: np.ndarray) -> Iterator[tuple]:
    """The paths on which sets go on from the nodes ``paths``, and the coordinates they have
    used, as two words of bits: no node samples one again that splits nothing any more."""
    low, high = used
    first, stride = mix(paths + np.uint64(1)), mix(paths + np.uint64(2)) | np.uint64(1)
    at = first % np.uint64(TOKENS)
    for _ in range(BRANCHES):
        for _ in range(TOKENS):
            taken = (np.where(at < 64, low, high) >> (at & np.uint64(63))) & np.uint64(1) == 1
            if not taken.any():
                break
            at = np.where(taken, (at + stride) % np.uint64(TOKENS), at)
        bit = np.uint64(1) << (at & np.uint64(63))
        low, high = np.where(at < 64, low | bit, low), np.where(at < 64, high, high | bit)
        token = tokens[np.arange(len(tokens)), at.astype(np.int64)].astype(np.uint64)
        path = mix(paths ^ mix((at << np.uint64(32)) | token))
        yield path.view(np.int64), low.view(np.int64), high.view(np.int64)


_PATHS = "parent long, path long, low long, high long, key binary"


def _first_paths(sets: DataFrame) -> DataFrame:
    def split(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                tokens, none = _tokens(frame["tokens"]), np.zeros(len(frame), np.uint64)
                for run in range(RUNS):
                    root = np.full(len(frame), mix(np.array([run + 1], np.uint64))[0])
                    for path, low, high in _children(root, [none, none], tokens):
                        yield pd.DataFrame({"parent": 0, "path": path, "low": low, "high": high, "key": frame["key"]})

    return sets.select("key", "tokens").mapInPandas(split, _PATHS)


def _next_paths(rows: DataFrame, sets: DataFrame) -> DataFrame:
    def split(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                paths, *used = (frame[c].to_numpy(np.int64).view(np.uint64) for c in ("path", "low", "high"))
                for path, low, high in _children(paths, used, _tokens(frame["tokens"])):
                    yield pd.DataFrame({"parent": frame["path"], "path": path, "low": low, "high": high, "key": frame["key"]})

    joined = rows.select("path", "low", "high", "key").join(sets.select("key", "tokens"), "key")
    return joined.select("path", "low", "high", "key", "tokens").mapInPandas(split, _PATHS)


def _leaves(sets: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``path, key`` of the buckets of at most ``BRUTE`` sets, and of the larger ones that
    splitting does not help: every bucket ends as one or the other."""
    small, large = [], []
    rows = materialise(_first_paths(sets), "paths")
    while True:
        sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        members = materialise(rows.drop("parent").join(sizes, "path"), "members")
        small.append(members.filter(F.col("n") <= BRUTE).select("path", "key"))
        open_buckets = members.filter(F.col("n") > BRUTE)
        if open_buckets.isEmpty():
            break
        children = materialise(_next_paths(open_buckets, sets), "paths")
        square = F.col("c").cast("double") * F.col("c")
        left = children.groupBy("parent", "path").agg(F.count(F.lit(1)).alias("c")).groupBy("parent").agg(F.sum(square).alias("left"))
        own = open_buckets.groupBy("path").agg(F.first("n").cast("double").alias("n"))
        helps = F.col("left") <= FEWER * F.col("n") * F.col("n")
        judged = materialise(left.withColumnRenamed("parent", "path").join(own, "path").select("path", helps.alias("helps")), "judged")
        large.append(open_buckets.select("path", "key").join(judged.filter(~F.col("helps")), "path").select("path", "key"))
        rows = children.join(judged.filter("helps").select(F.col("path").alias("parent")), "parent")
    return reduce(DataFrame.unionByName, small), reduce(DataFrame.unionByName, large) if large else None


def _compared(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b`` (a < b) of the pairs in a small bucket whose sketches are alike.  ``members``
    is ``path, key``."""

    def sketch(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            low = _tokens(frame.pop("tokens")).astype(np.uint8) if len(frame) else None
            frame["sketch"] = [row.tobytes() for row in low] if low is not None else []
            yield frame

    def compare(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn_of("jaccard")
        bucket, held = None, []
        for frame in frames:
            found: list[tuple[bytes, bytes]] = []
            for now, key, sketched in zip(*(frame[c] for c in ("path", "key", "sketch")), strict=True):
                # Rows of a bucket stand together.
                if now != bucket:
                    found += _alike(held)
                    bucket, held = now, []
                held.append((key, sketched))
            yield pd.DataFrame(found, columns=["a", "b"])
        yield pd.DataFrame(_alike(held), columns=["a", "b"])

    rows = members.join(sets.select("key", "tokens"), "key").select("path", "key", "tokens")
    sketched = rows.mapInPandas(sketch, "path long, key binary, sketch binary")
    return sketched.repartition("path").sortWithinPartitions("path").mapInPandas(compare, "a binary, b binary")


def _alike(some: list) -> list[tuple[bytes, bytes]]:
    if len(some) < 2:
        return []
    x = np.frombuffer(b"".join(s for _, s in some), np.uint8).reshape(len(some), TOKENS)
    pairs = []
    for i, row in enumerate(x[:-1]):
        a = some[i][0]
        for j in np.flatnonzero((x[i + 1 :] == row).sum(axis=1) >= SKETCH_LEAST * TOKENS):
            b = some[i + 1 + j][0]
            pairs.append((min(a, b), max(a, b)))
    return pairs


# --- Large buckets, block against block -----------------------------------------------


def _bundle(*parts: np.ndarray) -> bytes:
    sizes = np.array([p.nbytes for p in parts], np.int64)
    return zstandard.compress(b"".join([sizes.tobytes(), *(p.tobytes() for p in parts)]), 3)


def _unbundle(packed: bytes, *kinds: type) -> list[np.ndarray]:
    data, at, out = zstandard.decompress(packed), 8 * len(kinds), []
    for kind, size in zip(kinds, np.frombuffer(data, np.int64, len(kinds)), strict=True):
        out.append(np.frombuffer(data[at : at + size], kind))
        at += int(size)
    return out


def _listed(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All values, and as numbers of values the entries of the lists with their lengths."""
    values, entries = np.unique(np.concatenate(lists), return_inverse=True)
    return values, entries.astype(np.int32), np.array([len(x) for x in lists], np.int32)


def _shared(x: tuple, y: tuple) -> np.ndarray:
    """How many values each list of ``x`` shares with each of ``y``."""
    out = np.zeros((len(x[2]), len(y[2])), np.float32)
    both = np.intersect1d(x[0], y[0], assume_unique=True)
    sides = []
    for values, entries, lengths in (x, y):
        number = np.full(len(values), -1, np.int64)
        number[np.searchsorted(values, both)] = np.arange(len(both))
        columns, rows = number[entries], np.repeat(np.arange(len(lengths)), lengths)
        order = np.argsort(columns, kind="stable")
        sides.append((columns[order], rows[order]))
    for at in range(0, len(both), 2048):
        dense = []
        for (columns, rows), n in zip(sides, out.shape, strict=True):
            here = slice(*np.searchsorted(columns, [at, at + 2048]))
            dense.append(np.zeros((n, min(2048, len(both) - at)), np.float32))
            dense[-1][rows[here], columns[here] - at] = 1
        out += dense[0] @ dense[1].T
    return out


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """As many of the links (row, column) as connect all that ``linked`` connects."""
    across, rows, columns, out = np.ascontiguousarray(linked.T), linked.any(axis=1), linked.any(axis=0), []
    for first in np.flatnonzero(rows):
        reached = [first] if rows[first] else []
        rows[first] = False
        while reached:
            i = reached.pop()
            for j in np.flatnonzero(linked[i] & columns):
                columns[j] = False
                more = np.flatnonzero(across[j] & rows)
                rows[more] = False
                out += [(i, j), *((k, j) for k in more)]
                reached += list(more)
    return out


def _blocks(large: DataFrame, lists: DataFrame, sets: DataFrame) -> DataFrame:
    """``path, team, block, packed``: the sets of a large bucket in blocks of about ``SPLIT``.

    A team is what has its smallest large bucket in common, named by it; those of small teams
    are in the team of the bucket's own name.
    """
    rows = large.join(lists, "key").withColumn("first", F.col("paths")[0])
    counts = materialise(rows.groupBy("path", "first").agg(F.count(F.lit(1)).alias("c")), "teams")
    counts = counts.withColumn("team", F.when(F.col("c") * 8 >= SPLIT, F.col("first")).otherwise(F.col("path")))
    teams = counts.groupBy("path", "team").agg(F.ceil(F.sum("c") / SPLIT).cast("int").alias("parts"))
    teams = counts.select("path", "first", "team").join(teams, ["path", "team"])
    salted = rows.join(teams, ["path", "first"]).withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    dealt = salted.join(sets.select("key", "packed"), "key").select("path", "team", "part", "key", "paths", "packed")

    def build(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn_of("jaccard")
        task, made, here, held, size = TaskContext.get().partitionId(), 0, None, [], 0

        def block() -> pd.DataFrame:
            keys, grams, met = zip(*held, strict=True)
            names = np.frombuffer(b"".join(keys), np.uint8)
            packed = _bundle(names, *_listed(grams), *_listed(met))
            return pd.DataFrame({"path": [here[0]], "team": [here[1]], "block": [(task << 32) + made], "packed": [packed]})

        for path, team, part, key, paths, packed in arrays(frames, "path", "team", "part", "key", "paths", "packed"):
            if held and (here != (path, team, part) or size >= BLOCK_GRAMS):
                yield block()
                made, held, size = made + 1, [], 0
            here = path, team, part
            grams = ngram_set(zstandard.decompress(packed).decode("utf-8"))
            met = np.asarray(paths, np.int64)
            held.append((key, grams, met[met < path]))
            size += len(grams)
        if held:
            yield block()

    ordered = dealt.repartition("path", "team", "part").sortWithinPartitions("path", "team", "part")
    return materialise(ordered.mapInPandas(build, "path long, team long, block long, packed binary"), "blocks")


def block_links(large: DataFrame, lists: DataFrame, sets: DataFrame, least: float = LEAST) -> DataFrame:
    """``a, b, n`` of the large buckets: rows without ``b`` add ``n`` to the links of ``a``,
    the others are links that span the classes.

    Each pair of blocks is one row of a task.  A pair of sets that meets in several large
    buckets counts in the one of smallest path; two blocks of a team that is named by
    another bucket hold no other pairs and are not compared.
    """
    blocks = _blocks(large, lists, sets)
    x = blocks.select("path", F.col("team").alias("t"), F.col("block").alias("x"))
    y = blocks.select("path", F.col("team").alias("u"), F.col("block").alias("y"))
    pairs = x.join(y, "path").filter("x <= y AND (t != u OR t = path)").select("x", "y")
    for side in ("x", "y"):
        pairs = pairs.join(blocks.select(F.col("block").alias(side), F.col("packed").alias(f"packed_{side}")), side)

    def compare(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn_of("jaccard")
        kinds = [np.uint8, np.uint64, np.int32, np.int32, np.int64, np.int32, np.int32]
        for i, j, *packed in arrays(frames, "x", "y", "packed_x", "packed_y"):
            (a, *x), (b, *y) = (_unbundle(p, *kinds) for p in packed)
            a, b = ([k.tobytes() for k in keys.reshape(-1, 16)] for keys in (a, b))
            shared = _shared(x[:3], y[:3]).astype(np.float64)
            linked = shared / (x[2][:, None] + y[2] - shared) >= least
            linked &= _shared(x[3:], y[3:]) == 0
            if i == j:
                np.fill_diagonal(linked, False)
            counts = [*zip(a, linked.sum(axis=1), strict=True)]
            if i == j:
                np.fill_diagonal(linked, True)
            else:
                counts += zip(b, linked.sum(axis=0), strict=True)
            out = [(key, None, int(n)) for key, n in counts if n]
            out += [(a[p], b[q], 0) for p, q in _forest(linked) if a[p] != b[q]]
            yield pd.DataFrame(out, columns=["a", "b", "n"])

    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.select("x", "y", "packed_x", "packed_y").repartition(parts, "x", "y")
    return dealt.mapInPandas(compare, "a binary, b binary, n long")


def candidate_pairs(small: DataFrame, lists: DataFrame | None, sets: DataFrame) -> DataFrame:
    """Pairs of keys that some small bucket and no large one holds and whose sketches are alike."""
    pairs = _compared(small, sets).distinct()
    if lists is None:
        return pairs
    for end in ("a", "b"):
        pairs = pairs.join(lists.select(F.col("key").alias(end), F.col("paths").alias(f"paths_{end}")), end, "left")
    return pairs.filter(~F.coalesce(F.arrays_overlap("paths_a", "paths_b"), F.lit(False))).select("a", "b")


def verified_links(pairs: DataFrame, sets: DataFrame, least: float = LEAST) -> DataFrame:
    """The pairs whose full sets are as similar as asked.  One text of each pair moves."""

    def verify(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn_of("jaccard")
        grams = Memo(lambda packed: ngram_set(zstandard.decompress(packed).decode("utf-8")), 64)
        for frame in frames:
            ok = [similarity(grams[x], grams[y]) >= least for x, y in zip(frame["x"], frame["y"], strict=True)]
            yield frame.loc[np.array(ok, bool), ["a", "b"]]

    left = sets.select(F.col("key").alias("a"), F.col("packed").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("packed").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(verify, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """``key, root`` for every key that has a link; root is the smallest key it reaches.

    Large-star and small-star steps in turn: each key's larger, then its smaller neighbours
    are hung on the smallest one, until nothing changes.
    """
    edges, before = materialise(links.select("a", "b"), "links"), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        larger = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
        edges = materialise(larger.filter("a != b").distinct(), "large_star")
        lower = edges.groupBy("b").agg(F.min("a").alias("m"))
        smaller = edges.join(lower, "b").select(F.col("m").alias("x"), "a", "b")
        hung = smaller.select("x", F.explode(F.array("a", "b")).alias("b")).filter("x != b")
        edges = materialise(hung.select(F.col("x").alias("a"), "b").distinct(), "small_star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("key"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("key"), F.col("a").alias("root")).distinct()
    )


def _classes(shingled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``key, root`` of linked sets, and ``key, n_links``."""
    parts = int(shingled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sets = bucketed(_sets(shingled), "key", parts)
    small, large = _leaves(sets)
    lists = None
    if large is not None:
        large = materialise(large, "large")
        lists = materialise(large.groupBy("key").agg(F.sort_array(F.collect_list("path")).alias("paths")), "lists")
    pairs = materialise(candidate_pairs(small, lists, sets), "pairs")
    links = materialise(verified_links(pairs, sets), "verified")
    ends = links.select(F.explode(F.array("a", "b")).alias("key"), F.lit(1).cast("long").alias("n"))
    if large is not None:
        found = materialise(block_links(large, lists, sets), "block_links")
        ends = ends.unionByName(found.filter("b IS NULL").select(F.col("a").alias("key"), "n"))
        links = links.unionByName(found.filter("b IS NOT NULL").select("a", "b"))
    return components(links), ends.groupBy("key").agg(F.sum("n").alias("n_links"))


def join_documents(docs: DataFrame) -> DataFrame:
    """One row per document: class_id, the smallest doc_id of its class, and n_links.

    A class holds texts with equal n-gram sets and all that verified links connect;
    ``n_links`` counts the verified links of the document's text to different texts, in
    large families too.
    Texts without words (null, empty, blank) are copies of each other.  Repeated rows stay
    rows; null ids stay null and name a class only if it has no other.  An empty table gives
    an empty result; further columns are ignored.
    """
    shingled = _shingled(id_and_text(docs))
    keyed = shingled.select("doc_id", F.col(KEY).alias("key"))
    roots, degrees = _classes(shingled)
    sets = keyed.groupBy("key").agg(F.min("doc_id").alias("first"))
    rooted = sets.join(roots, "key", "left").select("key", "first", F.coalesce("root", "key").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("class_id"))
    named_sets = rooted.join(named, "root").join(degrees, "key", "left")
    named_sets = named_sets.select("key", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return keyed.join(named_sets, "key").select("doc_id", "class_id", "n_links")


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, the one with the smallest doc_id, with its own columns."""
    rows = _shingled(docs)
    keyed = rows.select("doc_id", F.col(KEY).alias("key"))
    roots, _ = _classes(rows)
    sets = keyed.groupBy("key").agg(F.min("doc_id").alias("first"))
    rooted = sets.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    order = F.struct(F.col("first").isNull(), "first", "key")
    chosen = rooted.groupBy("root").agg(F.min(order).alias("o")).select(
        F.col("o.key").alias(KEY), F.col("o.first").alias("chosen id")
    )
    one = rows.drop(SKETCH).join(chosen, KEY).filter(F.col("doc_id").eqNullSafe(F.col("chosen id")))
    return one.drop("chosen id").dropDuplicates([KEY]).drop(KEY)


def op10_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(documents(spark, sf_dir))


ORACLE = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\s]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_sort(list_distinct(
           CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))
           END)) AS grams
  FROM docs
), keyed AS (
  SELECT doc_id, grams, md5(array_to_string(grams, chr(10))) AS key FROM sets
), reps AS (
  SELECT key, any_value(grams) AS grams, min(doc_id) AS first FROM keyed GROUP BY key
), tokens AS (
  SELECT key, len(grams) AS n, unnest(grams) AS gram FROM reps
), pairs AS (
  SELECT a.key AS x, b.key AS y FROM tokens a JOIN tokens b ON a.gram = b.gram AND a.key < b.key
  GROUP BY a.key, b.key, a.n, b.n HAVING 10 * count(*) >= 8 * (a.n + b.n - count(*))
), links AS (
  SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs
), reached AS (
  SELECT key, key AS origin FROM reps
  UNION SELECT l.y, r.origin FROM reached r JOIN links l ON l.x = r.key
), classes AS (
  SELECT r.key, min(o.first) AS class_id FROM reached r JOIN reps o ON o.key = r.origin GROUP BY r.key
), degrees AS (
  SELECT x AS key, count(*) AS n_links FROM links GROUP BY x
)
SELECT k.doc_id, c.class_id, coalesce(d.n_links, 0) AS n_links
FROM keyed k JOIN classes c USING (key) LEFT JOIN degrees d USING (key)
"""
