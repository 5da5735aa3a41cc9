"""Phrases whose words keep together, from counts of neighbouring ids.

Words that are frequent enough get ids by rank of frequency.  Neighbouring ids make a matrix of
pairs, counted in tiles: tiles of frequent words with many pairs by a dense ``bincount``, all
others as sorted coordinates.  Pairs that are frequent are ranked again and become the ids of
the next round, where neighbours overlap in all words but two: a phrase of k + 1 words is a
pair of phrases of k words.

Texts are encoded once, in batches of one language.  From then on a batch sends each of its
distinct words or pairs once, with its count, and gets back the ids of the frequent ones.  What
it sends is cut into parts by a hash and squeezed, so a row is a batch's share of a part and
not a pair.  A part of a language is added up by one task; it ranks what it finds frequent, and
the ranks of all parts are interleaved.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.functions.storage import materialise
from eventloom.llm.base import documents, give_back, mix, ship_package, text_or_empty

LEAST = 100
LONGEST = 5
TOP = 2000
#: Bytes of text in a batch; all unfinished batches of a task hold at most four times that.
BATCH_BYTES = 4 << 20

#: Width of a tile, how many of them a side may be dense, and how many pairs make one dense.
TILE_BITS = 10
DENSE_TILES = 4
DENSE_PAIRS = 1 << 16

#: Parts of a language, at least; more if that leaves over so many words of text to one.
PARTS = 64
PART_WORDS = 8 << 20

_ENDS = b".,;:!?\n\x0b\x0c\r"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_PLAIN = bytes.maketrans(_ENDS + b"\t" + _UPPER, b"." * len(_ENDS) + b" " + _UPPER.lower())


def words_and_ends(text: str) -> list[bytes]:
    """The words in order, with ``.`` wherever a piece ends."""
    return text.encode().translate(_PLAIN).replace(b".", b" . ").split()


_squeezer = zstandard.ZstdCompressor(level=3)


def _squeeze(values: np.ndarray, kind: type = np.int32) -> bytes:
    """Bytes of equal weight lie together, so that small numbers compress."""
    wide = np.dtype(kind).itemsize
    return _squeezer.compress(values.astype(kind).view(np.uint8).reshape(-1, wide).T.tobytes())


def _unsqueeze(data: bytes, kind: type = np.int32) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


# --- Parts --------------------------------------------------------------------------

_PART_ROWS = "array<struct<part: int, start: int, keys: binary, counts: binary>>"
_PART = pa.struct([("part", pa.int32()), ("start", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _cut(part: np.ndarray, counts: np.ndarray, keys: Callable[[int, int], bytes]) -> pa.Array:
    """One row's list of parts.  Items are in the order of their parts, and places follow it:
    the first item of a part has the place ``start + 1``."""
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(starts, len(part))[1:]
    cuts = [
        {"part": int(part[s]), "start": int(s), "keys": keys(s, e), "counts": _squeeze(counts[s:e], np.int64)}
        for s, e in zip(starts, ends, strict=True)
    ]
    return pa.array([cuts], pa.list_(_PART))


def _ranked(table: pa.Table, parts: int, inverse: np.ndarray, totals: np.ndarray, least: int, keys: Callable) -> pa.Table:
    """What is told to the batches of one part, and a row without a batch that lists the
    frequent items.  ``inverse`` has the batches' items as places in ``totals``, which are in
    the order of the keys; ``keys`` gives the columns of those at some places."""
    part = table.column("part")[0].as_py()
    often = np.flatnonzero(totals >= least)
    often = often[np.argsort(-totals[often], kind="stable")]
    numbers = np.zeros(len(totals), np.int64)
    numbers[often] = np.arange(len(often)) * parts + part + 1
    batches, places, ids = [], [], []
    at = 0
    for batch, start, size in zip(*(table.column(c).to_pylist() for c in ("batch", "start", "size")), strict=True):
        told = numbers[inverse[at : at + size]]
        at += size
        known = np.flatnonzero(told)
        if len(known):
            batches.append(batch)
            places.append(_squeeze(np.diff(known + start + 1, prepend=0)))
            ids.append(_squeeze(told[known], np.int64))
    found = {**keys(often), "f": pa.array(totals[often], pa.int64()), "id": pa.array(numbers[often], pa.int64())}
    offsets = pa.array([0] * (len(batches) + 1) + [len(often)], pa.int32())
    columns = {
        "lang": pa.array([table.column("lang")[0].as_py()] * (len(batches) + 1), pa.string()),
        "batch": pa.array([*batches, None], pa.int64()),
        "places": pa.array([*places, None], pa.binary()),
        "ids": pa.array([*ids, None], pa.binary()),
        **{name: pa.ListArray.from_arrays(offsets, values) for name, values in found.items()},
    }
    return pa.table(columns)


def add_words(table: pa.Table, parts: int, least: int) -> pa.Table:
    """One part of the words of a language, added up over all batches."""
    lists = [pa.array(zstandard.decompress(k).split(b" "), pa.large_binary()) for k in table.column("keys").to_pylist()]
    counts = [_unsqueeze(c, np.int64) for c in table.column("counts").to_pylist()]
    coded = pa.concat_arrays(lists).dictionary_encode()
    by_key = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(by_key), np.int64)
    place[by_key] = np.arange(len(by_key))
    inverse = place[coded.indices.to_numpy()]
    order = np.argsort(inverse, kind="stable")
    totals = np.add.reduceat(np.concatenate(counts)[order], np.flatnonzero(np.diff(inverse[order], prepend=-1)))
    table = table.append_column("size", pa.array([len(c) for c in counts], pa.int64()))

    def keys(often: np.ndarray) -> dict[str, pa.Array]:
        return {"word": coded.dictionary.take(pa.array(by_key[often])).cast(pa.string())}

    return _ranked(table, parts, inverse, totals, least, keys)


def add_pairs(table: pa.Table, parts: int, least: int) -> pa.Table:
    """One part of the pairs of a language, added up over all batches."""
    firsts, seconds, counts = [], [], []
    for keys, times in zip(*(table.column(c).to_pylist() for c in ("keys", "counts")), strict=True):
        both = _unsqueeze(keys, np.int64)
        firsts.append(np.cumsum(both[: len(both) // 2]))
        seconds.append(both[len(both) // 2 :])
        counts.append(_unsqueeze(times, np.int64))
    table = table.append_column("size", pa.array([len(c) for c in counts], pa.int64()))
    a, b, counts = np.concatenate(firsts), np.concatenate(seconds), np.concatenate(counts)
    del firsts, seconds
    if a.max() < 1 << 31 and b.max() < 1 << 32:
        order = np.argsort(a << 32 | b, kind="stable")
    else:
        order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    inverse = np.empty(len(a), np.int64)
    inverse[order] = np.cumsum(new) - 1
    totals = np.add.reduceat(counts[order], np.flatnonzero(new))
    a, b = a[new], b[new]

    def keys(often: np.ndarray) -> dict[str, pa.Array]:
        return {"a": pa.array(a[often], pa.int64()), "b": pa.array(b[often], pa.int64())}

    return _ranked(table, parts, inverse, totals, least, keys)


# --- Words --------------------------------------------------------------------------

_WORD_ROWS = f"batch long, lang string, n long, places binary, parts {_PART_ROWS}"


class Words:
    """A batch of texts as places in its own list of words; 0 is the end of a piece."""

    def __init__(self):
        self.index: defaultdict[bytes, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.index[b"."] = 0
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str) -> None:
        found = words_and_ends(text)
        self.parts.append(np.fromiter(map(self.index.__getitem__, found), np.int32, len(found)))
        self.parts.append(np.zeros(1, np.int32))
        self.size += len(text)

    def row(self, batch: int, lang: str) -> pa.RecordBatch:
        words = sorted(self.index)
        part = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % PARTS
        part[words.index(b".")] = -1
        order = np.argsort(part, kind="stable")
        words = [words[i] for i in order]
        anew = np.empty(len(words), np.int32)
        anew[np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))] = np.arange(len(words))
        places = anew[np.concatenate(self.parts)]
        counts = np.bincount(places, minlength=len(words))[1:]
        parts = _cut(part[order][1:], counts, lambda s, e: _squeezer.compress(b" ".join(words[s + 1 : e + 1])))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([batch], pa.int64()),
                pa.array([lang], pa.string()),
                pa.array([int(counts.sum())], pa.int64()),
                pa.array([_squeeze(places)], pa.binary()),
                parts,
            ],
            ["batch", "lang", "n", "places", "parts"],
        )


def _encoded(docs: DataFrame) -> DataFrame:
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: defaultdict[str, Words] = defaultdict(Words)
        total = 0
        for batch in batches:
            for i in range(batch.num_rows):
                lang, text = batch.column("lang")[i].as_py(), batch.column("text")[i].as_py()
                held[lang].add(text)
                total += len(text)
                full = lang if held[lang].size >= BATCH_BYTES else None
                if full is None and total >= 4 * BATCH_BYTES:
                    full = max(held, key=lambda x: held[x].size)
                if full is not None:
                    done = held.pop(full)
                    total -= done.size
                    yield done.row((task << 32) + made, full)
                    made += 1
        for lang, rest in held.items():
            yield rest.row((task << 32) + made, lang)
            made += 1
        held.clear()
        give_back()

    ship_package(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    return texts.mapInArrow(encode, _WORD_ROWS)


# --- Pairs --------------------------------------------------------------------------

_PAIR_ROWS = f"batch long, lang string, places binary, parts {_PART_ROWS}"


def count_pairs(
    ids: np.ndarray, left: np.ndarray, right: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each pair of places its own place (from 1) among the distinct pairs; the ids of
    those, and their counts.  ``ids`` are the places' ids; no two places share one."""
    a, b = ids[left], ids[right]
    place = np.zeros(len(a), np.int32)
    firsts, seconds, counts = [], [], []
    made = 1

    low = np.flatnonzero(np.maximum(a, b) >> TILE_BITS < DENSE_TILES)
    tile = (a[low] >> TILE_BITS) * DENSE_TILES + (b[low] >> TILE_BITS)
    sparse = np.ones(len(a), bool)
    side = 1 << TILE_BITS
    for t in np.flatnonzero(np.bincount(tile, minlength=DENSE_TILES**2) >= DENSE_PAIRS):
        at = low[tile == t]
        cell = ((a[at] & (side - 1)) << TILE_BITS) | (b[at] & (side - 1))
        cells = np.bincount(cell, minlength=side * side)
        used = np.flatnonzero(cells)
        number = np.zeros(side * side, np.int32)
        number[used] = np.arange(made, made + len(used))
        place[at] = number[cell]
        firsts.append((used >> TILE_BITS) + (t // DENSE_TILES) * side)
        seconds.append((used & (side - 1)) + (t % DENSE_TILES) * side)
        counts.append(cells[used])
        made += len(used)
        sparse[at] = False

    # Places fit into 32 bits however many ids there are.
    rest = np.flatnonzero(sparse)
    code = left[rest].astype(np.int64) << 32 | right[rest]
    code, inverse, times = np.unique(code, return_inverse=True, return_counts=True)
    place[rest] = inverse + made
    firsts.append(ids[code >> 32])
    seconds.append(ids[code & 0xFFFFFFFF])
    counts.append(times)
    return place, np.concatenate(firsts), np.concatenate(seconds), np.concatenate(counts)


def next_places(places: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of neighbouring pairs, given the ids (0: none) of the places before."""
    known = ids[places] > 0
    both = known[:-1] & known[1:]
    at, a, b, counts = count_pairs(ids, places[:-1][both], places[1:][both])
    out = np.zeros(len(both), np.int32)
    out[both] = at
    # One 0 is enough between two runs.
    kept = out > 0
    kept[1:] |= kept[:-1]
    return out[kept], a, b, counts


def parted(a: np.ndarray, b: np.ndarray, counts: np.ndarray, parts: int) -> tuple[np.ndarray, pa.Array]:
    """New places (0 stays) of distinct pairs, by part and pair, and the parts."""
    part = (mix(a.astype(np.uint64) ^ mix(b)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((b, a, part))
    anew = np.zeros(len(a) + 1, np.int32)
    anew[order + 1] = np.arange(1, len(a) + 1)
    a, b = a[order], b[order]

    def keys(s: int, e: int) -> bytes:
        return _squeeze(np.concatenate([np.diff(a[s:e], prepend=0), b[s:e]]), np.int64)

    return anew, _cut(part[order], counts[order], keys)


def _paired(encoded: DataFrame, told: DataFrame, parts: int) -> DataFrame:
    """Rows of the next round; batches without any frequent id have none."""

    def pair(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                places = _unsqueeze(row.column("places")[0].as_py())
                table = np.zeros(int(places.max(initial=0)) + 1, np.int64)
                for part in row.column("told")[0]:
                    table[np.cumsum(_unsqueeze(part["places"].as_py()))] = _unsqueeze(part["ids"].as_py(), np.int64)
                found, a, b, counts = next_places(places, table)
                if len(a) == 0:
                    continue
                anew, cut = parted(a, b, counts, parts)
                yield pa.RecordBatch.from_arrays(
                    [row.column("batch"), row.column("lang"), pa.array([_squeeze(anew[found])], pa.binary()), cut],
                    ["batch", "lang", "places", "parts"],
                )
        give_back()

    told = told.groupBy("batch").agg(F.collect_list(F.struct("places", "ids")).alias("told"))
    joined = encoded.select("batch", "lang", "places").join(told, "batch")
    return joined.mapInArrow(pair, _PAIR_ROWS)


# --- Rounds -------------------------------------------------------------------------


def _frequent(encoded: DataFrame, key: dict[str, str], parts: int, least: int) -> tuple[DataFrame, DataFrame]:
    """``(lang, key, f, id)`` of what is frequent, and its places and ids by ``batch``.

    Both come from one shuffle of the batches' parts.  Ids follow the frequency within a part
    and tell the part, so no two items of a language share one.
    """
    add = add_words if "word" in key else add_pairs
    sent = encoded.select("batch", "lang", F.inline("parts"))
    lists = ", ".join(f"{k} array<{t}>" for k, t in {**key, "f": "long", "id": "long"}.items())
    added = sent.groupBy("lang", "part").applyInArrow(
        lambda table: add(table, parts, least), f"lang string, batch long, places binary, ids binary, {lists}"
    )
    added = materialise(added, "frequent")
    found = added.where(F.col("batch").isNull()).select("lang", F.inline(F.arrays_zip(*key, "f", "id")))
    return found, added.where(F.col("batch").isNotNull()).select("batch", "places", "ids")


def _phrases(ranked: DataFrame, shorter: DataFrame) -> DataFrame:
    """Words of the ranked pairs, and the counts of all their beginnings and ends."""
    first = shorter.select("lang", F.col("id").alias("a"), F.col("words").alias("head"), "begins")
    second = shorter.select("lang", F.col("id").alias("b"), F.col("words").alias("tail"), "ends")
    joined = ranked.join(first, ["lang", "a"]).join(second, ["lang", "b"])
    return joined.select(
        "lang",
        "id",
        "a",
        "b",
        "f",
        F.concat("head", F.slice("tail", -1, 1)).alias("words"),
        F.concat("begins", F.array("f")).alias("begins"),
        F.concat("ends", F.array("f")).alias("ends"),
    )


def _scored(phrases: DataFrame, length: int) -> Column:
    """The lowest ``(score, cut, l, r)`` of the phrases' cuts; whole numbers of 38 digits."""
    cuts = []
    for cut in range(1, length):
        left, right = F.element_at("begins", cut), F.element_at("ends", length - cut)
        whole = [F.lit(1000).cast("decimal(4,0)"), F.col("f").cast("decimal(16,0)"), F.col("n").cast("decimal(16,0)")]
        top = whole[0] * whole[1] * whole[2]
        score = F.call_function("div", top, left.cast("decimal(16,0)") * right.cast("decimal(16,0)"))
        cuts.append(F.struct(score.alias("score"), F.lit(cut).alias("cut"), left.alias("l"), right.alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """The ``top`` best phrases of each language, by score, frequency and UTF-8 bytes.

    A null text is empty and a null lang is ``und``.  Every occurrence counts, also in
    repeated rows and whole long texts.  A language without candidates has no rows; an empty
    table gives an empty result; further columns are ignored.
    """
    encoded = materialise(_encoded(docs), "words")
    sizes = encoded.groupBy("lang").agg(F.sum("n").alias("n"))
    ranked, told = _frequent(encoded, {"word": "string"}, PARTS, least)
    # The words of the largest language; no batch sends more pairs than it has words.
    most = sizes.agg(F.max("n")).first()[0] or 0
    parts = max(PARTS, 1 << (most // PART_WORDS).bit_length())
    rounds = [
        ranked.select("lang", "id", "f", *[F.array(c).alias(n) for c, n in (("word", "words"), ("f", "begins"), ("f", "ends"))])
    ]
    found = []
    for length in range(2, longest + 1):
        encoded = materialise(_paired(encoded, told, parts), f"pairs-{length}")
        ranked, told = _frequent(encoded, {"a": "long", "b": "long"}, parts, least)
        rounds.append(materialise(_phrases(ranked, rounds[-1]), f"phrases-{length}"))
    for length in range(2, longest + 1):
        phrases = rounds[length - 1]
        if length < longest:
            # What lies inside a longer candidate lies inside one with one more word.
            inside = rounds[length].select("lang", F.explode(F.array("a", "b")).alias("id"), F.col("f").alias("longer"))
            most = inside.groupBy("lang", "id").agg(F.max("longer").alias("longer"))
            phrases = phrases.join(most, ["lang", "id"], "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("f")))
        scored = phrases.join(sizes, "lang").withColumn("best", _scored(phrases, length))
        found.append(
            scored.select(
                "lang",
                F.array_join("words", " ").alias("phrase"),
                F.col("f").alias("a"),
                F.col("best.l").alias("l"),
                F.col("best.r").alias("r"),
                "n",
                F.col("best.score").cast("long").alias("score"),
            )
        )
    together = found[0]
    for more in found[1:]:
        together = together.unionByName(more)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    # Spark keeps the first rows of each task before it brings a language together.
    best = together.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


ORACLE = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^ \\t]+') AS words
  FROM (SELECT lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\\n\\x0b\\x0c\\r]')) AS piece FROM documents)
), sizes AS (
  SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang
), counted AS (
  SELECT lang, words[i : i + k - 1] AS words, count(*) AS f
  FROM pieces, unnest(range(1, {LONGEST + 1})) AS ks(k), unnest(range(1, len(words) - k + 2)) AS starts(i)
  GROUP BY ALL
), frequent AS (
  SELECT *, len(words) AS k FROM counted WHERE f >= {LEAST}
), dominated AS (
  SELECT lang, words[i : i + j - 1] AS words, max(f) AS longer
  FROM frequent, unnest(range(2, k)) AS js(j), unnest(range(1, k - j + 2)) AS starts(i)
  GROUP BY ALL
), cuts AS (
  SELECT p.lang, p.words, p.f AS a, x.f AS l, y.f AS r, s.n, j,
         CAST((1000::HUGEINT * p.f * s.n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM frequent p JOIN sizes s USING (lang), unnest(range(1, p.k)) AS js(j)
  JOIN frequent x ON x.lang = p.lang AND x.words = p.words[1 : j]
  JOIN frequent y ON y.lang = p.lang AND y.words = p.words[j + 1 : p.k]
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, j) = 1
)
SELECT lang, row_number() OVER w AS rank, array_to_string(words, ' ') AS phrase, a, l, r, n, score
FROM best LEFT JOIN dominated USING (lang, words)
WHERE longer IS NULL OR longer < a
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' '))
QUALIFY rank <= {TOP}
"""
