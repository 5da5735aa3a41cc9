"""Best-fit packing of token pieces into sequences, improved by swap-based local search.

Pieces are dealt evenly to tasks; a task packs groups of at most ``GROUP`` pieces.  In each
group a best-fit pass makes bins.  Then underfull bins exchange pieces, one for one, two for
one or one for nothing, always so that the fuller bin gains: the sum of squared fills grows,
so the search ends, and room gathers in ever fewer bins until they are empty.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from eventloom.functions.storage import materialise
from eventloom.llm.base import INFORMATION_SEPARATORS, Generations, arrays, documents, id_and_text, remembers, turn_of

CAPACITY = 4096
VOCABULARY = "word_bpe_49k.json"
#: Id put after each document.
SEPARATOR = 1
#: Pieces packed together, and pieces dealt to one task, at most.
GROUP, TASK_ROWS = 1 << 15, 1 << 18
#: Units and words whose ids a task remembers, each.
REMEMBERED = 800_000

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer(name: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path(name))
    found.no_truncation()
    found.no_padding()
    return found


class WordIds:
    """Little-endian 32-bit ids of a text, through memories of text and words seen before.

    The vocabulary drops white space before it splits, so no token spans it: a text's ids
    are those of its units between white space, and a unit's those of the words in it.
    Printable ASCII is split here, the rest by the tokenizer's own parts; words are encoded
    by the tokenizer's model.
    """

    def __init__(self, name: str):
        import regex

        self.whole = tokenizer(name)
        self.unit = Generations(self._unit, REMEMBERED)
        self.word = Generations(self._word, REMEMBERED)
        self.blanks = regex.compile(r"\p{White_Space}+")
        self.split = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+").findall

    def _word(self, word: str) -> bytes:
        return np.array([t.id for t in self.whole.model.tokenize(word)], "<u4").tobytes()

    def _unit(self, unit: str) -> bytes:
        if "<|" in unit:  # may hold special tokens
            return np.array(self.whole.encode(unit, add_special_tokens=False).ids, "<u4").tobytes()
        if unit.isascii() and unit.isprintable():
            words = self.split(unit.lower())
        else:
            normal = self.whole.normalizer.normalize_str(unit)
            words = [w for w, _ in self.whole.pre_tokenizer.pre_tokenize_str(normal)]
        return b"".join(map(self.word.__getitem__, words))

    def __call__(self, text: str) -> bytes:
        odd = any(c in text for c in INFORMATION_SEPARATORS)
        units = [u for u in self.blanks.split(text) if u] if odd else text.split()
        return b"".join(map(self.unit.__getitem__, units))


@functools.cache
def word_ids(name: str) -> WordIds:
    """One for each Python worker."""
    return WordIds(name)


remembers("packing", word_ids.cache_clear)


def pieces(docs: DataFrame, name: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """The documents' ids, each followed by the separator, cut where they exceed a sequence."""

    def cut(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn_of("packing")
        encode = word_ids(name)
        end = np.array([SEPARATOR], "<u4").tobytes()
        for frame in frames:
            rows = []
            for doc, text in arrays([frame], "doc_id", "text"):
                ids = encode(text) + end
                for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, i, at // 4, len(part) // 4, zlib.crc32(part)))
            yield _frame(rows)

    return id_and_text(docs).mapInPandas(cut, PIECE)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
    return frame.astype({"doc_id": "Int64"})


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes: longest first, each to the bin with the least room that takes it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        by_room[room - n].append(b)
        rooms |= 1 << (room - n)
    return bins


class LocalSearch:
    """Fills underfull bins to the brim at the cost of emptier ones, until bins are empty.

    Bins take their turn from the fullest on.  One takes a piece, takes a piece for one or
    two smaller ones of its own, or takes two pieces of the emptiest bin for none or one of
    its own; of all these the exchange is made that fills it most.
    """

    def __init__(self, lengths: list[int], bins: list[list[int]], capacity: int):
        self.lengths, self.bins, self.capacity = lengths, bins, capacity
        self.fill = [sum(lengths[i] for i in b) for b in bins]
        self.owner = {i: b for b, items in enumerate(bins) for i in items}

    def run(self) -> list[list[int]]:
        slack = sum(self.capacity - f for f in self.fill)
        order = sorted((b for b, f in enumerate(self.fill) if f < self.capacity), key=lambda b: -self.fill[b])
        self.pool = sorted((self.lengths[i], i) for b in order for i in self.bins[b])
        self.emptiest = order[::-1]
        for receiver in order:
            # With less room in all than one bin has, no bin can be saved.
            if slack < self.capacity:
                break
            if not self.bins[receiver]:
                continue
            for i in self.bins[receiver]:
                self._leave_pool(i)
            while self.fill[receiver] < self.capacity and (found := self._best(receiver)):
                slack -= self.capacity * self._exchange(receiver, *found)
        return [b for b in self.bins if b]

    def _best(self, receiver: int) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
        """What the receiver gives and takes."""
        room, fill, best, found = self.capacity - self.fill[receiver], self.fill[receiver], 0, None
        own = self.bins[receiver]
        while not self.bins[self.emptiest[0]]:
            self.emptiest.pop(0)
        for given in itertools.chain(((),), ((i,) for i in own), itertools.combinations(own, 2)):
            base = sum([self.lengths[i] for i in given])
            at = bisect.bisect_right(self.pool, (base + room, len(self.lengths))) - 1
            if at >= 0 and (gain := self.pool[at][0] - base) > best:
                if fill + gain > self.fill[self.owner[self.pool[at][1]]]:  # squared fill grows
                    best, found = gain, (given, (self.pool[at][1],))
                    if best == room:
                        return found
        last = self.emptiest[0]
        for taken in itertools.combinations(self.bins[last] if last != receiver else [], 2):
            whole = sum([self.lengths[i] for i in taken])
            for given in itertools.chain(((),), ((i,) for i in own)):
                gain = whole - sum([self.lengths[i] for i in given])
                if best < gain <= room:
                    best, found = gain, (given, taken)
        return found

    def _leave_pool(self, item: int) -> None:
        del self.pool[bisect.bisect_left(self.pool, (self.lengths[item], item))]

    def _exchange(self, receiver: int, given: tuple[int, ...], taken: tuple[int, ...]) -> bool:
        """Whether the bin that gave the taken pieces is empty now."""
        donor = self.owner[taken[0]]
        for items, source, target in ((taken, donor, receiver), (given, receiver, donor)):
            for i in items:
                self.bins[source].remove(i)
                self.bins[target].append(i)
                self.fill[source] -= self.lengths[i]
                self.fill[target] += self.lengths[i]
                self.owner[i] = target
        for i in taken:
            self._leave_pool(i)
        for i in given:
            bisect.insort(self.pool, (self.lengths[i], i))
        return not self.bins[donor]


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    return LocalSearch(lengths, best_fit(lengths, capacity), capacity).run()


def pack(parts: DataFrame, rows: int, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``parts`` (``rows`` of them) with sequence_id and offset; they are dealt round robin."""

    def placed(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, made = TaskContext.get().partitionId(), 0
        for frame in _regrouped(frames, group):
            bins = pack_lengths(frame["length"].tolist(), capacity)
            order = np.array([i for b in bins for i in b], np.int64)
            sequence = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
            out = frame.iloc[order].reset_index(drop=True)
            before = out["length"].cumsum() - out["length"]
            out["sequence_id"] = (task << 40) + made + sequence
            out["offset"] = before - before.groupby(sequence).transform("min")
            made += len(bins)
            yield out

    cores = parts.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-rows // TASK_ROWS), min(-(-rows // group), cores), 1)
    return parts.repartition(tasks).mapInPandas(placed, f"{PIECE}, sequence_id long, offset long")


def _regrouped(frames: Iterable[pd.DataFrame], group: int) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []
    for frame in frames:
        for at in range(0, len(frame), group):
            held.append(frame.iloc[at : at + group])
            if sum(map(len, held)) >= group:
                joined = pd.concat(held, ignore_index=True)
                yield joined.iloc[:group].reset_index(drop=True)
                held = [joined.iloc[group:]]
    if sum(map(len, held)):
        yield pd.concat(held, ignore_index=True)


def pack_documents(docs: DataFrame, name: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of a document, with its sequence and its place there.

    A null or empty text is the separator alone.  Repeated rows are packed each; a null
    doc_id stays null; an empty table gives an empty result; further columns are ignored.
    """
    cut = materialise(pieces(docs, name, capacity), "pieces")
    return pack(cut, cut.count(), capacity)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
