"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII blanks that separate words.
BLANKS = " \t\n\x0b\x0c\r"
#: str.split() also splits at these, which are no white space to most tokenizers.
INFORMATION_SEPARATORS = "\x1c\x1d\x1e\x1f"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: By application, the driver's archive of this package; executors fetch it when they start.
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session, unless they find it by the
    working directory or PYTHONPATH."""
    root = Path(__file__).resolve().parents[2]
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    app = spark.sparkContext.applicationId
    if app in _shipped or str(root) in known:
        return
    _shipped[app] = tempfile.TemporaryDirectory(prefix="eventloom-")
    archive = shutil.make_archive(f"{_shipped[app].name}/eventloom", "zip", root, "eventloom")
    spark.sparkContext.addPyFile(archive)


def text_or_empty() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns most operators need, whatever else the table holds."""
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


class Memo(dict):
    """A dict that computes missing values and forgets all of them when it is full.

    Look-ups cost far less than the computation for words that come again; the bound
    keeps a task's memory independent of the vocabulary.
    """

    def __init__(self, compute: Callable, limit: int):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


class Generations(dict):
    """A memory like ``Memo`` that forgets gradually.

    Values are held in two generations of half the bound each.  When the younger one is full
    it becomes the older one, and what is met again comes back from there, so frequent words
    stay however many rare ones there are.
    """

    def __init__(self, compute: Callable, limit: int):
        super().__init__()
        self.compute, self.half, self.older = compute, max(limit // 2, 1), {}

    def __missing__(self, key):
        value = self.older.get(key, self)
        if value is self:
            value = self.compute(key)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


_forget: dict[str, Callable[[], None]] = {}
_turn: list[str] = []


def remembers(operator: str, forget: Callable[[], None]) -> None:
    """Announce what an operator keeps in a Python worker from task to task."""
    _forget[operator] = forget


def turn_of(operator: str) -> None:
    """Called by an operator's tasks first: a worker that served another operator before
    drops what that one remembered, so that memories of several never add up."""
    if _turn != [operator]:
        for other, forget in _forget.items():
            if other != operator:
                forget()
        _turn[:] = [operator]
        give_back()


def give_back() -> None:
    """Return memory that is no longer used from Arrow and the allocator to the system; both
    would keep it for as long as the worker lives."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def arrays(frames: Iterable, *columns: str) -> Iterator[tuple]:
    """The rows of the batches, one by one, as tuples of plain Python values."""
    for frame in frames:
        yield from zip(*(frame[c] for c in columns), strict=True)


# --- 64-bit mixing -----------------------------------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that lets every bit depend on every bit."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _S30)) * _M1
        x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words, given the words' hashes; one hash of all words if
    there are fewer, none if there is no word."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    width = min(n, len(words))
    count = len(words) - width + 1
    with np.errstate(over="ignore"):
        h = np.full(count, np.uint64(0x9E3779B97F4A7C15 + width), np.uint64)
        for i in range(width):
            h = mix(h * np.uint64(0x100000001B3) + words[i : i + count])
    return h
