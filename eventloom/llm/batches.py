"""Documents in batches: one row holds some megabytes of them, compressed.

A batch is the unit that later stages join to, so a text crosses the network once a join
and never as a row of a hot key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from eventloom.functions.storage import new_folder
from eventloom.llm.base import arrays, ship_package

#: A fifth smaller than at level 1, and written once.
LEVEL = 6
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.binary()), ("rest", pa.binary())])


def pack(rows: list[tuple]) -> bytes:
    ids, texts, rests = zip(*rows, strict=True)
    table = pa.table([pa.array(ids, pa.int64()), pa.array(texts, pa.binary()), pa.array(rests, pa.binary())], schema=_SCHEMA)
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))
    with pa.ipc.new_stream(sink, _SCHEMA, options=options) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(packed: bytes) -> tuple[list, list, list]:
    """Ids, texts in UTF-8, and what else was packed with them."""
    table = pa.ipc.open_stream(packed).read_all()
    return tuple(table.column(c).to_pylist() for c in _SCHEMA.names)


def in_batches(docs: DataFrame, size: int, measure: Callable[[bytes], int] = len) -> DataFrame:
    """``batch, measure, docs`` of a table ``doc_id, text[, rest binary]``, without a shuffle.

    A batch ends with the document that brings it to ``size`` bytes of text; ``measure`` is
    summed over its texts.
    """
    columns = [c for c in ("doc_id", "text", "rest") if c in docs.columns]

    def gather(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, made, held, held_bytes = TaskContext.get().partitionId(), 0, [], 0

        def packed() -> pd.DataFrame:
            total = sum(measure(text) for _, text, _ in held)
            return pd.DataFrame({"batch": [(task << 32) + made], "measure": [total], "docs": [pack(held)]})

        for doc, text, *rest in arrays(frames, *columns):
            data = text.encode("utf-8")
            held.append((None if pd.isna(doc) else int(doc), data, rest[0] if rest else None))
            held_bytes += len(data)
            if held_bytes >= size:
                yield packed()
                made, held, held_bytes = made + 1, [], 0
        if held:
            yield packed()

    ship_package(docs.sparkSession)
    return docs.mapInPandas(gather, "batch long, measure long, docs binary")


def bucketed(rows: DataFrame, key: str, parts: int) -> DataFrame:
    """``rows`` written once to the shared folder, dealt by ``key``: later joins on it move
    only their other side."""
    spark = rows.sparkSession
    name = f"eventloom_{uuid.uuid4().hex}"
    path = new_folder(spark, name)
    dealt = rows.repartition(parts, key)
    dealt.write.bucketBy(parts, key).option("path", path).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)
