"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scopes: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, else a folder below the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no one has used, in the innermost open scope."""
    parts = [shared_dir(spark).rstrip("/"), "eventloom", spark.sparkContext.applicationId, *_scopes]
    return "/".join([*parts, uuid.uuid4().hex, label])


def materialise(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and return the written table.

    Cuts lineage, survives the loss of executors, and later readers get column
    pruning.  Each call writes a new folder, so nothing is ever overwritten.  ``codec``
    is the session's unless given.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Tables materialised inside are deleted at the end: results must be read or written
    by then."""
    _scopes.append(uuid.uuid4().hex)
    parts = [shared_dir(spark).rstrip("/"), "eventloom", spark.sparkContext.applicationId, *_scopes]
    try:
        yield
    finally:
        _scopes.pop()
        path = spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
