"""Writing a log so that readers see all of it or the one before.

``write_log`` writes a new version folder, compares it with the source, and only
then adds a record to the list of published versions.  A failed or short write leaves
the list, and so every reader, as it was.

Records are numbered, and a number is a file that is created once, so of two loads that
publish at the same time one comes after the other, whatever their clocks say.  That a
file is created once is the promise of HDFS and of object stores with conditional writes;
a local file system looks first and creates then.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.validate import ValidationError, parity

RECORD = "number bigint, version string, published_at timestamp, rows bigint, cases bigint"


class Overtaken(RuntimeError):
    """Another load was published since the one that this load was to follow."""


def write_version(log: DataFrame, path: str, version: str, files: int | None = None) -> DataFrame:
    """Write one version, clustered by case and time, and return it."""
    by = ["case_id", "event_timestamp", "event_id"]
    ranged = log.repartitionByRange(files, *by) if files else log.repartitionByRange(*by)
    folder = f"{path}/versions/{version}"
    ranged.sortWithinPartitions(*by).write.parquet(folder)
    return log.sparkSession.read.parquet(folder)


def verify_parity(source: DataFrame, written: DataFrame) -> DataFrame:
    """The comparison, or an error with the differing counts."""
    lines = parity(source, written).collect()
    if not all(r["passed"] for r in lines):
        raise ValidationError(
            "load mismatch: "
            + ", ".join(f"{r['check']} {r['source']} against {r['written']}" for r in lines)
        )
    return written.sparkSession.createDataFrame(lines, "check string, source bigint, written bigint, passed boolean")


def _create_once(spark: SparkSession, path: str, line: str) -> bool:
    """Write a new file, or say that there is one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(target):
        return False
    try:
        out = system.create(target, False)
    except Py4JJavaError as error:
        if system.exists(target):
            return False
        raise error
    out.write(bytearray(line, "utf-8"))
    out.close()
    return True


def publish(
    spark: SparkSession, path: str, version: str, rows: int, cases: int, after: int | None = None
) -> int:
    """Add a record to the list; returns its number.

    Without ``after`` it takes the next number that is free.  With ``after`` it follows that
    record (0: it is the first) or fails with ``Overtaken``.  A number whose file was left
    without a whole record is passed over.
    """
    last = latest(spark, path)
    behind = last["number"] or 0 if last else 0
    if after is not None and behind != after:
        raise Overtaken(f"version {behind} was published after version {after}")
    number = behind + 1
    now = datetime.now(timezone.utc).isoformat()
    while True:
        record = {"number": number, "version": version, "published_at": now, "rows": rows, "cases": cases}
        if _create_once(spark, f"{path}/published/{number:012d}.json", json.dumps(record) + "\n"):
            return number
        if after is not None and (latest(spark, path) or {"number": 0})["number"] != after:
            raise Overtaken(f"version {number} was published after version {after}")
        number += 1


def records(spark: SparkSession, path: str) -> DataFrame:
    """The published versions; a record that was not written to its end is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/published")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).json(f"{path}/published").where("version IS NOT NULL")


def latest(spark: SparkSession, path: str) -> Row | None:
    """The record with the highest number; records without one are older, by time."""
    fields = F.struct("number", "version", "published_at", "rows", "cases")
    order = F.struct(F.coalesce("number", F.lit(0)), "published_at", "version")
    return records(spark, path).agg(F.max_by(fields, order)).first()[0]


def write_log(log: DataFrame, path: str, files: int | None = None, after: int | None = None) -> DataFrame:
    """Full reload of ``path``; returns the published log as readers see it."""
    spark, version = log.sparkSession, uuid.uuid4().hex
    written = write_version(log, path, version, files)
    counts = {r["check"]: r["written"] for r in verify_parity(log, written).collect()}
    number = publish(spark, path, version, counts["rows"], counts["cases"], after)
    return read_log(spark, path, number)


def read_log(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The latest published version, or the one of that number."""
    if number is None:
        record = latest(spark, path)
    else:
        record = records(spark, path).where(F.col("number") == number).first()
    if record is None:
        raise ValueError(f"{path} has no published version" + (f" {number}" if number is not None else ""))
    return spark.read.parquet(f"{path}/versions/{record['version']}")


def audit(spark: SparkSession, path: str) -> DataFrame:
    """One line per version that was published or written: what its record says, what its
    files hold, whether both agree, and whether readers see it."""
    stored = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/versions")
    version = F.regexp_extract(F.col("_metadata.file_path"), r"/versions/([^/]+)/[^/]+$", 1)
    cases = stored.select(version.alias("version"), "case_id").groupBy("version", "case_id").agg(F.count("*").alias("n"))
    found = cases.groupBy("version").agg(F.sum("n").alias("rows_found"), F.count("*").alias("cases_found"))
    last = latest(spark, path)
    agree = F.col("rows").eqNullSafe(F.col("rows_found")) & F.col("cases").eqNullSafe(F.col("cases_found"))
    return records(spark, path).join(found, "version", "full_outer").select(
        "number",
        "version",
        "published_at",
        "rows",
        "cases",
        F.coalesce("rows_found", F.lit(0)).alias("rows_found"),
        F.coalesce("cases_found", F.lit(0)).alias("cases_found"),
        (F.col("number").isNotNull() & agree).alias("whole"),
        (F.col("version") == F.lit(last["version"] if last else "")).alias("current"),
    )


def write_bucketed(log: DataFrame, table: str, buckets: int) -> None:
    """A catalog table bucketed by case: windows and groupings on it need no shuffle."""
    log.write.mode("overwrite").bucketBy(buckets, "case_id").sortBy(
        "case_id", "event_timestamp"
    ).saveAsTable(table)
