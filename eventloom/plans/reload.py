"""Full reload: read, validate, write, compare, publish, and the case table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.validate import require_valid
from ..operators.views import case_table
from ..sources.raw import load_log
from ..sources.sinks import write_log


def reload(
    spark: SparkSession,
    raw_path: str,
    log_path: str | None = None,
    case_path: str | None = None,
    sep: str = ";",
) -> DataFrame:
    """Without ``log_path`` only the case table is built, from the validated source."""
    log = require_valid(load_log(spark, raw_path, sep))
    if log_path is not None:
        log = write_log(log, log_path)
    cases = case_table(log)
    if case_path is not None:
        write_case_table(cases, case_path)
    return cases


def write_case_table(cases: DataFrame, path: str, fmt: str = "csv") -> None:
    """Many files, ordered by case: the table grows with the log."""
    ordered = cases.orderBy("case_id")
    if fmt == "csv":
        ordered.write.mode("overwrite").csv(path, header=True)
    else:
        ordered.write.mode("overwrite").format(fmt).save(path)
