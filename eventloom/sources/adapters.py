"""Event logs over other tables.

``user_log``: one case per user and period of some days of the ``events`` table.
``shipment_log``: one case per order, one event per order line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import COLUMN_MAP

# event_type -> state of the ticket process.
STATES = {
    "signup": "Ticket created",
    "view": "WIP - level 1 support",
    "click": "Level 1 escalates to level 2 support",
    "error": "WIP - level 3 support",
    "purchase": "Ticket closed",
}
PRIORITIES = ["Low", "Medium", "High"]
ISSUE_TYPES = ["Bug", "Incident", "Service Request", "Feature Request"]
CHANNELS = ["App", "Email", "Website", "Phone", "Chat"]
VARIANTS = 13
REPORTERS = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(names: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (index + 1).cast("int"))


def user_log(events: DataFrame, days: int = 3) -> DataFrame:
    """All case attributes are functions of the user, so they are constant in a case."""
    user = F.col("user_id")
    period = F.floor(F.date_diff(F.to_date("ts"), F.lit("2000-01-01").cast("date")) / days)
    state = F.lit(None).cast("string")
    for kind, name in STATES.items():
        state = F.when(F.col("event_type") == kind, name).otherwise(state)
    reporter = F.concat(F.lit("agent "), (user % REPORTERS).cast("string"))
    issue = _pick(ISSUE_TYPES, user % len(ISSUE_TYPES))
    return events.select(
        "event_id",
        F.concat(user.cast("string"), F.lit("-"), period.cast("string")).alias("case_id"),
        F.concat(F.lit("Variant "), (user % VARIANTS + 1).cast("string")).alias("variant"),
        _pick(PRIORITIES, user % len(PRIORITIES)).alias("priority"),
        reporter.alias("reporter"),
        F.col("ts").alias("event_timestamp"),
        state.alias("event"),
        issue.alias("issue_type"),
        F.when(
            ~F.col("event_type").isin("signup", "purchase"),
            (F.col("event_id") % 7).cast("string"),
        ).alias("resolver"),
        _pick(CHANNELS, user % len(CHANNELS)).alias("report_channel"),
        F.concat(issue, F.lit(" reported by "), reporter).alias("short_description"),
        (user % 5 + 1).cast("int").alias("customer_satisfaction"),
    )


def shipment_log(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """``case_id`` stays the order key, so the join's partitioning serves the windows."""
    lines = lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        "l_returnflag",
        "l_linestatus",
    )
    customer = F.col("o_custkey")
    reporter = F.concat(F.lit("clerk "), (customer % REPORTERS).cast("string"))
    return orders.join(lines, "o_orderkey").select(
        F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("event_id"),
        F.col("o_orderkey").alias("case_id"),
        F.concat(F.lit("Variant "), (customer % VARIANTS + 1).cast("string")).alias("variant"),
        F.col("o_orderpriority").alias("priority"),
        reporter.alias("reporter"),
        F.col("l_shipdate").alias("event_timestamp"),
        F.concat("l_returnflag", "l_linestatus").alias("event"),
        F.col("o_orderstatus").alias("issue_type"),
        F.col("l_suppkey").cast("string").alias("resolver"),
        _pick(CHANNELS, customer % len(CHANNELS)).alias("report_channel"),
        F.concat(F.lit("order of "), reporter).alias("short_description"),
        (customer % 5 + 1).cast("int").alias("customer_satisfaction"),
    )


# Canonical column -> header of the raw export, and its row number.
RAW_HEADERS = {canonical: raw for raw, canonical in COLUMN_MAP.items()}
ROW = "Row"


def _clock(mixed: bool) -> Column:
    """The event time as export text; ``mixed`` uses three spellings."""
    ts = F.col("event_timestamp")
    day, month, year = F.dayofmonth(ts), F.month(ts), F.year(ts)
    second = F.extract(F.lit("SECOND"), ts)
    micros = ((second - F.floor(second)) * 1_000_000).cast("int")
    time = (F.hour(ts), F.minute(ts), F.floor(second).cast("int"), micros)
    usual = F.format_string("%02d/%02d/%04d %02d:%02d:%02d.%06d", day, month, year, *time)
    if not mixed:
        return usual
    kind = F.col("event_id") % 3
    return (
        F.when(kind == 0, usual)
        .when(kind == 1, F.format_string("%d-%d-%04d %d:%02d:%02d.%06d", day, month, year, *time))
        .otherwise(F.format_string("%04d-%02d-%02d %02d:%02d:%02d.%06d", year, month, day, *time))
    )


def raw_export(log: DataFrame, mixed: bool = False) -> DataFrame:
    """A log turned back into the text columns of an export, row number last."""
    text = {c: F.col(c).cast("string") for c in RAW_HEADERS}
    text["event_timestamp"] = _clock(mixed)
    if mixed:
        text["variant"] = F.concat(F.lit("  "), text["variant"], F.lit(" "))
        text["resolver"] = F.coalesce(text["resolver"], F.lit("   "))
        text["short_description"] = F.concat(text["short_description"], F.lit(' "as told"; open'))
    return log.select(
        *[text[c].alias(header) for c, header in RAW_HEADERS.items()],
        F.col("event_id").alias(ROW),
    )
