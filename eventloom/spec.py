"""Names, types and default literals of an event log.

Every operator works on the canonical columns below.  Any other event table is
brought into that shape by ``sources.raw.normalize_columns`` (a rename map) or by
a ``select`` such as those in ``sources.adapters``.

``event_id`` breaks ties between events of a case that share a timestamp.  It may
be of any orderable type: a number, or a struct of several columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Header of the raw export -> canonical column, in canonical order.
COLUMN_MAP = {
    "Case ID": "case_id",
    "Variant": "variant",
    "Priority": "priority",
    "Reporter": "reporter",
    "Timestamp": "event_timestamp",
    "Event": "event",
    "Issue Type": "issue_type",
    "Resolver": "resolver",
    "Report Channel": "report_channel",
    "Short Description": "short_description",
    "Customer Satisfaction": "customer_satisfaction",
}

EVENT_ORDER = ["event_timestamp", "event_id"]

# Attributes of a case, repeated on each of its events.
CASE_DIMS = [
    "variant",
    "priority",
    "reporter",
    "issue_type",
    "report_channel",
    "customer_satisfaction",
]

# Columns that hold text.
TEXT_COLUMNS = [
    "variant",
    "priority",
    "reporter",
    "event",
    "issue_type",
    "resolver",
    "report_channel",
    "short_description",
]

EVENT_LOG_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType(), False),
        T.StructField("case_id", T.StringType(), False),
        T.StructField("variant", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("reporter", T.StringType()),
        T.StructField("event_timestamp", T.TimestampNTZType(), False),
        T.StructField("event", T.StringType()),
        T.StructField("issue_type", T.StringType()),
        T.StructField("resolver", T.StringType()),
        T.StructField("report_channel", T.StringType()),
        T.StructField("short_description", T.StringType()),
        T.StructField("customer_satisfaction", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class MilestonePatterns:
    """Case-insensitive patterns; a case has a milestone if any event matches."""

    escalated: str = "%escalat%"
    reached_level_3: str = "%level 3%"
    is_completed: str = "%closed%"

    def items(self):
        return [
            ("escalated", self.escalated),
            ("reached_level_3", self.reached_level_3),
            ("is_completed", self.is_completed),
        ]


# Literals the standard reports are run with.
FOCUS_VARIANT = "Variant 7"
LEVEL3_VARIANTS = ("Variant 6", "Variant 7")
BASE_PRIORITY = "High"
WORK_STATES = ("Ticket created", "WIP - level 1 support", "WIP - level 2 support")
SLA_HOURS = 24.0
SCORE_CAP = 3
FIRST_EVENT = "Ticket created"
