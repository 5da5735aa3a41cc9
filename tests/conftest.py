import os
import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from eventloom.spec import EVENT_LOG_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("eventloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.strptime(text, "%Y-%m-%d %H:%M")


# Six cases: (case, variant, priority, reporter, time, event, issue, resolver, channel, text, score).
ROWS = [
    # Plain path, two events in the same minute (event_id decides).
    ("A", "Variant 1", "High", "dana", "2023-01-01 08:00", "Ticket created", "Bug", None, "App", "Bug in app", 5),
    ("A", "Variant 1", "High", "dana", "2023-01-01 09:00", "WIP - level 1 support", "Bug", "alice", "App", "Bug in app", 5),
    ("A", "Variant 1", "High", "dana", "2023-01-01 09:00", "Ticket solved by level 1 support", "Bug", "alice", "App", "Bug in app", 5),
    ("A", "Variant 1", "High", "dana", "2023-01-01 12:00", "Ticket closed", "Bug", None, "App", "Bug in app", 5),
    # Escalated with rework, longer than a day, score capped.
    ("B", "Variant 7", "Low", "eli", "2023-01-01 10:00", "Ticket created", "Bug", None, "Email", "Bug in mail", 3),
    ("B", "Variant 7", "Low", "eli", "2023-01-01 16:00", "WIP - level 1 support", "Bug", "alice", "Email", "Bug in mail", 3),
    ("B", "Variant 7", "Low", "eli", "2023-01-02 10:00", "Level 2 escalates to level 3 support", "Bug", "bob", "Email", "Bug in mail", 3),
    ("B", "Variant 7", "Low", "eli", "2023-01-02 12:00", "WIP - level 3 support", "Bug", "carol", "Email", "Bug in mail", 3),
    ("B", "Variant 7", "Low", "eli", "2023-01-02 20:00", "WIP - level 3 support", "Bug", "carol", "Email", "Bug in mail", 3),
    ("B", "Variant 7", "Low", "eli", "2023-01-03 10:00", "Ticket closed", "Bug", None, "Email", "Bug in mail", 3),
    # A NULL event in the middle.
    ("C", "Variant 1", "Medium", "fern", "2023-01-04 00:00", "Ticket created", "Incident", None, "Phone", "Call", 4),
    ("C", "Variant 1", "Medium", "fern", "2023-01-04 01:00", None, "Incident", "alice", "Phone", "Call", 4),
    ("C", "Variant 1", "Medium", "fern", "2023-01-04 03:00", "WIP - level 1 support", "Incident", "alice", "Phone", "Call", 4),
    ("C", "Variant 1", "Medium", "fern", "2023-01-04 06:00", "Ticket closed", "Incident", None, "Phone", "Call", 4),
    # A NULL event at the end.
    ("D", "Variant 7", "Low", "gus", "2023-01-05 00:00", "Ticket created", "Bug", None, "App", "Bug in app", 2),
    ("D", "Variant 7", "Low", "gus", "2023-01-05 02:00", None, "Bug", None, "App", "Bug in app", 2),
    # Only NULL events.
    ("E", "Variant 2", "High", "dana", "2023-01-06 00:00", None, "Incident", None, "App", None, None),
    ("E", "Variant 2", "High", "dana", "2023-01-06 00:30", None, "Incident", "bob", "App", None, None),
    # A single event.
    ("F", "Variant 2", "Medium", "eli", "2023-01-07 00:00", "Ticket created", "Incident", None, "Email", "Call", 1),
]


def build(spark, rows):
    data = [
        (i, r[0], r[1], r[2], r[3], at(r[4]), r[5], r[6], r[7], r[8], r[9], r[10])
        for i, r in enumerate(rows, 1)
    ]
    return spark.createDataFrame(data, EVENT_LOG_SCHEMA)


@pytest.fixture(scope="session")
def log(spark):
    return build(spark, ROWS).cache()


def by(df, *keys):
    """Rows as dicts, found by the values of the key columns."""
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r.asDict() for r in df.collect()}
