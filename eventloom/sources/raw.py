"""From a delimited text export to the typed event log."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ordered import global_rank
from ..functions.quantiles import summarise
from ..functions.storage import materialise
from ..spec import COLUMN_MAP, EVENT_LOG_SCHEMA, TEXT_COLUMNS
from .dates import lenient_timestamp

# The export's own format, then day-first forms tried on what is left.
TIMESTAMP_FORMATS = [
    "dd/MM/yyyy HH:mm",
    "d/M/yyyy H:mm[:ss][.SSSSSS]",
    "d-M-yyyy H:mm[:ss][.SSSSSS]",
    "d.M.yyyy H:mm[:ss][.SSSSSS]",
    "yyyy-M-d H:mm[:ss][.SSSSSS]",
    "yyyy-M-d'T'H:mm[:ss][.SSSSSS]",
    "d/M/yyyy",
    "d-M-yyyy",
    "d.M.yyyy",
    "yyyy-M-d",
]

# Cell texts that stand for a missing value.
NULL_MARKERS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Where a row stood in the source: file, start of its block, row within the scan.
SOURCE_POSITION = ["_file", "_block", "_row"]


# Holds the text of a row whose number of cells differs from the header's.
MALFORMED = "_malformed"


def read_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ";",
    header: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """All columns as text, missing cells as NULL, plus the source position.

    Cells may be quoted; a quote inside one is doubled.  With ``multiline`` quoted cells
    may hold line breaks, and a file is then read by one task.  Reading fails on a file
    whose header differs from the first one's, and ``require_well_formed`` on rows of
    another width, so that no value comes under a wrong name.
    """
    options = {"sep": sep, "header": header, "quote": '"', "escape": '"', "multiLine": multiline}
    names = spark.read.csv(path, inferSchema=False, **options).columns
    fields = T.StructType([T.StructField(c, T.StringType()) for c in [*names, MALFORMED]])
    raw = spark.read.csv(
        path,
        schema=fields,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=MALFORMED,
        enforceSchema=not header,
        **options,
    )
    placed = raw.select(
        *[F.col(f"`{c}`") for c in names],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        MALFORMED,
    )
    return placed.withColumns({c: _null_if_marker(F.col(f"`{c}`")) for c in names})


def require_well_formed(raw: DataFrame) -> DataFrame:
    """The rows without the column of malformed text, or an error with their number."""
    # All columns are asked for: the width of a row is only seen if all its cells are read.
    wrong = raw.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in raw.columns]).first()[MALFORMED]
    if wrong:
        raise ValueError(f"{wrong} rows have more or fewer cells than the header; aborting.")
    return raw.drop(MALFORMED)


def _null_if_marker(c: Column) -> Column:
    return F.when(~c.isin(*NULL_MARKERS), c)


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"Input is missing expected columns: {missing}")
    return df


def clean_headers(df: DataFrame) -> DataFrame:
    """Header text stripped, in lower case, with underscores for spaces."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def normalize_columns(df: DataFrame, columns: Mapping[str, str] = COLUMN_MAP) -> DataFrame:
    """Rename to canonical names in canonical order; other columns are dropped."""
    require_columns(df, list(columns))
    position = [c for c in SOURCE_POSITION if c in df.columns]
    return df.select(*[F.col(f"`{a}`").alias(b) for a, b in columns.items()], *position)


def _outline(fmt: str) -> str:
    """The separators that every text of a format has, as a LIKE pattern."""
    return re.sub(r"%+", "%", re.sub(r"\[[^\]]*\]|'[^']*'|[A-Za-z\\]+", "%", fmt))


def parse_ts(
    text: Column | str, formats: Sequence[str] = TIMESTAMP_FORMATS, lenient: bool = True
) -> Column:
    """First format that fits, as a zone-less timestamp; NULL when none does.

    Later formats are tried only on values that the earlier ones refused, and the loose
    spellings of ``dates.lenient_timestamp`` only on what all formats refused.  The CSV
    reader's parser is used because it never goes through the session time zone.
    """
    text = F.col(text) if isinstance(text, str) else text
    exact = [
        F.when(
            text.like(_outline(f)),  # a format that does not fit costs an exception
            F.from_csv(text, "t timestamp_ntz", {"timestampNTZFormat": f, "sep": "\u0001"})["t"],
        )
        for f in formats
    ]
    return F.coalesce(*exact, lenient_timestamp(text)) if lenient else F.coalesce(*exact)


def to_number(text: Column | str, kind: str = "double") -> Column:
    """NULL for text that is no number; for ``int`` also for fractions."""
    text = F.col(text) if isinstance(text, str) else text
    number = text.try_cast("double")
    if kind == "int":
        return F.when(number == F.floor(number), number.try_cast("int"))
    return number.try_cast(kind)


def clean_text(text: Column | str) -> Column:
    """Surrounding white space removed; nothing left means NULL."""
    text = F.col(text) if isinstance(text, str) else text
    # Trimming characters is cheaper; these line ends the expression treats on their own.
    ended = F.endswith(text, F.lit("\u0085")) | F.endswith(text, F.lit("\u2028")) | F.endswith(text, F.lit("\u2029"))
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.nullif(F.when(ended, F.regexp_replace(text, r"^\s+|\s+$", "")).otherwise(trimmed), F.lit(""))


def type_events(
    normalized: DataFrame, formats: Sequence[str] = TIMESTAMP_FORMATS, bad_timestamps: str = "keep"
) -> DataFrame:
    """Typed columns; unparseable timestamps stay as NULL rows or are dropped."""
    if bad_timestamps not in ("keep", "drop"):
        raise ValueError("bad_timestamps must be 'keep' or 'drop'")
    typed = normalized.withColumns(
        {
            "event_timestamp": parse_ts("event_timestamp", formats),
            "customer_satisfaction": to_number("customer_satisfaction", "int"),
            **{c: clean_text(c) for c in TEXT_COLUMNS},
        }
    )
    return typed.na.drop(subset=["event_timestamp"]) if bad_timestamps == "drop" else typed


def assign_event_ids(
    typed: DataFrame, source_order: Sequence[str] = tuple(SOURCE_POSITION), chunks: int | None = None
) -> DataFrame:
    """``event_id`` 1..N by case, time and source order; ``source_seq`` keeps the latter.

    The numbering is a range-partitioned sort, so no task sees more than its share.
    """
    order = ["case_id", "event_timestamp", *source_order]
    numbered = global_rank(typed, order, "event_id", chunks)
    return numbered.select(
        *[F.col(f.name).cast(f.dataType) for f in EVENT_LOG_SCHEMA],
        F.struct(*source_order).alias("source_seq"),
    )


def load_log(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ";",
    columns: Mapping[str, str] = COLUMN_MAP,
    formats: Sequence[str] = TIMESTAMP_FORMATS,
    bad_timestamps: str = "fail",
    multiline: bool = False,
) -> DataFrame:
    """Read, rename, parse and number an event log.

    ``bad_timestamps='fail'`` raises with their number, ``'drop'`` leaves them out.  The text
    is parsed once: numbering reads its rows several times.
    """
    raw = require_well_formed(read_raw(spark, path, sep, multiline=multiline))
    typed = type_events(
        normalize_columns(raw, columns), formats, "drop" if bad_timestamps == "drop" else "keep"
    )
    typed = materialise(typed, "typed")
    if bad_timestamps == "fail":
        # Before the sort: a bad export costs one pass.
        bad = unparseable_timestamps(typed).first()["failures"]
        if bad:
            raise ValueError(f"{bad} rows have unparseable timestamps; aborting.")
    return assign_event_ids(typed)


def unparseable_timestamps(log: DataFrame) -> DataFrame:
    return log.agg(F.count_if(F.col("event_timestamp").isNull()).alias("failures"))


def profile(log: DataFrame) -> DataFrame:
    """Grouped by case and variant first: the distinct counts see one row of each pair."""
    pairs = log.groupBy("case_id", "variant").agg(
        F.count("*").alias("n"), F.min("event_timestamp").alias("lo"), F.max("event_timestamp").alias("hi")
    )
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("events"),
        F.countDistinct("case_id").alias("cases"),
        F.countDistinct("variant").alias("variants"),
        F.min("lo").alias("first_event_at"),
        F.max("hi").alias("last_event_at"),
    )


# Cleaning steps of the superseded notebooks, each on its own.


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drops columns that are NULL in every row; one pass counts them all."""
    filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.drop(*[c for c in df.columns if filled[c] == 0])


def fill_unknown(df: DataFrame, columns: Sequence[str], value: str = "Unknown") -> DataFrame:
    """Never for ``resolver``: a NULL there means a system step, not missing data."""
    if "resolver" in columns:
        raise ValueError("resolver is NULL on system steps and must stay so")
    return df.na.fill(value, subset=list(columns))


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs become the column's exact median, or 0 where it has no value."""
    fills = {}
    for c in columns:
        row = summarise(df, [], [F.count(c).alias("n")], c, {"median": 0.5}).first()
        fills[c] = row["median"] if row["median"] is not None else 0.0
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in fills.items()}
    )


def flag_missing_resolver(df: DataFrame) -> DataFrame:
    return df.withColumn("resolver_missing", F.col("resolver").isNull().cast("int"))


def drop_incomplete(df: DataFrame, columns: Sequence[str] = ("duration_hours", "variant")) -> DataFrame:
    return df.na.drop(subset=list(columns))


def slug(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", text.lower()).strip("_")
