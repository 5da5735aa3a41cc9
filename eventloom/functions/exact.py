"""Time differences, rounding and sums that do not depend on row order.

Hours are kept to four decimals.  Their sums are taken over whole
ten-thousandths, so that a report gives the same digits however rows are
partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1e6
MICROS_PER_HOUR = 3.6e9
HOUR_PARTS = 10_000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Microseconds from ``start`` to ``end``, whatever the session time zone.

    ``timestampdiff`` would read zone-less timestamps in the session zone and go
    wrong around clock changes; subtracting them does not.
    """
    apart = col(end) - col(start)
    part = {u: F.extract(F.lit(u), apart) for u in ("DAY", "HOUR", "MINUTE", "SECOND")}
    minutes = (part["DAY"].cast("bigint") * 24 + part["HOUR"]) * 60 + part["MINUTE"]
    return minutes * 60_000_000 + (part["SECOND"] * 1_000_000).cast("bigint")


def tidy(value: Column, digits: int) -> Column:
    """Decimal rounding, half away from zero, of a computed double.

    The first rounding removes binary noise (1.2349999999999999 is 1.235).
    """
    return F.round(F.round(value.cast("double"), 10), digits)


def hours(micros: Column | str) -> Column:
    return F.round(col(micros) / F.lit(MICROS_PER_HOUR), 4)


def hour_parts(hours_col: Column | str) -> Column:
    """Four-decimal hours as a whole number of ten-thousandths."""
    return F.round(col(hours_col) * HOUR_PARTS).cast("bigint")


def sum_hours(hours_col: Column | str) -> Column:
    return F.sum(hour_parts(hours_col)) / F.lit(float(HOUR_PARTS))


def mean_hours(hours_col: Column | str) -> Column:
    c = col(hours_col)
    return F.sum(hour_parts(c)) / (F.count(c) * F.lit(float(HOUR_PARTS)))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return tidy(F.lit(100.0) * part / whole, digits)


def matches(event: Column | str, pattern: str) -> Column:
    return col(event).ilike(pattern)


def any_true(flag: Column) -> Column:
    """1 if any row has the flag, else 0; NULL rows count as not having it."""
    return F.max(F.coalesce(flag, F.lit(False))).cast("int")
