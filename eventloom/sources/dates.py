"""Dates and times in loose spellings, day before month, as expressions.

A text is taken apart into a clock time and the words and numbers of a date; their classes
(month name, number of one or two, of four, of eight digits) decide what each of them is.
What does not fit exactly one reading is NULL; nothing is guessed from the present day.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# English names, found by their first three letters.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTH = (
    r"jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    r"sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)
WEEKDAY = r"(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?"

# Two-digit years from here on are in the last century.
PIVOT = 69

CLOCK = (
    r"(?:^|[\st,])(?:at\s+)?(\d{1,2})(?::(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*([ap]\.?m\.?)?|\s*([ap]\.?m\.?))(?=$|[\s,])"
)


def _digits(text: Column) -> Column:
    """The number, NULL if there is none."""
    return F.nullif(text, F.lit("")).try_cast("int")


def _year(token: Column) -> Column:
    number = _digits(token)
    short = number + F.when(number >= PIVOT, 1900).otherwise(2000)
    return F.when(F.length(token) == 4, number).when(F.length(token) == 2, short)


def _month(token: Column) -> Column:
    return F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(token, 1, 3)), F.lit(0)).cast("int")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, in code that stays small."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _groups(text: Column, pattern: str, names: tuple[str, ...]) -> Column:
    return F.struct(*[F.regexp_extract(text, pattern, i).alias(n) for i, n in enumerate(names)])


def lenient_timestamp(text: Column) -> Column:
    """A zone-less timestamp, or NULL.

    * The time is ``h:mm``, with seconds and up to nine decimals (six count), with or without
      am or pm, or an hour with am or pm; without one it is midnight.
    * Names of weekdays, ``of``, commas and the endings of 1st, 2nd, 3rd and 4th say nothing.
    * Three numbers are day, month, year; year, month, day if the first has four digits.  If
      only the other order of day and month is possible, that is meant.
    * With the name of a month, the number with four digits or the last one is the year.
    * Eight digits are year, month, day.
    * Years have four digits, or two: 69 to 99 are in the last century.
    * Any other word, zone, further number or second clock time makes the text unreadable.
    """
    low = F.lower(F.regexp_replace(text, r"^\s+|\s+$", ""))
    names = ("all", "hour", "minute", "second", "fraction", "half", "half_only")
    return _let(low, lambda t: _let(_groups(t, CLOCK, names), lambda clock: _let(_date(t), lambda d: _together(d, clock))))


def _clock(part: Column) -> tuple[Column, Column, Column]:
    """Hour, minute and second with its decimals; NULL for an hour that am and pm do not have."""
    half = F.substring(F.concat(part["half"], part["half_only"]), 1, 1)
    hour = _digits(part["hour"])
    of_twelve = F.when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    hour = F.when(part["all"] == "", 0).when(half == "", hour).otherwise(of_twelve)
    minute, second = (F.coalesce(_digits(part[n]), F.lit(0)) for n in ("minute", "second"))
    decimals = F.rpad(F.substring(part["fraction"], 1, 6), 6, "0")
    return hour, minute, F.concat_ws(".", second.cast("string"), decimals).cast("decimal(16,6)")


def _date(low: Column) -> Column:
    """Year, month and day of what is left beside the first clock time."""
    date = F.concat_ws(" ", F.split(low, CLOCK, 2))
    date = F.regexp_replace(date, rf"\b{WEEKDAY}\b\.?|\bof\b|,", " ")
    date = F.regexp_replace(date, r"\b(\d{1,2})(?:st|nd|rd|th)\b", "$1")

    def plain(date: Column) -> Column:
        three = rf"^\s*(\d{{1,4}}|{MONTH})\.?[\s/.\-]+(\d{{1,2}}|{MONTH})\.?[\s/.\-]+(\d{{4}}|\d{{1,2}})\s*$"
        eight = r"^\s*(\d{4})(\d{2})(\d{2})\s*$"
        joined = F.regexp_like(date, F.lit(eight))
        whole = _fields(*(_digits(F.regexp_extract(date, eight, i)) for i in (1, 2, 3)))
        return F.when(joined, whole).otherwise(_let(_groups(date, three, ("all", "x", "y", "z")), _ordered))

    return _let(date, plain)


def _fields(year: Column, month: Column, day: Column) -> Column:
    return F.struct(year.cast("int").alias("y"), month.cast("int").alias("m"), day.cast("int").alias("d"))


def _ordered(token: Column) -> Column:
    """Which of three words or numbers is the year, the month and the day."""
    x, y, z = token["x"], token["y"], token["z"]

    def numbers(year: Column, month: Column, day: Column) -> Column:
        """Month and day the other way round if only that is possible."""
        swap = (month > 12) & (day <= 12)
        return _fields(year, F.when(swap, day).otherwise(month), F.when(swap, month).otherwise(day))

    short_x, short_z = F.length(x) <= 2, F.length(z) <= 2
    return (
        F.when(_month(x).isNotNull(), F.when(_digits(y).isNotNull(), _fields(_year(z), _month(x), _digits(y))))
        .when(_month(y).isNotNull() & (F.length(x) == 4), F.when(short_z, _fields(_digits(x), _month(y), _digits(z))))
        .when(_month(y).isNotNull(), F.when(short_x, _fields(_year(z), _month(y), _digits(x))))
        .when(F.length(x) == 4, F.when(short_z, numbers(_digits(x), _digits(y), _digits(z))))
        .when(short_x, numbers(_year(z), _digits(y), _digits(x)))
    )


def _together(date: Column, part: Column) -> Column:
    hour, minute, second = _clock(part)
    return F.try_make_timestamp_ntz(date["y"], date["m"], date["d"], hour, minute, second)
