"""URL filter: an as-of join of captures with a dated list.

A list is a log of entries ``(pattern, listed_on, listed)``: from that day on the pattern is
on the list (1) or off it (0).  The log becomes validity intervals, and each capture is
judged by the entries that were active when it was fetched.  A pattern is a host, which
covers its subdomains, or a host with the first part of a path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Days over which the captures and the list entries of the query are spread.
DAYS = 1000


def host_of(url: Column) -> Column:
    """Host in lower case without user, port and final dot; empty where there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.rtrim(F.lower(found), F.lit("."))


def section_of(url: Column) -> Column:
    """First part of the path, empty where there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)", 1)


def intervals(entries: DataFrame) -> DataFrame:
    """``pattern, valid_from, valid_to`` (exclusive, null: open) of the listed spans.

    An entry holds until the pattern's next one.  Of entries of one day the listing wins;
    repeated entries are one; entries with a null field have no meaning and are dropped.
    """
    days = entries.dropna(subset=["pattern", "listed_on", "listed"]).groupBy("pattern", "listed_on").agg(
        F.max("listed").alias("listed")
    )
    after = Window.partitionBy("pattern").orderBy("listed_on")
    changed = days.withColumn("before", F.lag("listed").over(after)).filter(
        F.col("listed") != F.coalesce("before", F.lit(0))
    )
    return (
        changed.withColumn("valid_to", F.lead("listed_on").over(after))
        .filter(F.col("listed") == 1)
        .select("pattern", F.col("listed_on").alias("valid_from"), "valid_to")
    )


def candidate_patterns(host: Column, section: Column) -> Column:
    """The host, each parent domain of two names or more, and the host's section."""
    names = F.split(host, r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(names) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(names, i, F.size(names)), "."),
    )
    return F.array_compact(F.concat(parents, F.array(F.when(section != "", F.concat_ws("/", host, section)))))


def judge_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per capture ``(page_id, url, fetched_on)``: host, fetched_on, blocked, and the
    longest active pattern (the first by name of equally long ones) with its first day.

    A capture without a host or day is not blocked.  Repeated captures keep a row each.
    An empty list blocks nothing.  Further columns of both tables are ignored.

    The join sees each distinct (host, section, day) once, so a host that holds a third of
    all captures adds a row a section and day, not one a capture.
    """
    url = F.col("url").cast("string")
    rows = captures.select(
        "page_id",
        F.coalesce(host_of(url), F.lit("")).alias("host"),
        F.coalesce(section_of(url), F.lit("")).alias("section"),
        F.col("fetched_on").cast("date").alias("fetched_on"),
    )
    asked = rows.filter((F.col("host") != "") & F.col("fetched_on").isNotNull()).drop("page_id").distinct()
    patterns = candidate_patterns(F.col("host"), F.col("section"))
    active = (
        asked.withColumn("pattern", F.explode_outer(patterns))
        .join(intervals(entries), "pattern")
        .filter(
            (F.col("fetched_on") >= F.col("valid_from"))
            & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to")))
        )
    )
    best = F.min(F.struct((-F.length("pattern")).alias("rank"), "pattern", "valid_from"))
    verdicts = active.groupBy("host", "section", "fetched_on").agg(best.alias("best"))
    return rows.join(verdicts, ["host", "section", "fetched_on"], "left").select(
        "page_id",
        "host",
        "fetched_on",
        F.col("best").isNotNull().alias("blocked"),
        F.col("best.pattern").alias("pattern"),
        F.col("best.valid_from").alias("valid_from"),
    )


def _number(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, at, 4), 16, 10).cast("int")


def _day(number: Column) -> Column:
    return F.date_add(F.lit("2023-01-01").cast("date"), number)


def example_entries(pages: DataFrame) -> DataFrame:
    """A list log over the table's own hosts and sections, made from their names' digests:
    every fourth host and every ninth section is listed once, many are taken off again, and
    some return; the hosts named spam or pills are listed from the first day on."""
    url = F.col("url").cast("string")
    seen = pages.select(host_of(url).alias("host"), section_of(url).alias("section")).filter("host != ''").distinct()
    hosts = seen.select(F.col("host").alias("pattern"), F.lit(4).alias("every")).distinct()
    sections = seen.filter("section != ''").select(
        F.concat_ws("/", "host", "section").alias("pattern"), F.lit(9).alias("every")
    )
    digest = F.md5("pattern")
    first, second, third = (_number(digest, at) for at in (5, 9, 13))
    on, off, again = first % DAYS, first % DAYS + 1 + second % 300, first % DAYS + 301 + third % 300
    always = (F.col("every") == 4) & F.col("pattern").rlike("spam|pills")
    entry = lambda number, listed: F.struct(_day(number).alias("listed_on"), F.lit(listed).alias("listed"))
    log = F.when(always, F.array(entry(F.lit(0), 1))).when(
        _number(digest, 1) % F.col("every") == 0,
        F.array_compact(
            F.array(
                entry(on, 1),
                F.when(second % 3 > 0, entry(off, 0)),
                F.when(third % 3 == 0, entry(again, 1)),
            )
        ),
    )
    return hosts.unionByName(sections).select("pattern", F.inline(log))


def op2_temporal_url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``pages``; a page's day of fetching follows from its id."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    fetched = _day((F.pmod(F.col("page_id"), F.lit(DAYS)) * 619 % DAYS).cast("int"))
    return judge_captures(pages.withColumn("fetched_on", fetched), example_entries(pages))


_NUMBER = "CAST('0x' || substr(digest, {}, 4) AS INTEGER)"

ORACLE = rf"""
WITH parts AS (
  SELECT page_id,
         rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '.') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)', 1) AS section,
         DATE '2023-01-01' + CAST(page_id % {DAYS} * 619 % {DAYS} AS INTEGER) AS fetched_on
  FROM pages
), names AS (
  SELECT DISTINCT host AS pattern, 4 AS every FROM parts WHERE host <> ''
  UNION ALL
  SELECT DISTINCT host || '/' || section, 9 FROM parts WHERE host <> '' AND section <> ''
), numbered AS (
  SELECT pattern, every, {_NUMBER.format(1)} AS chosen, {_NUMBER.format(5)} % {DAYS} AS first_day,
         {_NUMBER.format(9)} AS second, {_NUMBER.format(13)} AS third,
         every = 4 AND regexp_matches(pattern, 'spam|pills') AS always
  FROM (SELECT *, md5(pattern) AS digest FROM names)
), entries AS (
  SELECT pattern, 0 AS day, 1 AS listed FROM numbered WHERE always
  UNION SELECT pattern, first_day, 1 FROM numbered WHERE NOT always AND chosen % every = 0
  UNION SELECT pattern, first_day + 1 + second % 300, 0 FROM numbered
        WHERE NOT always AND chosen % every = 0 AND second % 3 > 0
  UNION SELECT pattern, first_day + 301 + third % 300, 1 FROM numbered
        WHERE NOT always AND chosen % every = 0 AND third % 3 = 0
), log AS (
  SELECT pattern, DATE '2023-01-01' + day AS listed_on, max(listed) AS listed FROM entries GROUP BY ALL
), states AS (
  SELECT pattern, listed_on, listed,
         lead(listed_on) OVER (PARTITION BY pattern ORDER BY listed_on) AS until,
         coalesce(lag(listed) OVER (PARTITION BY pattern ORDER BY listed_on), 0) AS before
  FROM log
), found AS (
  SELECT p.page_id, p.host, p.fetched_on, s.pattern,
         (SELECT max(b.listed_on) FROM states b WHERE b.pattern = s.pattern AND b.listed = 1 AND b.before = 0
             AND b.listed_on <= s.listed_on) AS valid_from
  FROM parts p JOIN states s
    ON s.listed = 1 AND p.host <> ''
   AND (s.pattern = p.host OR s.pattern = p.host || '/' || p.section
        OR (position('/' IN s.pattern) = 0 AND position('.' IN s.pattern) > 0 AND ends_with(p.host, '.' || s.pattern)))
   AND p.fetched_on >= s.listed_on AND (s.until IS NULL OR p.fetched_on < s.until)
), best AS (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC, pattern) AS place FROM found
)
SELECT p.page_id, p.host, p.fetched_on, b.pattern IS NOT NULL AS blocked, b.pattern, b.valid_from
FROM parts p LEFT JOIN best b ON b.page_id = p.page_id AND b.place = 1
"""
