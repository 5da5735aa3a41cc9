import pytest

from eventloom.sources.raw import parse_ts

READ = {
    "5 Jan 2023 3:04 pm": "2023-01-05 15:04:00",
    "Jan 5, 2023": "2023-01-05 00:00:00",
    "Thursday, 5th of January 2023 at 12:30 AM": "2023-01-05 00:30:00",
    "05.01.23 14:15:16.5": "2023-01-05 14:15:16.5",
    "12/25/2023": "2023-12-25 00:00:00",  # no thirteenth month: the other order
    "25-12-98": "1998-12-25 00:00:00",
    "25-12-68": "2068-12-25 00:00:00",
    "20230105 10:11": "2023-01-05 10:11:00",
    "2023/1/5": "2023-01-05 00:00:00",
    "2023-13-05": "2023-05-13 00:00:00",
    "2023 Mar 7 1:02:03.123456789": "2023-03-07 01:02:03.123456",
    "7-Sept-21 9:05": "2021-09-07 09:05:00",
    "5 pm 3 Feb 2021": "2021-02-03 17:00:00",
    "12:00 am 1 May 2020": "2020-05-01 00:00:00",
    "  1/2/2020 10:00 ": "2020-02-01 10:00:00",
}
UNREAD = [
    "13/25/2023",
    "31/02/2023",
    "not a date",
    "2023-01-05T10:11:12Z",
    "3 Foo 2021",
    "",
    None,
    "13:00 pm 1 Jan 2020",
    "1/2/2020 10:00 11:00",
    "1/2/3",
    "5.1.2023 24:00",
    "Jan 2023",
    "5 Jan 2023 10:11 +02:00",
    "1 2 3 2020",
]


def test_loose_spellings(spark):
    texts = [*READ, *UNREAD]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["p"] for r in df.select("i", parse_ts("t").cast("string").alias("p")).collect()}
    assert {t: got[i] for i, t in enumerate(texts)} == READ | dict.fromkeys(UNREAD)
    strict = df.select(parse_ts("t", lenient=False).alias("p"), "t").where("t LIKE '%Jan%' AND p IS NOT NULL")
    assert strict.count() == 0


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_no_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("12 Mar 2023 2:30 am",)], "t string")
        assert df.select(parse_ts("t").cast("string")).first()[0] == "2023-03-12 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
