from datetime import datetime
from pathlib import Path

import pytest
from conftest import ROWS, build
from pyspark.sql import functions as F

from eventloom.operators import validate
from eventloom.plans.registry import GROUPS, REPORTS, Views, export_reports, select_reports
from eventloom.plans.reload import reload
from eventloom.sources import raw, sinks

HEADER = (
    "Case ID;Variant;Priority;Reporter;Timestamp;Event;Issue Type;Resolver;"
    "Report Channel;Short Description;Customer Satisfaction;Extra"
)
LINES = [
    "INC2; Variant 1 ;High;dana;02/01/2023 08:00;Ticket created;Bug;;App;Crash;4;x",
    "INC1;Variant 1;High;dana;01/02/2023 08:00;Ticket created;Bug;   ;App;Crash;5;x",
    "INC1;Variant 1;High;dana;2023-02-01 10:30;NULL;Bug;alice;App;Crash;5;x",
    "INC1;Variant 1;High;dana;01/02/2023 08:00;WIP;Bug;alice;App;Crash;5;x",
    "INC2;Variant 1;High;dana;2/1/2023 9:05;Ticket closed;Bug;;App;Crash;4;x",
]


def write(path, lines, header=HEADER):
    path.mkdir()
    (path / "log.csv").write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return str(path)


def test_load_log(spark, tmp_path):
    log = raw.load_log(spark, write(tmp_path / "raw", LINES)).orderBy("event_id").collect()
    assert [r["event_id"] for r in log] == [1, 2, 3, 4, 5]
    assert [(r["case_id"], r["event"]) for r in log] == [
        ("INC1", "Ticket created"),
        ("INC1", "WIP"),
        ("INC1", None),
        ("INC2", "Ticket created"),
        ("INC2", "Ticket closed"),
    ]
    # Day comes first, also in the fallback; the ISO form keeps its own order.
    assert [r["event_timestamp"] for r in log] == [
        datetime(2023, 2, 1, 8, 0),
        datetime(2023, 2, 1, 8, 0),
        datetime(2023, 2, 1, 10, 30),
        datetime(2023, 1, 2, 8, 0),
        datetime(2023, 1, 2, 9, 5),
    ]
    assert [r["resolver"] for r in log] == [None, "alice", "alice", None, None]
    assert {r["variant"] for r in log} == {"Variant 1"}
    assert "Extra" not in log[0].asDict()


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("12/03/2023 02:30",)], "c string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(raw.parse_ts("c")).first()[0] == datetime(2023, 3, 12, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unreadable_timestamps_fail_with_their_number_or_are_dropped(spark, tmp_path):
    bad = LINES + ["INC2;Variant 1;High;dana;31/02/2023 08:00;X;Bug;;App;Crash;4;x",
                   "INC2;Variant 1;High;dana;soon;X;Bug;;App;Crash;4;x"]
    path = write(tmp_path / "raw", bad)
    with pytest.raises(ValueError, match="2 rows have unparseable timestamps"):
        raw.load_log(spark, path)
    assert raw.load_log(spark, path, bad_timestamps="drop").count() == len(LINES)


def test_missing_columns_are_all_named(spark, tmp_path):
    header = HEADER.replace("Variant", "V").replace("Resolver", "R")
    with pytest.raises(ValueError, match=r"\['Variant', 'Resolver'\]"):
        raw.load_log(spark, write(tmp_path / "raw", LINES, header))


def test_numbers_and_headers(spark):
    df = spark.createDataFrame([("5",), ("4.0",), ("x",), (None,), ("3.5",)], "c string")
    assert [r[0] for r in df.select(raw.to_number("c", "int")).collect()] == [5, 4, None, None, None]
    assert [r[0] for r in df.select(raw.to_number("c")).collect()] == [5.0, 4.0, None, None, 3.5]
    headers = spark.createDataFrame([(1, 2)], "` Case ID ` int, `Issue Type` int")
    assert raw.clean_headers(headers).columns == ["case_id", "issue_type"]


def test_cleaning_steps(spark):
    df = spark.createDataFrame(
        [("a", 1.0, None, None), (None, 5.0, None, "x"), ("b", None, None, None), ("c", 2.0, None, None)],
        "t string, n double, e int, resolver string",
    )
    assert raw.drop_empty_columns(df).columns == ["t", "n", "resolver"]
    assert [r["t"] for r in raw.fill_unknown(df, ["t"]).collect()] == ["a", "Unknown", "b", "c"]
    with pytest.raises(ValueError):
        raw.fill_unknown(df, ["resolver"])
    filled = raw.impute_median(df, ["n", "e"]).collect()
    assert [r["n"] for r in filled] == [1.0, 5.0, 2.0, 2.0]
    assert {r["e"] for r in filled} == {0.0}
    assert [r["resolver_missing"] for r in raw.flag_missing_resolver(df).collect()] == [1, 0, 1, 1]
    assert raw.drop_incomplete(df, ["t", "n"]).count() == 2


def test_written_log_is_what_was_sent(spark, log, tmp_path):
    path = str(tmp_path / "log")
    written = sinks.write_log(log, path, files=3)
    assert written.exceptAll(log).count() == 0 and log.exceptAll(written).count() == 0
    assert validate.case_count_differences(log, written).count() == 0
    newer = log.where("case_id <> 'F'")
    sinks.write_log(newer, path)
    assert sinks.read_log(spark, path).count() == len(ROWS) - 1


def test_short_write_is_refused_and_readers_keep_the_old_version(spark, log, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    sinks.write_log(log, path)
    write_all = sinks.write_version
    monkeypatch.setattr(
        sinks, "write_version", lambda df, *a, **k: write_all(df.where("case_id <> 'B'"), *a, **k)
    )
    with pytest.raises(validate.ValidationError, match="rows 19 against 13"):
        sinks.write_log(log, path)
    assert sinks.read_log(spark, path).count() == len(ROWS)


def test_of_two_loads_at_once_one_comes_after_the_other(spark, log, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    sinks.write_log(log, path)
    sinks.write_version(log.where("case_id = 'A'"), path, "a")
    sinks.write_version(log.where("case_id = 'B'"), path, "b")
    # Both saw version 1 as the latest.
    seen = sinks.latest(spark, path)
    monkeypatch.setattr(sinks, "latest", lambda *args: seen)
    assert [sinks.publish(spark, path, "a", 4, 1), sinks.publish(spark, path, "b", 6, 1)] == [2, 3]
    monkeypatch.undo()
    assert {r["case_id"] for r in sinks.read_log(spark, path).collect()} == {"B"}
    assert {r["case_id"] for r in sinks.read_log(spark, path, 2).collect()} == {"A"}
    with pytest.raises(ValueError, match="no published version 4"):
        sinks.read_log(spark, path, 4)


def test_a_load_that_was_overtaken_is_not_published(spark, log, tmp_path):
    path = str(tmp_path / "log")
    sinks.write_log(log, path, after=0)
    sinks.write_log(log.where("case_id <> 'F'"), path, after=1)
    with pytest.raises(sinks.Overtaken):
        sinks.write_log(log, path, after=1)
    assert sinks.read_log(spark, path).count() == len(ROWS) - 1


def test_what_an_interrupted_load_leaves_behind_is_not_seen(spark, log, tmp_path):
    path = str(tmp_path / "log")
    with pytest.raises(ValueError, match="no published version"):
        sinks.read_log(spark, path)
    sinks.write_log(log, path)
    sinks.write_version(log.where("case_id = 'A'"), path, "unpublished")
    # A record whose writer died, and one of a short version.
    (tmp_path / "log" / "published" / "000000000002.json").write_text('{"number": 2, "vers')
    assert sinks.read_log(spark, path).count() == len(ROWS)
    sinks.write_version(log.where("case_id = 'B'"), path, "short")
    assert sinks.publish(spark, path, "short", 9, 1) == 3
    lines = {r["version"]: r for r in sinks.audit(spark, path).collect()}
    assert (lines["unpublished"]["number"], lines["unpublished"]["rows_found"], lines["unpublished"]["whole"]) == (None, 4, False)
    assert (lines["short"]["rows_found"], lines["short"]["whole"], lines["short"]["current"]) == (6, False, True)
    first = next(r for r in lines.values() if r["number"] == 1)
    assert first["whole"] and first["rows"] == len(ROWS)


def test_records_of_one_time_have_one_order(spark, tmp_path):
    folder = tmp_path / "log" / "published"
    folder.mkdir(parents=True)
    line = '{"version": "%s", "published_at": "2023-01-01T00:00:00Z", "rows": 1, "cases": 1}'
    (folder / "old.json").write_text("\n".join(line % v for v in "bca"))
    assert sinks.latest(spark, str(tmp_path / "log"))["version"] == "c"


def test_parity_sees_moved_events(log):
    moved = log.withColumn("case_id", F.when(F.col("event_id") == 1, "B").otherwise(F.col("case_id")))
    lines = {r["check"]: r["passed"] for r in validate.parity(log, moved).collect()}
    steady = dict.fromkeys(["rows", "cases", "variants", "first event", "last event"], True)
    assert lines == steady | {"cases of unequal size": False}


def test_reload_end_to_end(spark, tmp_path):
    source = write(tmp_path / "raw", LINES)
    cases = reload(spark, source, str(tmp_path / "log"), str(tmp_path / "cases"))
    assert cases.count() == 2
    back = spark.read.csv(str(tmp_path / "cases"), header=True)
    assert back.columns == cases.columns and back.count() == 2
    assert reload(spark, source).count() == 2  # case table only
    short = write(tmp_path / "short", LINES[1:])
    with pytest.raises(validate.ValidationError, match="fewer than 2 events: 1"):
        reload(spark, short)


def test_bucketed_table_needs_no_shuffle_for_windows(spark, log):
    from eventloom.operators.sequence import by_case

    sinks.write_bucketed(log, "bucketed_log", 4)
    try:
        steps = by_case(spark.table("bucketed_log"), before=["event_timestamp"])
        plan = steps.groupBy("case_id").agg(F.count("prev_event_timestamp"))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
    finally:
        spark.sql("DROP TABLE bucketed_log")


def test_source_order_check_sees_late_rows(spark):
    from eventloom.operators.quality import ordering_defects
    from eventloom.operators.views import transition_metrics

    rows = [r for r in ROWS if r[0] == "A"]
    late = build(spark, [rows[3], rows[0], rows[1], rows[2]])
    found = ordering_defects(transition_metrics(late), late).first()
    assert (found["out_of_order"], found["negative_durations"], found["source_out_of_order"]) == (0, 0, 1)


def test_registry(spark, log, tmp_path):
    assert len(REPORTS) == 23
    assert {g: len(select_reports(group=g)) for g in GROUPS} == {
        "kpis": 8, "bottlenecks": 4, "quality": 5, "provenance": 6,
    }
    with pytest.raises(KeyError):
        select_reports(["no such"])
    views = Views(log)
    paths = export_reports(views, str(tmp_path / "out"), group="quality")
    assert sorted(paths) == ["completeness", "null_events", "ordering_defects", "resolver_nulls", "score_ceiling"]
    exported = spark.read.csv(paths["null_events"], header=True)
    assert exported.count() == 4 and exported.columns == ["case_id", "event_timestamp", "resolver"]
    parquet = export_reports(views, str(tmp_path / "pq"), names=["kpi_overall"], fmt="parquet")
    assert spark.read.parquet(parquet["kpi_overall"]).first()["incidents"] == 6
    views.register()
    assert spark.sql("SELECT count(*) FROM case_metrics").first()[0] == 6


def test_quoted_cells(spark, tmp_path):
    """Doubled quotes and delimiters in quotes; line breaks on request."""
    (tmp_path / "a.csv").write_text('k;t;u\n1;"say ""hi"" ; now";x\n2;plain;y\n')
    rows = raw.require_well_formed(raw.read_raw(spark, str(tmp_path / "a.csv"))).orderBy("k").collect()
    assert [(r.k, r.t, r.u) for r in rows] == [("1", 'say "hi" ; now', "x"), ("2", "plain", "y")]
    (tmp_path / "b.csv").write_text('k;t;u\n1;"two\nlines";x\n2;plain;y\n')
    rows = raw.require_well_formed(raw.read_raw(spark, str(tmp_path / "b.csv"), multiline=True)).collect()
    assert sorted((r.k, r.t, r.u) for r in rows) == [("1", "two\nlines", "x"), ("2", "plain", "y")]
    with pytest.raises(ValueError, match="rows have more or fewer cells"):
        raw.require_well_formed(raw.read_raw(spark, str(tmp_path / "b.csv")))


@pytest.mark.parametrize("line", ["3;only two", "3;one;too;many"])
def test_rows_of_another_width_are_counted(spark, tmp_path, line):
    (tmp_path / "a.csv").write_text(f"k;t;u\n1;a;b\n{line}\n")
    with pytest.raises(ValueError, match="^1 rows have more or fewer cells"):
        raw.require_well_formed(raw.read_raw(spark, str(tmp_path / "a.csv")))


def test_files_with_other_headers_fail(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text("k;t;u\n1;a;b\n")
    (tmp_path / "raw" / "b.csv").write_text("k;u;t\n2;b;a\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw.require_well_formed(raw.read_raw(spark, str(tmp_path / "raw"))).collect()


def test_unreadable_times_and_numbers(spark):
    rows = [("1", "no time"), ("unknown", "01/02/2023 10:11:12.5"), (None, "2023-02-01 10:11")]
    df = spark.createDataFrame(rows, "n string, t string")
    got = df.select(raw.to_number("n", "int").alias("n"), raw.parse_ts("t").alias("t")).collect()
    assert [r.n for r in got] == [1, None, None]
    assert [str(r.t) for r in got] == ["None", "2023-02-01 10:11:12.500000", "2023-02-01 10:11:00"]


def test_intermediates_leave_nothing_behind(spark, tmp_path):
    from eventloom.functions.storage import intermediates, materialise, shared_dir

    def files():
        folder = Path(shared_dir(spark)) / "eventloom" / spark.sparkContext.applicationId
        return {p for p in folder.rglob("*") if p.is_file()}

    before = files()
    with intermediates(spark):
        assert materialise(spark.range(5), "five").count() == 5 and files() > before
    assert files() == before


def test_text_is_parsed_once(spark, tmp_path, monkeypatch):
    """Numbering reads typed rows several times, not the text."""
    seen, number = [], raw.assign_event_ids
    monkeypatch.setattr(raw, "assign_event_ids", lambda typed: seen.append(typed.inputFiles()) or number(typed))
    raw.load_log(spark, write(tmp_path / "raw", LINES))
    assert seen[0] and all(f.endswith(".parquet") for f in seen[0])


def test_white_space_around_text(spark):
    """As a regular expression has it, also before a last line end that is no white space."""
    texts = [" a b\t", "\n\x0b\x0c\r x \r\n", "   ", "", None, "a \u0085", " \u2028", "\u00a0a\u00a0", "a \u2029 "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    by_expression = F.nullif(F.regexp_replace("t", r"^\s+|\s+$", ""), F.lit(""))
    assert all(a == b for a, b in df.select(raw.clean_text("t"), by_expression).collect())


def test_formats_fit_the_texts_they_did(spark):
    """A format is tried on texts with its separators only, which changes no time."""
    assert raw._outline("d/M/yyyy H:mm[:ss][.SSSSSS]") == "%/%/% %:%"
    assert raw._outline("yyyy-M-d'T'H:mm[:ss][.SSSSSS]") == "%-%-%:%"
    days = ["1/2/2023", "01/02/2023", "2023-1-2", "1.2.2023", "1-2-2023", "31/2/2023", "2023/1/2", "0005-1-2023"]
    clocks = ["", " 1:02", " 01:02", "T1:02:03", "t01:02:03.5", " 1:02:03.123456", "  1:02", " 25:00", " "]
    texts = [q + d + c + q for d in days for c in clocks for q in ("", '"', " ", "\n")] + ["", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = [F.from_csv("t", "t timestamp_ntz", {"timestampNTZFormat": f, "sep": "\u0001"})["t"] for f in raw.TIMESTAMP_FORMATS]
    rows = df.select("t", raw.parse_ts("t", lenient=False).alias("got"), F.coalesce(*plain).alias("want")).collect()
    assert [r for r in rows if r["got"] != r["want"]] == [] and any(r["got"] for r in rows)
