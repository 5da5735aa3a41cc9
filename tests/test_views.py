import pytest
from conftest import ROWS, build, by
from pyspark.sql import functions as F

from eventloom.operators import validate
from eventloom.operators.sequence import by_case
from eventloom.operators.views import CASE_KEY, case_metrics, case_table, step_gaps, transition_metrics


def test_case_metrics_by_hand(log):
    cases = by(case_metrics(log), "case_id")
    assert len(cases) == 6
    a = cases["A"]
    assert (a["event_count"], a["unique_events"], a["unique_resolvers"]) == (4, 4, 1)
    assert a["cycle_time_seconds"] == 4 * 3600.0
    assert a["cycle_time_hours"] == 4.0
    assert (a["mean_step_seconds"], a["max_step_seconds"], a["median_step_seconds"]) == (4800.0, 10800.0, 3600.0)
    assert (a["escalated"], a["reached_level_3"], a["is_completed"]) == (False, False, True)
    b = cases["B"]
    assert (b["event_count"], b["unique_events"], b["unique_resolvers"]) == (6, 5, 3)
    assert b["cycle_time_hours"] == 48.0
    assert (b["escalated"], b["reached_level_3"], b["is_completed"]) == (True, True, True)


def test_milestones_are_null_only_when_all_events_are(log):
    cases = by(case_metrics(log), "case_id")
    assert cases["E"]["escalated"] is None and cases["E"]["is_completed"] is None
    assert cases["D"]["escalated"] is False
    assert cases["E"]["unique_events"] == 0


def test_single_event_case_has_no_steps(log):
    f = by(case_metrics(log), "case_id")["F"]
    assert f["cycle_time_hours"] == 0.0
    assert f["mean_step_seconds"] is None and f["median_step_seconds"] is None


def test_varying_attribute_splits_the_case(spark):
    rows = [r for r in ROWS if r[0] == "A"]
    changed = rows[:2] + [r[:3] + ("zoe",) + r[4:] for r in rows[2:]]
    assert case_metrics(build(spark, changed)).count() == 2
    assert case_table(build(spark, changed)).count() == 1


def test_transitions_charge_the_state_left(log):
    steps = by(transition_metrics(log), "case_id", "from_timestamp", "from_event")
    labels = [k[2] for k in steps if k[0] == "A"]
    assert sorted(labels) == ["Ticket created", "Ticket solved by level 1 support", "WIP - level 1 support"]
    same_minute = next(v for k, v in steps.items() if k[0] == "A" and k[2] == "WIP - level 1 support")
    assert same_minute["to_event"] == "Ticket solved by level 1 support"
    assert same_minute["duration_hours"] == 0.0
    created = next(v for k, v in steps.items() if k[0] == "B" and k[2] == "Ticket created")
    assert created["transition"] == "Ticket created -> WIP - level 1 support"
    assert created["duration_hours"] == 6.0


def test_null_event_removes_both_its_transitions(log):
    dropped = transition_metrics(log).where("case_id = 'C'").collect()
    assert [r["transition"] for r in dropped] == ["WIP - level 1 support -> Ticket closed"]
    bridged = transition_metrics(log, null_event="bridge").where("case_id = 'C'")
    assert {r["transition"]: r["duration_hours"] for r in bridged.collect()} == {
        "Ticket created -> WIP - level 1 support": 3.0,
        "WIP - level 1 support -> Ticket closed": 3.0,
    }
    with pytest.raises(ValueError):
        transition_metrics(log, null_event="other")


def test_number_of_transitions(log):
    """Events less cases less neighbouring pairs that touch a NULL event."""
    touched = 2 + 1 + 1  # C, D, E
    assert transition_metrics(log).count() == len(ROWS) - 6 - touched


def test_steps_add_up_to_the_cycle(log):
    steps = step_gaps(log).groupBy("case_id").agg(F.sum("step_seconds").alias("s"))
    joined = steps.join(case_metrics(log), "case_id")
    assert joined.where(F.coalesce("s", F.lit(0.0)) != F.col("cycle_time_seconds")).count() == 0
    assert step_gaps(log).where("step_seconds IS NULL").count() == 6


def test_case_table_first_non_null_and_flags(spark):
    rows = [
        ("A", None, "High", "dana", "2023-01-01 08:00", None, "Bug", None, "App", None, None),
        ("A", "Variant 1", "High", "dana", "2023-01-01 09:00", "LEVEL 3 Escalation", "Bug", "x", "App", "text", 4),
        ("A", "Variant 2", "High", "dana", "2023-01-01 10:30", "Ticket closed", "Bug", "x", "App", "later", 5),
    ]
    only = case_table(build(spark, rows)).collect()
    assert len(only) == 1
    a = only[0].asDict()
    assert (a["variant"], a["short_description"], a["customer_satisfaction"]) == ("Variant 1", "text", 4)
    assert (a["event_count"], a["unique_events"], a["unique_resolvers"]) == (3, 2, 1)
    assert a["duration_hours"] == 2.5
    assert (a["escalated"], a["reached_level_3"], a["is_completed"]) == (1, 1, 1)


def test_case_table_flag_is_zero_for_null_events(log):
    assert by(case_table(log), "case_id")["E"]["escalated"] == 0


def test_clock_change_does_not_matter(spark, log):
    """02:30 does not exist in New York on 2023-03-12; the log has no zone."""
    rows = [
        ("A", "V", "High", "d", "2023-03-12 01:30", "a", "Bug", None, "App", "t", 1),
        ("A", "V", "High", "d", "2023-03-12 02:30", "b", "Bug", None, "App", "t", 1),
        ("A", "V", "High", "d", "2023-03-12 03:30", "c", "Bug", None, "App", "t", 1),
    ]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frame = build(spark, rows)
        assert case_metrics(frame).first()["cycle_time_hours"] == 2.0
        assert [r[0] for r in transition_metrics(frame).orderBy("from_timestamp").select("duration_hours").collect()] == [1.0, 1.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_window_and_grouping_share_one_shuffle(spark, log):
    """Cases within a chunk: the window's exchange serves the grouping by case attributes."""
    rows = by_case(spark.createDataFrame(log.collect(), log.schema), before=["event_timestamp"])
    grouped = rows.groupBy(*CASE_KEY).agg(F.count("prev_event_timestamp"))
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Window [") == 1


def test_validation_accepts_a_good_log(spark):
    good = build(spark, [r for r in ROWS if r[0] in "ABC"])
    assert validate.require_valid(good) is good


@pytest.mark.parametrize(
    "change, check",
    [
        (lambda rows: rows + [rows[0]], "duplicate events"),
        (lambda rows: rows[:1], "cases with fewer than 2 events"),
        (lambda rows: rows[:3] + [rows[3][:1] + ("Variant 9",) + rows[3][2:]], "varying variant"),
        (lambda rows: rows[:3] + [rows[3][:2] + ("Low",) + rows[3][3:]], "varying priority"),
        (lambda rows: rows[:3] + [rows[3][:3] + ("zoe",) + rows[3][4:]], "varying reporter"),
        (lambda rows: rows[:3] + [rows[3][:6] + ("Incident",) + rows[3][7:]], "varying issue_type"),
        (lambda rows: rows[:3] + [rows[3][:8] + ("Phone",) + rows[3][9:]], "varying report_channel"),
        (lambda rows: rows[:3] + [rows[3][:10] + (1,)], "varying customer_satisfaction"),
    ],
)
def test_each_check_fails_alone(spark, change, check):
    bad = build(spark, change([r for r in ROWS if r[0] == "A"]))
    failed = {r["check"]: r["failures"] for r in validate.validation_summary(bad).where("NOT passed").collect()}
    assert failed == {check: 1}
    with pytest.raises(validate.ValidationError, match=check):
        validate.require_valid(bad)


def test_null_events_count_as_equal_duplicates(spark):
    row = ("A", "V", "High", "d", "2023-01-01 08:00", None, "Bug", None, "App", "t", 1)
    assert validate.duplicate_events(build(spark, [row, row, row])).first()["surplus_rows"] == 2


def test_null_is_not_a_second_value(spark):
    rows = [r for r in ROWS if r[0] == "A"]
    holes = build(spark, rows[:3] + [rows[3][:1] + (None,) + rows[3][2:]])
    assert validate.check_constant(holes).where("varying_cases > 0").count() == 0


def test_events_are_dealt_before_they_are_grouped(spark):
    """A task's map of groups must not grow with what a split of a well compressed file holds."""
    twice = build(spark, [*ROWS, *ROWS, ROWS[0]])
    found = validate.duplicate_events(twice)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("RebalancePartitions")
    assert sum(r["surplus_rows"] for r in found.collect()) == len(ROWS) + 1
    checks = {r["check"]: r["failures"] for r in validate.validation_summary(twice).collect()}
    assert checks["duplicate events"] == len(ROWS) + 1
