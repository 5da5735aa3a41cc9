"""Reports on the literal log, by hand."""

from conftest import by

from eventloom.operators import analyses, bottlenecks, kpis, legacy, provenance, quality
from eventloom.plans.registry import Views

import pytest


@pytest.fixture(scope="module")
def v(log):
    return Views(log)


def test_kpis(v):
    one = kpis.kpi_overall(v.cases).first()
    # Hours: 4, 48, 6, 2, 0.5, 0
    assert (one["incidents"], one["mean_cycle_hours"], one["median_cycle_hours"]) == (6, 10.08, 3.0)
    assert (one["p75_cycle_hours"], one["p95_cycle_hours"], one["max_cycle_hours"]) == (5.5, 37.5, 48.0)
    assert one["mean_satisfaction"] == 3.0
    low = by(kpis.sla_by(v.cases), "priority")["Low"]
    assert (low["incidents"], low["pct_over_24h"], low["mean_cycle_hours"]) == (2, 50.0, 25.0)
    flags = by(kpis.escalation_impact(v.cases), "escalated")
    assert flags[None]["incidents"] == 1 and flags[True]["pct_of_incidents"] == 16.67
    assert sum(r["pct_of_incidents"] for r in flags.values()) == pytest.approx(100, abs=0.02)
    assert [r["case_id"] for r in kpis.slowest_cases(v.cases, 2).collect()] == ["B", "C"]


def test_time_by_state(v):
    states = by(kpis.time_by_state(v.transitions), "from_event")
    # 1 h (A) + 6 h (B) in creation; C and D lose theirs to a NULL event.
    assert states["Ticket created"]["total_hours"] == 7.0
    assert states["WIP - level 3 support"]["cases"] == 1
    assert sum(s["pct_of_all_time"] for s in states.values()) == pytest.approx(100, abs=0.3)


def test_bottlenecks(v):
    everything = by(bottlenecks.transition_bottlenecks(v.transitions, v.log), "transition")
    loop = everything["WIP - level 3 support -> WIP - level 3 support"]
    assert (loop["occurrences"], loop["cases"], loop["case_percentage"], loop["mean_hours"]) == (1, 1, 16.67, 8.0)
    own = by(bottlenecks.variant_bottlenecks(v.transitions), "transition")
    # Case D has the variant but no transition, so B is all of them.
    assert {r["case_percentage"] for r in own.values()} == {100.0}
    again = by(bottlenecks.rework_events(v.log), "event")
    assert again["WIP - level 3 support"]["max_occurrences"] == 2
    assert again[None]["cases"] == 1  # NULL is its own group
    funnel = by(bottlenecks.escalation_funnel(v.cases), "issue_type")
    assert (funnel["Bug"]["escalated"], funnel["Bug"]["escalation_rate_pct"]) == (1, 33.33)
    assert funnel["Incident"]["mean_hours_with_escalation"] is None
    assert funnel["Incident"]["mean_hours_no_escalation"] == 3.0  # E is on neither side


def test_quality(v):
    assert quality.completeness(v.log).first()["null_event"] == 4
    assert quality.null_events(v.log).count() == 4
    created = by(quality.resolver_nulls(v.log), "event")["Ticket created"]
    assert (created["rows"], created["null_pct"]) == (5, 100.0)
    ceiling = by(quality.score_ceiling(v.cases), "variant")
    assert ceiling["Variant 7"]["appears_capped_at_3"] is True
    assert ceiling["Variant 1"]["appears_capped_at_3"] is False


def test_provenance(v):
    paths = by(provenance.path_determinism(v.paths), "variant")
    # C and A differ; E has no named event and so no path.
    assert (paths["Variant 1"]["distinct_sequences"], paths["Variant 2"]["cases"]) == (2, 1)
    spread = by(provenance.event_count_spread(v.cases), "variant")
    assert spread["Variant 7"]["event_count_spread"] == 4
    label = by(provenance.label_by_variant(v.cases), "variant")
    assert (label["Variant 7"]["l3_behaviour"], label["Variant 1"]["l3_behaviour"]) == ("MIXED", "NONE")
    outside = provenance.outside_variant_set(v.cases).first()
    assert (outside["outside_them"], outside["l3_outside_them"]) == (4, 0)
    verdict = provenance.provenance_verdict(v.paths, v.cases).first()
    assert verdict["variants_with_event_count_spread"] == 2
    assert verdict["variants_with_multiple_sequences"] == 2


def test_case_without_variant_is_neither_inside_nor_outside(v):
    from pyspark.sql import functions as F

    holes = v.cases.withColumn("variant", F.when(F.col("case_id") != "A", F.col("variant")))
    row = provenance.outside_variant_set(holes).first()
    assert (row["total_cases"], row["in_deterministic_variants"], row["outside_them"]) == (6, 2, 3)


def test_priority_multiplier_modes(v):
    by_sum = by(provenance.priority_multiplier(v.transitions), "from_event", "priority")
    assert by_sum["Ticket created", "Low"]["multiplier_vs_high"] == 6.0
    by_mean = by(provenance.priority_multiplier(v.transitions, stat="mean"), "from_event", "priority")
    assert by_mean["Ticket created", "Low"]["multiplier_vs_high"] == 6.0
    with pytest.raises(ValueError):
        provenance.priority_multiplier(v.transitions, stat="max")


def test_legacy(v):
    backward = by(legacy.backward_bottlenecks(v.log, n=None), "bottleneck_event")
    # The wait before level 3 is charged to the escalation's successor here.
    assert backward["Level 2 escalates to level 3 support"]["average_duration_seconds"] == 18 * 3600.0
    cycle = by(legacy.legacy_case_cycle(v.log), "incident_id")
    assert (cycle["A"]["total_steps"], cycle["A"]["average_step_duration_seconds"]) == (4, 4800.0)
    assert legacy.example_trace(v.log, "A").count() == 4
    ranked = legacy.ranked_bottlenecks(v.transitions).collect()
    assert [r["bottleneck_rank"] for r in ranked] == list(range(1, len(ranked) + 1))


def test_what_if(v):
    row = analyses.what_if(v.transitions, v.cases).first()
    # A and B save 1 h each; level 1 work is 0 (A), 18 h (B) and 3 h (C): 20 % of 21 h.
    assert row["saving_hours_per_case"] == pytest.approx((2 + 4.2) / 6, abs=1e-3)


def test_dwell_multiplier_sums_inside_a_case_first(v):
    rows = by(analyses.dwell_multiplier(v.transitions), "state_group", "priority")
    assert rows["intake", "Low"]["multiplier"] == 6.0
    assert rows["level 1 work", "Low"]["mean_hours"] == 18.0


def test_compare_metrics(spark):
    old = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "metric string, value double")
    new = spark.createDataFrame([("a", 1.5), ("c", 3.0)], "metric string, value double")
    rows = by(analyses.compare_metrics(old, new), "metric")
    assert rows["a"]["difference"] == 0.5 and rows["b"]["new_value"] is None and rows["c"]["old_value"] is None
