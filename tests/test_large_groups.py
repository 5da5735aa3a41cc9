"""Results do not depend on how the log is cut into chunks."""

import random

import numpy as np
import pandas as pd
import pytest
from conftest import ROWS, build
from pyspark.sql import functions as F

from eventloom.functions.ordered import global_rank, running_totals, split_at_borders
from eventloom.functions.quantiles import exact_quantiles, planned_quantile
from eventloom.operators import analyses, provenance
from eventloom.operators.sequence import ordered_log, with_neighbours
from eventloom.operators.views import case_metrics, case_table, step_gaps, transition_metrics


@pytest.fixture(scope="module")
def skewed(spark):
    """One case holds a third of all events, many of them at the same minute."""
    rng = random.Random(7)
    rows = []
    for i in range(600):
        case = "BIG" if i % 3 == 0 else f"c{rng.randrange(60)}"
        minute = rng.randrange(40) if case == "BIG" else rng.randrange(600)
        rows.append(
            (case, f"Variant {1 + len(case) % 2}", "High", "d",
             f"2023-01-01 {minute // 60:02d}:{minute % 60:02d}",
             rng.choice(["Ticket created", "escalated", "level 3", "Ticket closed", None]),
             "Bug", rng.choice([None, "x", "y", "z"]), "App", "text", 3)
        )
    return build(spark, rows).cache()


def frames_equal(a, b, keys):
    a, b = (x.toPandas().sort_values(keys).reset_index(drop=True) for x in (a, b))
    pd.testing.assert_frame_equal(a, b[a.columns])


def test_only_keys_at_borders_are_apart(skewed):
    rows = ordered_log(skewed, 6)
    whole, reaching = split_at_borders(rows, ["case_id"])
    spread = {r[0]: r[1] for r in rows.groupBy("case_id").agg(F.countDistinct("_chunk")).collect()}
    assert spread["BIG"] > 1
    assert {r[0] for r in reaching.select("case_id").collect()} == {k for k, n in spread.items() if n > 1}
    assert whole.count() + reaching.count() == 600


def test_a_null_case_is_a_case(skewed):
    hidden = F.when(F.col("case_id") != "BIG", F.col("case_id"))
    rows = with_neighbours(skewed.withColumn("case_id", hidden), position=True, chunks=6)
    places = [r["position"] for r in rows.where("case_id IS NULL").collect()]
    assert sorted(places) == list(range(1, 201))


def test_views_of_an_ordered_log_start_no_job(skewed, spark):
    rows, path = ordered_log(skewed, 6), "no-job"
    spark.sparkContext.setJobGroup(path, path)
    for view in (case_metrics, transition_metrics, case_table, step_gaps, provenance.case_paths):
        view(rows)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(path)


@pytest.mark.parametrize("view, keys", [
    (case_metrics, ["case_id"]),
    (transition_metrics, ["case_id", "from_timestamp", "to_timestamp", "transition"]),
])
def test_views_are_the_same_in_chunks(skewed, view, keys):
    frames_equal(view(skewed, chunks=1), view(skewed, chunks=6), keys)


def test_case_table_and_gaps_are_the_same(skewed):
    frames_equal(case_table(skewed, chunks=1), case_table(skewed, chunks=7), ["case_id"])
    frames_equal(step_gaps(skewed, chunks=1), step_gaps(skewed, chunks=7), ["case_id", "event_id"])


def test_neighbours_and_positions_against_python(skewed):
    events = sorted(skewed.collect(), key=lambda r: (r["case_id"], r["event_timestamp"], r["event_id"]))
    expected = {}
    for i, row in enumerate(events):
        before = events[i - 1] if i and events[i - 1]["case_id"] == row["case_id"] else None
        after = events[i + 1] if i + 1 < len(events) and events[i + 1]["case_id"] == row["case_id"] else None
        place = expected[before["event_id"]][2] + 1 if before else 1
        expected[row["event_id"]] = (
            before and before["event"], after and after["event_timestamp"], place
        )
    for result in (
        with_neighbours(skewed, ["event"], ["event_timestamp"], position=True),
        with_neighbours(skewed, ["event"], ["event_timestamp"], position=True, chunks=1),
        with_neighbours(skewed, ["event"], ["event_timestamp"], position=True, chunks=7),
        with_neighbours(ordered_log(skewed, 40), ["event"], ["event_timestamp"], position=True),
    ):
        got = {r["event_id"]: (r["prev_event"], r["next_event_timestamp"], r["position"]) for r in result.collect()}
        assert got == expected


def test_paths_are_counted_the_same(skewed):
    paths = skewed.where("event IS NOT NULL").groupBy("case_id", "variant").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_timestamp", "event_id", "event"))), lambda s: s["event"]), ">").alias("path")
    )
    for chunks in (1, 5):
        own = provenance.case_paths(skewed, chunks)
        frames_equal(provenance.path_determinism(paths), provenance.path_determinism(own), ["variant"])


def test_gap_spread_is_the_same(skewed):
    for analysis in (analyses.gap_spread_by_case, analyses.gap_spread_by_position):
        frames_equal(analysis(skewed, None, 1), analysis(skewed, None, 7), analysis(skewed, None).columns[:2])


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1001])
def test_quantiles_against_numpy(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.lognormal(2, 2, n), 4)
    values[: n // 3] = 7.5  # a third of all rows share one value
    values[n // 2 :] *= rng.choice([-1, 1], n - n // 2)
    df = spark.createDataFrame([(i % 2 if n > 3 else 0, float(v)) for i, v in enumerate(values)], "g int, v double")
    probs = {"p0": 0.0, "p5": 0.05, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p100": 1.0}
    for row in exact_quantiles(df, ["g"], "v", probs).collect():
        own = [v for i, v in enumerate(values) if (i % 2 if n > 3 else 0) == row["g"]]
        for name, p in probs.items():
            assert row[name] == pytest.approx(np.quantile(own, p), rel=1e-12, abs=1e-12)
    only = exact_quantiles(df, [], "v", probs).collect()
    assert len(only) == 1 and only[0]["p50"] == pytest.approx(np.quantile(values, 0.5))


def test_quantiles_keep_a_null_group_and_skip_null_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("b", 5.0)], "g string, v double")
    assert {r["g"]: r["m"] for r in exact_quantiles(df, ["g"], "v", {"m": 0.5}).collect()} == {None: 2.0, "b": 5.0}


@pytest.mark.parametrize("prob", [0.0, 0.3, 0.5, 1.0])
def test_planned_quantiles_against_numpy(spark, prob):
    rng = np.random.default_rng(4)
    values = {"a": rng.integers(-(1 << 52), 1 << 52, 301), "b": rng.integers(-70_000, 70_000, 400), "c": np.array([9]), None: np.array([1, 2] * 50)}
    rows = [(g, int(v)) for g, own in values.items() for v in own]
    df = spark.createDataFrame([*rows, ("a", None), ("none", None)], "g string, v long")
    path = f"planned-{prob}"
    spark.sparkContext.setJobGroup(path, path)
    planned = planned_quantile(df, ["g"], "v", "q", prob)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(path)
    got = {r["g"]: r["q"] for r in planned.collect()}
    assert got == {g: pytest.approx(np.quantile(own, prob), rel=1e-12, abs=1e-9) for g, own in values.items()}


def test_running_totals_against_python(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), i, rng.randrange(5)) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, t int, x bigint")
    got = running_totals(df, ["g"], [F.col("t").desc()], {"s": "x"}, chunks=7)
    expected, sums = {}, {"a": 0, "b": 0}
    for g, t, x in sorted(rows, key=lambda r: -r[1]):
        sums[g] += x
        expected[t] = sums[g]
    collected = got.collect()
    assert {r["t"]: r["s"] for r in collected} == expected
    assert all(r["s_all"] == sums[r["g"]] for r in collected)


def test_global_rank_is_dense_over_chunks(spark):
    df = spark.range(500).select(((F.col("id") * 7919) % 500).alias("v"))
    ranked = global_rank(df, ["v"], chunks=9).collect()
    assert all(r["rank"] == r["v"] + 1 and r["rank_all"] == 500 for r in ranked)


def test_literal_log_in_chunks(spark):
    literal = build(spark, ROWS)
    frames_equal(case_metrics(literal, chunks=1), case_metrics(literal, chunks=3), ["case_id"])
