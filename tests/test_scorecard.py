"""Scores that are sums of points."""

import math

import pytest

from eventloom.study import importance
from eventloom.study.features import FeatureSet
from eventloom.study.scorecard import columns_of, learn_scorecard

SCHEMA = "case_id string, colour string, hour int, label int"
TRAIN = [("a", "red", 1, 1), ("b", "red", 1, 1), ("c", "blue", 1, 0), ("d", None, 2, 0), ("e", "blue", 2, 1)]


def test_points_are_log_odds_less_those_of_all(spark):
    card = learn_scorecard(spark.createDataFrame(TRAIN, SCHEMA), "label", FeatureSet(["colour"], ["hour"]))
    base = math.log(4 / 3)
    points = {(r["feature"], r["level"]): float(r["points"]) for r in card.points.collect()}
    odds = {("colour", "red"): 3 / 1, ("colour", "blue"): 2 / 2, ("colour", None): 1 / 2, ("hour", "1"): 3 / 2, ("hour", "2"): 2 / 2}
    assert points == {k: pytest.approx(math.log(v) - base, abs=1e-6) for k, v in odds.items()}


def test_unknown_levels_are_worth_nothing_and_null_is_a_level(spark):
    card = learn_scorecard(spark.createDataFrame(TRAIN, SCHEMA), "label", FeatureSet(["colour"]))
    rows = spark.createDataFrame([("x", "green", 1, 0), ("y", None, 1, 0), ("z", "red", 9, 1)], SCHEMA)
    scores = {r["case_id"]: r["score"] for r in card.scored(rows, "label").collect()}
    assert scores["x"] == pytest.approx(4 / 7, abs=1e-6)
    assert scores["y"] == pytest.approx(1 / 3, abs=1e-6)
    assert scores["z"] == pytest.approx(3 / 4, abs=1e-6)


def test_a_text_that_is_also_a_category_counts_once():
    assert columns_of(FeatureSet(["a", "t"], ["n"], "t")) == ["a", "t", "n"]


def test_one_class_is_an_error(spark):
    with pytest.raises(ValueError, match="single class"):
        learn_scorecard(spark.createDataFrame(TRAIN[:2], SCHEMA), "label", FeatureSet(["colour"]))


def test_a_column_without_influence_has_no_importance(spark):
    rows = [(f"{i:03}", "red" if i % 2 else "blue", 1, i % 2) for i in range(60)]
    frame = spark.createDataFrame(rows, SCHEMA)
    card = learn_scorecard(frame, "label", FeatureSet(["colour"], ["hour"]))
    found = {r["feature"]: r for r in importance.permutation_importance(card, frame, "label").collect()}
    assert found["hour"]["permutation_importance_mean"] == 0 and found["hour"]["permutation_importance_std"] == 0
    assert found["colour"]["permutation_importance_mean"] > 0.3
