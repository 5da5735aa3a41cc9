"""The whole study, on the smallest tables and with short learners in the grid."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventloom.functions.storage import materialise
from eventloom.plans.registry import Views
from eventloom.plans.study import run_study
from eventloom.sources.adapters import table, user_log
from eventloom.study import features, models
from eventloom.study.features import FeatureSet

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="needs the generated tables")
def test_run_study(spark, tmp_path):
    views = Views(materialise(user_log(table(spark, str(DATA), "events")), "log"))
    quick = {
        "logistic_regression": (features.fit_features, lambda d, c, f: models.logreg(d, c, f, max_iter=5)),
        "boosted_trees": (
            lambda d: features.fit_ordinal(d, ["priority"], ["created_hour"]),
            lambda d, c, f: models.gbt_classifier(d, c, f, max_iter=2),
        ),
    }
    report = run_study(
        views.log, views.cases, str(tmp_path), labels=["reached_level_3"], learners=quick, n_repeats=2
    )
    sections = {r[0] for r in report.select(F.split("section", "/")[0]).distinct().collect()}
    assert sections == {
        "ablation", "baselines", "class_balance", "coefficients", "customer_satisfaction_timing",
        "cycle_time_regression", "intake_frame", "permutation_importance", "results",
        "segment_profile", "short_description_templating", "split_sensitivity", "splits",
    }
    assert spark.read.json(f"{tmp_path}/metrics").count() == report.count()
    cases = views.cases.count()
    assert spark.read.parquet(f"{tmp_path}/cycle_time_histogram").agg(F.sum("cases")).first()[0] == cases
    points = spark.read.parquet(f"{tmp_path}/curves")
    assert points.groupBy("split", "label_name", "model").count().count() == 4
    assert models.Fitted.load(spark, f"{tmp_path}/model_boosted_trees").model.getNumTrees > 0
