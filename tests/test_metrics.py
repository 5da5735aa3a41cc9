import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.study import diagnostics, metrics


def brute(y, s):
    """Figures from their definitions, over all pairs and thresholds."""
    y, s = np.asarray(y), np.asarray(s)
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    ap, last = 0.0, 0.0
    best = (-1.0, None)
    for t in sorted(set(s), reverse=True):
        tp, fp = int(((s >= t) & (y == 1)).sum()), int(((s >= t) & (y == 0)).sum())
        ap += (tp / len(pos) - last) * tp / (tp + fp)
        last = tp / len(pos)
        f1 = 2 * tp / (tp + fp + len(pos))
        if f1 >= best[0]:
            best = (f1, t)
    return auc, ap, best


@pytest.fixture(scope="module", params=[1, 2, 3])
def sample(request):
    rng = np.random.default_rng(request.param)
    y = rng.integers(0, 2, 300)
    s = np.round(np.clip(0.3 * y + rng.random(300) * 0.8, 0, 1), 2)
    s[:100] = 0.5  # ties
    return y, s


def frame(spark, y, s):
    return spark.createDataFrame([(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, s))], "case_id int, label int, score double")


def test_evaluation_against_definitions(spark, sample):
    y, s = sample
    auc, ap, (f1, threshold) = brute(y, s)
    m = metrics.evaluate_binary(frame(spark, y, s), chunks=5).first()
    assert m["roc_auc"] == pytest.approx(auc, abs=1e-6)
    assert m["pr_auc"] == pytest.approx(ap, abs=1e-6)
    assert m["best_f1"] == pytest.approx(f1, abs=1e-6)
    assert m["best_threshold"] == pytest.approx(threshold)
    assert m["brier"] == pytest.approx(np.mean((s - y) ** 2), abs=1e-6)
    hit = s >= 0.5
    tp, fp = int((hit & (y == 1)).sum()), int((hit & (y == 0)).sum())
    tn, fn = int((~hit & (y == 0)).sum()), int((~hit & (y == 1)).sum())
    assert (m["tn"], m["fp"], m["fn"], m["tp"]) == (tn, fp, fn, tp)
    assert m["mcc"] == pytest.approx(np.corrcoef(hit, y)[0, 1], abs=1e-6)
    assert m["balanced_accuracy"] == pytest.approx((tp / (tp + fn) + tn / (tn + fp)) / 2, abs=1e-6)
    assert m["lift_over_base_rate"] == pytest.approx(ap / y.mean(), abs=1e-3)
    assert m["best_n_flagged"] == int((s >= threshold).sum())


def test_groups_are_judged_apart(spark, sample):
    y, s = sample
    both = frame(spark, y, s).withColumn("g", F.lit("x")).union(
        frame(spark, 1 - y, s).withColumn("g", F.lit(None).cast("string"))
    )
    rows = {r["g"]: r["roc_auc"] for r in metrics.evaluate_binary(both, by=["g"], chunks=4).collect()}
    assert rows["x"] + rows[None] == pytest.approx(1.0, abs=2e-6)


def test_perfect_and_one_class_scores(spark):
    perfect = metrics.evaluate_binary(frame(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])).first()
    assert (perfect["roc_auc"], perfect["pr_auc"], perfect["mcc"], perfect["best_threshold"]) == (1.0, 1.0, 1.0, 0.8)
    none = metrics.evaluate_binary(frame(spark, [0, 0], [0.1, 0.2])).first()
    assert none["roc_auc"] is None and none["mcc"] == 0.0 and none["lift_over_base_rate"] is None
    assert none["precision_at_half"] == 0.0


def test_regression_and_spearman(spark):
    rng = np.random.default_rng(5)
    y = np.round(rng.random(200), 1)
    p = np.round(y + rng.normal(0, 0.3, 200), 1)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "actual double, predicted double")
    m = metrics.evaluate_regression(df, float(y.mean())).first()

    def ranks(v):
        return np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])

    assert m["mae"] == pytest.approx(np.abs(y - p).mean(), abs=1e-4)
    assert m["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-6)
    assert m["spearman"] == pytest.approx(np.corrcoef(ranks(y), ranks(p))[0, 1], abs=1e-6)
    assert m["baseline_r2"] == pytest.approx(0.0, abs=1e-6)


def test_matched_points(spark, sample):
    y, s = sample
    points = metrics.curve_points(frame(spark, y, s))
    row = metrics.at_matched(points, recall=0.7).first()
    hit = s >= row["threshold"]
    assert row["recall"] == pytest.approx(y[hit].sum() / y.sum(), abs=1e-6) and row["recall"] >= 0.7
    higher = s > row["threshold"]
    assert y[higher].sum() / y.sum() < 0.7
    with pytest.raises(ValueError):
        metrics.at_matched(points)


def test_mutual_information(spark):
    def nmi(rows):
        return diagnostics.mutual_information(spark.createDataFrame(rows, "short_description string, issue_type string")).first()["nmi"]

    assert nmi([("a", "x"), ("b", "y")] * 10) == 1.0
    assert nmi([("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")] * 5) == 0.0
    assert nmi([("a", "x")] * 4) == 1.0
    # p = (1/2, 1/4, 1/4): information 0.3113 bits, entropies 0.8113 and 1
    rows = [("a", "x")] * 2 + [("a", "y"), ("b", "y")]
    assert nmi(rows) == pytest.approx(0.3113 / ((0.8113 + 1.0) / 2), abs=1e-3)


def test_histogram_keeps_every_case(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 10, 10, 10]], "cycle_time_hours double")
    bins = {r["bin"]: r["cases"] for r in metrics.histogram(df, bins=5).collect()}
    assert bins == {0: 2, 1: 2, 4: 3}
    same = spark.createDataFrame([(2.0,), (2.0,)], "cycle_time_hours double")
    assert [r["cases"] for r in metrics.histogram(same).collect()] == [2]
