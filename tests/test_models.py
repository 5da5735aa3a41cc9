import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from eventloom.functions.storage import materialise
from eventloom.plans.study import long_form, split_sensitivity
from eventloom.study import boosting, features, importance, levels, metrics, models
from eventloom.study.features import FeatureSet
from eventloom.study.splits import chrono_split, held_out, random_split, split_report, train_of


@pytest.fixture(scope="module")
def frame(spark):
    """The label is a function of the variant; the priority leans on it; time is noise."""
    rows = spark.range(1200).select(
        F.concat(F.lit("c"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("case_id"),
        F.pmod(F.xxhash64("id"), F.lit(13)).alias("v"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)).alias("u"),
        (F.lit("2023-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("created_at"),
    )
    hit = F.col("v").isin(6, 7)
    return materialise(
        rows.select(
            "case_id",
            "created_at",
            F.concat(F.lit("Variant "), F.col("v").cast("string")).alias("variant"),
            F.when(hit & (F.col("u") < 70), "Low").otherwise(F.when(F.col("u") < 50, "Medium").otherwise("High")).alias("priority"),
            F.lit("Bug").alias("issue_type"),
            F.concat(F.lit("agent "), (F.col("u") % 5).cast("string")).alias("reporter"),
            F.when(F.col("u") < 5, F.lit(None)).otherwise("App").alias("report_channel"),
            F.when(hit, "app crash again").otherwise("printer is slow").alias("short_description"),
            (F.col("u") % 5 + 1).cast("int").alias("customer_satisfaction"),
            F.hour("created_at").alias("created_hour"),
            F.weekday("created_at").alias("created_dow"),
            (F.weekday("created_at") >= 5).cast("int").alias("created_is_weekend"),
            F.month("created_at").alias("created_month"),
            F.dayofyear("created_at").alias("created_dayofyear"),
            F.lit(15).alias("desc_length"),
            hit.cast("int").alias("reached_level_3"),
            (F.when(hit, 30.0).otherwise(10.0) + F.col("u") / 50.0).alias("cycle_time_hours"),
        ),
        "frame",
    )


@pytest.fixture(scope="module")
def split(frame):
    return materialise(chrono_split(frame), "split")


def test_splits_are_exact_and_repeatable(frame, split):
    test = {r["case_id"] for r in held_out(split).collect()}
    assert len(test) == 360 and min(test) == "c0840"
    parts = {r["is_test"]: r for r in split_report(split).collect()}
    assert parts[False]["created_at_max"] < parts[True]["created_at_min"]
    assert parts[True]["cases_at_cut"] == 1
    drawn = {r["case_id"] for r in held_out(random_split(frame)).collect()}
    again = {r["case_id"] for r in held_out(random_split(frame.repartition(5), chunks=3)).collect()}
    assert len(drawn) == 360 and drawn == again and drawn != test


def test_equal_times_are_cut_by_case(spark):
    rows = spark.range(20).select(
        F.format_string("c%02d", "id").alias("case_id"), F.lit("2023-01-01").cast("timestamp_ntz").alias("created_at")
    )
    cut = chrono_split(rows, chunks=4)
    assert sorted(r["case_id"] for r in held_out(cut).collect()) == [f"c{i}" for i in range(14, 20)]
    assert {r["cases_at_cut"] for r in split_report(cut).collect()} == {14, 6}


def test_variant_decides_the_label(split):
    scores = models.ablation_scores(split, ["with_variant", "temporal_only", "text_only", "categorical_only"])
    auc = {r["ablation"]: r["roc_auc"] for r in metrics.evaluate_binary(scores, by=["ablation"]).collect()}
    assert auc["with_variant"] == 1.0 and auc["text_only"] == 1.0
    assert auc["categorical_only"] > 0.8
    assert abs(auc["temporal_only"] - 0.5) < 0.12


def test_excluding_a_variant_removes_its_cases(split):
    scores = models.ablate(split, "without_focus_variant", focus_variant="Variant 7")
    assert scores.count() == held_out(split).where("variant <> 'Variant 7'").count()


def test_logistic_gradient_is_zero(split):
    """At the solution of sum(w * loss) + |b|^2 / 2, the gradient is zero."""
    train = train_of(split)
    fitted = models.logreg(train, "reached_level_3", FeatureSet(["priority", "reporter"], ["created_hour"]))
    rows = fitted.features.transform(train).select(vector_to_array("features").alias("x"), "reached_level_3").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["reached_level_3"] for r in rows])
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    b, b0 = fitted.model.coefficients.toArray(), fitted.model.intercept
    p = 1 / (1 + np.exp(-(x @ b + b0)))
    assert np.abs(x.T @ (w * (p - y)) + b).max() < 0.05
    assert abs((w * (p - y)).sum()) < 0.05
    assert len(fitted.features.names) == x.shape[1]


def test_unseen_category_is_all_zeros_and_missing_is_a_level(spark, split):
    train = train_of(split)
    fitted = features.fit_features(train, FeatureSet(["priority", "report_channel"]))
    assert "cat__report_channel_(missing)" in fitted.names
    odd = spark.createDataFrame([("Odd", None), ("Low", "App")], "priority string, report_channel string")
    vectors = [r[0] for r in fitted.transform(odd).select(vector_to_array("features")).collect()]
    named = [dict(zip(fitted.names, v)) for v in vectors]
    assert [n for n, v in named[0].items() if v] == ["cat__report_channel_(missing)"]
    assert sorted(n for n, v in named[1].items() if v) == ["cat__priority_Low", "cat__report_channel_App"]


def test_ordinal_codes_come_from_train(spark, split):
    fitted = features.fit_ordinal(train_of(split), ["priority"], [])
    odd = spark.createDataFrame([("High",), ("Low",), ("Medium",), ("Odd",), (None,)], "priority string")
    assert [r[0][0] for r in fitted.transform(odd).select(vector_to_array("features")).collect()] == [0, 1, 2, -1, -1]


def test_levels_beyond_any_limit(spark, monkeypatch):
    """More levels than fit a broadcast: joined by a shuffle, numbered in order, none lost."""
    monkeypatch.setattr(levels, "SMALL_LEVELS", 1000)
    wide = spark.range(120_000).select(F.format_string("v%06d", "id").alias("priority"), (F.col("id") % 3).cast("string").alias("reporter"))
    fitted = features.fit_features(wide, FeatureSet(["priority", "reporter"]))
    assert fitted.levels.counts == {"priority": 120_000, "reporter": 3} and fitted.one_hot == 120_003
    odd = spark.createDataFrame([("v000000", "0"), ("v119999", "2"), ("v777777", "x"), (None, None)], "priority string, reporter string")
    rows = odd.withColumn("k", F.monotonically_increasing_id())
    got = features.entries(fitted.transform(rows), ["k"]).groupBy("k").agg(F.sort_array(F.collect_list("position")).alias("p"))
    assert sorted(r["p"] for r in got.collect()) == [[0, 120_000], [119_999, 120_002]]
    codes = features.fit_ordinal(wide, ["priority"], []).transform(odd).select(vector_to_array("features")[0]).collect()
    assert sorted(r[0] for r in codes) == [-1.0, -1.0, 0.0, 119_999.0]


def test_text_features_against_definition(spark):
    texts = ["App crash, app CRASH again", "slow app a x", "crash", "", None, "über-slow größe 42"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    words = [[w for w in __import__("re").findall(r"\w\w+", (t or "").lower())] for t in texts]
    grams = [w + [f"{a} {b}" for a, b in zip(w, w[1:])] for w in words]
    total = {}
    for g in grams:
        for t in g:
            total[t] = total.get(t, 0) + 1
    chosen = [t for t, _ in sorted(total.items(), key=lambda p: (-p[1], p[0]))][:6]
    got = [r["term"] for r in features.vocabulary(df, "t", terms=6).orderBy(F.desc("occurrences"), "term").collect()]
    assert got == chosen
    df_of = {t: sum(t in g for g in grams) for t in chosen}
    expected = {}
    for k, g in enumerate(grams):
        w = {t: g.count(t) * (1 + np.log((1 + len(texts)) / (1 + df_of[t]))) for t in chosen if t in g}
        norm = np.sqrt(sum(v * v for v in w.values()))
        expected |= {(k, t): v / norm for t, v in w.items()}
    table = {(r["k"], r["term"]): r["weight"] for r in features.tfidf_weights(df, "k", "t", terms=6).collect()}
    assert table == pytest.approx(expected, abs=1e-6)
    stages, names = features.text_stages(df, "t", (1, 2), 6)
    vectors = PipelineModel(stages).transform(df).select("k", vector_to_array("text_weights").alias("v")).collect()
    staged = {(r["k"], n.removeprefix("tfidf__")): v for r in vectors for n, v in zip(names, r["v"]) if v}
    assert staged == pytest.approx(expected, abs=1e-9)


def test_three_word_runs(spark):
    df = spark.createDataFrame([("aa bb cc dd",), ("aa",)], "t string")
    runs = [r["terms"] for r in features.with_terms(df, "t", (2, 3)).collect()]
    assert runs == [["aa bb", "bb cc", "cc dd", "aa bb cc", "bb cc dd"], []]


def test_boosted_trees_importance_and_saving(spark, split, tmp_path):
    cats = ["short_description", "reporter"]
    fitted = models.gbt_classifier(
        train_of(split), "reached_level_3", FeatureSet(cats, ["created_hour"]), max_iter=5
    )
    test = held_out(split)
    scores = fitted.scored(test, "reached_level_3")
    assert metrics.evaluate_binary(scores).first()["roc_auc"] == 1.0
    drops = {
        r["feature"]: r["permutation_importance_mean"]
        for r in importance.permutation_importance(fitted, test, "reached_level_3", n_repeats=2).collect()
    }
    assert drops["short_description"] > 0.3 and drops["reporter"] == 0.0 and drops["created_hour"] == 0.0
    fitted.save(str(tmp_path / "model"))
    again = models.Fitted.load(spark.newSession(), str(tmp_path / "model")).scored(test, "reached_level_3")
    assert again.exceptAll(scores).count() == 0


def test_leafwise_trees_on_cases(spark, split, tmp_path):
    train, test = train_of(split), held_out(split)
    few = FeatureSet(["short_description", "reporter"], ["created_hour"])
    fitted = models.leafwise_classifier(train, "reached_level_3", few, boosting.Growth(rounds=3))
    scores = fitted.scored(test, "reached_level_3")
    assert metrics.evaluate_binary(scores).first()["roc_auc"] == 1.0
    assert {r["feature"] for r in fitted.nodes(spark).where("left >= 0").collect()} == {"short_description"}
    fitted.save(str(tmp_path / "trees"))
    again = models.Trees.load(spark.newSession(), str(tmp_path / "trees")).scored(test, "reached_level_3")
    assert again.exceptAll(scores).count() == 0
    hours = models.leafwise_regressor(train, features=few, growth=boosting.Growth(rounds=15, rate=0.3))
    mean = train.agg(F.avg("cycle_time_hours")).scalar()
    assert metrics.evaluate_regression(hours.predicted(test, "cycle_time_hours"), mean).first()["r2"] > 0.5


def leaves_of(tree):
    return [i for i, f in enumerate(tree["feature"]) if f < 0]


def test_trees_grow_leaf_by_leaf(spark):
    """Against a plain version that splits the leaf of most gain, one after another."""
    r = np.random.default_rng(3)
    x = np.column_stack([r.integers(0, 6, 900), r.integers(0, 400, 900), r.normal(size=900).round(3)]).astype(float)
    y = (x[:, 0] > 2) * 3.0 + (x[:, 1] > 250) * (x[:, 0] < 4) * 2.0 + r.normal(size=900) * 0.1
    df = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, y double").repartition(5)
    growth = boosting.Growth(rounds=3, rate=0.3, leaves=6, least_rows=20, l2=1.0)
    model = boosting.boost(df, "x", "y", "squared", F.lit(False), growth)
    cuts = boosting.thresholds(boosting.bin_table(df.select(F.posexplode("x").alias("feature", "value"))), 3)
    assert [len(c) for c in cuts][0] == 5 and max(map(len, cuts)) == 254
    scores = np.full(900, y.mean())
    for tree in model.trees:
        g = scores - y
        leaves, number, splits = {0: np.arange(900)}, 1, []
        while len(leaves) < 6:
            best = None
            for node, rows in leaves.items():
                for f in range(3):
                    for cut in cuts[f]:
                        left = x[rows, f] < cut
                        a, b = rows[left], rows[~left]
                        if min(len(a), len(b)) < 20:
                            continue
                        gain = g[a].sum() ** 2 / (len(a) + 1) + g[b].sum() ** 2 / (len(b) + 1) - g[rows].sum() ** 2 / (len(rows) + 1)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-5):
                            best = (gain, node, f, cut, a, b)
            _, node, f, cut, a, b = best
            del leaves[node]
            leaves |= {number: a, number + 1: b}
            splits.append((node, f, cut))
            number += 2
        assert [(i, tree["feature"][i], tree["threshold"][i]) for i, *_ in sorted(splits)] == sorted(splits)
        assert sorted(leaves) == leaves_of(tree)
        for node, rows in leaves.items():
            value = -0.3 * g[rows].sum() / (len(rows) + 1)
            assert tree["value"][node] == pytest.approx(value, abs=1e-5) and tree["rows"][node] == len(rows)
            scores[rows] += tree["value"][node]
    found = {tuple(r["x"]): r["s"] for r in df.select("x", model.score("x").alias("s")).collect()}
    assert [found[tuple(v)] for v in x.tolist()] == pytest.approx(scores.tolist(), abs=1e-6)


def test_boosting_stops_when_held_back_rows_do(spark):
    """Labels are noise, so the loss of the rows held back stops falling."""
    df = spark.range(1500).select(
        F.array(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(50)).cast("double") for i in range(3)]).alias("x"),
        (F.pmod(F.xxhash64("id", F.lit(9)), F.lit(2))).alias("y"),
        (F.col("id") % 5 == 0).alias("out"),
    )
    growth = boosting.Growth(rounds=60, rate=0.3, patience=3)
    model = boosting.boost(df, "x", "y", "logistic", F.col("out"), growth)
    assert len(model.trees) < 60 and len(model.losses) == len(model.trees) + 1
    assert min(model.losses[-3:]) >= model.losses[-4] - 1e-7
    assert all(max(len(leaves_of(t)) for t in model.trees) <= 31 and min(t["rows"]) >= 40 for t in model.trees)
    same = boosting.boost(df.repartition(7), "x", "y", "logistic", F.col("out"), boosting.Growth(rounds=2, rate=0.3))
    assert same.trees == model.trees[:2]


def test_shuffled_copies_move_one_column_only(split):
    test = held_out(split)
    copies = importance.shuffled_copies(test, ["priority", "reporter"], 0).where("feature = 'priority'")
    joined = copies.alias("a").join(test.alias("b"), "case_id")
    assert joined.where("a.reporter <> b.reporter").count() == 0
    assert joined.where("a.priority <> b.priority").count() > 0

    def counts(df):
        return {r["priority"]: r["count"] for r in df.groupBy("priority").count().collect()}

    assert counts(copies) == counts(test)


def test_regressor_beats_the_mean(split):
    train, test = train_of(split), held_out(split)
    fitted = models.gbt_regressor(train, features=FeatureSet(["short_description"], ["created_hour"]), max_iter=20)
    mean = train.agg(F.avg("cycle_time_hours")).scalar()
    m = metrics.evaluate_regression(fitted.predicted(test, "cycle_time_hours"), mean).first()
    assert m["mae"] < m["baseline_mae"] / 2 and m["r2"] > 0.5 and m["spearman"] > 0.3


def test_grid_and_sensitivity(frame, split):
    quick = {
        "logistic_regression": (lambda d: features.fit_features(d, FeatureSet(["priority"])), models.logreg),
        "boosted_trees": (
            lambda d: features.fit_ordinal(d, ["priority"], []),
            lambda d, c, f: models.gbt_classifier(d, c, f, max_iter=2),
        ),
    }
    scores = models.train_grid({"chronological": split, "random": random_split(frame)}, ["reached_level_3"], quick)
    assert scores.columns == ["case_id", "split", "label_name", "model", "label", "score"]
    rows = metrics.evaluate_binary(scores, by=["split", "label_name", "model"])
    assert rows.count() == 4
    delta = split_sensitivity(rows).first()
    assert delta["delta_random_minus_chrono"] == pytest.approx(delta["random_auc"] - delta["chronological_auc"], abs=1e-6)
    assert long_form(rows, "results", ["split", "model"]).where("metric = 'roc_auc'").count() == 4


def test_baselines(split):
    train, test = train_of(split), held_out(split)
    never = metrics.always_negative(train, test, "reached_level_3").first()
    assert never["accuracy"] == pytest.approx(1 - never["base_rate_test"], abs=1e-6)
    drawn = metrics.stratified_random(train, test, "reached_level_3").first()
    assert drawn["n_repeats"] == 20 and abs(drawn["roc_auc_mean"] - 0.5) < 0.05
    one_class = train.withColumn("reached_level_3", F.lit(0))
    with pytest.raises(ValueError, match="single class"):
        models.logreg(one_class, "reached_level_3")


def test_tasks_add_up_histograms():
    """Sums of a task's batches against plain loops; rows held back and rows elsewhere count apart."""
    tree = {"feature": [0, -1, 1, -1, -1], "bin": [1, -1, 0, -1, -1], "left": [1, -1, 3, -1, -1], "right": [2, -1, 4, -1, -1], "depth": 2}
    known = {"feature": [1, -1, -1], "bin": [1, -1, -1], "left": [1, -1, -1], "right": [2, -1, -1], "depth": 1, "value": [0.0, 0.25, -0.5]}
    rows = [([i % 3, i * 7 % 4], 0.125 * (i % 5), float(i % 2) if i % 11 else None, i % 6 == 0) for i in range(60)]
    fields = [("bins", pa.list_(pa.int32())), ("f", pa.float64()), ("y", pa.float64()), ("out", pa.bool_())]
    table = pa.table([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(fields)], [n for n, _ in fields])
    add_up = boosting.cells_of([known], tree, {1: 0, 3: 1}, "squared", 2, 4)
    found = [r for b in add_up(table.to_batches(max_chunksize=13)) for r in b.to_pylist()]
    want = {}
    for bins, f, y, out in rows:
        raw = f + (0.25 if bins[1] <= 1 else -0.5)
        node = 0 if bins[0] <= 1 else 1 if bins[1] <= 0 else None
        off = raw - y if y is not None else 0.0
        cells = [(-1, -1, -1)] if out else [] if node is None else [(node, i, b) for i, b in enumerate(bins)]
        for cell in cells:
            g, h, n = want.get(cell, (0, 0, 0))
            want[cell] = (g + int((0.5 * off * off if out else off) * (1 << 20)), h + (1 << 20), n + 1)
    assert {(r["node"], r["feature"], r["bin"]): (r["g"], r["h"], r["n"]) for r in found} == want


class CountedScores:
    """A model that counts how often it scores a row."""

    features = FeatureSet(["priority"])

    def __init__(self, spark):
        self.times = times = spark.sparkContext.accumulator(0)

        def score(text):
            times.add(1)
            return float(len(text))

        self.score = F.udf(score, "double").asNondeterministic()

    def scored(self, frame, label, keep=("case_id",)):
        return frame.select(*keep, F.col(label).cast("int").alias("label"), self.score("priority").alias("score"))


def test_importance_scores_each_row_once(frame, spark):
    model, few = CountedScores(spark), frame.limit(200)
    out = importance.permutation_importance(model, few, "reached_level_3", ["priority"], n_repeats=2).collect()
    assert len(out) == 1 and model.times.value == 3 * 200
