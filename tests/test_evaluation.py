"""Reports, quantiles and ROC against brute force; scorers; diagnosis."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.operators import diagnosis, evaluation, modeling, ordered, scoring
from tidemark.plans import reports


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(1)
    # A third of all rows share one value and one group.
    frame = pd.DataFrame({"g": ["hot"] * 400 + ["a"] * 500 + ["b"] * 300, "x": rng.normal(size=1200)})
    frame.loc[:399, "x"] = 0.25
    frame["y"] = (rng.random(1200) < 0.4).astype(int)
    return frame, spark.createDataFrame(frame).repartition(6)


def test_exact_quantiles(scores):
    frame, df = scores
    marks = {"lo": 0.0, "q1": 0.25, "med": 0.5, "p9": 0.9, "hi": 1.0}
    got = {r["g"]: r for r in ordered.exact_quantiles(df, "x", marks, ["g"]).collect()}
    for g, part in frame.groupby("g"):
        for name, p in marks.items():
            assert got[g][name] == pytest.approx(np.quantile(part["x"], p), abs=1e-12)
    overall = ordered.exact_quantiles(df, "x", {"med": 0.5}).first()
    assert overall["med"] == pytest.approx(frame["x"].median()) and overall["rows"] == 1200


@pytest.mark.parametrize("descending", [False, True])
def test_cumulative(spark, descending):
    df = spark.createDataFrame([(float(i), i) for i in range(100)], "v double, n long").repartition(5)
    got = {r["v"]: r["c"] for r in ordered.cumulative(df, "v", {"c": "n"}, descending=descending, buckets=7).collect()}
    values = list(range(99, -1, -1)) if descending else list(range(100))
    assert [got[float(v)] for v in values] == list(np.cumsum(values))


def test_auc_and_roc(scores):
    frame, df = scores
    pos, neg = frame[frame.y == 1].x.to_numpy(), frame[frame.y == 0].x.to_numpy()
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert evaluation.auc(df, "y", "x").first()["auc"] == pytest.approx(wins / (len(pos) * len(neg)))
    points = evaluation.roc_points(df, "y", "x").orderBy(F.desc("threshold")).toPandas()
    assert points["tpr"].is_monotonic_increasing and points.iloc[-1][["tpr", "fpr"]].tolist() == [1.0, 1.0]
    assert points[points.threshold == 0.25]["true_pos"].item() == (pos >= 0.25).sum()


def test_auc_with_one_class(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, x double")
    assert evaluation.auc(df, "y", "x").first()["auc"] is None


def test_all_predictions_one_label(spark):
    df = spark.createDataFrame([("up", "up", 0.6), ("down", "up", 0.6)], "a string, p string, c double")
    report = {r["label"]: r for r in evaluation.classification_report(df, "a", "p").collect()}
    assert report["down"]["precision"] == 0.0 and report["down"]["f1"] == 0.0 and report["up"]["precision"] == 0.5
    assert report["accuracy"]["f1"] == 0.5
    matrix = {r["a"]: (r["pred_up"], r["pred_down"]) for r in evaluation.confusion_matrix(df, "a", "p", ["up", "down"]).collect()}
    assert matrix == {"up": (1, 0), "down": (1, 0)}
    assert sum(sum(v) for v in matrix.values()) == 2
    row = evaluation.degenerate_check(df, "p", "c").first()
    assert row["one_label_only"] and row["top_pct"] == 100.0 and row["distinct_confidences"] == 1


def test_confidence_bins_match_cut(spark):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"c": np.append(rng.random(300), [0.0, 1.0, 0.2, 0.4]), "h": rng.random(304) < 0.5, "k": True})
    frame.loc[:50, "k"] = False
    got = evaluation.confidence_bins(spark.createDataFrame(frame), "c", F.col("h"), F.col("k")).orderBy("bin").toPandas()
    cut = pd.cut(frame["c"], bins=5)
    want = frame[frame.k].groupby(cut[frame.k], observed=True)["h"].agg(["mean", "count"])
    np.testing.assert_allclose(got["accuracy"], want["mean"])
    assert got["n"].tolist() == want["count"].tolist()


def test_single_valued_bins_and_histogram(spark):
    df = spark.createDataFrame([(0.7, True)] * 3, "c double, h boolean")
    assert evaluation.confidence_bins(df, "c", F.col("h"), F.lit(True)).first()["bin"] == 3
    counts = evaluation.histogram(df, "c", 10).orderBy("bin").toPandas()["n"].tolist()
    assert counts == np.histogram([0.7] * 3, bins=10)[0].tolist()


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(4).normal(size=500)
    got = evaluation.histogram(spark.createDataFrame(pd.DataFrame({"v": values})), "v").orderBy("bin").toPandas()
    counts, edges = np.histogram(values, bins=50)
    assert got["n"].tolist() == counts.tolist()
    np.testing.assert_allclose(got["bin_start"], edges[:-1])


def test_regression_metrics(spark):
    rng = np.random.default_rng(6)
    frame = pd.DataFrame({"y": rng.normal(size=200), "p": rng.normal(size=200)})
    row = evaluation.regression_metrics(spark.createDataFrame(frame), "y", "p").first()
    e = frame.y - frame.p
    assert row["rmse"] == pytest.approx(np.sqrt((e**2).mean()))
    assert row["r2"] == pytest.approx(1 - (e**2).sum() / ((frame.y - frame.y.mean()) ** 2).sum())
    assert row["mape"] == pytest.approx((e / (frame.y + 1e-8)).abs().mean() * 100)
    loss = evaluation.directional_loss(spark.createDataFrame(frame), "y", "p").first()["directional_loss"]
    wrong = np.sign(frame.p) != np.sign(frame.y)
    assert loss == pytest.approx(((e**2) + wrong * frame.y.abs() * 2).mean())


def test_scorer_retries_and_defaults(spark):
    def factory():
        calls = {"n": 0}

        def score(texts):
            calls["n"] += 1
            if calls["n"] == 1 or texts.str.contains("bad").any():
                raise RuntimeError("not now")
            return pd.DataFrame({"label": "positive", "confidence": 0.9}, index=texts.index)

        return score

    df = spark.createDataFrame([("x",), ("bad",), (None,), ("y",)], "t string").coalesce(1)
    got = {r["t"]: (r["sentiment"], r["confidence"]) for r in scoring.score_articles(df, scoring.score_column(F.col("t"), factory)).collect()}
    assert got == {"x": ("positive", 0.9), "y": ("positive", 0.9), "bad": ("neutral", 0.5), None: ("neutral", 0.5)}
    replies = df.select("t", scoring.reply_column(F.col("t"), lambda: lambda p: p + "!").alias("r"))
    assert {r["t"]: r["r"] for r in replies.collect()} == {"x": "x!", "bad": "bad!", None: None, "y": "y!"}


def test_profiles(spark):
    df = spark.createDataFrame([("A", 1.0, None), ("A", None, None), ("B", 3.0, 2.0)], "symbol string, x double, z double")
    profile = {r["column_name"]: r["nulls"] for r in diagnosis.null_profile(df).collect()}
    assert profile == {"symbol": 0, "x": 1, "z": 2}
    near = F.abs("x") < 2
    rows = {r["symbol"]: (r["near_zero_records"], r["normal_records"]) for r in diagnosis.group_profile(df, near).collect()}
    assert rows == {"A": (1, 1), "B": (0, 1)}
    ratio = diagnosis.cohort_ratios(df, F.col("symbol") == "B", F.col("symbol") == "A", ["x", "z"]).collect()
    assert {r["feature"]: r["ratio"] for r in ratio} == {"x": 3.0, "z": None}
    assert [r["symbol"] for r in diagnosis.only_in_group(df, F.col("x") > 1.5).collect()] == ["B"]


def test_linear_attribution_is_additive(spark):
    df = spark.createDataFrame([(float(i), float(i * i % 7), 3.0 * i - 2.0 * (i * i % 7) + 1) for i in range(40)], "a double, b double, y double")
    table = modeling.assemble(df, ["a", "b"])
    model = modeling.fit_linear(table, "y")
    means = modeling.feature_means(df, ["a", "b"])
    coefficients = dict(zip(["a", "b"], model.coefficients))
    base = model.intercept + sum(coefficients[c] * means[c] for c in means)
    made = modeling.linear_attributions(model.transform(table), coefficients, means).toPandas()
    np.testing.assert_allclose(made["shap_a"] + made["shap_b"] + base, made["predicted"])
    ablated = modeling.ablation_attributions(model, df, ["y"], ["a", "b"], means).toPandas()
    merged = ablated[ablated.feature == "a"].merge(made, on="y")
    np.testing.assert_allclose(merged["attribution"], merged["shap_a"], atol=1e-9)
    report = reports.attribution_report(
        spark.createDataFrame(made.drop(columns="features")).withColumn(s.SPLIT, F.lit("train")), ["a", "b"]
    )
    assert report["by_group"].count() == 2 and report["importance"].agg(F.sum("pct")).first()[0] == pytest.approx(100)


def test_minmax_fit_on_train_only(spark):
    train = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (3.0, 5.0)], "a double, k double")
    ranges = modeling.fit_minmax(train, ["a", "k"])
    assert ranges == {"a": (0.0, 3.0), "k": (5.0, 5.0)}
    test = spark.createDataFrame([(6.0, 5.0), (None, 6.0)], "a double, k double")
    assert [tuple(r) for r in modeling.apply_minmax(test, ranges).collect()] == [(2.0, 0.0), (0.0, 1.0)]


def test_reports_run(spark):
    rng = np.random.default_rng(9)
    n = 200
    frame = pd.DataFrame(
        {
            "sentiment": rng.choice(["positive", "neutral", "negative"], n),
            "confidence": rng.random(n),
            "percent_daily_price_change": rng.normal(0, 0.02, n),
            "predicted_direction": rng.choice(["up", "down", "stable"], n),
            "prediction_confidence": 0.6,
        }
    )
    df = spark.createDataFrame(frame)
    counts = {k: v.count() for k, v in reports.sentiment_report(df).items()}
    assert counts["labels"] == 3 and counts["accuracy"] == 2 and counts["accuracy_by_confidence"] == 5
    direction = {k: v.count() for k, v in reports.direction_report(df).items()}
    assert direction["confusion"] == 2 and direction["distribution"] == 3
