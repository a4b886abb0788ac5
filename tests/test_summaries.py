"""One-pass reports against the frames of the longer reports; places over a total order."""

import math

from pyspark.sql import functions as F

from tidemark.operators.evaluation import frequency_order
from tidemark.plans import reports
from tidemark.session import stage_table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sentiment_summary_is_the_report(spark):
    labels = ["positive", "negative", "neutral", None]
    rows = [(labels[i % 4], None if i % 7 == 0 else (i % 5 - 2) / 10, [0.95, 0.5, None, math.nan][i % 3 if i % 9 else 3]) for i in range(80)]
    scored = stage_table(spark.createDataFrame(rows, "sentiment string, percent_daily_price_change double, confidence double"), "scored")
    made = reports.sentiment_summary(scored)
    assert _plan(made).count("FileScan") == 1
    by_label = {r["sentiment"]: r for r in made.collect()}
    assert set(by_label) == {"all", *labels}
    report = reports.sentiment_report(scored)
    for r in report["moves"].collect():
        mine = by_label[r["sentiment"]]
        assert math.isclose(mine["mean_move"], r["mean"]) and math.isclose(mine["std_move"], r["std"]) and math.isclose(mine["se_move"], r["se"])
    for r in report["labels"].collect():
        assert math.isclose(by_label[r["sentiment"]]["pct"], r["pct"]) and by_label[r["sentiment"]]["n"] == r["n"]
    overall = report["accuracy_overall"].first()
    assert math.isclose(by_label["all"]["accuracy"], overall["accuracy"]) and by_label["all"]["n_decided"] == overall["n"]
    usable = scored.where(~F.isnan("confidence") | F.col("confidence").isNull())
    sure = reports.sentiment_report(usable)["accuracy_confident"].first()
    assert by_label["all"]["n_confident"] == sure["n"] and math.isclose(by_label["all"]["accuracy_confident"], sure["accuracy"])
    assert reports.sentiment_summary(scored.limit(0)).where("n > 0").isEmpty()


def test_prediction_summary(spark):
    rows = [("A", f"2020-01-0{i + 1}", 0.01 * i, p) for i, p in enumerate([0.01, 0.2, -0.3])]
    rows += [("B", "2020-02-01", 0.1, 0.0), (None, "2020-03-01", -0.2, -0.04), ("B", "2020-02-02", None, 0.9)]
    table = stage_table(spark.createDataFrame(rows, "symbol string, prediction_date string, actual double, predicted double"), "predicted")
    made = reports.prediction_summary(table, actual="actual")
    assert _plan(made).count("FileScan") == 1
    near, normal = (made.where(F.col("pred_group") == g).first() for g in ("near_zero", "normal"))
    assert (near["n"], near["symbols"], near["only_symbols"]) == (3, 3, 2)
    assert (normal["n"], normal["symbols"], normal["only_symbols"], normal["largest_share"]) == (2, 1, 0, 1.0)
    errors = [0.01 - 0.2, 0.02 + 0.3]
    assert math.isclose(normal["rmse"], math.sqrt(sum(e * e for e in errors) / 2)) and math.isclose(normal["mae"], sum(map(abs, errors)) / 2)
    assert math.isclose(normal["direction_accuracy"], 0.5)


def test_attribution_summary_is_the_report(spark):
    rows = [("train" if i % 3 else "test", None if i % 11 == 0 else (i % 4 - 1.5) / 20, i % 5 - 2.0, None if i == 1 else i / 10) for i in range(40)]
    table = stage_table(spark.createDataFrame(rows, "split string, predicted double, shap_a double, shap_b double"), "shap")
    made = reports.attribution_summary(table, ["a", "b"])
    assert _plan(made).count("FileScan") == 1
    report = reports.attribution_report(table, ["a", "b"])
    mine = {r["feature"]: r for r in made.collect()}
    for r in report["importance"].collect():
        assert math.isclose(mine[r["feature"]]["importance"], r["importance"]) and math.isclose(mine[r["feature"]]["pct"], r["pct"])
    for r in report["by_group"].collect():
        for c in ("high_sum", "low_sum", "high_pct", "low_pct", "pct_diff"):
            assert math.isclose(mine[r["feature"]][c], r[c], abs_tol=1e-12)
    assert sorted(r["place"] for r in mine.values()) == [1, 2]


def test_frequency_order(spark):
    values = ["x"] * 5 + ["b", "a"] * 2 + [None] * 2 + [f"once{i:03d}" for i in range(300)]
    table = spark.createDataFrame([(v,) for v in values], "word string").repartition(5)
    made = sorted((r["place"], r["word"], r["n"]) for r in frequency_order(table, "word").collect())
    assert [m[0] for m in made] == list(range(1, 305))
    assert [m[1:] for m in made[:5]] == [("x", 5), (None, 2), ("a", 2), ("b", 2), ("once000", 1)]
    assert made[-1][1] == "once299"
    assert frequency_order(table.limit(0), "word").isEmpty()
