"""Queries of fitted models score their rows and return what the model says."""

import os
import re

import pytest
from pyspark.sql import functions as F

from checks import load, modeling
from tidemark.operators import modeling as m

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not there")


def query(name):
    return load()[0][name]


def printed_prediction(model, x):
    """Prediction recomputed from the printed trees."""
    total, weights, skip = 0.0, iter(model.treeWeights), None
    for line in model.toDebugString.splitlines()[1:]:
        depth, line = len(line) - len(line.lstrip()), line.strip()
        if line.startswith("Tree"):
            weight, skip = next(weights), None
            continue
        if skip is not None and depth > skip:
            continue
        skip = None
        if line.startswith("Predict"):
            total += weight * float(line.split(":")[1])
        else:
            at, sign, value = re.search(r"feature (\d+) (<=|>) (\S+)\)", line).groups()
            if (x[int(at)] <= float(value)) != (sign == "<="):
                skip = depth
    return total


def test_ablation_check_scores_rows(spark):
    plan = query("ablation_attribution")(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF(" in plan


def test_ablation_values_equal_the_printed_trees(spark, monkeypatch):
    held = {}

    class Trees:
        def fit(self, table):
            held["model"] = m.boosted_trees("target", trees=3, depth=3).fit(table.withColumnRenamed(modeling.s.TARGET, "target"))
            return held["model"]

    real = m.ablation_attributions

    def spied(model, df, keys, features, means):
        held.update(df=df, means=means)
        return real(model, df, keys, features, means)

    monkeypatch.setattr(modeling, "_reference_trees", Trees)
    monkeypatch.setattr(modeling.m, "ablation_attributions", spied)
    made = query("ablation_attribution_values")(spark, SF_DIR)
    names = modeling._MODEL_FEATURES
    keys = modeling.s.KEY_COLUMNS
    rows = held["df"].orderBy(*keys).limit(3).collect()
    wanted = spark.createDataFrame([tuple(r[k] for k in keys) for r in rows], held["df"].select(*keys).schema)
    found = {(*[r[k] for k in keys], r["feature"]): r["attribution"] for r in made.join(F.broadcast(wanted), keys).collect()}
    assert len(found) == 3 * len(names)
    for r in rows:
        x = [float(r[c]) for c in names]
        base = printed_prediction(held["model"], x)
        for i, c in enumerate(names):
            swapped = [*x[:i], held["means"][c], *x[i + 1 :]]
            assert found[(*[r[k] for k in keys], c)] == pytest.approx(base - printed_prediction(held["model"], swapped), abs=1e-9)


def test_other_models_return_their_values(spark, monkeypatch):
    monkeypatch.setattr(modeling, "_reference_trees", lambda: m.boosted_trees(modeling.s.TARGET, trees=1, depth=2))
    monkeypatch.setattr(modeling, "_training", lambda *_, table=modeling._training(spark, SF_DIR): table)
    for name, columns in {
        "gbt_prediction_values": ["predicted"],
        "cv_score_values": ["rmse", "mae", "r2", "rmse_mean", "rmse_std"],
        "fitted_linear_attribution_values": [f"shap_{c}" for c in modeling._ABLATED],
        "text_classifier_values": ["prediction", "confidence"],
        "sequence_forecast_values": ["predicted_return", "predicted_price"],
    }.items():
        made = query(name)(spark, SF_DIR)
        found = made.agg(*[F.count(c).alias(c) for c in columns], F.count("*").alias("rows"), F.count_distinct(columns[0]).alias("several")).first()
        assert all(found[c] == found["rows"] > 0 for c in columns) and found["several"] > 1, name


def test_texts_are_read_once(spark):
    rows = [(i, f"{'up rises gains' if i % 2 else 'down falls losses'} Word{i % 7}", i % 2, "train" if i % 5 else "test") for i in range(40)]
    rows += [(40, None, 1, "train"), (41, "up", None, "test")]
    made = m.text_classifier(spark.createDataFrame(rows, "id int, body string, label int, split string"), "body", "label")
    # The fit and the prediction work on counts: without the text column no text is read again.
    assert "body" not in made.drop("body")._jdf.queryExecution().executedPlan().toString()
    assert made.columns == ["id", "body", "label", "split", "prediction", "confidence"]
    found = made.collect()
    assert {(r["id"], r["body"], r["label"]) for r in found} == {r[:3] for r in rows[:40]}
    assert all(r["prediction"] == r["label"] and r["confidence"] > 0.5 for r in found)
