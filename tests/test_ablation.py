"""Ablation attributions of boosted trees: by the splits of a row's paths, and by scoring one row per feature."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import modeling as m

NAMES = ["a", "b", "c"]


def by_rows(model, rows, means):
    """Prediction minus the prediction of the row with one feature at its mean, scored one by one."""
    from pyspark.ml.linalg import Vectors

    found = {}
    for i, *x in rows:
        x = [float("nan") if v is None else v for v in x]
        for k, c in enumerate(NAMES):
            found[i, c] = model.predict(Vectors.dense(x)) - model.predict(Vectors.dense([*x[:k], means[c], *x[k + 1 :]]))
    return found


def test_tree_differences_equal_scored_rows(spark):
    rng = random.Random(5)
    rows = [(i, rng.gauss(0, 1), float(rng.randrange(5)), None if i % 31 == 0 else rng.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    train = df.where("c IS NOT NULL").withColumn("y", F.expr("a * b + CASE WHEN c > 0.5 THEN a ELSE b END"))
    model = m.boosted_trees("y", trees=5, depth=4).fit(m.training_table(train, NAMES, ["y"]))
    means = m.feature_means(train, NAMES)
    made = m.ablation_attributions(model, df, ["id"], NAMES, means)
    # No row is scored once per feature: the trees are not below the rows' multiplication.
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert made.columns == ["id", "feature", "attribution"] and "differences(" in plan and plan.index("Generate") < plan.index("differences(UDF(")
    found = {(r["id"], r["feature"]): r["attribution"] for r in made.collect()}
    wanted = by_rows(model, rows[:40], means)
    assert len(found) == 900 and all(found[k] == pytest.approx(v, abs=1e-12) for k, v in wanted.items())
    assert any(wanted.values()) and not all(wanted.values())
    assert m.ablation_attributions(model, df.limit(0), ["id"], NAMES, means).count() == 0
