"""The forecast from merged sums is the one of the estimator on all rows, and keeps no sequences."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tidemark.operators import modeling as m


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    made = []
    for i in range(400):
        steps = rng.normal(size=(3, 4)) * [1.0, 0.01, 5.0, 0.0] + [0.0, 1.0, -2.0, 0.25]
        made.append((f"S{i}", "train" if i % 4 else "test", steps.tolist(), float(steps[0, 0] - 0.3 * steps[2, 2] + rng.normal()), 2.0, 2.5))
    schema = "symbol string, split string, sequence array<array<double>>, forward_return double, prev_close double, future_close double"
    return m.stage_table(spark.createDataFrame(made, schema).repartition(7), "sequences")


def test_forecast_is_that_of_the_estimator_on_all_rows(rows):
    flat = rows.select("*", array_to_vector(F.flatten("sequence")).alias("x"))
    estimator = LinearRegression(featuresCol="x", labelCol="forward_return", predictionCol="p", regParam=0.1, solver="l-bfgs", maxIter=4)
    wanted = {r["symbol"]: r["p"] for r in estimator.fit(flat.where("split = 'train'")).transform(flat).collect()}
    made = {r["symbol"]: r for r in m.sequence_forecast(rows, max_iter=4).collect()}
    assert made.keys() == wanted.keys()
    for symbol, value in wanted.items():
        assert made[symbol]["predicted_return"] == pytest.approx(value, rel=1e-7, abs=1e-9)
        assert made[symbol]["predicted_price"] == pytest.approx(2.0 * (1 + value))


def test_moments_do_not_depend_on_the_tasks_and_leave_rows_without_a_label_out(rows):
    more = rows.unionByName(rows.limit(3).withColumn("forward_return", F.lit(None).cast("double")))
    n, means, cross = m.moments(more.select(F.flatten("sequence").alias("v"), "forward_return"), "v", "forward_return")
    x = np.array([np.ravel(r["sequence"]).tolist() + [r["forward_return"]] for r in rows.collect()])
    assert n == len(x) and np.allclose(means, x.mean(axis=0)) and np.allclose(cross, np.cov(x.T, bias=True) * n, atol=1e-9)
    few = m.equivalent_rows(n, means, cross)
    assert len(few) == 2 * x.shape[1] and np.allclose(few.mean(axis=0), means) and np.allclose(np.cov(few.T, bias=True), cross / n, atol=1e-9)


def test_no_sequences_are_written(spark, rows, monkeypatch):
    written = []
    real = m.stage_table
    monkeypatch.setattr(m, "stage_table", lambda df, name: written.append((name, df.dtypes)) or real(df, name))
    m.sequence_forecast(rows)
    kept = [kind for name, columns in written if name != "equivalent-rows" for _, kind in columns]
    assert kept and not any(kind.startswith("array") or kind == "vector" for kind in kept)
