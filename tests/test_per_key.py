"""Ridge per key against a plain solution; joins and roll-ups keep rows with null keys."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import diagnosis, evaluation, news, ordered, per_key, sequences


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for key, n in (("A", 200), ("B", 40), (None, 60), ("C", 1)):
        for _ in range(n):
            x = [1e6 + rng.gauss(0, 1), rng.gauss(5, 2), 3.0]
            out.append((key, *x, 2 * x[0] - 0.5 * x[1] * len(key or "") + rng.gauss(0, 0.1), rng.random() < 0.8))
    return [*out, ("A", None, 1.0, 1.0, 1.0, True), ("A", 1.0, 1.0, float("nan"), 1.0, True), ("B", 1.0, 2.0, 3.0, None, True)]


def plain_ridge(own, l2):
    x, y = np.array([r[1:4] for r in own]), np.array([r[4] for r in own])
    spread = x.std(axis=0)
    flat = spread <= 1e-9
    z = np.where(flat, 0.0, (x - x.mean(axis=0)) / np.where(flat, 1.0, spread))
    found = np.linalg.solve(z.T @ z / len(z) + l2 * np.eye(3), z.T @ (y - y.mean()) / len(z))
    found = np.where(flat, 0.0, found / np.where(flat, 1.0, spread))
    return y.mean() - found @ x.mean(axis=0), found


@pytest.mark.parametrize("held", [1, 1000])
def test_ridge_per_key(spark, rows, monkeypatch, held):
    monkeypatch.setattr(per_key, "HELD", held)
    table = spark.createDataFrame(rows, "k string, a double, b double, c double, y double, fit boolean").repartition(7)
    models = per_key.fit_ridge_per_key(table, ["k"], ["a", "b", "c"], "y", 0.01, F.col("fit"))
    found = {r["k"]: r for r in models.collect()}
    usable = [r for r in rows if all(v is not None and v == v for v in r[1:5])]
    for key in {r[0] for r in usable if r[5]}:
        own = [r for r in usable if r[0] == key and r[5]]
        intercept, coefficients = plain_ridge(own, 0.01)
        assert found[key]["train_rows"] == len(own)
        assert found[key]["coefficients"] == pytest.approx(list(coefficients), rel=1e-5, abs=1e-6)
    predicted = per_key.predict_ridge_per_key(table, models, ["k"], ["a", "b", "c"]).collect()
    assert len(predicted) == len(rows)
    for r in predicted:
        if r["k"] in found and r["a"] is not None and r["c"] == 3.0 and r["y"] is not None:
            intercept, coefficients = plain_ridge([u for u in usable if u[0] == r["k"] and u[5]], 0.01)
            assert r["predicted"] == pytest.approx(intercept + coefficients @ [r["a"], r["b"], r["c"]], rel=1e-6)


def test_ridge_of_no_rows(spark):
    empty = spark.createDataFrame([], "k string, a double, y double")
    models = per_key.fit_ridge_per_key(empty, ["k"], ["a"], "y")
    assert models.count() == 0 and per_key.predict_ridge_per_key(empty, models, ["k"], ["a"]).count() == 0


def test_null_keys_stay(spark):
    rows = [(k, f"2024-01-{d:02d}", float(d)) for k in ("A", None) for d in range(1, 11)]
    table = spark.createDataFrame(rows, "symbol string, day string, v double").withColumn("day", F.to_date("day"))
    scaled = sequences.minmax_by_key(table, ["symbol"], ["v"]).collect()
    assert len(scaled) == 20 and {r["v_scaled"] for r in scaled if r["symbol"] is None} == {k / 9 for k in range(10)}
    cut = sequences.chronological_cut(table, ["symbol"], "day", 0.8).groupBy("symbol", "part").count().collect()
    assert sorted((str(r["symbol"]), r["part"], r["count"]) for r in cut) == [
        (k, p, n) for k in ("A", "None") for p, n in (("fit", 8), ("validate", 2))
    ]
    found = ordered.exact_quantiles(table, "v", {"median": 0.5}, ["symbol"]).collect()
    assert sorted((str(r["symbol"]), r["rows"], r["median"]) for r in found) == [("A", 10, 5.5), ("None", 10, 5.5)]


def test_articles_without_a_date_are_numbered(spark):
    articles = spark.createDataFrame([(None, ["A"], "x"), ("2024-01-01 10:00:00", ["A"], "y")], "created_at string, symbols array<string>, headline string")
    articles = articles.withColumns({"created_at": F.to_timestamp("created_at"), "symbols": F.concat_ws(",", "symbols")})
    assert sorted((r["headline"], r["article_no"]) for r in news.number_articles(articles).collect()) == [("x", 1), ("y", 1)]


def test_nan_is_missing(spark):
    table = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,), (3.0,)], "v double")
    bins = evaluation.histogram(table, "v", 2).orderBy("bin").collect()
    assert [(r["n"], r["bin_start"]) for r in bins] == [(1, 1.0), (2, 2.0)]
    row = diagnosis.cohort_ratios(table, F.lit(True), F.lit(True), ["v"]).first()
    assert (row["high_mean"], row["high_nulls"], row["ratio"]) == (2.0, 2, 1.0)
