"""Whitening by shifted CholeskyQR against an eigendecomposition."""

import math
import random

import numpy as np
import pytest

from tidemark.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, x string, id int, component int, n int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "clash", 1, 2, 3) for i, v in enumerate(vectors)], SCHEMA)


def usable(vectors):
    kept = [(i, v) for i, v in enumerate(vectors) if v and all(c is not None and math.isfinite(c) for c in v)]
    return [(i, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]) for i, v in kept]


def check(rows, kept, count=8, rank=None):
    ids, m = [i for i, _ in kept], np.array([v for _, v in kept])
    n, sums = len(m), m.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(m.T, bias=True).reshape(m.shape[1], -1))
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(count, m.shape[1])
    rank = count if rank is None else min(rank, count)
    rows = sorted(rows, key=lambda r: (r["vec_id"], r["component"]))
    assert [(r["vec_id"], r["component"]) for r in rows] == [(i, k + 1) for i in sorted(ids) for k in range(count)]
    got = np.array([r["whitened"] if r["whitened"] is not None else np.nan for r in rows]).reshape(-1, count)
    want = (m - sums / n) @ vectors[:, :rank] / np.sqrt(values[:rank])
    signs = np.sign((got[:, :rank] * want).sum(axis=0))
    assert np.allclose(got[:, :rank] * signs, want, atol=1e-6)
    assert np.isnan(got[:, rank:]).all()
    deviations = {i: sum((n * int(v) - int(s)) ** 2 for v, s in zip(x, sums)) for i, x in kept}
    assert all(r["deviation"] == deviations[r["vec_id"]] and r["n"] == n for r in rows)
    assert all(abs(r["explained"] - max(values[r["component"] - 1], 0) / values.sum()) < 1e-6 for r in rows)
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def test_awkward_vectors(spark):
    rng = random.Random(2)
    vectors = [[rng.gauss(0, 1 + k) for k in range(12)] for _ in range(300)]
    odd = [None, [], [None] * 12, [float("nan")] * 12, [1.0] * 11 + [float("inf")], [1.0] * 11 + [None], [1.0, 2.0]]
    vectors = vectors + odd + [vectors[0]] * 5
    kept = [(i, v) for i, v in usable(vectors) if len(v) == 12]
    check(whitening.whiten(frame(spark, vectors)).collect(), kept)


def test_few_dimensions_and_few_rows(spark):
    rng = random.Random(3)
    flat = [[rng.gauss(0, 1), rng.gauss(0, 9), 5.0] for _ in range(50)]  # one constant dimension
    check(whitening.whiten(frame(spark, flat)).collect(), usable(flat), rank=2)
    few = [[rng.gauss(0, 1) for _ in range(10)] for _ in range(4)]
    check(whitening.whiten(frame(spark, few)).collect(), usable(few), rank=3)


def test_bad_condition(spark):
    """Small components that a covariance in double precision would lose."""
    rng = np.random.default_rng(4)
    left, _ = np.linalg.qr(rng.normal(size=(400, 4)))
    left -= left.mean(axis=0)
    turned, _ = np.linalg.qr(rng.normal(size=(4, 4)))
    vectors = np.round(left * [1e9, 1e6, 1e4, 1e2] @ turned.T)
    rows = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    x = whitening.whole_numbers(rows, scale=1, offset=0)
    found = whitening.fit(x)
    exact = np.linalg.svd(vectors - vectors.mean(axis=0), compute_uv=False) ** 2 / len(vectors)
    assert np.allclose(found.variances, exact, rtol=1e-6)
    assert whitening.identity_error(x, found, 4) < 1e-4


def test_equal_rows_and_no_rows(spark):
    rows = whitening.whiten(frame(spark, [[1.0, 2.0]] * 3)).collect()
    assert [tuple(r)[2:] for r in rows] == [(3, 0, None, None, None)] * 6
    for vectors in ([], [None, []]):
        empty = whitening.whiten(frame(spark, vectors))
        assert empty.count() == 0 and empty.columns[:3] == ["vec_id", "component", "n"]


def test_large_numbers(spark):
    """Beyond 64 bits sums of squares are exact or null."""
    vectors = [[float(k * 10**6), 1.0] for k in range(1000)]
    rows = whitening.whiten(frame(spark, vectors)).collect()
    m = usable(vectors)
    n, sums = len(m), [sum(v[k] for _, v in m) for k in (0, 1)]
    for r in rows:
        exact = sum((n * v - s) ** 2 for v, s in zip(dict(m)[r["vec_id"]], sums))
        assert r["deviation"] == (exact if exact < 2**63 else None)


@pytest.mark.parametrize("fan_in", [2, 64])
def test_query(spark, monkeypatch, fan_in):
    monkeypatch.setattr(whitening, "FAN_IN", fan_in)
    sf_dir = "/root/testdata/sf0.001"
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    kept = usable([vectors.get(i) for i in range(max(vectors) + 1)])
    check(queries.op13_cholesky_whitening(spark, sf_dir).collect(), kept)
