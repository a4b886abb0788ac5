"""Steps whose tasks or plans may not grow beyond their input."""

import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.operators import modeling, score_store, sequences
from tidemark.session import stage_table


def test_wide_ranges_and_means_are_read_in_groups(spark, monkeypatch):
    names = [f"c{i}" for i in range(5)]
    table = spark.createDataFrame([(1.0, 2.0, None, 4.0, 5.0), (3.0, -2.0, 1.0, 4.0, 0.0)], ", ".join(f"{c} double" for c in names))
    monkeypatch.setattr(modeling, "AT_ONCE", 2)
    assert modeling.fit_minmax(table, names) == {"c0": (1, 3), "c1": (-2, 2), "c2": (0, 1), "c3": (4, 4), "c4": (0, 5)}
    assert modeling.feature_means(table, names) == {"c0": 2, "c1": 0, "c2": 1, "c3": 4, "c4": 2.5}


def test_sequences_join_where_their_frames_lie(spark):
    first = datetime.date(2020, 1, 1)
    rows = [(k, first + datetime.timedelta(i), float(i), float(i * i)) for k in ("A", "B") for i in range(60 if k == "A" else 9)]
    bars = stage_table(spark.createDataFrame(rows, "symbol string, bar_date date, close double, f double"), "bars")
    options = {"length": 4, "horizon": 2, "min_history": 10, "min_train": 1, "min_test": 1, "chunk_rows": 7}
    made = sequences.training_sequences(bars, ["f"], "2020-02-01", **options)
    plan = made._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 1 and "_chunk" in joins[0]
    got = sorted((r["prediction_date"], [x[0] for x in r["sequence"]]) for r in made.collect())
    assert [d for d, _ in got] == [first + datetime.timedelta(i) for i in range(3, 58)]
    assert all(values == pytest.approx([(i + j) ** 2 / 59**2 for j in range(4)]) for i, (_, values) in enumerate(got))


def test_a_task_scores_a_bounded_number_of_articles(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(score_store, "TASK_ROWS", 5, raising=False)
    articles = spark.range(90).select(F.col("id").alias("k"), F.lit("text").alias("t"))
    score = F.struct(F.col("t").alias("label"), F.lit(0.5).alias("confidence"))
    path = f"file://{tmp_path}/scores"
    assert score_store.score_pending(articles, path, "m", ["k"], score, batch_rows=45, tasks=2) == 2
    stored = score_store.scores(spark, path, articles.select("k").schema)
    assert sorted(r["k"] for r in stored.collect()) == list(range(90))
    sizes = [pq.read_metadata(p).num_rows for p in (tmp_path / "scores" / "scores").rglob("*.parquet")]
    assert sum(sizes) == 90 and len(sizes) > 4 and max(sizes) < 20
