"""Sequences made from bars are those made from a written table of indicators, with and without incomplete rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import indicator_sequences as i
from tidemark.operators.indicators import indicator_table
from tidemark.operators.sequences import training_sequences
from tidemark.session import stage_table

CUTOFF = "2020-06-01"
OPTIONS = {"length": 6, "horizon": 3, "min_history": 12, "min_train": 2, "min_test": 2, "chunk_rows": 32}
FEATURES = ["sma_5", "rsi_14", "macd_hist", "ema_8", "bb_pos_20", "close"]


@pytest.fixture(scope="module")
def bars(spark):
    rng, out = random.Random(3), []
    for symbol, days, holes in (("A", 260, ()), ("B", 230, (70, 71, 97, 150, 151, 152)), ("C", 190, (100,)), ("D", 61, ()), (None, 90, ())):
        price = 50.0
        for k in range(days):
            price *= 1 + rng.gauss(0, 0.02)
            open_, close = price, price * (1 + rng.gauss(0, 0.01))
            volume, count = float(rng.randrange(1, 900)), None if k in holes or k % 80 == 79 else 5.0
            day = datetime.date(2020, 1, 1) + datetime.timedelta(days=k)
            out.append((symbol, day, open_, max(open_, close) * 1.01, min(open_, close) * 0.99, close, volume, count, (open_ + close) / 2))
    schema = "symbol string, bar_date date, open double, high double, low double, close double, volume double, trade_count double, vwap double"
    return stage_table(spark.createDataFrame(out, schema), "bars")


@pytest.fixture(scope="module")
def wanted(bars):
    ready = stage_table(indicator_table(bars, chunk_rows=32), "indicators")
    return rows_of(training_sequences(ready, FEATURES, CUTOFF, fit_on_train=True, **OPTIONS))


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_sequences_are_those_of_the_written_indicators(bars, wanted, monkeypatch):
    written = []
    monkeypatch.setattr(i, "stage_table", lambda df, name: written.append(df.columns) or stage_table(df, name))
    made = i.indicator_sequences(bars, FEATURES, CUTOFF, fit_on_train=True, **OPTIONS)
    assert rows_of(made) == wanted and len(wanted) > 100
    assert {r["symbol"] for r in made.select("symbol").distinct().collect()} == {"A", "B", "C"}
    # Neither indicators nor sequences are written, and the rows are dealt once.
    assert not any("rsi_14" in columns or "sequence" in columns for columns in written)
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2


def test_more_incomplete_rows_than_a_chunk(bars, spark):
    holes = bars.withColumn("volume", F.when((F.col("symbol") == "A") & F.col("bar_date").between("2020-04-01", "2020-05-15"), None).otherwise(F.col("volume")))
    holes = stage_table(holes, "holes")
    ready = stage_table(indicator_table(holes, chunk_rows=32), "indicators")
    assert rows_of(i.indicator_sequences(holes, FEATURES, CUTOFF, **OPTIONS)) == rows_of(training_sequences(ready, FEATURES, CUTOFF, **OPTIONS)) != []


def test_no_bars(bars):
    assert i.indicator_sequences(bars.limit(0), FEATURES, CUTOFF, **OPTIONS).count() == 0
