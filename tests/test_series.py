"""Chunked windows and exponential means against brute force, with chunks and blocks far shorter than the series."""

import datetime
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.operators import indicators, sequences, series


def walk(symbols: dict[str, int], seed: int = 3) -> pd.DataFrame:
    random = np.random.default_rng(seed)
    frames = []
    for symbol, rows in symbols.items():
        days = np.sort(random.choice(4000, rows, replace=False))
        close = 50 + np.cumsum(random.normal(0, 1, rows)) * 0.1
        frames.append(
            pd.DataFrame(
                {
                    "symbol": symbol,
                    "bar_date": [datetime.date(1995, 1, 1) + datetime.timedelta(int(d)) for d in days],
                    "open": close + random.normal(0, 0.1, rows),
                    "close": close,
                    "volume": random.integers(1, 100, rows).astype(float),
                    "trade_count": 1.0,
                }
            )
        )
    df = pd.concat(frames, ignore_index=True)
    df["high"] = df[["open", "close"]].max(axis=1) + 0.05
    df["low"] = df[["open", "close"]].min(axis=1) - 0.05
    df["vwap"] = (df["high"] + df["low"]) / 2
    return df


SIZES = {"A": 1, "B": 7, "C": 49, "D": 50, "E": 51, "F": 333}


@pytest.fixture(scope="module")
def bars(spark):
    frame = walk(SIZES)
    return frame, spark.createDataFrame(frame).repartition(5)


def by_day(df, columns):
    return df.select("symbol", "bar_date", *columns).toPandas().sort_values(["symbol", "bar_date"]).reset_index(drop=True)


def test_positions(bars):
    frame, df = bars
    got = by_day(series.number_rows(df, ["symbol"], "bar_date", block_days=100), ["_pos"])
    want = frame.groupby("symbol").cumcount()
    assert got["_pos"].tolist() == want.tolist()


@pytest.mark.parametrize("chunk_rows", [8, 1000])
def test_ema_matches_pandas(bars, chunk_rows):
    frame, df = bars
    got = by_day(
        series.ema(df, ["symbol"], "bar_date", "close", [3, 8, 34], block_days=200, chunk_rows=chunk_rows),
        ["ema_3", "ema_8", "ema_34"],
    )
    for span in (3, 8, 34):
        want = frame.groupby("symbol")["close"].transform(lambda x: x.ewm(span=span, adjust=False).mean())
        np.testing.assert_allclose(got[f"ema_{span}"], want, rtol=1e-12)


@pytest.mark.parametrize("chunk_rows", [4, 8, 1000])
def test_ema_with_missing_values_matches_pandas(spark, chunk_rows):
    frame = walk({"A": 60, "B": 40, "C": 20, "D": 90})
    close = frame["close"].to_numpy().copy()
    first = frame.groupby("symbol", sort=False).cumcount().to_numpy()
    close[(first < 3) & (frame["symbol"] == "A")] = np.nan  # at the start
    close[np.isin(first, [7, 8, 9, 15, 16, 31])] = np.nan  # around chunk borders
    close[(frame["symbol"] == "C").to_numpy()] = np.nan  # never a value
    close[(frame["symbol"] == "D").to_numpy() & (first >= 10) & (first < 70)] = np.nan  # longer than several chunks
    frame["close"] = close
    rows = [(r.symbol, r.bar_date, None if np.isnan(r.close) else float(r.close)) for r in frame.itertuples()]
    df = spark.createDataFrame(rows, "symbol string, bar_date date, close double")
    got = by_day(series.ema(df, ["symbol"], "bar_date", "close", [3, 34], block_days=200, chunk_rows=chunk_rows), ["ema_3", "ema_34"])
    for span in (3, 34):
        want = frame.groupby("symbol")["close"].transform(lambda x: x.ewm(span=span, adjust=False).mean())
        np.testing.assert_allclose(got[f"ema_{span}"].astype(float), want, rtol=1e-9)


def test_positions_keep_rows_with_null_keys_and_dates(spark):
    day = datetime.date(2020, 1, 1)
    rows = [("A", day), ("A", None), (None, day), (None, None), ("A", day + datetime.timedelta(5000))]
    got = series.number_rows(spark.createDataFrame(rows, "symbol string, bar_date date"), ["symbol"], "bar_date").collect()
    assert sorted((r["symbol"] or "", r["_pos"]) for r in got) == [("", 0), ("", 1), ("A", 0), ("A", 1), ("A", 2)]


def test_any_period_and_equal_spans(bars):
    frame, df = bars
    got = by_day(
        indicators.indicators(df, features=["sma_12", "rsi_9", "bb_width_13", "macd", "macd_signal"], chunk_rows=16, macd_spans=(9, 26, 9)),
        ["sma_12", "rsi_9", "bb_width_13", "macd_signal"],
    )
    by = frame.groupby("symbol")["close"]
    price = frame["close"]
    np.testing.assert_allclose(got["sma_12"].astype(float), by.transform(lambda x: x.rolling(12).mean()) / price - 1, rtol=1e-9, atol=1e-12)
    wide = by.transform(lambda x: x.rolling(13).std()) * 4 / price
    np.testing.assert_allclose(got["bb_width_13"].astype(float), wide, rtol=1e-8)

    def strength(x):
        move = x.diff()
        up, down = move.clip(lower=0).rolling(9).mean(), (-move.clip(upper=0)).rolling(9).mean()
        return 100 - 100 / (1 + up / (down + 1e-10))

    np.testing.assert_allclose(got["rsi_9"].astype(float), by.transform(strength), rtol=1e-8)

    def signal(x):
        line = x.ewm(span=9, adjust=False).mean() - x.ewm(span=26, adjust=False).mean()
        return line.ewm(span=9, adjust=False).mean() / x

    np.testing.assert_allclose(got["macd_signal"].astype(float), by.transform(signal), rtol=1e-8, atol=1e-12)


def recursive_mean(values: np.ndarray, span: int) -> np.ndarray:
    """e[0] = x[0], e[t] = e[t-1] + a (x[t] - e[t-1]) with a = 2 / (span + 1)."""
    out = np.array(values, dtype=float)
    for t in range(1, len(out)):
        out[t] = out[t - 1] + 2.0 / (span + 1) * (values[t] - out[t - 1])
    return out


def brute_force(g: pd.DataFrame) -> pd.DataFrame:
    """Every indicator from its definition, row by row on the row's own slice of history."""
    high, low, close, open_, volume, vwap = (
        g[c].to_numpy(float) for c in ("high", "low", "close", "open", "volume", "vwap")
    )
    steps = np.diff(close)
    line = recursive_mean(close, 12) - recursive_mean(close, 26)
    smooth = recursive_mean(line, 9)
    averages = {n: recursive_mean(close, n) for n in s.EMA_SPANS}
    table = []
    for t, price in enumerate(close):

        def last(values: np.ndarray, n: int, t: int = t) -> np.ndarray | None:
            return values[t - n + 1 : t + 1] if t >= n - 1 else None

        top, bottom = max(open_[t], price), min(open_[t], price)
        row = {
            "price_range": (high[t] - low[t]) / price,
            "body_size": (top - bottom) / price,
            "upper_shadow": (high[t] - top) / price,
            "lower_shadow": (bottom - low[t]) / price,
            "macd": line[t] / price,
            "macd_signal": smooth[t] / price,
            "macd_hist": (line[t] - smooth[t]) / price,
            "vwap_diff": vwap[t] / price - 1,
        }
        row |= {f"ema_{n}": e[t] / price - 1 for n, e in averages.items()}
        for n in s.SMA_PERIODS:
            w = last(close, n)
            row[f"sma_{n}"] = np.nan if w is None else sum(w) / n / price - 1
        for n in s.RSI_PERIODS:
            w = steps[t - n : t] if t >= n else None
            ratio = np.nan if w is None else (sum(w[w > 0]) / n) / (-sum(w[w < 0]) / n + 1e-10)
            row[f"rsi_{n}"] = 100 - 100 / (1 + ratio)
        for n in s.BOLLINGER_PERIODS:
            w = last(close, n)
            row[f"bb_pos_{n}"] = np.nan if w is None else (price - w.mean()) / (2 * w.std(ddof=1) + 1e-10)
            row[f"bb_width_{n}"] = np.nan if w is None else 4 * w.std(ddof=1) / price
        for n in s.ATR_PERIODS:
            w = last((high - low) / close, n)
            row[f"atr_{n}"] = np.nan if w is None else w.mean()
        for n in s.VOLUME_PERIODS:
            w = last(volume, n)
            row[f"volume_sma_{n}"] = np.nan if w is None else w.mean() / (volume[t] + 1e-10) - 1
        for n in s.ROC_PERIODS:
            row[f"roc_{n}"] = np.nan if t < n else price / close[t - n] - 1
        w = last(close, 20)
        row["close_zscore"] = np.nan if w is None else (price - w.mean()) / (w.std(ddof=1) + 1e-10)
        table.append(row)
    return pd.DataFrame(table)


@pytest.mark.parametrize("chunk_rows", [16, 64, 512])
def test_indicators_match_brute_force(bars, chunk_rows):
    frame, df = bars
    got = by_day(
        indicators.indicators(df, block_days=150, chunk_rows=chunk_rows), s.INDICATOR_FEATURES
    )
    want = pd.concat([brute_force(g) for _, g in frame.groupby("symbol")]).reset_index(drop=True)
    for name in s.INDICATOR_FEATURES:
        np.testing.assert_allclose(got[name].astype(float), want[name], rtol=1e-8, atol=1e-10, err_msg=name)


def test_warmup_edges(bars):
    _, df = bars
    kept = indicators.indicator_table(df, chunk_rows=32).groupBy("symbol").count().collect()
    assert {r["symbol"]: r["count"] for r in kept} == {"E": 1, "F": 283}


def test_constant_close_stays_finite(spark):
    frame = walk({"K": 60})
    frame[["open", "close", "high", "low", "vwap"]] = 7.0
    got = indicators.indicator_table(spark.createDataFrame(frame)).toPandas()
    assert len(got) == 10
    assert np.isfinite(got[s.INDICATOR_FEATURES].to_numpy()).all()
    assert (got["close_zscore"] == 0).all() and (got["bb_pos_20"] == 0).all()


@pytest.mark.parametrize("chunk_rows", [7, 512])
def test_sequences(bars, chunk_rows):
    frame, df = bars
    made = sequences.sequences(
        df, ["close", "volume"], length=40, horizon=5, block_days=300, chunk_rows=chunk_rows
    ).toPandas()
    assert made.groupby("symbol").size().to_dict() == {"C": 5, "D": 6, "E": 7, "F": 289}
    series_f = frame[frame.symbol == "F"].reset_index(drop=True)
    rows = made[made.symbol == "F"].sort_values("prediction_date").reset_index(drop=True)
    for i in (0, 1, 100, 288):
        np.testing.assert_array_equal(
            np.array([list(x) for x in rows.loc[i, "sequence"]]), series_f.loc[i : i + 39, ["close", "volume"]]
        )
        assert rows.loc[i, "prediction_date"] == series_f.loc[i + 39, "bar_date"]
        assert rows.loc[i, "target_date"] == series_f.loc[i + 44, "bar_date"]
        assert rows.loc[i, "future_close"] == series_f.loc[i + 44, "close"]


def test_min_history_edge(spark):
    df = spark.createDataFrame([("A", i) for i in range(74)] + [("B", i) for i in range(75)], "symbol string, i int")
    assert [r[0] for r in sequences.with_min_history(df).select("symbol").distinct().collect()] == ["B"]


def test_minmax_constant_and_fit(spark):
    df = spark.createDataFrame(
        [("A", 1.0, 5.0, True), ("A", 3.0, 5.0, True), ("A", 5.0, 5.0, False)], "symbol string, x double, k double, fit boolean"
    )
    both = sequences.minmax_by_key(df, ["symbol"], ["x", "k"]).orderBy("x").collect()
    assert [r["x_scaled"] for r in both] == [0.0, 0.5, 1.0] and {r["k_scaled"] for r in both} == {0.0}
    train = sequences.minmax_by_key(df, ["symbol"], ["x"], fit_on=F.col("fit")).orderBy("x").collect()
    assert [r["x_scaled"] for r in train] == [0.0, 1.0, 2.0]


def test_chronological_cut(bars):
    frame, df = bars
    got = sequences.chronological_cut(df, ["symbol"], "bar_date", block_days=100)
    counts = {r["symbol"]: r["n"] for r in got.filter("part = 'fit'").groupBy("symbol").agg(F.count("*").alias("n")).collect()}
    assert counts == {k: int(n * 0.9) for k, n in SIZES.items() if int(n * 0.9)}


def test_no_look_ahead(spark):
    frame = walk({"F": 200})
    cut = frame["bar_date"].iloc[150]
    full = indicators.indicators(spark.createDataFrame(frame), chunk_rows=32)
    part = indicators.indicators(spark.createDataFrame(frame[frame.bar_date <= cut]), chunk_rows=32)
    a = by_day(full.filter(F.col("bar_date") <= cut), s.INDICATOR_FEATURES)
    b = by_day(part, s.INDICATOR_FEATURES)
    pd.testing.assert_frame_equal(a, b)


def test_positions_and_means_join_no_rows(spark):
    """Block offsets and chunk states travel as rows of their own; keys may be null, and a key may have several blocks."""
    days = [f"19{y:02d}-03-0{d}" for y in (71, 77, 84, 90) for d in range(1, 6)]
    rows = [(k, d, float(i) if i % 3 else None) for k in ("a", None) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "symbol string, day string, x double").withColumn("day", F.to_date("day"))
    numbered = series.number_rows(df, ["symbol"], "day")
    made = series.with_ema(numbered, ["symbol"], F.col("x"), {3: "mean"}, chunk_rows=4)
    for frame in (numbered, made):
        assert "Join" not in frame._jdf.queryExecution().optimizedPlan().toString()
    assert made.columns == [*numbered.columns, "mean"]
    values = [i if i % 3 else math.nan for i in range(len(days))]
    expected = pd.Series(values, dtype=float).ewm(span=3, adjust=False).mean()
    for key in ("a", None):
        own = sorted((r for r in made.collect() if r["symbol"] == key), key=lambda r: r["day"])
        assert [r["_pos"] for r in own] == list(range(len(days)))
        assert [r["mean"] is None for r in own] == [math.isnan(v) for v in expected]
        assert all(abs(r["mean"] - v) < 1e-9 for r, v in zip(own, expected) if not math.isnan(v))
