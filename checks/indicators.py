"""Indicators, forward returns, sequences and chronological splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standin as t
from checks.registry import check, rounded, rounded_sql
from checks.views import CUTOFF, with_views
from tidemark import schemas as s
from tidemark.operators import indicators as ind
from tidemark.operators import sequences as seq
from tidemark.operators.series import number_rows, shift, with_frames

KEYS = ["symbol", "bar_date"]
_W = "PARTITION BY symbol ORDER BY bar_date"


def _full(value: str, n: int, function: str) -> str:
    frame = f"OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({value}) {frame} = {n} THEN {function}({value}) {frame} END"


def _rolling_sql() -> dict[str, str]:
    out = {
        "price_range": "(high - low) / close",
        "body_size": "abs(close - open) / close",
        "upper_shadow": "(high - greatest(open, close)) / close",
        "lower_shadow": "(least(open, close) - low) / close",
    }
    out |= {f"sma_{n}": f"({_full('close', n, 'avg')}) / close - 1" for n in s.SMA_PERIODS}
    for n in s.RSI_PERIODS:
        out[f"rsi_{n}"] = f"100 - 100 / (1 + ({_full('gain', n, 'avg')}) / (({_full('loss', n, 'avg')}) + 1e-10))"
    for n in s.BOLLINGER_PERIODS:
        deviation = _full("close", n, "stddev_samp")
        out[f"bb_pos_{n}"] = f"(close - ({_full('close', n, 'avg')})) / (2 * ({deviation}) + 1e-10)"
        out[f"bb_width_{n}"] = f"4 * ({deviation}) / close"
    out |= {f"atr_{n}": _full("spread", n, "avg") for n in s.ATR_PERIODS}
    out |= {f"volume_sma_{n}": f"({_full('volume', n, 'avg')}) / (volume + 1e-10) - 1" for n in s.VOLUME_PERIODS}
    out["vwap_diff"] = "(vwap - close) / close"
    out |= {f"roc_{n}": f"close / lag(close, {n}) OVER ({_W}) - 1" for n in s.ROC_PERIODS}
    n = s.ZSCORE_PERIOD
    out["close_zscore"] = f"(close - ({_full('close', n, 'avg')})) / (({_full('close', n, 'stddev_samp')}) + 1e-10)"
    return out


_ROLLING = _rolling_sql()

# The recursions as recursions, one step per bar.
_SPANS = [*s.EMA_SPANS, *s.MACD_SPANS[:2]]
_STEP = ", ".join(f"r.e{n} * (1 - 2e0 / {n + 1}) + b.close * 2e0 / {n + 1}" for n in _SPANS)
_LINE = "(r.e12 * (1 - 2e0 / 13) + b.close * 2e0 / 13) - (r.e26 * (1 - 2e0 / 27) + b.close * 2e0 / 27)"
_NUMBERED = f"""numbered AS (
  SELECT *, row_number() OVER ({_W}) AS i, (high - low) / close AS spread,
    close - lag(close) OVER ({_W}) AS change FROM bars),
moved AS (SELECT *, CASE WHEN change IS NOT NULL THEN greatest(change, 0) END AS gain,
  CASE WHEN change IS NOT NULL THEN -least(change, 0) END AS loss FROM numbered)"""
_RECURSION = f"""ema AS (
  SELECT symbol, i, {", ".join(f"close AS e{n}" for n in _SPANS)}, 0e0 AS signal FROM numbered WHERE i = 1
  UNION ALL
  SELECT b.symbol, b.i, {_STEP}, r.signal * (1 - 2e0 / 10) + ({_LINE}) * 2e0 / 10
  FROM ema r JOIN numbered b ON b.symbol = r.symbol AND b.i = r.i + 1)"""
_EMA = {f"ema_{n}": f"e{n} / close - 1" for n in s.EMA_SPANS}
_EMA |= {"macd": "(e12 - e26) / close", "macd_signal": "signal / close", "macd_hist": "(e12 - e26 - signal) / close"}


def _rolling_query(features: list[str]) -> str:
    columns = ", ".join(rounded_sql(_ROLLING[f], f, 6) for f in features)
    return with_views("bars", f"SELECT symbol, bar_date, {columns} FROM moved", _NUMBERED)


def _recursive_query(features: list[str]) -> str:
    columns = ", ".join(rounded_sql(_EMA[f], f, 6) for f in features)
    return with_views(
        "bars",
        f"SELECT symbol, bar_date, {columns} FROM numbered JOIN ema USING (symbol, i)",
        f"{_NUMBERED},\n{_RECURSION}",
        recursive=True,
    )


_GROUPS = {
    "candle_shape": ["price_range", "body_size", "upper_shadow", "lower_shadow"],
    "sma": [f"sma_{n}" for n in s.SMA_PERIODS],
    "rsi": [f"rsi_{n}" for n in s.RSI_PERIODS],
    "bollinger": [f"bb_{k}_{n}" for n in s.BOLLINGER_PERIODS for k in ("pos", "width")],
    "range_volatility": [f"atr_{n}" for n in s.ATR_PERIODS],
    "volume_ratio": [*[f"volume_sma_{n}" for n in s.VOLUME_PERIODS], "vwap_diff"],
    "roc": [f"roc_{n}" for n in s.ROC_PERIODS],
    "zscore": ["close_zscore"],
    "ema": [f"ema_{n}" for n in s.EMA_SPANS],
    "macd": ["macd", "macd_signal", "macd_hist"],
}


def _register(name: str, features: list[str]) -> None:
    sql = _recursive_query(features) if features[0] in _EMA else _rolling_query(features)

    @check(name, sql)
    def query(spark, sf_dir):
        made = ind.indicators(t.stored_bars(spark, sf_dir), features=features)
        return rounded(made.select(*KEYS, *features), features, 6)


for _name, _features in _GROUPS.items():
    _register(_name, _features)


_ALL = {**{f: _ROLLING[f] for f in _ROLLING}, **_EMA}


@check(
    "indicator_table",
    with_views(
        "bars",
        "SELECT symbol, bar_date, open, high, low, close, volume, trade_count, vwap, "
        + ", ".join(rounded_sql(f, f, 6) for f in s.INDICATOR_FEATURES)
        + " FROM made WHERE i > 50 AND "
        + " AND ".join(f"{f} IS NOT NULL" for f in s.INDICATOR_FEATURES),
        f"{_NUMBERED},\n{_RECURSION},\nmade AS (SELECT moved.*, "
        + ", ".join(f"{_ALL[f]} AS {f}" for f in s.INDICATOR_FEATURES)
        + " FROM moved JOIN ema USING (symbol, i))",
        recursive=True,
    ),
)
def indicator_table(spark, sf_dir):
    return rounded(ind.indicator_table(t.stored_bars(spark, sf_dir)), s.INDICATOR_FEATURES, 6)


@check(
    "first_difference",
    with_views("bars", f"SELECT symbol, bar_date, close - lag(close) OVER ({_W}) AS change FROM bars"),
)
def first_difference(spark, sf_dir):
    made = with_frames(
        t.bars(spark, sf_dir).select(*KEYS, "close"),
        ["symbol"],
        "bar_date",
        lambda rows, window: rows.withColumn("change", F.col("close") - shift("close", 1, window)),
        before=1,
    )
    return made.select(*KEYS, "change")


@check(
    "forward_return",
    with_views(
        "bars",
        f"""SELECT symbol, bar_date, close, lead(close, 5) OVER ({_W}) AS future_close,
              lead(bar_date, 5) OVER ({_W}) AS target_date, (lead(close, 5) OVER ({_W}) - close) / close AS forward_return
            FROM bars""",
    ),
)
def forward_return(spark, sf_dir):
    return seq.forward_returns(t.bars(spark, sf_dir).select(*KEYS, "close"))


_SEQUENCE_FEATURES = ["open", "close", "volume", "vwap"]


@check(
    "sequence_dataset",
    with_views(
        "bars",
        f"""SELECT symbol, bar_date AS prediction_date, target_date, close AS prev_close, future_close,
              (future_close - close) / close AS forward_return, sequence
            FROM (SELECT *, lead(close, 5) OVER ({_W}) AS future_close, lead(bar_date, 5) OVER ({_W}) AS target_date,
                list([{", ".join(_SEQUENCE_FEATURES)}]) OVER ({_W} ROWS BETWEEN 39 PRECEDING AND CURRENT ROW) AS sequence,
                row_number() OVER ({_W}) AS i FROM bars) b
            WHERE i >= 40 AND target_date IS NOT NULL""",
    ),
)
def sequence_dataset(spark, sf_dir):
    return seq.sequences(t.stored_bars(spark, sf_dir), _SEQUENCE_FEATURES)


@check(
    "min_history_symbols",
    with_views("bars", "SELECT symbol, count(*) AS rows FROM bars GROUP BY symbol HAVING count(*) >= 540"),
)
def min_history_symbols(spark, sf_dir):
    return seq.keys_with_history(t.bars(spark, sf_dir), ["symbol"], 540)


@check(
    "bars_with_min_history",
    with_views(
        "bars",
        """SELECT symbol, bar_date, close FROM bars
           WHERE symbol IN (SELECT symbol FROM bars GROUP BY symbol HAVING count(*) >= 540)""",
    ),
)
def bars_with_min_history(spark, sf_dir):
    return seq.with_min_history(t.bars(spark, sf_dir).select(*KEYS, "close"), at_least=540)


@check(
    "minmax_by_symbol",
    with_views(
        "bars",
        """SELECT symbol, bar_date, (close - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END AS close_scaled,
             (volume - vlo) / CASE WHEN vhi = vlo THEN 1 ELSE vhi - vlo END AS volume_scaled
           FROM (SELECT *, min(close) OVER w AS lo, max(close) OVER w AS hi, min(volume) OVER w AS vlo,
               max(volume) OVER w AS vhi FROM bars WINDOW w AS (PARTITION BY symbol)) b""",
    ),
)
def minmax_by_symbol(spark, sf_dir):
    scaled = seq.minmax_by_key(t.bars(spark, sf_dir), ["symbol"], ["close", "volume"])
    return scaled.select(*KEYS, "close_scaled", "volume_scaled")


_RETURNS = f"""returns AS (
  SELECT symbol, bar_date, lead(bar_date, 5) OVER ({_W}) AS target_date FROM bars)"""


@check(
    "target_date_split",
    with_views(
        "bars",
        f"""SELECT symbol, bar_date, target_date,
              CASE WHEN target_date < DATE '{CUTOFF}' THEN 'train' ELSE 'test' END AS split
            FROM returns WHERE target_date IS NOT NULL AND symbol IN (SELECT symbol FROM returns
              WHERE target_date IS NOT NULL GROUP BY symbol
              HAVING count(*) FILTER (WHERE target_date < DATE '{CUTOFF}') >= 400
                AND count(*) FILTER (WHERE target_date >= DATE '{CUTOFF}') >= 100)""",
        _RETURNS,
    ),
)
def target_date_split(spark, sf_dir):
    ahead = seq.forward_returns(t.bars(spark, sf_dir)).filter(F.col("target_date").isNotNull())
    return seq.target_date_split(ahead, CUTOFF, min_train=400, min_test=100).select(*KEYS, "target_date", "split")


@check(
    "chrono_train_val",
    with_views(
        "bars",
        f"""SELECT symbol, bar_date, CASE WHEN row_number() OVER ({_W}) <= floor(0.9e0 * count(*) OVER
              (PARTITION BY symbol)) THEN 'fit' ELSE 'validate' END AS part FROM bars""",
    ),
)
def chrono_train_val(spark, sf_dir):
    return seq.chronological_cut(t.bars(spark, sf_dir).select(*KEYS), ["symbol"], "bar_date")


@check(
    "warmup_drop",
    with_views(
        "bars",
        f"SELECT symbol, bar_date, close FROM bars QUALIFY row_number() OVER ({_W}) > 50",
    ),
)
def warmup_drop(spark, sf_dir):
    return seq.drop_warmup(t.bars(spark, sf_dir).select(*KEYS, "close"), ["symbol"], "bar_date")


@check(
    "row_positions",
    with_views("bars", f"SELECT symbol, bar_date, row_number() OVER ({_W}) - 1 AS position FROM bars"),
)
def row_positions(spark, sf_dir):
    return number_rows(t.bars(spark, sf_dir).select(*KEYS), ["symbol"], "bar_date", position="position")
