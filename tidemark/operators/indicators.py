"""Multi-scale technical indicators per symbol.

All rolling columns share one shuffle and one sort per (symbol, chunk); see ``tidemark.operators.series``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.functions.market import candle_shape, clip, vwap_distance
from tidemark.operators import series
from tidemark.operators.series import BLOCK_DAYS, CHUNK_ROWS, POS, full_frame, shift
from tidemark.session import stage_table

_EPS = s.EPSILON

# A frame re-adds all its rows for each row, so frames are evaluated over this many rows only, plus one for what is left of a
# period; longer means and deviations are put together from several of them by ``lag``.
_UNIT = {"close": 5, "square": 5, "volume": 5, "gain": 7, "loss": 7, "range": 7}


def _values() -> dict[str, Column]:
    close, change = F.col("close"), F.col("_change")
    return {
        "close": close,
        "volume": F.col("volume"),
        "gain": clip(change, lower=0.0),
        "loss": -clip(change, upper=0.0),
        "range": F.col("_spread"),
    }


def _lengths(kind: str, rows: int) -> list[int]:
    """Lengths of the pieces of a period, newest first: full units, then what is left."""
    unit = _UNIT[kind]
    return [unit] * (rows // unit) + ([rows % unit] if rows % unit else [])


def _piece_columns(window: WindowSpec, periods: Mapping[str, set[int]]) -> dict[str, Column]:
    """Sums (for ``square``: squared deviations from the piece's own mean) over trailing pieces, null until full."""
    values, made = _values(), {}
    for kind, lengths in periods.items():
        for n in sorted({x for rows in lengths for x in _lengths(kind, rows)}):
            if kind == "square":
                made[f"_square_{n}"] = full_frame(values["close"], n, window, F.var_pop) * n
            else:
                made[f"_{kind}_{n}"] = full_frame(values[kind], n, window, F.sum)
    return made


def _parts(kind: str, rows: int, window: WindowSpec) -> list[tuple[int, Column]]:
    """(length, column) of the non-overlapping pieces of the trailing ``rows`` rows."""
    parts, back = [], 0
    for n in _lengths(kind, rows):
        column = F.col(f"_{kind}_{n}")
        parts.append((n, shift(column, back, window) if back else column))
        back += n
    return parts


def _total(columns: list[Column]) -> Column:
    return sum(columns[1:], columns[0])


def _mean(kind: str, rows: int, window: WindowSpec) -> Column:
    return _total([c for _, c in _parts(kind, rows, window)]) / rows


def _deviation(rows: int, window: WindowSpec) -> Column:
    """Sample deviation of the close. Squared deviations inside the pieces plus those of the piece means: both are
    sums of squares, so nothing cancels."""
    mean = _mean("close", rows, window)
    between = [n * (part / n - mean) * (part / n - mean) for n, part in _parts("close", rows, window)]
    inside = [part for _, part in _parts("square", rows, window)]
    return F.sqrt((_total(inside) + _total(between)) / (rows - 1))


def sma_distance(rows: int, window: WindowSpec) -> Column:
    return _mean("close", rows, window) / F.col("close") - 1


def rsi(rows: int, window: WindowSpec) -> Column:
    """Relative strength from simple means of gains and losses."""
    return 100 - 100 / (1 + _mean("gain", rows, window) / (_mean("loss", rows, window) + _EPS))


def bollinger(rows: int, window: WindowSpec) -> tuple[Column, Column]:
    """(position, width) of the band of two sample deviations."""
    close, deviation = F.col("close"), _deviation(rows, window)
    return (close - _mean("close", rows, window)) / (2 * deviation + _EPS), 4 * deviation / close


def volume_ratio(rows: int, window: WindowSpec) -> Column:
    return _mean("volume", rows, window) / (F.col("volume") + _EPS) - 1


def rate_of_change(rows: int, window: WindowSpec) -> Column:
    return F.try_divide(F.col("close"), shift("close", rows, window)) - 1


def zscore(rows: int, window: WindowSpec) -> Column:
    return (F.col("close") - _mean("close", rows, window)) / (_deviation(rows, window) + _EPS)


# Feature families with a period in their name: the sums they need and how far they look back.
_FAMILIES = {
    "sma": ("close",),
    "rsi": ("gain", "loss"),
    "bb_pos": ("close", "square"),
    "bb_width": ("close", "square"),
    "atr": ("range",),
    "volume_sma": ("volume",),
    "roc": (),
    "ema": (),
}
_PLAIN = ("price_range", "body_size", "upper_shadow", "lower_shadow", "macd", "macd_signal", "macd_hist", "vwap_diff", "close_zscore")


def _family(feature: str) -> tuple[str, int]:
    """(family, period) of a feature such as ``sma_12``; period 0 for one without."""
    name, _, period = feature.rpartition("_")
    if name in _FAMILIES and period.isdigit() and int(period) >= 2:
        return name, int(period)
    if feature in _PLAIN:
        return feature, 0
    raise ValueError(f"unknown indicator: {feature}")


def rolling_columns(window: WindowSpec, features: Sequence[str]) -> dict[str, Column]:
    """The features with a bounded look-back, from the piece columns."""
    close = F.col("close")
    plain = dict(candle_shape(F.col("open"), F.col("high"), F.col("low"), close)) | {"vwap_diff": vwap_distance(F.col("vwap"), close)}
    made = {}
    for feature in features:
        family, n = _family(feature)
        if family in plain:
            made[feature] = plain[family]
        elif family == "close_zscore":
            made[feature] = zscore(s.ZSCORE_PERIOD, window)
        elif family in ("bb_pos", "bb_width"):
            made[feature] = bollinger(n, window)[family == "bb_width"]
        elif family == "atr":
            made[feature] = _mean("range", n, window)
        elif family in ("sma", "rsi", "volume_sma", "roc"):
            made[feature] = {"sma": sma_distance, "rsi": rsi, "volume_sma": volume_ratio, "roc": rate_of_change}[family](n, window)
    return made


def _needs(features: Sequence[str]) -> tuple[dict[str, set[int]], int]:
    """Periods by kind of sum, and the longest look-back in rows."""
    periods: dict[str, set[int]] = {}
    longest = 1
    for feature in features:
        family, n = _family(feature)
        if family == "close_zscore":
            family, n = "bb_pos", s.ZSCORE_PERIOD
        if not n or family == "ema":
            continue
        longest = max(longest, n + 1)
        for kind in _FAMILIES[family]:
            periods.setdefault(kind, set()).add(n)
    return periods, longest


def indicators(
    bars: DataFrame,
    by: Sequence[str] = ("symbol",),
    on: str = "bar_date",
    features: Sequence[str] = tuple(s.INDICATOR_FEATURES),
    warmup: int = 0,
    block_days: int = BLOCK_DAYS,
    chunk_rows: int = CHUNK_ROWS,
    macd_spans: tuple[int, int, int] = s.MACD_SPANS,
) -> DataFrame:
    """Bars plus the requested indicator columns; the first ``warmup`` rows of each symbol are dropped.

    ``features`` are the plain names and any ``sma_<n>, rsi_<n>, bb_pos_<n>, bb_width_<n>, atr_<n>, volume_sma_<n>, roc_<n>,
    ema_<n>``. Only what they need is computed. Numbered bars, and exponential means if any are asked for, are written
    once and read by the passes that follow.
    """
    keys = list(by)
    rows = with_means(bars, keys, on, features, block_days, chunk_rows, macd_spans)
    rows = series.spread_chunks(rows, look_back(features), 0, chunk_rows)
    kept = with_features(rows, keys, features).filter(F.col(series.HOME) & (F.col(POS) >= warmup))
    return kept.select(*bars.columns, *features)


def look_back(features: Sequence[str]) -> int:
    """Rows before a row that its features are made of, exponential means apart."""
    return _needs(features)[1]


def with_means(
    bars: DataFrame,
    by: Sequence[str],
    on: str,
    features: Sequence[str],
    block_days: int = BLOCK_DAYS,
    chunk_rows: int = CHUNK_ROWS,
    macd_spans: tuple[int, int, int] = s.MACD_SPANS,
) -> DataFrame:
    """Numbered bars with what the features need from all rows before: exponential means, ``_line`` and ``_signal``."""
    keys, close = list(by), F.col("close")
    fast, slow, signal = macd_spans
    with_macd = any(f.startswith("macd") for f in features)
    spans = {n: f"_ema_{n}" for family, n in map(_family, features) if family == "ema"}
    if with_macd:
        spans |= {n: f"_ema_{n}" for n in (fast, slow)}

    rows = series.number_rows(bars, keys, on, block_days=block_days)
    if spans:
        rows = series.with_ema(stage_table(rows, "numbered-bars"), keys, close, spans, chunk_rows)
    if with_macd:
        line = F.col(f"_ema_{fast}") - F.col(f"_ema_{slow}")
        rows = stage_table(rows.withColumn("_line", line), "bars-with-means")
        rows = series.with_ema(rows, keys, F.col("_line"), {signal: "_signal"}, chunk_rows)
    return rows


def with_features(rows: DataFrame, by: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Adds the features to rows of :func:`with_means` that were sent to their chunks; right where the look-back is there."""
    periods, close = _needs(features)[0], F.col("close")
    window = series.chunk_window(by)
    rows = rows.withColumns({"_change": close - shift("close", 1, window), "_spread": (F.col("high") - F.col("low")) / close})
    # Further levels over the same partitioning and order: no further shuffle.
    rows = rows.withColumns(_piece_columns(window, periods) or {"_none": F.lit(0)})
    made = rolling_columns(window, features)
    made |= {f: F.col(f"_ema_{n}") / close - 1 for f in features for family, n in [_family(f)] if family == "ema"}
    if any(f.startswith("macd") for f in features):
        made |= {
            "macd": F.col("_line") / close,
            "macd_signal": F.col("_signal") / close,
            "macd_hist": (F.col("_line") - F.col("_signal")) / close,
        }
    return rows.withColumns(made)


def indicator_table(
    bars: DataFrame,
    by: Sequence[str] = ("symbol",),
    on: str = "bar_date",
    warmup: int = s.WARMUP_ROWS,
    block_days: int = BLOCK_DAYS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """All 32 indicators after the warm-up, complete rows only (NaN counts as missing)."""
    made = indicators(bars, by, on, warmup=warmup, block_days=block_days, chunk_rows=chunk_rows)
    return drop_incomplete(made)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with any null, or NaN in a floating column."""
    return df.filter(complete(df, df.columns))


def complete(df: DataFrame, columns: Sequence[str]) -> Column:
    """Whether none of the columns is null, or NaN if it is a floating one."""
    whole = F.lit(True)
    for field in (df.schema[c] for c in columns):
        whole = whole & F.col(field.name).isNotNull()
        if field.dataType.typeName() in ("double", "float"):
            whole = whole & ~F.isnan(field.name)
    return whole
