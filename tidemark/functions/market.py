"""Column expressions on prices, returns and labels. All of them stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def daily_move(open_: str | Column = "open", close: str | Column = "close") -> Column:
    """(close - open) / open; null for a zero open."""
    opened = F.col(open_) if isinstance(open_, str) else open_
    closed = F.col(close) if isinstance(close, str) else close
    return F.try_divide(closed - opened, opened)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio only for a strictly positive denominator, else null."""
    return F.when(denominator > 0, numerator / denominator)


def availability_date(day: Column, lag_days: int = 1) -> Column:
    """Last calendar day whose publications may be used for a bar of ``day``."""
    return F.date_sub(F.to_date(day), lag_days)


def look_back_start(as_of: str | date | Column, days: int) -> Column:
    """First day of a look-back window that ends on ``as_of``."""
    end = as_of if isinstance(as_of, Column) else F.to_date(F.lit(str(as_of)))
    return F.date_sub(end, days)


def exchange_date(instant: Column, zone: str = "America/New_York") -> Column:
    """Calendar day of a UTC instant at the exchange."""
    return F.to_date(F.from_utc_timestamp(instant, zone))


def split_label(day: Column, cutoff: str | date, inclusive: bool = True) -> Column:
    """``train`` up to the cut-off (with or without the day itself), ``test`` after it."""
    limit = F.to_date(F.lit(str(cutoff)))
    return F.when(day <= limit if inclusive else day < limit, F.lit("train")).otherwise(F.lit("test"))


def two_way_direction(
    move: Column, up: str | int = "up", down: str | int = "down", zero_is_up: bool = False
) -> Column:
    """Sign of a move as a label; zero counts as down unless ``zero_is_up``. Null moves are down, as ``x > 0`` fails."""
    rises = F.coalesce(move >= 0 if zero_is_up else move > 0, F.lit(False))
    return F.when(rises, F.lit(up)).otherwise(F.lit(down))


def three_way_direction(
    move: Column,
    threshold: float = 0.005,
    up: str | int = "up",
    down: str | int = "down",
    flat: str | int = "stable",
) -> Column:
    """Label with a dead band of +-``threshold``; the band's edges are flat."""
    return F.when(move > threshold, F.lit(up)).when(move < -threshold, F.lit(down)).otherwise(F.lit(flat))


def price_class(move: Column, threshold: float = 0.005) -> Column:
    """Class number of the three-way direction: 0 down, 1 up, 2 flat."""
    return three_way_direction(move, threshold, up=1, down=0, flat=2)


def sentiment_hit(sentiment: Column, move: Column) -> Column:
    """Whether a positive or negative label agrees with the two-way direction; neutral never does."""
    actual = two_way_direction(move, "positive", "negative")
    return F.coalesce(sentiment.isin("positive", "negative") & (sentiment == actual), F.lit(False))


def map_values(value: Column, mapping: Mapping[str, str]) -> Column:
    """Look a value up in a small literal mapping; unknown values give null."""
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), value)


def candle_shape(open_: Column, high: Column, low: Column, close: Column) -> dict[str, Column]:
    """Range, body and shadows of a bar relative to its close."""
    return {
        "price_range": (high - low) / close,
        "body_size": F.abs(close - open_) / close,
        "upper_shadow": (high - F.greatest(open_, close)) / close,
        "lower_shadow": (F.least(open_, close) - low) / close,
    }


def vwap_distance(vwap: Column, close: Column) -> Column:
    return (vwap - close) / close


def clip(value: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Clip that keeps nulls (``greatest``/``least`` alone would skip them)."""
    clipped = value
    if lower is not None:
        clipped = F.greatest(clipped, F.lit(lower))
    if upper is not None:
        clipped = F.least(clipped, F.lit(upper))
    return F.when(value.isNotNull(), clipped)


def target_price(price: Column, predicted_return: Column) -> Column:
    return price * (1 + predicted_return)


def has_value(column: Column, positive: bool = False) -> Column:
    """Null-safe availability flag."""
    return F.coalesce(column > 0, F.lit(False)) if positive else column.isNotNull()


def availability_pattern(has_sentiment: Column, has_financials: Column) -> Column:
    return (
        F.when(has_sentiment & has_financials, "Both")
        .when(has_sentiment, "Sentiment Only")
        .when(has_financials, "Financials Only")
        .otherwise("Neither")
    )


def softmax(logits: Column) -> Column:
    """Probabilities of an array of logits, shifted by the maximum for stability."""
    shifted = F.transform(logits, lambda x: F.exp(x.cast("double") - F.array_max(logits).cast("double")))
    total = F.aggregate(shifted, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(shifted, lambda x: x / total)


def softmax_label(logits: Column, labels: Sequence[str] | None = None) -> Column:
    """Struct (label, confidence) of the most probable entry; without ``labels`` the 0-based index.

    The winner is taken on the logits: two logits may round to one probability.
    """
    index = F.array_position(logits, F.array_max(logits)).cast("int") - 1
    top = F.lit(1.0) / F.aggregate(
        logits,
        F.lit(0.0),
        lambda acc, x: acc + F.exp(x.cast("double") - F.array_max(logits).cast("double")),
    )
    label = index if labels is None else F.get(F.array(*[F.lit(v) for v in labels]), index)
    return F.struct(label.alias("label"), top.alias("confidence"))
