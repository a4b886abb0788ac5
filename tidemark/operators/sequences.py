"""Training sequences, forward returns, history filters and chronological splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.operators.joins import null_safe_join
from tidemark.functions.market import split_label
from tidemark.operators.series import (
    BLOCK_DAYS,
    CHUNK,
    CHUNK_ROWS,
    HOME,
    POS,
    chunk_window,
    number_rows,
    shift,
    spread_chunks,
    with_frames,
)
from tidemark.session import stage_table


def forward_returns(
    df: DataFrame,
    by: Sequence[str] = ("symbol",),
    on: str = "bar_date",
    close: str = "close",
    horizon: int = s.PREDICTION_HORIZON,
    block_days: int = BLOCK_DAYS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Return over the next ``horizon`` rows with its future close and date; null at the end of a series."""

    def build(rows, window):
        ahead = rows.withColumns(
            {"future_close": shift(close, -horizon, window), "target_date": shift(on, -horizon, window)}
        )
        return ahead.withColumn("forward_return", F.try_divide(F.col("future_close") - F.col(close), F.col(close)))

    return with_frames(df, by, on, build, after=horizon, block_days=block_days, chunk_rows=chunk_rows)


def sequences(
    df: DataFrame,
    features: Sequence[str],
    by: Sequence[str] = ("symbol",),
    on: str = "bar_date",
    close: str = "close",
    length: int = s.SEQUENCE_LENGTH,
    horizon: int = s.PREDICTION_HORIZON,
    block_days: int = BLOCK_DAYS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """One row per position with ``length`` rows of history and ``horizon`` rows ahead.

    ``sequence`` is an array of feature arrays, oldest first; a series of n rows yields
    n - length - horizon + 1 sequences.
    """

    def build(rows, window):
        step = F.array(*[F.col(c).cast("double") for c in features])
        framed = rows.withColumns(
            {
                "sequence": F.collect_list(step).over(window.rowsBetween(-(length - 1), 0)),
                "future_close": shift(close, -horizon, window),
                "target_date": shift(on, -horizon, window),
            }
        )
        return framed.withColumn("forward_return", F.try_divide(F.col("future_close") - F.col(close), F.col(close)))

    framed = with_frames(
        df.select(*by, on, close, *[c for c in features if c != close]),
        by,
        on,
        build,
        before=length - 1,
        after=horizon,
        block_days=block_days,
        chunk_rows=chunk_rows,
        keep_position=True,
    )
    complete = framed.filter((F.col(POS) >= length - 1) & F.col("target_date").isNotNull())
    return complete.select(
        *by,
        F.col(on).alias("prediction_date"),
        "target_date",
        F.col(close).alias("prev_close"),
        "future_close",
        F.col("forward_return"),
        "sequence",
    )


def training_sequences(
    df: DataFrame,
    features: Sequence[str],
    cutoff: str,
    by: Sequence[str] = ("symbol",),
    on: str = "bar_date",
    close: str = "close",
    length: int = s.SEQUENCE_LENGTH,
    horizon: int = s.PREDICTION_HORIZON,
    fit_on_train: bool = False,
    min_history: int = s.SEQUENCE_LENGTH + s.PREDICTION_HORIZON + s.MIN_EXTRA_ROWS,
    min_train: int = s.MIN_TRAIN_ROWS,
    min_test: int = s.MIN_TEST_ROWS,
    block_days: int = BLOCK_DAYS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Scaled sequences with forward returns and the target-date split, of keys with enough history, train and test rows.

    The numbered rows are written once. One aggregate per key over them holds everything that decides about a key or scales
    it: rows, train and test sequences (a row is the target of one if enough rows lie before it) and the ranges. It is
    joined to plain rows of a chunk; arrays are built last and go through no join.
    """
    keys, names = list(by), list(dict.fromkeys([close, *features]))
    rows = stage_table(number_rows(df.select(*keys, on, *names), keys, on, block_days=block_days), "ordered-rows")
    trained = F.col(on) < F.to_date(F.lit(cutoff))
    target = F.col(POS) >= length - 1 + horizon
    ranges = []
    for c in features:
        value = F.when(trained, F.col(c)) if fit_on_train else F.col(c)
        ranges += [F.min(value).alias(f"_min_{c}"), F.max(value).alias(f"_max_{c}")]
    about = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(target & trained).alias("_train"),
        F.count_if(target & ~trained).alias("_test"),
        *ranges,
    )
    usable = about.filter((F.col("_rows") >= min_history) & (F.col("_train") >= min_train) & (F.col("_test") >= min_test))
    # Joined by the chunks that the frames need anyway: rows are shuffled once for both.
    last = F.floor((F.col("_rows") - 1) / F.lit(chunk_rows)).cast("long")
    per_chunk = usable.withColumn(CHUNK, F.explode(F.sequence(F.lit(0).cast("long"), last))).drop("_rows", "_train", "_test")
    joined = spread_chunks(rows, length - 1, horizon, chunk_rows).join(per_chunk, [*keys, CHUNK])
    return framed_sequences(joined, features, cutoff, F.col(POS) >= length - 1, keys, on, close, length, horizon)


def framed_sequences(
    rows: DataFrame,
    features: Sequence[str],
    cutoff: str,
    enough: Column,
    by: Sequence[str],
    on: str,
    close: str,
    length: int,
    horizon: int,
) -> DataFrame:
    """The sequences of rows in their chunks that hold the ranges of their key; ``enough`` tells whether the history is there."""
    scaled = [scaled_value(F.col(c), F.col(f"_min_{c}"), F.col(f"_max_{c}")).cast("double") for c in features]
    narrow = rows.select(*by, CHUNK, HOME, on, POS, close, F.array(*scaled).alias("_step"))
    window = chunk_window(by)
    framed = narrow.withColumns(
        {
            "sequence": F.collect_list("_step").over(window.rowsBetween(-(length - 1), 0)),
            "future_close": shift(close, -horizon, window),
            "target_date": shift(on, -horizon, window),
        }
    )
    whole = framed.filter(F.col(HOME) & enough & F.col("target_date").isNotNull())
    return whole.select(
        *by,
        F.col(on).alias("prediction_date"),
        "target_date",
        F.col(close).alias("prev_close"),
        "future_close",
        F.try_divide(F.col("future_close") - F.col(close), F.col(close)).alias("forward_return"),
        "sequence",
        split_label(F.col("target_date"), cutoff, inclusive=False).alias(s.SPLIT),
    )


def keys_with_history(df: DataFrame, by: Sequence[str], at_least: int) -> DataFrame:
    """Keys that have at least that many rows, with their count."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") >= at_least)


def with_min_history(
    df: DataFrame,
    by: Sequence[str] = ("symbol",),
    at_least: int = s.SEQUENCE_LENGTH + s.PREDICTION_HORIZON + s.MIN_EXTRA_ROWS,
) -> DataFrame:
    return null_safe_join(df, keys_with_history(df, by, at_least).select(*by), by, "left_semi")


def minmax_by_key(
    df: DataFrame, by: Sequence[str], columns: Sequence[str], fit_on: Column | None = None, suffix: str = "_scaled"
) -> DataFrame:
    """Scale columns to 0..1 with each key's own range; a constant column gives 0.

    ``fit_on`` restricts the rows the range is taken from (train rows only); without it all rows count.
    Ranges are one pre-aggregated row per key, joined back.
    """
    ranges = []
    for c in columns:
        value = F.col(c) if fit_on is None else F.when(fit_on, F.col(c))
        ranges += [F.min(value).alias(f"_min_{c}"), F.max(value).alias(f"_max_{c}")]
    joined = null_safe_join(df, df.groupBy(*by).agg(*ranges), by)
    scaled = {
        f"{c}{suffix}": scaled_value(F.col(c), F.col(f"_min_{c}"), F.col(f"_max_{c}")) for c in columns
    }
    return joined.withColumns(scaled).drop(*[f"_{m}_{c}" for m in ("min", "max") for c in columns])


def scaled_value(value: Column, low: Column, high: Column) -> Column:
    """(value - low) / (high - low), a zero range counting as one."""
    return (value - low) / F.when(high == low, F.lit(1.0)).otherwise(high - low)


def target_date_split(
    df: DataFrame,
    cutoff: str,
    by: Sequence[str] = ("symbol",),
    min_train: int = s.MIN_TRAIN_ROWS,
    min_test: int = s.MIN_TEST_ROWS,
) -> DataFrame:
    """Label rows by target date (strictly before the cut-off trains) and drop keys with too few of either."""
    labelled = df.withColumn(s.SPLIT, split_label(F.col("target_date"), cutoff, inclusive=False))
    usable = (
        labelled.groupBy(*by)
        .agg(
            F.count_if(F.col(s.SPLIT) == "train").alias("_train"),
            F.count_if(F.col(s.SPLIT) == "test").alias("_test"),
        )
        .filter((F.col("_train") >= min_train) & (F.col("_test") >= min_test))
    )
    return null_safe_join(labelled, usable.select(*by), by, "left_semi")


def chronological_cut(
    df: DataFrame,
    by: Sequence[str],
    on: str,
    first_share: float = 0.9,
    labels: tuple[str, str] = ("fit", "validate"),
    column: str = "part",
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """First ``int(n * first_share)`` rows of each key in time order against the rest."""
    numbered = number_rows(df, by, on, block_days=block_days)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    limit = F.floor(F.col("_rows") * F.lit(first_share))
    return (
        null_safe_join(numbered, sizes, by)
        .withColumn(column, F.when(F.col(POS) < limit, labels[0]).otherwise(labels[1]))
        .drop(POS, "_rows")
    )


def drop_warmup(
    df: DataFrame, by: Sequence[str], on: str, rows: int = s.WARMUP_ROWS, block_days: int = BLOCK_DAYS
) -> DataFrame:
    """Drop each key's first rows."""
    return number_rows(df, by, on, block_days=block_days).filter(F.col(POS) >= rows).drop(POS)
