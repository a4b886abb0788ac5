"""Training sequences of indicators that never store or shuffle the indicators themselves.

A row's indicators take several times the room of the bar and the exponential means that they are made of, so only those are
written, and sent twice to the chunks of their frames: once for the ranges of each key, once for the sequences.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.operators import indicators
from tidemark.operators.sequences import framed_sequences, training_sequences
from tidemark.operators.series import BLOCK_DAYS, CHUNK, CHUNK_ROWS, HOME, POS, spread_chunks
from tidemark.session import stage_table

_PRICES = ("open", "high", "low", "close", "volume", "vwap")


def indicator_sequences(
    bars: DataFrame,
    features: Sequence[str],
    cutoff: str,
    by: Sequence[str] = ("symbol",),
    on: str = "bar_date",
    length: int = s.SEQUENCE_LENGTH,
    horizon: int = s.PREDICTION_HORIZON,
    fit_on_train: bool = False,
    warmup: int = s.WARMUP_ROWS,
    min_history: int = s.SEQUENCE_LENGTH + s.PREDICTION_HORIZON + s.MIN_EXTRA_ROWS,
    min_train: int = s.MIN_TRAIN_ROWS,
    min_test: int = s.MIN_TEST_ROWS,
    block_days: int = BLOCK_DAYS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """What :func:`training_sequences` makes of the rows of ``indicator_table``, from bars.

    A sequence is made of complete rows, so its frames reach further by as many rows as a key has incomplete ones between its
    first and its last complete row; where that is more than a chunk, the indicators are written after all.
    """
    keys, every = list(by), list(s.INDICATOR_FEATURES)
    rows = indicators.with_means(bars, keys, on, every, block_days, chunk_rows)
    kept = [c for c in bars.columns if c in (*keys, on, *_PRICES, *features)]
    others = [c for c in bars.columns if c not in kept]
    means = [c for c in rows.columns if c in ("_line", "_signal", *[f"_{f}" for f in every])]
    rows = stage_table(rows.select(*kept, POS, *means, indicators.complete(bars, others).alias("_others")), "rows-with-means")
    reach = indicators.look_back(every)

    def built(before: int, after: int) -> DataFrame:
        """Complete rows in the chunks whose frames reach ``before`` rows back and ``after`` ahead."""
        made = indicators.with_features(spread_chunks(rows, reach + before, after, chunk_rows), keys, every)
        inside = F.col(POS) >= F.col(CHUNK) * chunk_rows - before
        return made.filter(inside & (F.col(POS) >= warmup) & F.col("_others") & indicators.complete(made, [*kept, *every]))

    trained = F.col(on) < F.to_date(F.lit(cutoff))
    ranges = []
    for c in features:
        value = F.when(trained, F.col(c)) if fit_on_train else F.col(c)
        ranges += [F.min(value).alias(f"_min_{c}"), F.max(value).alias(f"_max_{c}")]
    # Rows are in the order of their days, so those before the cut-off are the first of their key.
    first = F.lit(length - 1 + horizon)
    about = built(0, 0).filter(HOME).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(trained).alias("_trained"),
        F.min(POS).alias("_first"),
        F.max(POS).alias("_last"),
        *ranges,
    )
    about = stage_table(about, "ranges")
    missing = F.col("_last") - F.col("_first") + 1 - F.col("_rows")
    gaps = about.agg(F.coalesce(F.max(missing), F.lit(0))).first()[0]
    if gaps > chunk_rows:
        ready = stage_table(built(0, 0).filter(HOME).select(*keys, on, *dict.fromkeys(["close", *features])), "indicators")
        return training_sequences(
            ready, features, cutoff, keys, on, length=length, horizon=horizon, fit_on_train=fit_on_train, min_history=min_history,
            min_train=min_train, min_test=min_test, block_days=block_days, chunk_rows=chunk_rows,
        )
    train = F.greatest(F.col("_trained") - first, F.lit(0))
    test = F.greatest(F.col("_rows") - first, F.lit(0)) - train
    usable = about.filter((F.col("_rows") >= min_history) & (train >= min_train) & (test >= min_test))
    # A row per key and chunk: its rows meet it in the chunks that the frames need anyway.
    chunk = lambda position: F.floor(F.col(position) / F.lit(chunk_rows)).cast("long")
    per_chunk = usable.withColumn(CHUNK, F.explode(F.sequence(chunk("_first"), chunk("_last"))))
    per_chunk = per_chunk.drop("_rows", "_trained", "_first", "_last")
    narrow = built(length - 1 + gaps, horizon + gaps).select(*keys, CHUNK, HOME, on, POS, *dict.fromkeys(["close", *features]))
    joined = narrow.join(per_chunk, [*keys, CHUNK])
    enough = F.size("sequence") == length
    return framed_sequences(joined, features, cutoff, enough, keys, on, "close", length, horizon)
