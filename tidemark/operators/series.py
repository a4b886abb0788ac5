"""Row-based time-series operators that never need a whole series in one task.

A series (one ``by`` key in ``on`` order) may be arbitrarily long, so no window here is partitioned by the key
alone over raw rows. Rows get their position in the series from per-block counts, positions are cut into chunks
of ``chunk_rows``, and the few rows a frame needs from a neighbouring chunk are sent there as well. Windows then
run per (key, chunk). Recursions (exponential means) carry a small linear state from chunk to chunk.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.session import stage_table

BLOCK_DAYS = 2048
CHUNK_ROWS = 512

POS, CHUNK, HOME = "_pos", "_chunk", "_home"


def time_block(on: str | Column, block_days: int = BLOCK_DAYS) -> Column:
    """Index of the fixed calendar block a date or timestamp falls in; null without one."""
    column = F.col(on) if isinstance(on, str) else on
    return F.floor(F.unix_date(F.to_date(column)) / F.lit(block_days)).cast("int")


def number_rows(
    df: DataFrame,
    by: Sequence[str],
    on: str,
    ties: Sequence[str] = (),
    block_days: int = BLOCK_DAYS,
    position: str = POS,
) -> DataFrame:
    """Add the 0-based position of each row within its key, in ``on`` (then ``ties``) order.

    Two-level numbering: counts per (key, calendar block) are pre-aggregated, their running total gives each
    block's offset, and ``row_number`` only runs inside a block. ``block_days`` bounds the rows of one window
    group: with one row per key and day a group holds at most ``block_days`` rows, so series finer than a day need
    fewer days. Null keys are keys of their own; rows without a date come first.

    The input is read twice (once for keys and dates only), so it should be a table, not a long plan. A block's offset
    comes with its rows, as a row of its own before them: the rows are shuffled once, and null keys need no other join.
    """
    keys = [*by, "_block"]
    blocked = df.withColumn("_block", time_block(on, block_days))
    sizes = blocked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    rows = blocked.withColumn("_offset", F.lit(None).cast("long")).unionByName(offsets, allowMissingColumns=True)
    within = Window.partitionBy(*keys).orderBy(F.col("_offset").asc_nulls_last(), on, *ties)
    start = F.first("_offset").over(within.rowsBetween(Window.unboundedPreceding, 0))
    return (
        rows.withColumn(position, start + F.row_number().over(within) - 2)
        .filter(F.col("_offset").isNull())
        .drop("_block", "_offset")
    )


def spread_chunks(numbered: DataFrame, before: int, after: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Send every row to its own chunk and, near a border, to the neighbours whose frames reach it.

    Adds ``_chunk`` and ``_home`` (true in the row's own chunk). ``before``/``after`` may exceed ``chunk_rows``.
    """
    chunk = F.floor(F.col(POS) / F.lit(chunk_rows)).cast("long")
    low = F.greatest(F.lit(0).cast("long"), F.floor((F.col(POS) - F.lit(after)) / F.lit(chunk_rows)).cast("long"))
    high = F.floor((F.col(POS) + F.lit(before)) / F.lit(chunk_rows)).cast("long")
    if before == 0 and after == 0:
        return numbered.withColumn(CHUNK, chunk).withColumn(HOME, F.lit(True))
    return numbered.withColumn(CHUNK, F.explode(F.sequence(low, high))).withColumn(HOME, F.col(CHUNK) == chunk)


def chunk_window(by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by, CHUNK).orderBy(POS)


def with_frames(
    df: DataFrame,
    by: Sequence[str],
    on: str,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    before: int = 0,
    after: int = 0,
    ties: Sequence[str] = (),
    block_days: int = BLOCK_DAYS,
    chunk_rows: int = CHUNK_ROWS,
    keep_position: bool = False,
) -> DataFrame:
    """Evaluate row frames that look at most ``before`` rows back and ``after`` rows ahead.

    ``build(rows, window)`` adds columns with any function over ``window`` whose frame stays inside that reach
    (nested frames add up). All of them share one shuffle and one sort.
    """
    numbered = number_rows(df, by, on, ties, block_days)
    rows = spread_chunks(numbered, before, after, chunk_rows)
    framed = build(rows, chunk_window(by)).filter(F.col(HOME)).drop(CHUNK, HOME)
    return framed if keep_position else framed.drop(POS)


def full_frame(value: Column, rows: int, window: WindowSpec, function: Callable[[Column], Column]) -> Column:
    """``function`` over the trailing ``rows`` rows; null until that many non-null values are there."""
    frame = window.rowsBetween(-(rows - 1), 0)
    return F.when(F.count(value).over(frame) == rows, function(value).over(frame))


def shift(value: str | Column, offset: int, window: WindowSpec) -> Column:
    """Value ``offset`` rows back (positive) or ahead (negative)."""
    return F.lag(value, offset).over(window) if offset >= 0 else F.lead(value, -offset).over(window)


# ---------------------------------------------------------------------------------------------------------------
# Exponential means
# ---------------------------------------------------------------------------------------------------------------


def _alpha(span: int) -> float:
    return 2.0 / (span + 1.0)


def ema_chunk_rows(spans: Sequence[int], chunk_rows: int = CHUNK_ROWS) -> int:
    """Largest chunk (at most ``chunk_rows``) whose power weights stay well inside the double range."""
    smallest = min(spans)
    if smallest < 2:
        raise ValueError("span must be at least 2")
    return max(1, min(chunk_rows, int(300.0 / -math.log(1.0 - _alpha(smallest)))))


def _step_weights(gap: Column, span: int) -> tuple[Column, Column]:
    """(log of the weight of the old mean, weight of the new value) when ``gap`` rows without value lie between.

    The old mean fades with every row, and both weights are scaled to add up to one; without a gap they are 1 - alpha
    and alpha.
    """
    alpha = _alpha(span)
    old = F.pow(F.lit(1.0 - alpha), (gap + 1).cast("double"))
    total = F.when(gap == 0, F.lit(1.0)).otherwise(old + F.lit(alpha))
    return (gap + 1).cast("double") * F.lit(math.log(1.0 - alpha)) - F.log(total), F.lit(alpha) / total


def _inside(rows: DataFrame, by: Sequence[str], value: Column, spans: Sequence[int]) -> DataFrame:
    """What the values of a row's own chunk make of a mean that starts at the chunk's first value.

    The recursion e[t] = a[t] e[t-1] + b[t] x[t] unrolls to A[t] (e[first] + sum of b[i] x[i] / A[i]) with A the running
    product of a, kept as a running sum of logarithms.
    """
    window = chunk_window(by)
    past = window.rowsBetween(Window.unboundedPreceding, -1)
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    there = value.isNotNull() & F.col(POS).isNotNull()
    rows = rows.withColumn("_there", there).withColumn("_before", F.max(F.when(there, F.col(POS))).over(past))
    gap = F.col(POS) - F.col("_before") - 1
    next_ = F.col("_there") & F.col("_before").isNotNull()
    steps = {}
    for span in spans:
        fade, fresh = _step_weights(gap, span)
        steps[f"_fade_{span}"] = F.when(next_, fade).otherwise(0.0)
        steps[f"_new_{span}"] = F.when(next_, fresh * value).otherwise(0.0)
    rows = rows.withColumns(steps)
    first = F.first(F.when(F.col("_there"), value), ignorenulls=True).over(so_far)
    rows = rows.withColumns(
        {
            "_first": first,
            "_first_at": F.min(F.when(F.col("_there"), F.col(POS))).over(so_far),
            "_last_at": F.max(F.when(F.col("_there"), F.col(POS))).over(so_far),
            **{f"_log_{span}": F.sum(f"_fade_{span}").over(so_far) for span in spans},
        }
    )
    added = {f"_add_{n}": F.sum(F.col(f"_new_{n}") * F.exp(-F.col(f"_log_{n}"))).over(so_far) for n in spans}
    return rows.withColumns(added)


def _carries(inside: DataFrame, by: Sequence[str], spans: Sequence[int], chunk_rows: int) -> DataFrame:
    """Mean of each span, and the position of the last value, before every chunk: (by.., _chunk, _carried).

    A chunk's last row tells what the chunk does to a mean that comes in. The fold over earlier chunks stops where the
    remaining weight is below the smallest positive double.
    """
    parts = ["_first", "_first_at", "_last_at", *[f"_{part}_{n}" for n in spans for part in ("log", "add")]]
    chunks = inside.groupBy(*by, CHUNK).agg(F.max_by(F.struct(*parts), POS).alias("_end"))
    reach = math.ceil(745.0 / (-math.log(1.0 - _alpha(max(spans))) * chunk_rows)) + 1
    # Chunks are counted without empty ones: however long a gap is, the mean before it is still within reach.
    before = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    filled = F.col("_end._first_at").isNotNull()
    chunks = chunks.withColumn("_done", F.coalesce(F.sum(filled.cast("long")).over(before), F.lit(0)))
    earlier = Window.partitionBy(*by).orderBy("_done").rangeBetween(-reach, -1)

    def step(state: Column, item: Column) -> Column:
        fields = []
        for n in spans:
            opened = opening(state[f"s{n}"], state["at"], item["_first"], item["_first_at"], n)
            fields.append((F.exp(item[f"_log_{n}"]) * (opened + item[f"_add_{n}"])).alias(f"s{n}"))
        return F.struct(*fields, item["_last_at"].alias("at"))

    none = F.lit(None)
    zero = F.struct(*[none.cast("double").alias(f"s{n}") for n in spans], none.cast("long").alias("at"))
    state = F.aggregate(F.collect_list(F.when(filled, F.col("_end"))).over(earlier), zero, step)
    folded = chunks.withColumn("_state", state)
    carried = [F.col(f"_state.s{n}").alias(f"s{n}") for n in spans]
    return folded.select(*by, CHUNK, F.struct(*carried, F.col("_state.at").alias("at")).alias("_carried"))


def opening(carry: Column, carried_at: Column, first: Column, first_at: Column, span: int) -> Column:
    """The mean at a chunk's first value, from the mean before the chunk (null at the start of a series)."""
    fade, fresh = _step_weights(first_at - carried_at - 1, span)
    return F.when(carry.isNull(), first).otherwise(F.exp(fade) * carry + fresh * first)


def with_ema(
    numbered: DataFrame, by: Sequence[str], value: Column, columns: Mapping[int, str], chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Adds exponential means of ``value`` to numbered rows, one per span, by name.

    The first value starts a mean; a row without value keeps it, and the old mean goes on fading meanwhile. Chunk states
    come from a pass of their own over keys, positions and values (one row per chunk leaves it), so ``numbered`` should be a
    table. The mean that comes into a chunk is a row before the chunk's first: no join deals the rows once more.
    """
    spans = list(columns)
    size = ema_chunk_rows(spans, chunk_rows)
    spread = spread_chunks(numbered, 0, 0, size)
    carries = _carries(_inside(spread, by, value, spans), by, spans, size)
    inside = _inside(spread.unionByName(carries, allowMissingColumns=True), by, value, spans)
    so_far = chunk_window(by).rowsBetween(Window.unboundedPreceding, 0)
    joined = inside.withColumn("_carried", F.first("_carried").over(so_far)).filter(F.col(POS).isNotNull())
    made = {}
    for n, name in columns.items():
        carry = F.col(f"_carried.s{n}")
        opened = opening(carry, F.col("_carried.at"), F.col("_first"), F.col("_first_at"), n)
        here = F.exp(F.col(f"_log_{n}")) * (opened + F.col(f"_add_{n}"))
        made[name] = F.when(F.col("_first_at").isNull(), carry).otherwise(here)
    return joined.withColumns(made).select(*numbered.columns, *columns.values())


def ema(
    df: DataFrame,
    by: Sequence[str],
    on: str,
    value: str,
    spans: Sequence[int],
    block_days: int = BLOCK_DAYS,
    chunk_rows: int = CHUNK_ROWS,
    prefix: str = "ema_",
) -> DataFrame:
    """Exponential means of ``value`` for several spans, exact at any length; see :func:`with_ema`."""
    numbered = stage_table(number_rows(df, by, on, block_days=block_days), "numbered")
    return with_ema(numbered, by, F.col(value), {n: f"{prefix}{n}" for n in spans}, chunk_rows).drop(POS)
