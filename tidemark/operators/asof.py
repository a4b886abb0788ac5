"""As-of joins: for each left row the nearest right row in time, without row blow-up.

Left and right rows are merged per (key, calendar block) and the nearest right row is the last non-null one in
time order. The row an earlier (or, looking ahead, later) block leaves behind is copied into the following blocks,
so a key with a very long history is spread over many tasks. Each side is read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import BLOCK_DAYS, time_block

_FAR_FUTURE, _FAR_PAST = "2100-01-01", "1900-01-01"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order`` (compared left to right, nulls lowest).

    An aggregate, not a ranking window: copies of a hot key are reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ranked = [*[c for c in order if c in rest], *[c for c in rest if c not in order]]
    return df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_best")).select(*keys, "_best.*").select(*df.columns)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    direction: str = "backward",
    allow_exact: bool = True,
    ties: Sequence[str] = (),
    prefer: Sequence[str] | None = None,
    how: str = "left",
    right_unique: bool = False,
    block_days: int = BLOCK_DAYS,
    salts: int = 1,
) -> DataFrame:
    """Attach to every left row the nearest right row of the same key.

    direction     ``backward``: right_on before left_on; ``forward``: after it.
    allow_exact   whether an equal date matches.
    ties          right columns that decide between rows of one (key, right_on): the greatest wins, then the
                  remaining columns, so the result does not depend on row order.
    prefer        when given, the greatest right row by these columns among all rows in reach wins, not the nearest.
    how           ``left`` keeps unmatched left rows with nulls, ``inner`` drops them.
    right_unique  the right side has one row per (key, right_on) already.
    salts         ways to split the left rows of one (key, block), for a left side with very many rows per key and
                  day; the right rows are copied that often.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"unknown direction {direction!r}")
    if how not in ("left", "inner"):
        raise ValueError(f"unknown join type {how!r}")
    keys = list(by)
    payload = [c for c in right.columns if c not in keys]
    clash = set(payload) & set(left.columns)
    if clash:
        raise ValueError(f"column on both sides: {sorted(clash)}")
    backward = direction == "backward"

    def order(column: str) -> Column:
        return F.col(column).asc_nulls_first() if backward else F.col(column).desc_nulls_first()

    def block(column: str) -> Column:
        return _bounded_block(column, block_days, backward)

    usable = right.dropna(subset=[*keys, right_on])
    unique = usable if right_unique else latest_per_key(usable, [*keys, right_on], prefer or ties)
    packed = [*(prefer or []), *[c for c in payload if c not in (prefer or [])]]
    matches = unique.select(
        *keys, block(right_on).alias("_block"), F.col(right_on).alias("_on"), F.struct(*packed).alias("_match")
    )
    spread = _spread_matches(matches, keys, order, backward, bool(prefer), block_days)
    spread = spread.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))) if salts > 1 else F.lit(0))
    # A left row without a date finds nothing.
    rows = left.select(
        *keys,
        block(left_on).alias("_block"),
        F.col(left_on).alias("_on"),
        F.struct(*[F.col(c) for c in left.columns]).alias("_row"),
        (F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int") if salts > 1 else F.lit(0)).alias("_salt"),
    )
    # Rank at one date: a match counts for left rows behind it, so inclusive matches come first.
    match_rank, row_rank = (0, 1) if allow_exact else (1, 0)
    merged = spread.withColumn("_side", F.lit(match_rank)).unionByName(
        rows.withColumn("_side", F.lit(row_rank)), allowMissingColumns=True
    )
    seen = (
        Window.partitionBy(*keys, "_block", "_salt")
        .orderBy(order("_on"), F.col("_side"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    pick = F.max("_match") if prefer else F.last("_match", ignorenulls=True)
    joined = merged.withColumn("_found", pick.over(seen)).filter(F.col("_row").isNotNull())
    dated = F.col("_on").isNotNull()
    if how == "inner":
        joined = joined.filter(F.col("_found").isNotNull() & dated)
    found = [F.when(dated, F.col("_found").getField(c)).alias(c) for c in payload]
    return joined.select("_row.*", *found)


def _bounded_block(column: str, block_days: int, backward: bool) -> Column:
    """Calendar block, with everything beyond the far bound in one last block.

    The bound only limits how many blocks a carried row is copied to; dates beyond it are still matched exactly.
    """
    index = time_block(column, block_days)
    far = time_block(F.lit(_FAR_FUTURE if backward else _FAR_PAST).cast("date"), block_days)
    return F.when(F.col(column).isNotNull(), F.least(index, far) if backward else F.greatest(index, far))


def _spread_matches(
    matches: DataFrame, keys: list[str], order, backward: bool, running: bool, block_days: int
) -> DataFrame:
    """Right rows in their own block, and each block's outgoing row copied into the blocks that follow it.

    A block's last row is copied up to the next block that has rows of its own: that block's early left rows still
    need it. Copies have a null ``_on``, which sorts before every date of their block.
    """
    inside = Window.partitionBy(*keys, "_block").orderBy(order("_on"))
    marked = matches.withColumn("_is_edge", F.lead("_on").over(inside).isNull())
    if running:
        whole = Window.partitionBy(*keys, "_block")
        marked = marked.withColumn("_edge", F.max("_match").over(whole))
    # All edges of a key meet in one group, at most one row per block; other rows stay with their block.
    group = F.when(F.col("_is_edge"), F.lit(None)).otherwise(F.col("_block"))
    across = Window.partitionBy(*keys, "_is_edge", "_group").orderBy(order("_block"))
    linked = marked.withColumn("_group", group).withColumn("_next", F.lead("_block").over(across))
    if running:
        so_far = F.max("_edge").over(across.rowsBetween(Window.unboundedPreceding, 0))
        linked = linked.withColumn("_edge", so_far)
    else:
        linked = linked.withColumn("_edge", F.col("_match"))
    far = time_block(F.lit(_FAR_FUTURE if backward else _FAR_PAST).cast("date"), block_days)
    step = 1 if backward else -1
    start, stop = F.col("_block") + step, F.coalesce("_next", far)
    reaches = start <= stop if backward else start >= stop
    own = F.array(F.struct("_block", "_on", "_match"))
    copies = F.transform(
        F.sequence(start, stop, F.lit(step)),
        lambda b: F.struct(
            b.alias("_block"), F.lit(None).cast(matches.schema["_on"].dataType).alias("_on"), F.col("_edge").alias("_match")
        ),
    )
    placed = F.when(F.col("_is_edge") & reaches, F.concat(own, copies)).otherwise(own)
    return linked.select(*keys, F.explode(placed).alias("_placed")).select(*keys, "_placed.*")


def known_on(vintages: DataFrame, day: str | Column, current_only: bool = False) -> DataFrame:
    """Rows already published on ``day``; with ``current_only`` only those not yet replaced."""
    when = F.to_date(F.lit(day)) if isinstance(day, str) else day
    published = vintages.filter(F.col("realtime_start") <= when)
    return published.filter(F.col("realtime_end") >= when) if current_only else published
