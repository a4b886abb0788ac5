"""Subtree totals of forests of any shape by parallel tree contraction.

A round rakes and compresses. Rake: every leaf hands its total to its parent and goes. Compress: in chains of nodes with one
child, nodes whose coin shows 1 and whose child's coin shows 0 go, and leave what they held on the edge to their child. Each
round is a few joins and grouped sums, and about half of a chain goes in a round, so a path of a million nodes takes some
twenty rounds. Afterwards the rounds are read backwards: a node that went in a chain has the total of its child, which went
later, plus what was its own at the time.

Coins are bits of ``level`` (a node's depth, if known: then every second node of a chain goes), and bits of a hash above that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.session import stage_path

#: Bits of the level that are used as coins, one per round.
LEVEL_BITS = 24


#: The number of the round is a column, so every round runs the same compiled code.
_COIN = f"""IF(turn < {LEVEL_BITS} AND shiftright(level, turn) > 0, shiftright(level, turn) & 1, pmod(xxhash64(node, turn), 2)) = 1"""


def _round(live: DataFrame, values: list[str]) -> DataFrame:
    """Rows of ``live`` with ``kids`` and ``fate``: leaf, chain (with ``child``) or stays (with its leaves' totals added)."""
    children = live.where("parent IS NOT NULL")
    kids = children.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("kids"))
    known = live.join(kids, "node", "left").withColumn("kids", F.coalesce("kids", F.lit(0).cast("long")))
    leaf = F.col("kids") == 0
    told = known.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
        *[F.sum(F.when(leaf, F.col(v) + F.col(f"up_{v}"))).alias(f"got_{v}") for v in values],
        # Of an only child this is the child itself.
        F.max(F.when(~leaf, F.struct("node", "kids", F.expr(_COIN).alias("coin"), *[f"up_{v}" for v in values]))).alias("child"),
    )
    chain = F.col("parent").isNotNull() & (F.col("kids") == 1) & F.col("child").isNotNull()
    beside = (F.col("child.kids") == 1) & F.col("child.coin")
    fate = F.when(leaf, "leaf").when(chain & F.expr(_COIN) & ~beside, "chain").otherwise("stays")
    return known.join(told, "node", "left").select(
        "node",
        "parent",
        "level",
        "turn",
        "kids",
        fate.alias("fate"),
        *[(F.col(v) + F.coalesce(f"got_{v}", F.lit(0))).alias(v) for v in values],
        *[f"up_{v}" for v in values],
        F.when(fate == "chain", F.col("child")).alias("child"),
    )


def _after(state: DataFrame, values: list[str]) -> DataFrame:
    """What stays; a node whose parent went in a chain hangs on its grandparent, with the parent's values on the edge."""
    moved = state.where("fate = 'chain'").select(
        F.col("child.node").alias("node"),
        F.col("parent").alias("new_parent"),
        *[(F.col(v) + F.col(f"up_{v}")).alias(f"more_{v}") for v in values],
    )
    return state.where("fate = 'stays'").join(moved, "node", "left").select(
        "node",
        F.coalesce("new_parent", "parent").alias("parent"),
        "level",
        (F.col("turn") + 1).alias("turn"),
        *values,
        *[(F.col(f"up_{v}") + F.coalesce(f"more_{v}", F.lit(0))).alias(f"up_{v}") for v in values],
    )


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """``node``, ``kids`` (children) and the sums of ``values`` (long) over each node's subtree, itself included.

    ``tree`` has ``node`` (unique, not null), ``parent`` (null for roots), ``values`` and, if known, ``level`` (long).
    """
    spark = tree.sparkSession
    level = F.col("level") if "level" in tree.columns else F.lit(0)
    zeros = [F.lit(0).cast("long").alias(f"up_{v}") for v in values]
    live = tree.select("node", "parent", level.cast("long").alias("level"), F.lit(0).alias("turn"), *values, *zeros)
    states, chains, stays = [], [], True
    while stays:
        path, seen = stage_path(spark, "contraction"), Observation()
        found = _round(live, values)
        has = [F.max(F.when(F.col("fate") == f, 1).otherwise(0)).alias(f) for f in ("stays", "chain")]
        found.observe(seen, *has).write.parquet(path)
        state = spark.read.schema(found.schema).parquet(path)
        states.append(state)
        if seen.get.get("chain"):
            chains.append(state.where("fate = 'chain'"))
        stays = seen.get.get("stays")
        live = _after(state, values)
    path = stage_path(spark, "totals")
    for state in states:
        state.where("fate = 'leaf'").select("node", *values).write.mode("append").parquet(path)
    known = spark.read.schema(tree.select("node", *values).schema)
    for chain in reversed(chains):
        later = known.parquet(path).select(F.col("node").alias("below"), *[F.col(v).alias(f"below_{v}") for v in values])
        made = chain.withColumn("below", F.col("child.node")).join(later, "below")
        made = made.select("node", *[(F.col(v) + F.col(f"child.up_{v}") + F.col(f"below_{v}")).alias(v) for v in values])
        made.write.mode("append").parquet(path)
    return known.parquet(path).join(states[0].select("node", "kids"), "node")
