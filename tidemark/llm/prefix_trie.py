"""Trie of the shared beginnings of conversations.

Turns shrink at once to a digest and a length; texts are never shuffled. Turns are numbered by a sort in ranges of
(conversation, turn), so a conversation of any length is dealt to many tasks, with the counts of earlier ranges added. A
prefix is named by 128 bits: the exclusive or of two 64-bit hashes of (place, digest) over its turns, which adds up over blocks
of a conversation like a count does. Nodes are the distinct names; totals over subtrees come from :mod:`contraction`.

Defined cases: turns are ordered by number (null first), those of equal number by the digest of role and text, repeated turns
count each time; a null role or text is empty; turns without a conversation are left out; no conversations give an empty
table, else there is always a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.contraction import subtree_totals
from tidemark.session import stage_table

#: Rows of a block of a conversation, and ids that one string of ends joins.
BLOCK, ENDS = 4096, 50_000


def numbered(
    turns: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, digest, chars, at from 0) and conversations (conv_id, total)."""
    role, text = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in (role_column, text_column))
    rows = turns.select(
        turns[conv_column].cast("long").alias("conv_id"),
        turns[turn_column].alias("turn"),
        F.unhex(F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text).cast("binary"), 256)).alias("digest"),
        F.length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row"),  # only spreads rows that are equal
    ).where("conv_id IS NOT NULL")
    order = [F.col("turn").asc_nulls_first(), F.col("digest"), F.col("row")]
    dealt = rows.repartitionByRange(F.col("conv_id"), *order)
    dealt = stage_table(dealt.withColumn("part", F.spark_partition_id()), "turns")
    counts = dealt.groupBy("conv_id", "part").count()
    # One row per conversation and range: at most as many in a window as there are ranges.
    by_part = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select("conv_id", "part", F.coalesce(F.sum("count").over(by_part), F.lit(0)).alias("carried"))
    inside = Window.partitionBy("conv_id", "part").orderBy(*order)
    made = dealt.withColumn("at", F.row_number().over(inside) - 1).join(carried, ["conv_id", "part"])
    made = made.select("conv_id", "digest", "chars", (F.col("at") + F.col("carried")).alias("at"))
    return made, counts.groupBy("conv_id").agg(F.sum("count").alias("total"))


def rebuilt(turns: DataFrame, conversations: DataFrame, base: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first ``head`` turns of ``base`` and go on with their own turns after as many.

    Returns turns (conv_id, digest, chars, at, last) and conversations (conv_id, length).
    """
    known = conversations.withColumns({"base": base, "head": head})
    sizes = conversations.select(F.col("conv_id").alias("base"), F.col("total").alias("base_total"))
    known = known.join(sizes, "base", "left").withColumn("shared", F.least("head", F.coalesce("base_total", F.lit(0))))
    known = known.withColumn("length", F.col("shared") + F.greatest(F.col("total") - F.col("head"), F.lit(0)))
    known = stage_table(known.select("conv_id", "base", "head", "shared", "length"), "conversations")
    own = turns.join(known, "conv_id").where("at >= head").withColumn("at", F.col("at") - F.col("head") + F.col("shared"))
    # Only bases are joined, and of these only their beginnings.
    first = turns.join(known.select(F.col("base").alias("conv_id"), "head").groupBy("conv_id").agg(F.max("head").alias("most")), "conv_id")
    first = first.where("at < most").select(F.col("conv_id").alias("base"), "digest", "chars", "at")
    begun = known.join(first, "base").where("at < head")
    columns = ["conv_id", "digest", "chars", "at", (F.col("at") + 1 == F.col("length")).alias("last")]
    return own.select(*columns).unionByName(begun.select(*columns)), known.select("conv_id", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """Each turn as the end of a prefix: conv_id, depth, node, parent, chars, last."""
    at = F.col("at").cast("long")
    hashed = turns.select(
        "conv_id",
        "chars",
        "last",
        at.alias("at"),
        F.floor(at / BLOCK).alias("block"),
        F.xxhash64(at, "digest").alias("a"),
        F.xxhash64("digest", at, F.lit(1)).alias("b"),
    )
    hashed = stage_table(hashed, "hashed-turns")
    blocks = hashed.groupBy("conv_id", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(
        "conv_id", "block", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).cast("long").alias(f"{c}0") for c in "ab"]
    )
    so_far = Window.partitionBy("conv_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    summed = hashed.withColumns({f"{c}1": F.bit_xor(c).over(so_far) for c in "ab"}).join(carried, ["conv_id", "block"])
    name = {c: F.col(f"{c}1").bitwiseXOR(F.col(f"{c}0")) for c in "ab"}
    return summed.select(
        "conv_id",
        (F.col("at") + 1).alias("depth"),
        F.struct(name["a"].alias("a"), name["b"].alias("b")).alias("node"),
        F.struct(*[name[c].bitwiseXOR(F.col(c)).alias(c) for c in "ab"]).alias("parent"),
        "chars",
        "last",
    )


def ends_digest(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ids of each node (node, conv_id).

    Ids are sorted in ranges and joined to strings of bounded length, which are then hashed in order as they stream by.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(key, ids):
            text = ",".join(map(str, ids)).encode()
            return pa.RecordBatch.from_pydict({"a": [key[0]], "b": [key[1]], "first": [ids[0]], "ids": [text]}, schema=chunk)

        chunk = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("ids", pa.binary())])
        key, ids, full = None, [], []
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("a", "b", "conv_id")))
            for now, group in groupby(rows, key=lambda r: r[:2]):
                found = [r[2] for r in group]
                if now != key and ids:
                    full.append(packed(key, ids))
                    ids = []
                key = now
                ids += found
                if len(ids) >= ENDS:
                    full.append(packed(key, ids))
                    ids = []
            if full:
                yield pa.Table.from_batches(full).combine_chunks().to_batches()[0]
                full = []
        if ids:
            yield packed(key, ids)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
                if (a, b) != key:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = (a, b), hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
            yield pa.RecordBatch.from_pydict(dict(zip(("a", "b", "sha"), map(list, zip(*done)))) if done else {"a": [], "b": [], "sha": []}, schema=out)
            done = []
        if key:
            yield pa.RecordBatch.from_pydict({"a": [key[0]], "b": [key[1]], "sha": [state.hexdigest()]}, schema=out)

    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sha", pa.string())])
    rows = ends.select("node.a", "node.b", "conv_id")
    strings = rows.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    strings = strings.mapInArrow(joined, "a long, b long, first long, ids binary")
    shas = strings.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(hashed, "a long, b long, sha string")
    return shas.select(F.struct("a", "b").alias("node"), "sha")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per distinct beginning, from :func:`rebuilt`'s turns (conv_id, digest, chars, at, last) and conversations.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    root = F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    paths = stage_table(prefixes(turns), "prefixes")
    nodes = paths.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max("parent").alias("parent"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("chars").alias("chars"),
    )
    top = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    top = top.select(
        root.alias("node"), "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("struct<a:bigint,b:bigint>").alias("parent"), "n_convs", F.lit(0).cast("long").alias("chars")
    )
    nodes = stage_table(nodes.unionByName(top), "nodes")
    inner = nodes.where("parent IS NOT NULL").select(F.col("parent").alias("node")).distinct().withColumn("inner", F.lit(True))
    tree = nodes.join(inner, "node", "left").select(
        "node",
        "parent",
        F.col("depth").alias("level"),
        F.when(F.col("inner").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"])
    ends = paths.where("last").select("node", "conv_id").unionByName(conversations.where("length = 0").select(root.alias("node"), "conv_id"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(parents, "parent", "left").join(totals, "node").join(ends_digest(ends), "node", "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.col("kids").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
