"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints that differ in few bits are found by partitions of the 64 bits. Correlated bits go to the same partition; every
partition has its own threshold, and the thresholds only have to add up so that two close fingerprints must agree within the
threshold of at least one partition. Dynamic programming picks the number of partitions and the thresholds with the least
estimated work, from the distances that blocks of four bits show over all fingerprints. Each fingerprint is entered under its
value in each partition and probes the values within the threshold; what meets is verified on all bits.

Only distinct fingerprints are linked, so exact copies cost one entry. A value that many fingerprints share is split into
tiles, and a task passes on the links of a spanning forest, not every pair.

Defined cases: a text without words (or null) has fingerprint zero and is linked like any other; a text with fewer words than
a shingle is one shingle; repeated rows keep one result row each; a null id takes part but is never a component id; other
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts_of
from tidemark.llm.components import components
from tidemark.session import stage_table

BITS, BLOCK_BITS = 64, 4
#: Entries of one value compared by one task; larger values are split into tiles of two such blocks.
BLOCK = 2_048
#: Entries a task compares at a time, and cost of an entry against that of a comparison.
CHUNK, ENTRY_COST = 200_000, 250.0


def fingerprint(text: bytes, words: int, seed: int) -> int:
    parts = text.lower().split()  # bytes: lowers A-Z only, splits at the six ASCII spaces only
    if not parts:
        return 0
    joined = b" ".join(parts)
    starts = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
    count = max(1, len(parts) - words + 1)
    ends = (starts[min(words, len(parts)) :] - 1).tolist()
    digest = xxhash.xxh64_digest
    total = np.zeros(BITS, np.int64)
    begin = starts.tolist()
    for at in range(0, count, 1 << 16):
        hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(begin[at : min(at + (1 << 16), count)], ends[at:])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * total > count).tobytes(), "big", signed=True)


def fingerprints(
    docs: DataFrame, words: int = 4, seed: int = 42, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, fp``: a bit is set if it is set in over half of the XXH64 hashes of the text's word shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text, words, seed) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    rows = texts_of(docs, id_column, text_column, binary=True)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def _bits(batch: pa.RecordBatch) -> np.ndarray:
    """Rows of 64 zeros and ones; column b is bit b."""
    values = batch.column("fp").to_numpy(zero_copy_only=False).astype("<i8")
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _summed(fps: DataFrame, count, size: int) -> np.ndarray:
    """Sum over all rows of the ``size`` counts that ``count`` makes of a batch; each task passes on one row per count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += count(_bits(batch)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["cell", "n"])

    out = np.zeros(size, np.int64)
    for cell, n in fps.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():
        out[cell] = n
    return out


def bit_order(fps: DataFrame) -> list[int]:
    """The 64 bits in a chain in which each is followed by the one it correlates with most."""
    together = _summed(fps, lambda bits: (b := bits.astype(np.int64)).T @ b, BITS * BITS).reshape(BITS, BITS).astype(float)
    ones = np.diag(together)
    n = max(1, fps.count())
    spread = np.sqrt(np.maximum(ones * (n - ones), 1.0))
    close = np.abs(n * together - np.outer(ones, ones)) / np.outer(spread, spread)
    order, left = [0], set(range(1, BITS))
    while left:
        order.append(max(sorted(left), key=lambda b: close[order[-1], b]))
        left.remove(order[-1])
    return order


def block_distances(fps: DataFrame, order: list[int]) -> np.ndarray:
    """For each block of the order, the share of fingerprint pairs that differ in 0, 1, .. bits there."""
    blocks, values = BITS // BLOCK_BITS, 1 << BLOCK_BITS

    def count(bits: np.ndarray) -> np.ndarray:
        value = bits[:, order].reshape(len(bits), blocks, BLOCK_BITS) @ (1 << np.arange(BLOCK_BITS))
        return np.stack([np.bincount(value[:, b], minlength=values) for b in range(blocks)])

    share = _summed(fps, count, blocks * values).reshape(blocks, values).astype(float)
    share /= np.maximum(share.sum(axis=1, keepdims=True), 1.0)
    apart = np.bitwise_count(np.arange(values)[:, None] ^ np.arange(values))
    return np.array([[p @ (apart == d) @ p for d in range(BLOCK_BITS + 1)] for p in share])


def allocate(distances: np.ndarray, order: list[int], count: int, limit: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition in use: the cheapest whose thresholds plus one add up to ``limit`` plus one.

    If a pair differed by more than its threshold in every partition, it would differ in over ``limit`` bits.
    """
    best_cost, best = np.inf, []
    for parts in range(1, limit + 2):
        edges = np.linspace(0, len(distances), parts + 1).round().astype(int)
        cells = [range(a, b) for a, b in zip(edges, edges[1:])]
        cost = np.full((parts, limit + 2), np.inf)
        for i, cell in enumerate(cells):
            apart = np.ones(1)
            for block in cell:
                apart = np.convolve(apart, distances[block])
            width = len(cell) * BLOCK_BITS
            cost[i, 0] = 0.0  # threshold -1: not used
            for t in range(0, min(limit, 3) + 1):
                probes = 1 + sum(comb(width, d) for d in range(1, t + 1)) / 2
                cost[i, t + 1] = count * probes * ENTRY_COST + count * count / 2 * apart[: t + 1].sum()
        total, choice = np.full(limit + 2, np.inf), []
        total[0] = 0.0
        for i in range(parts):
            new, pick = np.full(limit + 2, np.inf), np.zeros(limit + 2, int)
            for s in range(limit + 2):
                for u in range(s + 1):
                    if total[s - u] + cost[i, u] < new[s]:
                        new[s], pick[s] = total[s - u] + cost[i, u], u
            total = new
            choice.append(pick)
        if total[limit + 1] < best_cost:
            best_cost, left, chosen = total[limit + 1], limit + 1, []
            for i in reversed(range(parts)):
                used = int(choice[i][left])
                left -= used
                if used:
                    chosen.append(([order[b * BLOCK_BITS + k] for b in cells[i] for k in range(BLOCK_BITS)], used - 1))
            best = chosen[::-1]
    return best


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def entries(fps: DataFrame, partitions: list[tuple[list[int], int]]) -> DataFrame:
    """``fp, probe, bucket``: each fingerprint under its value in each partition, and as a probe under the larger values within
    the partition's threshold (of two values within it, the smaller one probes)."""
    looks = []
    for part, (bits, threshold) in enumerate(partitions):
        mask = sum(1 << b for b in bits)
        for size in range(threshold + 1):
            for flips in combinations(bits, size):
                looks.append((part, _signed(mask), _signed(sum(1 << b for b in flips))))
    look = F.explode(F.array(*[F.struct(F.lit(p).alias("part"), F.lit(m).alias("mask"), F.lit(f).alias("flip")) for p, m, f in looks]))
    rows = fps.select("fp", look.alias("look")).select("fp", "look.*")
    own = F.col("fp").bitwiseAND(F.col("mask"))
    value = own.bitwiseXOR(F.col("flip"))
    return rows.where((F.col("flip") == 0) | (value > own)).select(
        "fp", (F.col("flip") != 0).alias("probe"), F.xxhash64("part", value).alias("bucket")
    )


def tiles(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Splits buckets of over two blocks: each row goes to the tiles its block shares with every other block."""
    large = rows.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 2 * block)
    large = large.select("bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    every = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.xxhash64("bucket", F.least(F.col("own"), other), F.greatest(F.col("own"), other)),
    )
    return (
        rows.join(large, "bucket", "left")
        .withColumn("own", own)
        .withColumn("bucket", F.explode(F.coalesce(every, F.array("bucket"))))
        .select("bucket", "fp", "probe")
    )


def _forest(fps: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, representative) of the linked rows: as few links as keep their components."""
    nodes, ends = np.unique(np.concatenate([fps[a], fps[b]]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def close_pairs(bucket: np.ndarray, fps: np.ndarray, probe: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of one bucket, not both probes, that differ in at most ``limit`` bits. Rows are sorted by bucket."""
    stops = np.searchsorted(bucket, bucket, side="right")
    bits = fps.view(np.uint64)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    at, step = np.nonzero(stops - np.arange(len(bucket)) > 1)[0], 1
    while len(at):
        other = at + step
        hit = (np.bitwise_count(bits[at] ^ bits[other]) <= limit) & ~(probe[at] & probe[other])
        left.append(at[hit])
        right.append(other[hit])
        step += 1
        at = at[at + step < stops[at]]
    return np.concatenate(left), np.concatenate(right)


def links(rows: DataFrame, limit: int) -> DataFrame:
    """``a, b``: links that keep the components of all verified pairs of every bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(held: list[np.ndarray]) -> pa.RecordBatch:
            a, b = close_pairs(*held, limit)
            node, top = _forest(held[1], a, b) if len(a) else (held[1][:0], held[1][:0])
            return pa.RecordBatch.from_arrays([pa.array(node), pa.array(top)], names=["a", "b"])

        held = None
        for batch in batches:
            own = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "fp", "probe")]
            held = own if held is None else [np.concatenate(x) for x in zip(held, own)]
            if len(held[0]) >= CHUNK:
                cut = np.searchsorted(held[0], held[0][-1])  # the last bucket may go on
                if cut:
                    yield found([x[:cut] for x in held])
                    held = [x[cut:] for x in held]
        if held is not None and len(held[0]):
            yield found(held)

    return (
        rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "a long, b long").where("a <> b").distinct()
    )


def near_duplicates(
    docs: DataFrame,
    words: int = 4,
    limit: int = 4,
    seed: int = 42,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, fp, component_id`` of every row: the smallest id reachable over links of ``limit`` or fewer differing bits."""
    rows = stage_table(fingerprints(docs, words, seed, id_column, text_column), "fingerprints")
    classes = stage_table(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    order = bit_order(classes)
    partitions = allocate(block_distances(classes, order), order, max(1, classes.count()), limit)
    found = components(links(tiles(entries(classes, partitions)), limit))
    named = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(smallest, "component").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")
