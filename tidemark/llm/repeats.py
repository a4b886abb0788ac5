"""Passages that repeat across or within texts, by prefix-partitioned suffix trees.

A window is ``width`` consecutive words; a word goes if any window over it starts anywhere else as well.

Suffixes are not shipped from every position. A window's anchor is its smallest hashed 8-gram: equal windows have equal
anchors at equal offsets, and about one position in fourteen is an anchor. A prefix, the 8-gram at an anchor, that occurs once
cannot be part of a repeat. Equal surroundings of a prefix are counted before any text is shuffled, so a passage that a third
of all texts share, or a text with thousands of copies, comes to a few rows; surroundings that occur twice make all their
windows repeats. The different surroundings of a repeated prefix form a group. Groups are cut to what a task holds by prefixes
of variable length: a group with too many surroundings is split into the windows that begin near the anchor and those that
begin further before it. All windows of a half share more words than the 8 of the anchor, and these make the longer prefix;
parts that are still too large are halved again (8, 22, 29, 32, 34 words), and what agrees in all words of a window is one node
without sorting.

In a group the suffixes that begin at the windows over the anchor are sorted; the common prefixes of neighbours give the inner
nodes of the suffix tree. Nodes at least ``width`` words deep are the repeats: each window at which a suffix below such a node
begins occurs elsewhere too.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, compared as they are. Defined cases: a null text, an empty one or one of
white space has no words and keeps the empty text; texts under ``width`` words keep all words; repeated rows are copies of each
other; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, slices, texts_of
from tidemark.session import stage_path, stage_table

WIDTH, PREFIX = 35, 8
#: Different surroundings of one prefix that one task sorts; groups of more are split by longer prefixes.
GROUP = 4_096
#: Bytes of a text that are hashed at once; longer texts go in parts that end at white space where they can.
PART = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


#: A number for each byte, none of them zero.
_BYTES = _mixed(_powers(_ODD, 257)[1:])
_STEPS, _BACK = _powers(_ODD, PART), _powers(_INVERSE, PART)
_WHITE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))


def _inside(codes: np.ndarray) -> np.ndarray:
    """Hash of every word of a part, from running sums over its bytes."""
    edges = np.flatnonzero(np.diff(_WHITE[codes], prepend=True, append=True))
    first, stop = edges[::2], edges[1::2]
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_BYTES[codes] * _STEPS[: len(codes)], out=sums[1:])
    return _mixed((sums[stop] - sums[first]) * _BACK[first])


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of every word of a text."""
    codes, found, at = np.frombuffer(text, np.uint8), [], 0
    while len(codes) - at >= PART:
        white = np.flatnonzero(_WHITE[codes[at : at + PART]])
        if len(white):
            found.append(_inside(codes[at : at + int(white[-1])]))
            at += int(white[-1]) + 1
        else:  # a word at least as long as a part has a hash of another kind wherever it stands
            later = np.flatnonzero(_WHITE[codes[at + PART :]])
            stop = at + PART + int(later[0]) if len(later) else len(codes)
            found.append(np.array([xxhash.xxh3_64_intdigest(text[at:stop])], np.uint64))
            at = stop
    found.append(_inside(codes[at:]))
    return np.concatenate(found)


class Prints:
    """Hash of any run of words of a text in constant time, from running sums."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * (_STEPS[:n] if n <= PART else _powers(_ODD, n)), out=self.sums[1:])
        self.back = _BACK[: n + 1] if n < PART else _powers(_INVERSE, n + 1)

    def runs(self, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[stop] - self.sums[first]) * self.back[first])


def anchors(hashes: np.ndarray, width: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, prefix hash, hash of the surroundings) of the smallest prefixes of all windows of words with such hashes."""
    n = len(hashes)
    prints = Prints(hashes)
    starts = np.arange(n - prefix + 1)
    grams = prints.runs(starts, starts + prefix)
    # Smallest 8-gram of each window, leftmost among equal ones, by doubling the span.
    least, at, span, reach = grams, starts, 1, width - prefix + 1
    while span < reach:
        step = min(span, reach - span)
        later = least[step:] < least[:-step]
        at = np.where(later, at[step:], at[:-step])
        least = np.where(later, least[step:], least[:-step])
        span += step
    position = np.unique(at)
    left = np.maximum(position - (width - prefix), 0)
    around = prints.runs(left, np.minimum(position + width, n))
    return position, grams[position], _mixed(around + (position - left).astype(np.uint64))


def _text_table(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``rid, key, doc_id, words``: the texts, in buckets by row, so that later joins leave them in place. Copies share a key."""
    spark = prepare(docs.sparkSession)
    rows = texts_of(docs, id_column, text_column, binary=True)
    rows = rows.select(F.monotonically_increasing_id().alias("rid"), F.unhex(F.sha2("text", 256)).alias("key"), "doc_id", F.col("text").alias("words"))
    name, buckets = f"texts_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = rows.repartition(buckets, "rid").write.bucketBy(buckets, "rid").option("path", stage_path(spark, name))
    made.saveAsTable(name, format="parquet")
    return spark.table(name)


def _anchor_rows(texts: DataFrame, width: int, prefix: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            parts = [[], [], [], []]
            for rid, text in zip(batch.column("rid").to_pylist(), batch.column("words")):
                hashes = word_hashes(text.as_py())
                if len(hashes) >= width:
                    position, gram, around = anchors(hashes, width, prefix)
                    for part, own in zip(parts, (gram, around, np.full(len(position), rid), position)):
                        part.append(own)
            columns = [np.concatenate(p) if p else np.empty(0) for p in parts]
            kinds = (np.uint64, np.uint64, np.int64, np.int32)
            columns = [c.astype(k) for c, k in zip(columns, kinds)]
            columns = [c.view(np.int64) if c.dtype == np.uint64 else c for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "around", "rid", "pos"])

    return texts.select("rid", "words").mapInArrow(run, "h long, around long, rid long, pos int")


def _surroundings(texts: DataFrame, wanted: DataFrame, width: int, prefix: int) -> DataFrame:
    """``h, around, left, words``: the words around each wanted anchor, ``left`` of them before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [[], [], [], []]
            for text, at in zip(batch.column("words"), batch.column("at").to_pylist()):
                words = text.as_py().split()
                for a in at:
                    left = max(0, a["pos"] - (width - prefix))
                    own = (a["h"], a["around"], a["pos"] - left, b" ".join(words[left : a["pos"] + width]))
                    for part, value in zip(out, own):
                        part.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(p, k) for p, k in zip(out, kinds)], names=["h", "around", "left", "words"])

    # Gathered by text; the bucketed side is not shuffled.
    gathered = wanted.groupBy("rid").agg(F.collect_list(F.struct("h", "around", "pos")).alias("at"))
    rows = texts.join(gathered, "rid").select("words", "at")
    return rows.mapInArrow(run, "h long, around long, left int, words binary")


def window_suffixes(left: int, words: bytes, width: int, low: int, high: int) -> Iterator[tuple[int, bytes]]:
    """(words before the anchor, the suffix) at the start of every window that begins ``low`` to ``high`` words before an anchor;
    each word ends with a space."""
    parts = words.split(b" ")
    ends = np.cumsum([len(p) + 1 for p in parts]).tolist()
    for before in range(low, min(left, high) + 1):
        first = left - before
        if first + width <= len(parts):
            yield before, words[(ends[first - 1] if first else 0) :] + b" "


def _common(a: bytes, b: bytes) -> int:
    """Words that two suffixes have in common at their beginnings."""
    low, high = 0, min(len(a), len(b))
    if a[:high] != b[:high]:
        while low + 1 < high:
            middle = (low + high) // 2
            if a[low:middle] == b[low:middle]:
                low = middle
            else:
                high = middle
        high = low if a[:high] != b[:high] else high
    return a.count(b" ", 0, high)


def internal_nodes(suffixes: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
    """(depth in words, depth of the parent, first, stop) of every inner node of the tree over sorted suffixes."""
    stack = [(0, 0)]  # (depth, first leaf) of the nodes on the path to the last leaf
    for at in range(1, len(suffixes) + 1):
        depth = _common(suffixes[at - 1], suffixes[at]) if at < len(suffixes) else 0
        first = at - 1
        while stack[-1][0] > depth:
            below, first = stack.pop()
            yield below, max(depth, stack[-1][0]), first, at
        if stack[-1][0] < depth:
            stack.append((depth, first))


def deep_nodes(group: list[tuple[int, bytes]], width: int, low: int, high: int) -> list[int]:
    """For each (left, words) around one prefix, a bit for every window that begins ``low`` to ``high`` words before it and below
    a node of its depth."""
    masks = [0] * len(group)
    by_offset: dict[int, list[tuple[bytes, int]]] = {}
    for row, (left, words) in enumerate(group):
        for before, suffix in window_suffixes(left, words, width, low, high):
            by_offset.setdefault(before, []).append((suffix, row))
    for before, leaves in by_offset.items():
        if len(leaves) < 2:
            continue
        leaves.sort()
        for depth, above, first, stop in internal_nodes([suffix for suffix, _ in leaves]):
            if depth >= width > above:  # nodes below it have the same leaves again
                for _, row in leaves[first:stop]:
                    masks[row] |= 1 << before
    return masks


def _grouped(rows: DataFrame, key: str, masks_of) -> DataFrame:
    """``h, around, mask`` of each group of rows with one key; a group is what ``masks_of(rows)`` gets at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(group: list[dict]) -> pa.RecordBatch:
            out = ([], [], [])
            for row, mask in zip(group, masks_of(group)):
                if mask:
                    for part, value in zip(out, (row["h"], row["around"], mask)):
                        part.append(value)
            return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in out], names=["h", "around", "mask"])

        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0][key] != row[key]:
                    yield found(held)
                    held = []
                held.append(row)
        if held:
            yield found(held)

    return rows.repartition(key).sortWithinPartitions(key).mapInArrow(run, "h long, around long, mask long")


def _trees(around: DataFrame, width: int, prefix: int) -> DataFrame:
    """``h, around, mask`` from one tree per prefix."""
    return _grouped(around, "h", lambda group: deep_nodes([(r["left"], r["words"]) for r in group], width, 0, width - prefix))


def halves(left: int, words: bytes, width: int, low: int, high: int) -> Iterator[tuple[int, int, int, bytes, bytes]]:
    """(low, high, words before the anchor, all words, the words that they share) of the windows in both halves of a range of
    offsets, where a window begins."""
    parts = words.split(b" ")
    middle = (low + high) // 2
    for a, b in ((low, middle), (middle + 1, high)):
        if max(a, left + width - len(parts)) <= min(b, left):
            every, shared = parts[max(left - b, 0) : left - a + width], parts[left - a : left + width - b]
            yield a, b, min(b, left), b" ".join(every), b" ".join(shared)


def _split_trees(around: DataFrame, width: int, prefix: int, group: int) -> list[DataFrame]:
    """The same for prefixes with many surroundings: ranges of offsets are halved, which makes prefixes longer, until a part fits.

    A row keeps no words but those of the windows in its range. Rows of a range with equal words are settled at once, whatever
    the size of their part: all their windows repeat, and one row of them goes on for the others. So of a passage that very many
    texts share only the ranges go on in which it begins or ends.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = ([], [], [], [], [], [], [])
            for row in batch.to_pylist():
                for low, high, left, words, shared in halves(row["left"], row["words"], width, row["low"], row["high"]):
                    name = b"%d %d %b" % (row["h"], low, shared)
                    own = (row["h"], row["around"], left, words, low, high, xxhash.xxh3_128_digest(name))
                    for part, value in zip(out, own):
                        part.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
            names = ["h", "around", "left", "words", "low", "high", "part"]
            yield pa.RecordBatch.from_arrays([pa.array(p, k) for p, k in zip(out, kinds)], names=names)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A mask for rows with repeats; words as well for those of a part that is too large for a tree and is to be split again.

        Rows of a part lie together, and in it those with equal words. No more than a group of different ones is held: once a
        part has more, they pass on as they come.
        """
        held: list[dict] = []
        now, large = None, False

        def every(row: dict) -> int:
            least = max(row["low"], row["left"] + width - row["words"].count(b" ") - 1)
            return (2 << min(row["high"], row["left"])) - (1 << least)

        def out(rows: list[tuple[dict, int, bool]]) -> pa.RecordBatch:
            columns = [pa.array([r[f.name] if g or f.name in ("h", "around") else None for r, _, g in rows], f.type) for f in fields]
            masks = pa.array([mask or None for _, mask, _ in rows], pa.int64())
            return pa.RecordBatch.from_arrays([*columns, masks], names=[*(f.name for f in fields), "mask"])

        def of_held() -> list[tuple[dict, int, bool]]:
            if large:
                return [(r, r["mask"], True) for r in held]
            masks = deep_nodes([(r["left"], r["words"]) for r in held], width, held[0]["low"], held[0]["high"]) if len(held) > 1 else [0]
            return [(r, r["mask"] | mask, False) for r, mask in zip(held, masks) if r["mask"] | mask]

        for batch in slices(batches):
            done = []
            for row in batch.to_pylist():
                if row["part"] != now:
                    if held:
                        done += of_held()
                    held, now, large = [], row["part"], False
                elif (row["left"], row["words"]) == (held[-1]["left"], held[-1]["words"]):
                    held[-1]["mask"] = every(row)
                    done.append((row, every(row), False))
                    continue
                if large:  # the last one is held while equal ones may follow
                    done += of_held()
                    held = []
                held.append(row | {"mask": 0})
                large = large or len(held) > max(group, 1)
            if done:
                yield out(done)
        if held:
            yield out(of_held())

    schema = "h long, around long, left int, words binary, low int, high int, part binary"
    kept = {"h": pa.int64(), "around": pa.int64(), "left": pa.int32(), "words": pa.binary(), "low": pa.int32(), "high": pa.int32()}
    fields = [pa.field(n, k) for n, k in kept.items()]
    judged_schema = "h long, around long, left int, words binary, low int, high int, mask long"
    rest, span, found = around.withColumns({"low": F.lit(0), "high": F.lit(width - prefix)}), width - prefix + 1, []
    while span > 1:
        parts = rest.mapInArrow(split, schema).repartition("part").sortWithinPartitions("part", "left", "words")
        judged, span = stage_table(parts.mapInArrow(judge, judged_schema), "halves"), -(-span // 2)
        found.append(judged.where("mask IS NOT NULL").select("h", "around", "mask"))
        rest = judged.where("words IS NOT NULL").drop("mask")
        if rest.isEmpty():
            break
    return found


def _covered(pos: np.ndarray, mask: np.ndarray, n: int, width: int, prefix: int) -> np.ndarray:
    """Which of ``n`` words the marked windows over the anchors at ``pos`` cover."""
    if not len(pos):
        return np.zeros(n, bool)
    before = np.arange(width - prefix + 1)
    first = pos[:, None].astype(np.int64) - before
    first = first[(mask[:, None] >> before & 1 > 0) & (first >= 0) & (first + width <= n)]
    edge = np.bincount(first, minlength=n + 1) - np.bincount(first + width, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def kept_words(
    docs: DataFrame,
    width: int = WIDTH,
    prefix: int = PREFIX,
    group: int = GROUP,
    id_column: str = "doc_id",
    text_column: str = "text",
    as_is: bool = False,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row.

    ``kept`` (binary) is the text of the words that stay, joined by one space; with ``as_is`` a text that loses nothing stays
    as it is."""
    texts = _text_table(docs, id_column, text_column)
    # All windows of a copied text are repeats; its first copy alone meets the others.
    named = texts.select("rid", "key")
    copies = named.groupBy("key").agg(F.count("*").alias("n"), F.min("rid").alias("first")).where("n > 1")
    copied = stage_table(named.join(copies, "key").select("rid", (F.col("rid") != F.col("first")).alias("later")), "copies")
    different_texts = texts.join(copied.where("later"), "rid", "left_anti")
    rows = stage_table(_anchor_rows(different_texts, width, prefix), "anchors")
    # A table of its own, so that a prefix with very many anchors can be split in the join.
    repeated = stage_table(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated-prefixes")
    rows = stage_table(rows.join(repeated, "h"), "repeated-anchors")
    different = rows.groupBy("h", "around").agg(F.count("*").alias("n"), F.min(F.struct("rid", "pos")).alias("first"))
    different = stage_table(different.select("h", "around", "n", "first.*"), "surroundings")
    sizes = different.groupBy("h").agg(F.count("*").alias("d")).where("d > 1")
    wanted = different.join(sizes, "h").select("rid", "pos", "h", "around", (F.col("d") > group).alias("many"))
    around = stage_table(_surroundings(texts, wanted.where("NOT many").drop("many"), width, prefix), "around")
    large = _surroundings(texts, wanted.where("many").drop("many"), width, prefix)
    every = F.lit((1 << (width - prefix + 1)) - 1)
    masks = different.where("n > 1").select("h", "around", every.alias("mask"))
    for more in [_trees(around, width, prefix), *_split_trees(large, width, prefix, group)]:
        masks = masks.unionByName(more)
    masks = stage_table(masks.groupBy("h", "around").agg(F.bit_or("mask").alias("mask")), "masks")
    spans = rows.join(masks, ["h", "around"]).select("rid", "pos", "mask")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, removed, kept = [], [], []
            at, copied = batch.column("at"), batch.column("copied").to_pylist()
            spans = at.flatten()  # lists of null rows are left out
            pos, mask = (spans.field(k).to_numpy() for k in ("pos", "mask"))
            ends = np.cumsum(np.nan_to_num(at.value_lengths().to_numpy(zero_copy_only=False))).astype(int).tolist()
            for row, (text, copy) in enumerate(zip(batch.column("words"), copied)):
                text = text.as_py()
                words = text.split()
                n = len(words)
                if copy and n >= width:
                    sizes.append(n)
                    removed.append(n)
                    kept.append(b"")
                    continue
                own = slice(ends[row - 1] if row else 0, ends[row])
                gone = _covered(pos[own], mask[own], n, width, prefix)
                sizes.append(n)
                removed.append(int(gone.sum()))
                stays = [w for w, g in zip(words, gone.tolist()) if not g] if removed[-1] else words
                kept.append(text if as_is and not removed[-1] else b" ".join(stays))
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept"])

    at = spans.groupBy("rid").agg(F.collect_list(F.struct("pos", "mask")).alias("at"))
    known = at.join(copied.select("rid", F.lit(True).alias("copied")), "rid", "full_outer")
    found = texts.join(known, "rid", "left").select("doc_id", "words", "at", "copied")
    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept binary")


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (text) of every row; see ``kept_words``."""
    found = kept_words(docs, id_column=id_column, text_column=text_column, **options)
    return found.withColumn("kept", F.decode("kept", "UTF-8"))
