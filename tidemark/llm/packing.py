"""Sum-of-squares packing of token pieces into sequences of a fixed capacity.

A document's ids end with an end id; only a document longer than the capacity is cut. Each piece goes where the sum of the
squared counts of open sequences per residual gap becomes smallest: that keeps many different gaps open, so later pieces
find exact fits. Pieces are dealt evenly to groups of a bounded number of tokens and each group is packed by one task, which
sees lengths only, never ids; what a group wastes at its end is a fixed number of sequences.

Defined cases: a null or empty text is one piece holding just the end id; repeated rows are separate pieces; a piece of the
whole capacity is a sequence of its own; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Recent, distinct_parts, taken, texts_of
from tidemark.session import stage_table

#: Sequences a group holds on average; the open ones at its end are all it wastes.
GROUP_SEQUENCES = 4096
#: Characters of the words a worker remembers the ids of. It only saves time.
CACHE_CHARS = 5_000_000


# A word that ends in marks after an ASCII letter or digit: the tokenizer cuts there, so both parts can be encoded alone.
_MARKED = re.compile(r"(.*[A-Za-z0-9])([.,;:!?*#$%&]+)", re.DOTALL)
# Stands between words that are encoded as one text, for a mark by itself is one token; words with it are encoded alone.
_BETWEEN = "|"


class Words:
    """Ids by word. The tokenizer drops white space and its merges never reach over it, so words can be encoded alone."""

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        (self.between,) = self.tokenizer.encode(_BETWEEN, add_special_tokens=False).ids
        self.known = Recent(CACHE_CHARS)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[str]) -> None:
        marked = {word: found.groups() for word in words if (found := _MARKED.fullmatch(word))}
        plain = set(words).difference(marked)
        plain.update(self.known.missing({part for parts in marked.values() for part in parts}))
        alone = [word for word in plain if _BETWEEN in word]
        plain = list(plain.difference(alone))
        for word, ids in zip(alone, self.ids(alone)):
            self.known.put(word, array("I", ids).tobytes(), len(word))
        lines = [plain[k : k + 64] for k in range(0, len(plain), 64)]
        for start in range(0, len(lines), 64):
            part = lines[start : start + 64]
            for line, ids in zip(part, self.ids([f" {_BETWEEN} ".join(line) for line in part])):
                ids = np.array(ids, "<u4")
                cuts = np.flatnonzero(ids == self.between)
                packed = ids.tobytes()
                for word, first, stop in zip(line, [-4, *(4 * cuts).tolist()], [*(4 * cuts).tolist(), len(packed)]):
                    self.known.put(word, packed[first + 4 : stop], len(word))
        of = self.known.young.__getitem__
        for word, (stem, marks) in marked.items():
            self.known.put(word, of(stem) + of(marks), len(word))

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the bounds of each text's."""
        # ASCII letters are lowered at once: fewer different words, and the tokenizer lowers them anyway.
        words, order, bounds = distinct_parts(pc.ascii_split_whitespace(pc.ascii_lower(texts)))
        self.known.turn()
        missing = self.known.missing(set(words))
        if missing:
            self.learn(missing)
        return taken(list(map(self.known.young.__getitem__, words)), order, bounds)


@lru_cache(maxsize=2)
def words_of(tokenizer_file: str) -> Words:
    return Words(tokenizer_file)


def pieces(
    docs: DataFrame,
    tokenizer_file: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = 2048,
    end_id: int = 0,
) -> DataFrame:
    """``doc_id, piece, start, length, ids``: each document's ids, cut only where they exceed ``capacity``."""
    rows = texts_of(docs, id_column, text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = words_of(tokenizer_file)
        for batch in batches:
            ids, bounds = own.encode(batch.column("text"))
            # Each text's ids and then the end id.
            sizes = np.diff(bounds) + 1
            ids = np.insert(ids.astype("<u4"), bounds[1:], end_id)
            counts = -(-sizes // capacity)
            owner = np.repeat(np.arange(batch.num_rows), counts)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            length = np.minimum(capacity, sizes[owner] - piece * capacity)
            ends = pa.py_buffer(np.append(0, 4 * np.cumsum(length)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(owner)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(piece * capacity),
                    pa.array(length),
                    pa.BinaryArray.from_buffers(pa.binary(), len(owner), [None, ends, pa.py_buffer(ids)]),
                ],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, taken in the given order. No length exceeds ``capacity``."""
    open_at = np.zeros(capacity + 1, np.int64)  # open sequences by gap; closed and empty ones are not counted
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    blocked = np.iinfo(np.int64).max
    sequence, offset, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for item, size in enumerate(lengths.tolist()):
        gap = capacity
        if size < capacity:
            here = open_at[size:capacity]
            # Half the change of the sum by moving one sequence from gap g to g - size.
            change = np.where(here > 0, open_at[: capacity - size] - here, blocked)
            tight = int(change.argmin())
            # Twice the change: +2 for a move, +1 for an exact fit (one count only shrinks) or a new sequence.
            best = 2 * int(change[tight]) + 2 if change[tight] != blocked else None
            if here[0] and (exact := 1 - 2 * int(here[0])) <= (best if best is not None else exact):
                best, tight = exact, 0
            if best is not None and best <= 2 * int(open_at[capacity - size]) + 1:
                gap = size + tight
        if gap == capacity:
            own, made = made, made + 1
        else:
            own = by_gap[gap].pop()
            open_at[gap] -= 1
        sequence[item], offset[item] = own, capacity - gap
        left = gap - size
        if left:
            by_gap[left].append(own)
            open_at[left] += 1
    return sequence, offset


def pack(table: DataFrame, capacity: int = 2048, group_sequences: int = GROUP_SEQUENCES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of at most ``capacity``.

    The rows are written once, so that the deal to groups is the same however often a task runs. Within a group longer pieces
    go first; sequence ids are the group's number times 2^32 plus a count.
    """
    table = stage_table(table, "pieces")
    total = table.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (capacity * group_sequences)))
    number = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.iloc[np.argsort(-rows["length"].to_numpy(), kind="stable")]
        sequence, offset = sum_of_squares(rows["length"].to_numpy(), capacity)
        return rows.assign(sequence_id=rows["_group"].to_numpy() * (1 << 32) + sequence, offset=offset).drop(columns="_group")

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    return (
        table.withColumn("_group", number)
        .groupBy("_group")
        .applyInPandas(run, f"{fields}, sequence_id long, offset long")
    )
