"""Byte-level BPE with a hierarchical-bitmap rank queue.

A text is cut by the pattern; each match is merged separately, lowest rank first and leftmost among equal ranks. The queue of
pending merges keeps a heap of list positions per rank, and three levels of 64-bit words mark the ranks in use, so the next
rank is found by three find-first-set steps however long a match is. Entries that a later merge has made stale are skipped
when they come up. All matches of a batch that are not yet known share one queue: they are laid end to end, and no pair
reaches over an edge.

Defined cases: a null or empty text has no ids and decodes to no bytes; rows are encoded one by one, so repeated rows give
repeated results; columns other than id and text are ignored; an empty table gives an empty table; a text or a match may be
of any length.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import Recent, distinct_parts, split_rows, taken, texts_of

#: Characters of the chunks, and of the matches, that a worker remembers. It only saves time.
CACHE_CHARS = 4_000_000


#: Places where a space is not a single one between two words, so a text is not simply cut at its spaces.
UNEVEN = r"\s | \s|\s$|^\s"


class Encoder:
    """Encoder and decoder of one rank file."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.top_rank = max(self.ranks.values())
        # All tokens end to end in order of rank, for decoding by position.
        by_rank = [b""] * (self.top_rank + 1)
        for token, rank in self.ranks.items():
            by_rank[rank] = token
        self.token_bytes = np.frombuffer(b"".join(by_rank), np.uint8)
        self.token_sizes = np.fromiter(map(len, by_rank), np.int64, len(by_rank))
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.of_two = np.full(1 << 16, -1, dtype=np.int32)
        for token, rank in self.ranks.items():
            if len(token) == 2:
                self.of_two[token[0] << 8 | token[1]] = rank
        self.pattern = regex.compile(pattern)
        # Matches never reach over the point between a non-space and a space that a non-space follows, so what lies between
        # two such points can be encoded, and remembered, on its own.
        self.uneven = regex.compile(UNEVEN)
        self.chunk = regex.compile(r"\s*\S+|\s+")
        # The rank of what two neighbouring tokens make, by both ranks packed into one number.
        self.of_pair: dict[int, int] = {}
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                left, right = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if left is not None and right is not None:
                    self.of_pair[left << 32 | right] = rank
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        # Packed 32-bit ids by chunk and by match.
        self.chunks, self.matches = Recent(CACHE_CHARS), Recent(CACHE_CHARS)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece. The queue's steps are written out: a call for each would take most of the time."""
        made_of = self.of_pair.get
        data = b"".join(pieces)
        total = len(data)
        edge = bytearray(total + 1)  # 1 where a piece begins, and at the end
        edge[total] = 1
        at = 0
        for piece in pieces:
            edge[at] = 1
            at += len(piece)
        # A linked list of tokens by their first byte: token i ends at end[i], and with the next token it would make a token
        # of rank pair[i]; -1 where it would not, or where i is no longer a token.
        end, before = list(range(1, total + 1)), list(range(-1, total - 1))
        codes = np.frombuffer(data, np.uint8).astype(np.int32)
        first = np.full(total, -1, np.int32)
        first[:-1] = np.where(np.frombuffer(edge, np.uint8)[1:total] == 0, self.of_two[codes[:-1] << 8 | codes[1:]], -1)
        pair, token = first.tolist(), self.of_byte[codes].tolist()
        low, mid, top = [0] * ((self.top_rank >> 6) + 1), [0] * ((self.top_rank >> 12) + 1), 0
        order = np.argsort(first, kind="stable")
        order = order[first[order] >= 0]
        used, starts = np.unique(first[order], return_index=True)
        buckets = {}
        for rank, positions in zip(used.tolist(), np.split(order, starts[1:])):
            buckets[rank] = positions.tolist()
            low[rank >> 6] |= 1 << (rank & 63)
            mid[rank >> 12] |= 1 << ((rank >> 6) & 63)
            top |= 1 << (rank >> 12)
        while top:
            # The lowest rank in use: find first set, three times.
            high = (top & -top).bit_length() - 1
            word = mid[high]
            middle = (high << 6) | ((word & -word).bit_length() - 1)
            word = low[middle]
            rank = (middle << 6) | ((word & -word).bit_length() - 1)
            bucket = buckets[rank]
            lower = False
            while bucket and not lower:
                i = heappop(bucket)
                if pair[i] != rank:
                    continue
                j = end[i]
                k = end[i] = end[j]
                pair[j] = pair[i] = -1
                token[i] = rank
                if not edge[i]:
                    p = before[i]
                    pair[p] = made = made_of(token[p] << 32 | rank, -1)
                    if made in buckets:
                        heappush(buckets[made], p)
                        lower = made < rank
                    elif made >= 0:
                        buckets[made] = [p]
                        low[made >> 6] |= 1 << (made & 63)
                        mid[made >> 12] |= 1 << ((made >> 6) & 63)
                        top |= 1 << (made >> 12)
                        lower = made < rank
                if not edge[k]:
                    before[k] = i
                    pair[i] = made = made_of(rank << 32 | token[k], -1)
                    if made in buckets:
                        heappush(buckets[made], i)
                        lower = lower or made < rank
                    elif made >= 0:
                        buckets[made] = [i]
                        low[made >> 6] |= 1 << (made & 63)
                        mid[made >> 12] |= 1 << ((made >> 6) & 63)
                        top |= 1 << (made >> 12)
                        lower = lower or made < rank
            if not bucket:
                del buckets[rank]
                low[middle] &= ~(1 << (rank & 63))
                if not low[middle]:
                    mid[high] &= ~(1 << (middle & 63))
                    if not mid[high]:
                        top &= ~(1 << high)
        found, at = [], 0
        for piece in pieces:
            ids, stop = [], at + len(piece)
            while at < stop:
                ids.append(token[at])
                at = end[at]
            found.append(array("i", ids).tobytes())
        return found

    def cut(self, text: str) -> list[str]:
        if self.uneven.search(text):
            return self.chunk.findall(text)
        return [text[:at] if (at := text.find(" ")) >= 0 else text, *[" " + w for w in text.split(" ")[1:]]] if text else []

    def learn(self, missing: list[str]) -> None:
        """Remember the ids of chunks."""
        parts = [self.pattern.findall(chunk) for chunk in missing]
        unknown = self.matches.missing(set(chain.from_iterable(parts)))
        coded = [match.encode() for match in unknown]
        whole = [self.ranks.get(code) for code in coded]  # a match that is a token stays one, whatever the merges
        merged = iter(self.merge([code for code, rank in zip(coded, whole) if rank is None]))
        for match, rank in zip(unknown, whole):
            self.matches.put(match, next(merged) if rank is None else array("i", [rank]).tobytes(), len(match))
        of = self.matches.young.__getitem__
        for chunk, part in zip(missing, parts):
            self.chunks.put(chunk, b"".join(map(of, part)), len(chunk))

    def known(self, chunks: list[str]) -> list[bytes]:
        """Packed 32-bit ids of different chunks."""
        self.chunks.turn()
        self.matches.turn()
        missing = self.chunks.missing(set(chunks))
        if missing:
            self.learn(missing)
        return list(map(self.chunks.young.__getitem__, chunks))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed 32-bit ids of each text."""
        cut = [self.cut(text or "") for text in texts]
        different = list(set(chain.from_iterable(cut)))
        of = dict(zip(different, self.known(different))).__getitem__
        return [b"".join(map(of, chunks)) for chunks in cut]

    def encode_even(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without :data:`UNEVEN` places end to end, and the bounds of each text's.

        Their words are cut by Arrow, and only different ones reach Python; all but the first begin with the space before.
        """
        words, order, bounds = distinct_parts(pc.split_pattern(texts, " "))
        first, count = bounds[:-1], len(words)
        # The first words of texts are chunks of their own, without a space.
        opening = order[first]
        opened, place = np.unique(opening, return_inverse=True)
        order = order.copy()
        order[first] = count + place
        chunks = [" " + word for word in words] + [words[k] for k in opened.tolist()]
        return taken(self.known(chunks), order, bounds)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens of ``ids``, taken from all tokens laid end to end."""
        sizes = self.token_sizes[ids]
        ends = np.cumsum(sizes)
        moved = np.repeat(self.token_starts[ids] - (ends - sizes), sizes)
        return self.token_bytes[moved + np.arange(len(moved))].tobytes()


@lru_cache(maxsize=2)
def encoder(rank_file: str, pattern: str) -> Encoder:
    """One encoder per worker process; its rank table has a fixed size."""
    return Encoder(rank_file, pattern)


def _encoded(own: Encoder, batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(doc_id, ids end to end, bounds) of the rows of a batch, in one or two parts."""
    even, uneven = split_rows(batch, UNEVEN.replace(r"\s", r"[\t-\r\x1c-\x20\x{85}\pZ]"))  # what \s is in the pattern
    if even.num_rows:
        yield even.column("doc_id"), *own.encode_even(even.column("text"))
    if uneven.num_rows:
        packed = own.encode(uneven.column("text").to_pylist())
        yield uneven.column("doc_id"), *taken(packed, np.arange(len(packed)), np.arange(len(packed) + 1))


def _lists(ids: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))


def _schema(rows: DataFrame) -> str:
    return f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>"


def encode(
    docs: DataFrame, rank_file: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row. ``rank_file`` must be readable on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(rank_file, pattern)
        for batch in batches:
            for rows, ids, bounds in _encoded(own, batch):
                yield pa.RecordBatch.from_arrays([rows, _lists(ids, bounds)], names=["doc_id", "ids"])

    rows = texts_of(docs, id_column, text_column)
    return rows.mapInArrow(run, _schema(rows))


def round_trip(
    docs: DataFrame, rank_file: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` (binary): what :func:`decode` gives for :func:`encode`, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(rank_file, pattern)
        for batch in batches:
            for rows, ids, bounds in _encoded(own, batch):
                texts = pa.array([own.decode(ids[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([rows, _lists(ids, bounds), texts], names=["doc_id", "ids", "decoded"])

    rows = texts_of(docs, id_column, text_column)
    return rows.mapInArrow(run, _schema(rows) + ", decoded binary")


def decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Adds ``decoded`` (binary) to rows with ``doc_id`` and ``ids``; null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(rank_file, pattern)
        for batch in batches:
            lists = batch.column("ids")
            values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            texts = [
                own.decode(values[a:b]) if known else b""
                for a, b, known in zip(offsets, offsets[1:], lists.is_valid().to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.binary())],
                names=["doc_id", "ids", "decoded"],
            )

    rows = encoded.select("doc_id", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")
