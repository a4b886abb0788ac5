"""SentencePiece BPE by a prefix table, and decoding.

For every prefix of a text the last token of its encoding is unique. An automaton finds the tokens that end at a position;
the one that is compatible with the last token of the prefix before it is the prefix's last token, and the ids are read off
backwards. Two neighbours are compatible if, while both grow from characters, no merge over the edge between them comes
before the merges that they grow by; only the tokens along the edge have to be looked at.

Texts are cut where no piece reaches over (before a run of white space, around line ends, between a letter and a mark that no
piece holds side by side), and workers remember what they have encoded.

Defined cases: a null or empty text is the end id only and decodes to an empty text; rows are encoded one by one, so repeated
rows give repeated results; columns other than id and text are ignored; an empty table gives an empty table; a text may be of
any length. Models with a normaliser, user-defined or unused pieces are refused.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, chain
from string import ascii_letters, digits

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import Recent, texts_of

SPACE = "▁"
#: Characters of the segments a worker remembers, and tested pairs. They only save time.
CACHE_CHARS, CACHE_PAIRS = 6_000_000, 1_500_000
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_NEVER = 1 << 40


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, model_file: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as content:
            model.ParseFromString(content.read())
        kinds = [p.type for p in model.pieces]
        normal = model.normalizer_spec
        plain = not normal.precompiled_charsmap and normal.add_dummy_prefix and normal.escape_whitespaces
        known = {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
        if model.trainer_spec.model_type != 2 or set(kinds) - known or not plain or normal.remove_extra_whitespaces:
            raise ValueError("only BPE models without normaliser and without user-defined pieces")
        self.end = next(i for i, p in enumerate(model.pieces) if p.piece == "</s>")
        self.unknown = kinds.index(_UNKNOWN)
        self.kinds, self.surface = kinds, [p.piece.replace(SPACE, " ").encode() for p in model.pieces]
        self.surface[self.unknown] = model.trainer_spec.unk_surface.encode()
        self.byte_ids = {}
        for i, kind in enumerate(kinds):
            if kind == _BYTE:
                self.byte_ids[int(model.pieces[i].piece[3:5], 16)] = i
                self.surface[i] = bytes([int(model.pieces[i].piece[3:5], 16)])
            elif kind == _CONTROL:
                self.surface[i] = b""

        ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        # Merges go by falling score; pieces of equal score share a rank and go by position.
        order = {score: rank for rank, score in enumerate(sorted({model.pieces[i].score for i in ids.values()}, reverse=True))}
        self.rank_of = {piece: order[model.pieces[i].score] for piece, i in ids.items() if len(piece) > 1}
        # Characters that only occur inside pieces can be merged, but are no pieces themselves.
        for char in sorted(set("".join(ids)).difference(ids)):
            ids[char] = len(model.pieces) + len(ids)
        self.ids, self.size = ids, 2 * (len(model.pieces) + len(ids))
        self.text_of = {i: piece for piece, i in ids.items()}
        self.length = {i: len(piece) for piece, i in ids.items()}
        self.rank = {i: self.rank_of.get(piece, -1) for piece, i in ids.items()}
        shared = [x for x, n in zip(*np.unique([r for r in self.rank.values() if r >= 0], return_counts=True)) if n > 1]
        self.left, self.right, self.tied = {}, {}, set()
        for piece, i in list(ids.items()):
            if len(piece) > 1:
                made, halves = self.merge(piece)
                if len(made) > 1:
                    del self.text_of[i]  # other merges always come first: never a token of a text
                    continue
                self.left[i], self.right[i] = halves
                if self.rank[i] in shared or max(map(self.rank.get, halves)) >= self.rank[i]:
                    self.tied.add(i)
        # Whatever grows from a tied piece needs the real order of merges as well.
        for i in sorted(self.left, key=self.length.get):
            if self.left[i] in self.tied or self.right[i] in self.tied:
                self.tied.add(i)
        self.merged = {}
        for piece, rank in self.rank_of.items():
            for k in range(1, len(piece)):
                if piece[:k] in ids and piece[k:] in ids:
                    self.merged[ids[piece[:k]] * self.size + ids[piece[k:]]] = rank

        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for i, piece in self.text_of.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.segments = Recent(CACHE_CHARS)
        self.cut = self._cutter(ids).findall

    @staticmethod
    def _cutter(pieces: Iterable[str]) -> re.Pattern:
        """Segments between which no piece reaches over."""
        beside = {(a, b) for piece in pieces for a, b in zip(piece, piece[1:])}
        inner = {b for _, b in beside}
        word = ascii_letters + digits
        marks = "".join(m for m in "\n\t,.;:!?\"'()[]{}#*$%&|<>=+-/_" if not any((c, m) in beside for c in word))
        if any(b == SPACE and a != SPACE for a, b in beside):
            return re.compile(r"(?s).+")  # pieces over several words: whole texts
        lone = "\n" if "\n" not in inner and not any(a == "\n" for a, _ in beside) else ""
        stop, marks = re.escape(SPACE + lone), re.escape(SPACE + lone + marks)
        ends = f"(?=[{marks}]|$)" if marks else "$"
        return re.compile(f"{SPACE}*[A-Za-z0-9]+{ends}|{SPACE}*[^{stop}]+|{SPACE}+" + (f"|{lone}" if lone else ""))

    def merge(self, text: str) -> tuple[list[int], tuple[int, int] | None]:
        """Ids by merging one pair after the other, and the two parts of the last merge. For short texts."""
        parts, halves = list(text), None
        while True:
            best = min(((self.rank_of.get(a + b, _NEVER), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))), default=(_NEVER, 0))
            if best[0] == _NEVER:
                return [self.ids.get(p, -1) for p in parts], halves
            k = best[1]
            halves = (self.ids[parts[k]], self.ids[parts[k + 1]])
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the encoding of both texts together is just these two tokens."""
        if a in self.tied or b in self.tied:
            return self.merge(self.text_of[a] + self.text_of[b])[0] == [a, b]
        merged, rank, size = self.merged.get, self.rank, self.size
        gone_a = gone_b = _NEVER  # when a and b are merged into what they are part of
        while True:
            made = merged(a * size + b)
            # Of equal ranks the leftmost merge goes first: the one inside the left token, then the one over the edge.
            if made is not None and made < gone_a and made <= gone_b:
                return False
            late_a, late_b = rank[a], rank[b]
            if late_a < 0 and late_b < 0:
                return True
            if late_a > late_b:
                gone_a, a = late_a, self.right[a]
            else:
                gone_b, b = late_b, self.left[b]

    def learn(self, missing: list[str]) -> None:
        """Encode and remember segments. They are laid end to end; an unknown character between them keeps them apart."""
        apart = next(c for c in map(chr, range(0xE000, 0xF8FF)) if c not in self.ids)
        text = apart.join(missing)
        last, pairs, size = [-2] * (len(text) + 1), self.pairs, self.size
        # -2: no token ends here, so the character before it is unknown; such a character is beside any token.
        for at, (token, length) in self.automaton.iter(text):
            if last[at + 1] == -2:
                before = last[at + 1 - length]
                if before >= 0:
                    key = before * size + token
                    fits = pairs.get(key)
                    if fits is None:
                        fits = pairs[key] = self.compatible(before, token)
                    if not fits:
                        continue
                last[at + 1] = token
        if len(pairs) > CACHE_PAIRS:
            pairs.clear()
        length_of, model_size = self.length, len(self.kinds)
        starts = accumulate((len(s) + 1 for s in missing), initial=0)
        for segment, start in zip(missing, starts):
            at, found = start + len(segment), []
            while at > start:
                token = last[at]
                if 0 <= token < model_size:
                    found.append(token)
                    at -= length_of[token]
                else:
                    found.extend(self._spelt(text[at - 1]))
                    at -= 1
            found.reverse()
            self.segments.put(segment, array("i", found).tobytes(), len(segment))

    def _spelt(self, char: str) -> list[int]:
        """The byte pieces of a character without a piece, last byte first; the unknown id if there are none."""
        coded = char.encode("utf-8", "replace")
        return [self.byte_ids[b] for b in reversed(coded)] if self.byte_ids else [self.unknown]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed 32-bit ids of each text, the end id included."""
        cut = [self.cut(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        self.segments.turn()
        missing = self.segments.missing(set(chain.from_iterable(cut)))
        if missing:
            self.learn(missing)
        of, end = self.segments.young.__getitem__, array("i", [self.end]).tobytes()
        return [b"".join(map(of, segments)) + end for segments in cut]

    def decode(self, ids: list[int]) -> str:
        surface = self.surface
        first, opened = b"", False  # the first white space is the one that encoding puts there
        at = 0
        while at < len(ids) and not first and not opened:
            first = surface[ids[at]]
            if self.kinds[ids[at]] == _NORMAL and first.startswith(b" "):
                first, opened = first[1:], True
            at += 1
        whole = first + b"".join(map(surface.__getitem__, ids[at:]))
        try:
            return whole.decode()
        except UnicodeDecodeError:
            return self._mended(first, ids, at)

    def _mended(self, first: bytes, ids: list[int], at: int) -> str:
        """Byte pieces that spell no character: each such byte becomes a replacement character."""
        out, run = [], bytearray()
        parts = [(first, self.kinds[ids[at - 1]] if at else _NORMAL), *((self.surface[i], self.kinds[i]) for i in ids[at:])]
        for part, kind in [*parts, (b"", _NORMAL)]:
            if kind == _BYTE:
                run += part
                continue
            k = 0
            while k < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[k : k + n]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    n = 1
                k += n
            run.clear()
            out.append(part.decode())
        return "".join(out)


@lru_cache(maxsize=2)
def pieces(model_file: str) -> Pieces:
    """One encoder per worker process; its tables have a fixed size."""
    return Pieces(model_file)


def _packed(ids: list[bytes]) -> pa.ListArray:
    offsets = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def encode(docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of int, end id included) of every row. ``model_file`` must be readable on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model_file)
        for batch in batches:
            ids = own.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _packed(ids)], names=["doc_id", "ids"])

    rows = texts_of(docs, id_column, text_column)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """Adds ``decoded`` (text) to rows with ``doc_id`` and ``ids``; null ids decode to an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model_file)
        for batch in batches:
            texts = pa.array([own.decode(ids or []) for ids in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), texts], names=["doc_id", "ids", "decoded"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded``: what :func:`decode` gives for :func:`encode`, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model_file)
        for batch in batches:
            ids = own.encode(batch.column("text").to_pylist())
            texts = pa.array([own.decode(memoryview(x).cast("i").tolist()) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _packed(ids), texts], names=["doc_id", "ids", "decoded"])

    rows = texts_of(docs, id_column, text_column)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")
