"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Every text is reduced to a few statistics. Cosines of random projections approximate a Gaussian kernel over them; each task sums
its part of the normal equations, Spark adds the parts by matrix row, and one small system is solved. The raw scores of the
labelled rows, counted in a fixed number of bins, then give a monotone calibration by pooling adjacent violators.

Defined cases: a null or empty text has statistics of zero and gets a score like any other; labels that are null, or whose id
is not in the documents, teach nothing; if an id has several labels or rows, each pair counts; without any usable label, or
with labels of one kind, all scores are the share of ones (0.5 without labels); repeated rows keep one result row each; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts_of
from tidemark.session import stage_table

#: Byte classes that are counted.
_CLASSES = {
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digit": b"0123456789",
    "symbol": b"#*$%&|<>",
    "mark": b"!?",
    "stop": b".,;:",
    "quote": b"\"'()[]{}",
    "odd": b"@\\^_`~+=/-",
    "high": bytes(range(128, 256)),
    "break": b"\n",
}
STATISTICS = [
    *_CLASSES, "words", "word_chars", "long_words", "distinct", "common", "run", "distinct_pairs", "lines", "line_chars", "same_lines", "capitals", "shouts",
]


def statistics(text: bytes) -> list[float]:
    """Numbers of order one that describe a text; see ``STATISTICS``."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = max(1, len(text))
    shares = [float(counts[list(own)].sum()) / size * 4 for own in _CLASSES.values()]
    words = text.split()
    n = len(words)
    if not n:
        return shares + [0.0] * (len(STATISTICS) - len(shares))
    different = set(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [line for line in text.split(b"\n") if line.strip()]
    same_next = sum(map(bytes.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:]))) / max(1, n - 1)
    return shares + [
        log1p(n) / 5,
        float(lengths.mean()) / 6,
        float((lengths > 15).mean()) * 4,
        len(different) / n,
        log1p(n / len(different)),
        same_next / n,
        pairs,
        log1p(len(lines)) / 3,
        log1p(len(text) / max(1, len(lines))) / 6,
        1 - len(set(lines)) / len(lines),
        sum(map(bytes.istitle, words)) / n,
        sum(map(bytes.isupper, words)) / n,
    ]


def text_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, stats`` (array of double) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "stats"]
            )

    rows = texts_of(docs, id_column, text_column, binary=True)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, stats array<double>")


def features(rows: np.ndarray, mean: np.ndarray, spread: np.ndarray, count: int, width: float, seed: int) -> np.ndarray:
    """Cosines whose products average to exp(-|x - y|^2 / (2 width^2)) over standardised statistics, and a constant."""
    random = np.random.default_rng(seed)
    direction = random.normal(size=(rows.shape[1], count)) / width
    phase = random.uniform(0, 2 * np.pi, count)
    standard = np.clip((rows - mean) / spread, -8, 8)
    return np.hstack([np.cos(standard @ direction + phase) * np.sqrt(2 / count), np.ones((len(rows), 1))])


def _stacked(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(rows: DataFrame, of, count: int, width: int) -> np.ndarray:
    """Sum over all batches of the (count x width) matrices that ``of`` makes; added up by Spark, one row per matrix row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count, width))
        for batch in batches:
            if batch.num_rows:
                total += of(batch)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(count)), pa.array(list(total), pa.list_(pa.float64()))], names=["row", "part"]
        )

    parts = rows.mapInArrow(run, "row long, part array<double>")
    cells = parts.select("row", F.posexplode("part").alias("cell", "value")).groupBy("row", "cell").agg(F.sum("value"))
    out = np.zeros((count, width))
    for row, cell, value in cells.collect():
        out[row, cell] = value
    return out


def pool_adjacent(score_sum: np.ndarray, ones: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean score, share of ones) of the monotone blocks of bins in score order."""
    blocks: list[list[float]] = []
    for s, o, n in zip(score_sum, ones, count):
        if n:
            blocks.append([s, o, n])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
                last = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    table = np.array(blocks)
    return table[:, 0] / table[:, 2], (table[:, 1] + 0.5) / (table[:, 2] + 1)


def score(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    label_column: str = "quality",
    count: int = 256,
    width: float = 8.0,
    ridge: float = 1e-3,
    bins: int = 4096,
    seed: int = 7,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row. ``held_out`` is over column ``doc_id``; such rows' labels are not used."""
    width_of = len(STATISTICS)
    stats = stage_table(text_statistics(docs, id_column, text_column), "statistics")
    given = labels.select(labels[id_column].alias("doc_id"), labels[label_column].cast("double").alias("label"))
    given = given.where(F.col("label").isin(0.0, 1.0) & ~held_out)
    taught = stage_table(stats.join(given, "doc_id").select("stats", "label"), "taught")

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        rows, label = _stacked(batch.column("stats"), width_of), batch.column("label").to_numpy()
        ends = np.zeros((1, width_of))
        ends[0, :2] = len(label), label.sum()
        return np.vstack([rows.sum(axis=0), np.square(rows).sum(axis=0), ends])

    total, squares, (n, ones, *_) = _sums(taught, moments, 3, width_of)
    if n == 0 or ones in (0, n):
        share = 0.5 if n == 0 else ones / n
        return stats.select("doc_id", held_out.alias("held_out"), F.lit(float(share)).alias("score")).withColumn(
            "predicted", (F.col("score") >= 0.5).cast("int")
        )
    mean = total / n
    spread = np.sqrt(np.maximum(squares / n - mean**2, 1e-6))
    side = count + 1

    def design(batch: pa.RecordBatch) -> np.ndarray:
        return features(_stacked(batch.column("stats"), width_of), mean, spread, count, width, seed)

    def equations(batch: pa.RecordBatch) -> np.ndarray:
        x = design(batch)
        return np.hstack([x.T @ x, (x.T @ batch.column("label").to_numpy())[:, None]])

    system = _sums(taught, equations, side, side + 1)
    penalty = ridge * n * np.eye(side) / side
    penalty[-1, -1] = 0.0
    weights = np.linalg.solve(system[:, :-1] + penalty, system[:, -1])

    def binned(batch: pa.RecordBatch) -> np.ndarray:
        raw, label = design(batch) @ weights, batch.column("label").to_numpy()
        cell = np.clip(((raw + 0.5) / 2 * bins).astype(int), 0, bins - 1)
        return np.stack([np.bincount(cell, w, bins) for w in (raw, label, np.ones(len(raw)))])

    at, share = pool_adjacent(*_sums(taught, binned, 3, bins))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = design(batch) @ weights
            calibrated = np.interp(raw, at, share)
            # A trace of the raw score keeps the order within flat stretches of the calibration.
            final = np.clip(calibrated * (1 - 1e-6) + 1e-6 / (1 + np.exp(-np.clip(raw, -30, 30))), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(final)], names=["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    scored = stats.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
