"""Toxicity by maximum-scoring segments.

Token log-odds between toxic and clean labelled texts, with Dirichlet priors, give every token a score; tokens that are not
significantly toxic share one small negative score. A linear scan finds all maximal-scoring segments of a text, the toxic
passages. By extreme-value theory the number of segments of score s to expect by chance in n tokens is K n exp(-lambda s);
a text's evidence is the sum of how far its segments lie beyond that, and a logistic curve over it gives the final score.

The model is learnt from at most ``SAMPLE`` labelled rows, those with the smallest hash of their id; all texts are scored whole.
Every significant token of those rows is in the lexicon, so that is bounded by the words of the sample and does not grow with
the corpus.

Defined cases: a null or empty text, or one without tokens, has no passages and no evidence; labels that are null, or whose id
is not in the documents, teach nothing; with labels of one kind only (or none), every score is the smoothed share of toxic
labels; repeated rows keep one result row each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import smallest, texts_of
from tidemark.session import stage_table

#: Labelled rows the model is learnt from.
SAMPLE = 50_000
#: Prior count of every token, weight of the pooled prior in tokens, and the least z-score and log-odds of a toxic token.
FLAT, POOLED, LEAST_Z, LEAST_ODDS = 0.5, 500.0, 3.5, 2.0
_FLUSH = 300_000
# ASCII letters and digits and all bytes of other characters make tokens; anything else separates them.
_TOKEN_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def tokens(text: str) -> list[bytes]:
    return text.lower().encode().translate(_TOKEN_BYTES).split()


def token_counts(taught: DataFrame) -> DataFrame:
    """``token, toxic, clean``: texts of either kind that hold the token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            every = list(set(counts[0]) | set(counts[1]))
            columns = [pa.array(every, pa.binary()), *(pa.array([c[w] for w in every], pa.int64()) for c in counts[::-1])]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, names=["token", "toxic", "clean"])

        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                counts[label].update(set(tokens(text)))
            if len(counts[0]) + len(counts[1]) > _FLUSH:
                yield flush()
        yield flush()

    found = taught.mapInArrow(run, "token binary, toxic long, clean long")
    return found.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def log_odds(counts: DataFrame, toxic: int, clean: int) -> DataFrame:
    """Adds ``score`` and ``z``; ``toxic`` and ``clean`` are the sums over all tokens."""
    prior = F.lit(FLAT) + F.lit(POOLED) * (F.col("toxic") + F.col("clean")) / F.lit(float(toxic + clean))
    t, c = F.col("toxic") + prior, F.col("clean") + prior
    odds = lambda x, n: F.log(x / F.greatest(F.lit(n + POOLED) - x, F.lit(1.0)))
    score = odds(t, float(toxic)) - odds(c, float(clean))
    return counts.withColumn("score", score).withColumn("z", F.col("score") / F.sqrt(1 / t + 1 / c))


def maximal_segments(found: list[tuple[int, float]], neutral: float) -> list[tuple[int, int, float]]:
    """(first token, last token, score) of all maximal-scoring segments; ``found`` has the positions with positive scores, and
    every other token scores ``-neutral``. Linear in ``found``: each held segment knows the last one before it that starts at a
    lower running total, so nothing is searched twice."""
    held: list[tuple[int, int, float, float, int]] = []  # first, last, total before, total after, the one before
    total, at = 0.0, 0
    for position, score in found:
        low = total - neutral * (position - at)
        total, at = low + score, position + 1
        first, high = position, total
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= low:
                j = held[j][4]
            if j < 0 or held[j][3] >= high:
                held.append((first, position, low, high, j))
                break
            first, low = held[j][0], held[j][2]
            del held[j:]
    return [(first, last, high - low) for first, last, low, high, _ in held]


def passages(docs: DataFrame, lexicon: dict[bytes, float], neutral: float, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, ``n_tokens`` and ``passages`` (first and last token, score) of rows with a ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            sizes, segments = [], []
            for text in batch.column("text").to_pylist():
                own = tokens(text)
                sizes.append(len(own))
                hits = []
                if not lexicon.keys().isdisjoint(own):  # a token right after itself adds nothing
                    hits = [(i, lexicon[w]) for i, w in enumerate(own) if w in lexicon and (not i or own[i - 1] != w)]
                segments.append([{"first": a, "last": b, "score": s} for a, b, s in maximal_segments(hits, neutral)])
            columns = [*(batch.column(c) for c in keep), pa.array(sizes, pa.int64()), pa.array(segments, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_tokens", "passages"])

    fields = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(
        run, f"{fields}, n_tokens long, passages array<struct<first:int,last:int,score:double>>"
    )


def evidence(rate: float, scale: float) -> Column:
    """Sum over the passages of lambda s - ln(K n), where positive: minus the log of the number to expect by chance."""
    chance = F.log(F.lit(scale) * F.greatest(F.col("n_tokens"), F.lit(1)))
    return F.aggregate(
        "passages", F.lit(0.0), lambda sum_, p: sum_ + F.greatest(F.lit(rate) * p["score"] - chance, F.lit(0.0))
    )


def decay(scores: np.ndarray, shares: np.ndarray, neutral: float) -> float:
    """The positive root of the mean of exp(lambda score) = 1 over tokens of clean texts."""
    low, high = 0.0, 1.0
    mean = lambda x: float((shares * np.exp(np.minimum(x * scores, 700))).sum() + (1 - shares.sum()) * exp(-x * neutral))
    while mean(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return max(low, 1e-3)


def logistic(x: np.ndarray, ones: np.ndarray, count: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic curve through counted values, with a weak prior, by Newton steps."""
    design, weight = np.stack([np.ones_like(x), x], axis=1), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ weight, -30, 30)))
        gradient = design.T @ (ones - count * p) - 1e-2 * weight
        hessian = (design * (count * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        weight += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(weight[0]), float(weight[1])


def score(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    label_column: str = "toxic",
    sample: int = SAMPLE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence, passages`` of every row. ``held_out`` is over column ``doc_id``; labels of
    such rows are not used."""
    rows = texts_of(docs, id_column, text_column)
    given = labels.select(labels[id_column].alias("doc_id"), labels[label_column].cast("int").alias("label"))
    given = given.where(F.col("label").isin(0, 1) & ~held_out).withColumn("mark", F.xxhash64("doc_id"))
    given = smallest(given, "mark", ["doc_id", "label"], sample).drop("mark")
    # At most ``sample`` pairs of numbers, so this side may be sent to every task whatever the size of the corpus.
    taught = stage_table(rows.join(F.broadcast(given), "doc_id").select("text", "label"), "taught")
    kinds = dict(taught.groupBy("label").count().collect())
    if len(kinds) < 2:
        share = (kinds.get(1, 0) + 0.5) / (sum(kinds.values()) + 1)
        none = F.array().cast("array<struct<first:int,last:int,score:double>>")
        return rows.select("doc_id", held_out.alias("held_out"), F.lit(share).alias("score")).select(
            "*", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.lit(0.0).alias("evidence"), none.alias("passages")
        )
    counts = stage_table(token_counts(taught), "token-counts")
    toxic, clean = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    toxic, clean = toxic or 0, clean or 0
    chosen = (
        log_odds(counts, toxic, clean).where((F.col("z") >= LEAST_Z) & (F.col("score") >= LEAST_ODDS))
        .orderBy(F.desc("z"), "token").select("token", "score", "toxic", "clean").collect()
    )
    lexicon = {bytes(r["token"]): r["score"] for r in chosen}
    # The tokens outside share the log-odds of being outside; at least a little below zero.
    outside_toxic = toxic - sum(r["toxic"] for r in chosen) + FLAT
    outside_clean = clean - sum(r["clean"] for r in chosen) + FLAT
    neutral = max(1e-3, -log(outside_toxic / (toxic + FLAT) * (clean + FLAT) / outside_clean))
    shares = np.array([(r["clean"] + FLAT) / (clean + FLAT * (len(chosen) + 1)) for r in chosen])
    rate = decay(np.array([r["score"] for r in chosen]), shares, neutral)
    found = stage_table(passages(taught, lexicon, neutral, ("label",)), "taught-passages")
    by_chance = found.where("label = 0").select("n_tokens", F.size("passages").alias("n"), F.array_min(F.transform("passages", lambda p: p["score"])).alias("least"))
    seen, length, least = by_chance.agg(F.sum("n"), F.sum("n_tokens"), F.min("least")).first()
    scale = ((seen or 0) + 1) * exp(min(rate * (least or 0.0), 50.0)) / ((length or 0) + 1)
    cell = F.least(F.floor(evidence(rate, scale) * 4), F.lit(4000)).alias("cell")
    table = found.select(cell, "label").groupBy("cell").agg(F.sum("label"), F.count("*")).orderBy("cell").collect()
    cells, ones, count = (np.array(x, float) for x in zip(*table))
    intercept, slope = logistic(np.log1p(cells / 4), ones, count)
    value = F.lit(intercept) + F.lit(slope) * F.log1p(F.col("evidence"))
    return (
        passages(rows, lexicon, neutral)
        .withColumn("evidence", evidence(rate, scale))
        .select(
            "doc_id",
            held_out.alias("held_out"),
            (1 / (1 + F.exp(-value))).alias("score"),
            (value >= 0).cast("int").alias("predicted"),
            "evidence",
            "passages",
        )
    )
