"""Nearest neighbours by a block matrix join over int8 product tiles.

Queries and candidates are dealt to blocks; each pair of blocks is one task of bounded size. There every vector is quantised to
int8, a tile of integer products gives all inner products with proven error bounds, pairs whose upper bound cannot reach
the k-th best are dropped, and the survivors are recomputed in double precision on the original vectors. Each task keeps its
k best per query; the sorted runs of all tasks are then merged by a heap. The result is exact.

Repeated vectors cost nothing: of equal candidates of a block only those with the k + 1 smallest ids can be among the k nearest
of a query (one may be the query itself). Where very many pairs survive the bounds, as among vectors that differ by less than a
code does, they are recomputed in slices of ``PAIRS``.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component take no part, as query or as
candidate; only vectors of one length are compared; rows with the query's own id are no candidates for it; repeated rows of an
id and vector count once; ties go to the smaller id; a query with fewer than k candidates gets them all; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from itertools import groupby, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block, so a task holds two blocks and one tile at a time.
QUERY_BLOCK, CANDIDATE_BLOCK, TILE = 8_192, 32_768, 1_024
#: Pairs whose vectors are gathered at once.
PAIRS = 1 << 17
#: Products of two int8 codes are summed in float32, which is exact for so many of them.
EXACT_TERMS = 1_024


def usable(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    vector = table[vector_column].cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return table.where(
        table[id_column].isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)
    ).select(table[id_column].cast("long").alias("id"), vector.alias("vector"))


class Codes:
    """int8 codes of the rows of a matrix, with the norms that bound what quantising may change."""

    def __init__(self, rows: np.ndarray):
        largest = np.abs(rows).max(axis=1, initial=0.0)
        scale = np.maximum(largest / 127.0, np.finfo(np.float64).tiny)
        self.codes = np.rint(rows / scale[:, None]).astype(np.int8)
        kept = self.codes * scale[:, None]
        unit = np.maximum(largest, np.finfo(np.float64).tiny)  # norms of scaled rows neither overflow nor vanish
        length = lambda x: np.sqrt(np.square(x / unit[:, None]).sum(axis=1)) * unit * (1 + 1e-9)
        self.scale, self.kept, self.lost, self.norm = scale, length(kept), length(rows - kept), length(rows)

    def products(self, other: Codes, part: slice) -> np.ndarray:
        total = np.zeros((len(self.codes), len(other.codes[part])))
        for at in range(0, self.codes.shape[1], EXACT_TERMS):
            own = self.codes[:, at : at + EXACT_TERMS].astype(np.float32)
            total += own @ other.codes[part, at : at + EXACT_TERMS].astype(np.float32).T
        return total


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def telling(ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places, in order of their ids, of the rows that can be among the k nearest of a query with another id."""
    whole = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.itemsize * rows.shape[1]))).ravel()
    kind = np.unique(whole, return_inverse=True)[1].ravel()
    order = np.lexsort((ids, kind))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(kind[order]) != 0) | (np.diff(ids[order]) != 0)
    order = order[new]
    first = np.searchsorted(kind[order], kind[order])
    order = order[np.arange(len(order)) - first <= k]
    return order[np.argsort(ids[order], kind="stable")]


def best_in_tile(queries, ids, candidates, candidate_ids, k):
    """(query row, candidate id, score) of each query's k best, best first within a query."""
    use = telling(candidate_ids, candidates, k)
    candidates, candidate_ids = candidates[use], candidate_ids[use]
    q_codes, c_codes = Codes(queries), Codes(candidates)
    floor = np.full(len(ids), -np.inf)
    kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    for at in range(0, len(candidate_ids), TILE):
        part = slice(at, at + TILE)
        middle = q_codes.scale[:, None] * c_codes.scale[part] * q_codes.products(c_codes, part)
        slack = (
            q_codes.kept[:, None] * c_codes.lost[part]
            + q_codes.lost[:, None] * c_codes.norm[part]
            + 1e-12 * len(queries[0]) * q_codes.norm[:, None] * c_codes.norm[part]
        )
        own = ids[:, None] == candidate_ids[part]
        lower, upper = np.where(own, -np.inf, middle - slack), np.where(own, -np.inf, middle + slack)
        # A floor needs k different ids: rows of one id stand side by side and count once, with their best bound.
        firsts = np.flatnonzero(np.diff(candidate_ids[part], prepend=candidate_ids[at] - 1))
        best = lower if len(firsts) == lower.shape[1] else np.maximum.reduceat(lower, firsts, axis=1)
        if best.shape[1] >= k:
            floor = np.maximum(floor, np.partition(best, best.shape[1] - k, axis=1)[:, -k])
        rows, cols = np.nonzero((upper >= floor[:, None]) & ~own)
        for low in range(0, len(rows), PAIRS):
            row, col = rows[low : low + PAIRS], cols[low : low + PAIRS]
            kept = _merged(kept, (row, candidate_ids[part][col], _scores(queries, row, candidates[part], col)), len(ids), k)
        row, _, score = kept
        count = np.bincount(row, minlength=len(ids))
        full = np.nonzero(count >= k)[0]
        floor[full] = np.maximum(floor[full], score[np.searchsorted(row, full) + k - 1])
    return kept


def _scores(queries, row, candidates, col) -> np.ndarray:
    left, right = queries[row], candidates[col]
    score = left[:, 0] * right[:, 0]
    for d in range(1, left.shape[1]):  # in the order of the components, as a plain sum does
        score += left[:, d] * right[:, d]
    return score


def _merged(kept, more, n: int, k: int):
    """The k best of each of ``n`` query rows among what was kept and what has come."""
    row, col, score = (np.concatenate(x) for x in zip(kept, more))
    order = np.lexsort((col, -score, row))
    row, col, score = row[order], col[order], score[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (col[1:] != col[:-1]) | (score[1:] != score[:-1])
    row, col, score = row[new], col[new], score[new]
    keep = np.arange(len(row)) - np.searchsorted(row, np.arange(n))[row] < k
    return row[keep], col[keep], score[keep]


def nearest(
    table: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that meets ``is_query`` (over the id as column ``id``) the ``k`` other
    rows with the largest inner product, exact in double precision."""
    rows = usable(table, id_column, vector_column)
    count = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    spark = table.sparkSession
    spread = max(1, spark.sparkContext.defaultParallelism * 2)
    query_blocks = max(1, math.ceil(count[1] / QUERY_BLOCK))
    least = math.ceil(count[0] / CANDIDATE_BLOCK)
    blocks = max(1, least, min(math.ceil(spread / query_blocks), count[0] // TILE))
    place = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    width = F.size("vector").alias("width")
    queries = rows.where(is_query).select("id", "vector", width, place(query_blocks).alias("q"), every(blocks).alias("c"))
    # Names of their own: both sides come from the same rows.
    candidates = rows.select(F.col("id").alias("other_id"), F.col("vector").alias("other_vector"), width, place(blocks).alias("c"), every(query_blocks).alias("q"))

    def tile(own: pa.Table, other: pa.Table) -> pa.Table:
        ids = own["id"].to_numpy()
        row, col, score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        if own.num_rows and other.num_rows:
            row, col, score = best_in_tile(matrix(own["vector"]), ids, matrix(other["other_vector"]), other["other_id"].to_numpy(), k)
        starts = np.searchsorted(row, np.arange(len(ids) + 1))
        some = np.nonzero(np.diff(starts))[0]
        offsets = pa.array(np.append(starts[some], len(row)), pa.int32())
        return pa.table(
            {
                "query_id": ids[some],
                "vec_ids": pa.ListArray.from_arrays(offsets, pa.array(col, pa.int64())),
                "scores": pa.ListArray.from_arrays(offsets, pa.array(score, pa.float64())),
            }
        )

    runs = (
        queries.groupBy("width", "q", "c")
        .cogroup(candidates.groupBy("width", "q", "c"))
        .applyInArrow(tile, "query_id long, vec_ids array<long>, scores array<double>")
    )

    def merge(found: pd.DataFrame) -> pd.DataFrame:
        """The k best of the sorted runs of all tasks."""
        runs = [zip(-scores, ids) for scores, ids in zip(found["scores"], found["vec_ids"])]
        best = list(islice((x for x, _ in groupby(heapq.merge(*runs))), k))
        return pd.DataFrame(
            {
                "query_id": found["query_id"].iloc[0],
                "rank": np.arange(1, len(best) + 1, dtype=np.int32),
                "vec_id": [vec_id for _, vec_id in best],
                "score": [-score for score, _ in best],
            }
        )

    return runs.groupBy("query_id").applyInPandas(merge, "query_id long, rank int, vec_id long, score double")
