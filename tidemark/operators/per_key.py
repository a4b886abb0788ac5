"""Ridge regressions of many features, one per key, from sums that merge.

A key's model needs only its row count and its sums and cross products. Tasks add these up per key over their rows, a hot key's
partial sums are first added in salted groups, and the small systems are solved for many keys at a time. Rows are never
gathered by key, so a key may hold any share of them.

Values are taken relative to the features' overall means, so that the sums do not cancel. Each feature is divided by its
deviation within the key; ``l2`` is added to the diagonal for every row, as for standardised features.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import null_safe_join
from tidemark.session import stage_table

#: Keys of which a task holds sums at once, and groups that the partial sums of one key are first dealt to.
HELD, SALTS = 1_000, 16


def _sums(rows: DataFrame, by: Sequence[str], features: Sequence[str], target: str, middle: np.ndarray) -> DataFrame:
    """``by`` and ``p``: cross products of (1, features, target) over a task's rows of a key."""
    columns = [*features, target]
    keys = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in by]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, np.ndarray] = {}

        def given() -> pd.DataFrame:
            out = pd.DataFrame(list(held), columns=list(by), dtype=object)
            return out.assign(p=[v.tobytes() for v in held.values()])

        for batch in batches:
            x = batch[columns].to_numpy(dtype=float, na_value=np.nan) - middle
            complete = np.isfinite(x).all(axis=1)
            x = np.column_stack([np.ones(len(x)), x])[complete]
            names = batch.loc[complete, list(by)].astype(object).where(lambda k: k.notna(), None)
            for key, own in names.groupby(list(by), dropna=False, sort=False).indices.items():
                key = tuple(None if pd.isna(k) else k for k in (key if isinstance(key, tuple) else (key,)))
                made = x[own].T @ x[own]
                held[key] = held[key] + made if key in held else made
            if len(held) > HELD:
                yield given()
                held.clear()
        if held:
            yield given()

    return rows.select(*by, *columns).mapInPandas(run, ", ".join([*keys, "p binary"]))


def _merged(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sums added per key: rows of a key follow each other and are added as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                now, part = tuple(row[k] for k in by), np.frombuffer(row["p"])
                if total is not None and now == key:
                    total = total + part
                    continue
                if total is not None:
                    made.append((*key, total.tobytes()))
                key, total = now, part
            if made:
                yield packed(made, batch.schema)
        if total is not None:
            yield packed([(*key, total.tobytes())], schema)

    def packed(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(dict(zip([*by, "p"], map(list, zip(*rows)))), schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = sums.select(*by, "p").schema
    schema = to_arrow_schema(kinds)
    salt = F.pmod(F.xxhash64("p"), F.lit(SALTS))
    for keys in ([*by, "_salt"], by):
        dealt = sums.withColumn("_salt", salt).repartition(*keys).sortWithinPartitions(*keys).select(*by, "p")
        sums = dealt.mapInArrow(run, kinds)
    return sums


def fit_ridge_per_key(
    df: DataFrame, by: Sequence[str], features: Sequence[str], target: str, l2: float = 1e-3, train: Column | None = None
) -> DataFrame:
    """``by``, intercept, coefficients (one per feature, in order) and train_rows of every key.

    Rows with a missing feature or target take no part; a key without rows has no model; a feature that is constant within a
    key has the coefficient 0.
    """
    rows = df if train is None else df.where(train)
    columns = [*features, target]
    finite = F.lit(True)
    for c in columns:
        finite = finite & (F.abs(F.col(c).cast("double")) < float("inf"))
    means = rows.where(finite).agg(*[F.avg(F.col(c).cast("double")).alias(f"m{k}") for k, c in enumerate(columns)]).first()
    middle = np.array([means[f"m{k}"] or 0.0 for k in range(len(columns))])
    sums = _merged(_sums(rows, by, features, target, middle), by)
    d = len(features)
    keys = [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in by]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            p = np.stack([np.frombuffer(v) for v in batch["p"]]).reshape(-1, d + 2, d + 2)
            n = p[:, 0, 0]
            mean = p[:, 0, 1:] / n[:, None]
            moments = p[:, 1:, 1:] / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
            variance = np.einsum("kii->ki", moments)[:, :d]
            # No more than what rounding leaves of equal values.
            flat = variance <= 1e-12 * np.einsum("kii->ki", p)[:, 1 : d + 1] / n[:, None]
            spread = np.sqrt(np.where(flat, 1.0, variance))
            scale = np.where(flat, 1.0, spread)
            gram = moments[:, :d, :d] / (scale[:, :, None] * scale[:, None, :])
            gram[flat] = 0.0
            gram += (l2 + flat)[:, :, None] * np.eye(d)
            side = np.where(flat, 0.0, moments[:, :d, d] / scale)
            found = np.linalg.solve(gram, side[:, :, None])[:, :, 0] if d else side
            found = np.where(flat, 0.0, found / scale)
            intercept = mean[:, d] + middle[d] - (found * (mean[:, :d] + middle[:d])).sum(axis=1)
            yield batch[list(by)].assign(intercept=intercept, coefficients=list(found), train_rows=n.round().astype(np.int64))

    return sums.mapInPandas(solve, ", ".join([*keys, "intercept double", "coefficients array<double>", "train_rows long"]))


def predict_ridge_per_key(
    df: DataFrame, models: DataFrame, by: Sequence[str], features: Sequence[str], prediction: str = "predicted"
) -> DataFrame:
    """Adds the prediction of each row's key, in column functions; null where a feature is missing or the key has no model."""
    kept = stage_table(models.select(*by, F.col("intercept").alias("_intercept"), F.col("coefficients").alias("_coefficients")), "ridge")
    joined = null_safe_join(df, kept, by, "left")
    total = F.col("_intercept")
    for k, c in enumerate(features):
        total = total + F.col("_coefficients")[k] * F.col(c).cast("double")
    return joined.withColumn(prediction, total).drop("_intercept", "_coefficients")
