"""Scaling, training, cross-validation, attribution and forecasts with ``pyspark.ml``.

Training inputs are written to the shared folder first: iterative fits read them many times.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Tokenizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.functions.market import target_price
from tidemark.operators.evaluation import class_weights, regression_metrics
from tidemark.operators.sequences import scaled_value
from tidemark.operators.splits import fold_column
from tidemark.session import stage_table

FEATURES, FOLD = "features", "fold"


#: Columns of one aggregate: the code for many more is too long to be compiled, so each column is read by one of several passes.
AT_ONCE = 16


def _groups(columns: Sequence[str]) -> list[list[str]]:
    return [list(columns[k : k + AT_ONCE]) for k in range(0, len(columns), AT_ONCE)]


def fill_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls and NaN of the columns as 0."""
    return df.na.fill(0, list(columns))


def fit_minmax(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(minimum, maximum) per column, missing values counting as 0. Aggregates of :data:`AT_ONCE` columns; two numbers per column."""
    found = {}
    for names in _groups(columns):
        filled = fill_missing(train.select(*names), names)
        row = filled.agg(
            *[F.min(c).cast("double").alias(f"lo_{c}") for c in names],
            *[F.max(c).cast("double").alias(f"hi_{c}") for c in names],
        ).first()
        found |= {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in names}
    return found


def apply_minmax(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Scale with the fitted ranges, no clipping; a constant column gives 0 on the rows it was fitted on."""
    filled = fill_missing(df, list(ranges))
    return filled.withColumns(
        {c: scaled_value(F.col(c).cast("double"), F.lit(lo), F.lit(hi)) for c, (lo, hi) in ranges.items()}
    )


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="keep").transform(df)


def training_table(df: DataFrame, features: Sequence[str], keep: Sequence[str], name: str = "training") -> DataFrame:
    """Keys, target and the feature vector, staged in the shared folder."""
    return stage_table(assemble(df, features).select(*keep, FEATURES), name)


def boosted_trees(
    target: str, trees: int = 100, rate: float = 0.1, depth: int = 6, seed: int = 42, prediction: str = "predicted"
) -> GBTRegressor:
    return GBTRegressor(
        featuresCol=FEATURES,
        labelCol=target,
        predictionCol=prediction,
        maxIter=trees,
        stepSize=rate,
        maxDepth=depth,
        seed=seed,
    )


def fit_and_predict(table: DataFrame, estimator, split: str = s.SPLIT) -> tuple[Model, DataFrame]:
    """Fit on the train rows of a staged table and predict all of it."""
    model = estimator.fit(table.filter(F.col(split) == "train"))
    return model, model.transform(table)


def save_model(model: Model | PipelineModel, path: str) -> None:
    """Store a fitted model; an existing path is an error."""
    model.write().save(path)


def cross_validate(
    table: DataFrame, estimator, target: str, keys: Sequence[str], folds: int = 5, prediction: str = "predicted"
) -> DataFrame:
    """Metrics per fold; the fold of a row is a hash of its key."""
    folded = table.withColumn(FOLD, fold_column(keys, folds))
    scored = []
    for fold in range(folds):
        model = estimator.fit(folded.filter(F.col(FOLD) != fold))
        scored.append(model.transform(folded.filter(F.col(FOLD) == fold)))
    return regression_metrics(reduce(DataFrame.unionByName, scored), target, prediction, [FOLD])


def cross_validation_summary(per_fold: DataFrame) -> DataFrame:
    """Mean and population deviation of each metric over the folds."""
    measures = ["rmse", "mae", "r2"]
    return per_fold.agg(
        *[F.avg(m).alias(f"{m}_mean") for m in measures], *[F.stddev_pop(m).alias(f"{m}_std") for m in measures]
    )


# --- attribution ----------------------------------------------------------------------------------------------


def feature_means(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    found = {}
    for names in _groups(features):
        found |= df.agg(*[F.avg(c).cast("double").alias(c) for c in names]).first().asDict()
    return found


def linear_attributions(
    df: DataFrame, coefficients: Mapping[str, float], means: Mapping[str, float], prefix: str = "shap_"
) -> DataFrame:
    """Exact attributions of a linear model: coefficient times distance from the mean. They add up to the
    prediction minus the prediction at the mean."""
    return df.withColumns(
        {f"{prefix}{c}": F.lit(float(b)) * (F.col(c) - F.lit(float(means[c]))) for c, b in coefficients.items()}
    )


def fit_linear(table: DataFrame, target: str, prediction: str = "predicted"):
    return LinearRegression(featuresCol=FEATURES, labelCol=target, predictionCol=prediction).fit(table)


def tree_tables(model: GBTRegressionModel) -> list[tuple[np.ndarray, ...]]:
    """(feature, threshold, children, weighted prediction) of the nodes of every tree; a leaf is its own child, its feature is -1.

    Read from the trees themselves, whose number and depth bound what the driver gets.
    """
    made = []
    for tree, weight in zip(model.trees, model.treeWeights):
        rows, waiting = [], [(tree._java_obj.rootNode(), None)]
        while waiting:
            node, place = waiting.pop()
            own = len(rows)
            if place is not None:
                rows[place[0]][2][place[1]] = own
            if node.subtreeDepth():
                rows.append((node.split().featureIndex(), node.split().threshold(), [own, own], 0.0))
                waiting += [(node.rightChild(), (own, 1)), (node.leftChild(), (own, 0))]
            else:
                rows.append((-1, math.inf, [own, own], weight * node.prediction()))
        made.append(tuple(np.array(part) for part in zip(*rows)))
    return made


def tree_differences(trees: Sequence[tuple[np.ndarray, ...]], x: np.ndarray, means: np.ndarray) -> np.ndarray:
    """For each row and feature: prediction of the trees minus their prediction with the feature at its mean.

    A tree is left another way only below a split on the row's path that sends the mean elsewhere; only these rows go down again.
    """
    out = np.zeros(x.shape)
    flat, base = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
    for feature, threshold, children, value in trees:
        mean_right = ~(means[feature] <= threshold) & (feature >= 0)
        column = np.maximum(feature, 0)  # a leaf asks no feature
        at, path = np.zeros(len(x), np.intp), []
        while (feature[at] >= 0).any():
            right = ~(flat[base + column[at]] <= threshold[at]) & (feature[at] >= 0)
            path.append((feature[at], right != mean_right[at], children[at, 1 - right.astype(np.intp)]))
            at = children[at, right.astype(np.intp)]
        last = value[at]
        for k, (own, parted, other) in enumerate(path):
            for before, earlier, _ in path[:k]:
                parted = parted & ~(earlier & (before == own))
            rows = np.flatnonzero(parted)
            now, swapped = other[rows], own[rows]
            while (feature[now] >= 0).any():
                right = ~(flat[base[rows] + column[now]] <= threshold[now]) & (feature[now] >= 0)
                right = np.where(feature[now] == swapped, mean_right[now], right)
                now = children[now, right.astype(np.intp)]
            out[rows, swapped] += last[rows] - value[now]
    return out


def ablation_attributions(
    model: Model,
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    means: Mapping[str, float],
    prediction: str = "predicted",
) -> DataFrame:
    """Attribution of any model: prediction minus the prediction with one feature set to its mean.

    Long form (keys, feature, attribution): each row becomes one row per feature, scored in a single pass. Nothing
    is shuffled. Of boosted trees, a row meets only the splits of its paths, see :func:`tree_differences`.
    """
    if isinstance(model, GBTRegressionModel):
        trees, at_mean = tree_tables(model), np.array([float(means[c]) for c in features])

        @F.pandas_udf("array<double>")
        def differences(x: pd.Series) -> pd.Series:
            return pd.Series(list(tree_differences(trees, np.stack(x.to_numpy()), at_mean)) if len(x) else [], dtype=object)

        found = assemble(df, features).select(*keys, F.posexplode(differences(vector_to_array(FEATURES))).alias("_i", "attribution"))
        return found.select(*keys, F.get(F.array(*[F.lit(c) for c in features]), F.col("_i")).alias("feature"), "attribution")
    base = model.transform(assemble(df, features)).select(
        *keys, F.col(prediction).alias("_base"), vector_to_array(FEATURES).alias("_x")
    )
    order = {c: i for i, c in enumerate(features)}
    swaps = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.lit(i).alias("i"), F.lit(float(means[c])).alias("mean")) for c, i in order.items()]
    )
    swapped = base.withColumn("_swap", F.explode(swaps)).select(
        *keys,
        "_base",
        "_swap.feature",
        array_to_vector(
            F.transform("_x", lambda x, i: F.when(i == F.col("_swap.i"), F.col("_swap.mean")).otherwise(x))
        ).alias(FEATURES),
    )
    return model.transform(swapped).select(
        *keys, "feature", (F.col("_base") - F.col(prediction)).alias("attribution")
    )


# --- per-key models -------------------------------------------------------------------------------------------


def fit_per_key(df: DataFrame, by: Sequence[str], feature: str, target: str, train: Column | None = None) -> DataFrame:
    """One least-squares line per key: (by, slope, intercept, train_rows).

    The fit is a mergeable aggregate, so a key of any size is fitted from partial sums; the parameters are a table.
    """
    rows = df if train is None else df.filter(train)
    return rows.groupBy(*by).agg(
        F.regr_slope(F.col(target), F.col(feature)).alias("slope"),
        F.regr_intercept(F.col(target), F.col(feature)).alias("intercept"),
        F.count(F.lit(1)).alias("train_rows"),
    )


def predict_per_key(
    df: DataFrame, parameters: DataFrame, by: Sequence[str], feature: str, prediction: str = "predicted_return"
) -> DataFrame:
    joined = df.join(parameters.select(*by, "slope", "intercept"), list(by))
    return joined.withColumn(prediction, F.col("intercept") + F.col("slope") * F.col(feature)).drop("slope", "intercept")


# --- sequences and texts --------------------------------------------------------------------------------------


#: Tasks that add up cross products, each into a table of its own; tables that one task adds.
_SUM_TASKS, _SUM_FAN_IN = 64, 8


def _rows_of(batch: pa.RecordBatch, arrays: str) -> np.ndarray:
    return batch.column(arrays).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def moments(df: DataFrame, arrays: str, label: str) -> tuple[float, np.ndarray, np.ndarray]:
    """(rows, means, centred cross products) of the vectors ``arrays`` with ``label`` behind them; rows without a label take no part.

    A task keeps one table of the squared length of a vector and no rows; tables are added in levels.
    """

    def merge(a, b):
        if a is None:
            return b
        n, step = a[0] + b[0], b[1] - a[1]
        return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)

    def packed(part) -> pa.RecordBatch:
        n, mean, cross = part
        return pa.RecordBatch.from_pydict({"p": pa.array([np.concatenate([[n], mean, cross.ravel()]).tobytes()], pa.binary())})

    def unpacked(part) -> tuple:
        flat = np.frombuffer(part)
        width = int((math.isqrt(4 * (len(flat) - 1) + 1) - 1) // 2)
        return flat[0], flat[1 : width + 1], flat[width + 1 :].reshape(width, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = np.column_stack([_rows_of(part, "x"), part.column("y").to_numpy(zero_copy_only=False)])
                mean = x.mean(axis=0)
                x -= mean
                total = merge(total, (float(len(x)), mean, x.T @ x))
        if total is not None:
            yield packed(total)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in batch.column("p"):
                total = merge(total, unpacked(part.as_buffer()))
        if total is not None:
            yield packed(total)

    known = df.where(F.col(label).isNotNull()).select(F.col(arrays).alias("x"), F.col(label).cast("double").alias("y"))
    rows, tasks = known.coalesce(_SUM_TASKS).mapInArrow(run, "p binary"), _SUM_TASKS
    while tasks > 1:
        tasks = -(-tasks // _SUM_FAN_IN)
        rows = rows.repartition(tasks).mapInArrow(again, "p binary")
    found = rows.first()
    if found is None:
        raise ValueError("no training rows")
    return unpacked(found["p"])


def equivalent_rows(n: float, means: np.ndarray, cross: np.ndarray) -> np.ndarray:
    """Two rows per column with the means and the covariances (divisor: the number of rows) of ``n`` rows with these moments.

    A linear fit sees nothing else of its rows. Columns are brought to unit deviation first; a constant one stays constant.
    """
    width = len(means)
    deviation = np.sqrt(np.diag(cross) / n)
    used = np.flatnonzero(deviation > 0)
    rows = np.tile(means, (2 * width, 1))
    values, vectors = np.linalg.eigh(cross[np.ix_(used, used)] / np.outer(deviation[used], deviation[used]) / n)
    steps = (vectors * np.sqrt(np.maximum(values, 0) * width)).T * deviation[used]
    rows[: len(used), used] += steps
    rows[width : width + len(used), used] -= steps
    return rows


def fit_linear_from_moments(spark: SparkSession, n: float, means: np.ndarray, cross: np.ndarray, regularization: float, max_iter: int):
    """The model that ``LinearRegression`` fits iteratively to ``n`` rows with these moments, fitted to a few rows like them."""
    rows = equivalent_rows(n, means, cross)
    table = spark.createDataFrame(pd.DataFrame({"x": list(rows[:, :-1]), "y": rows[:, -1]}), "x array<double>, y double")
    table = stage_table(table.select(array_to_vector("x").alias(FEATURES), "y"), "equivalent-rows")
    # Sample deviations divide by one row less, which weighs more among few rows; so the penalty is set against that.
    few = len(rows)
    ratio = few / (few - 1) * (n - 1) / n
    estimator = LinearRegression(
        featuresCol=FEATURES,
        labelCol="y",
        regParam=regularization / math.sqrt(ratio),
        solver="l-bfgs",
        maxIter=max_iter,
    )
    return estimator.fit(table)


def sequence_forecast(sequences: DataFrame, cutoff_split: str = s.SPLIT, max_iter: int = 20) -> DataFrame:
    """Linear forecast of the forward return from flattened sequences, for train and test rows.

    Sequences are neither written nor kept: one pass over the train rows adds up their cross products, a second one forecasts.
    What is written are the rows without their sequences.
    """
    flat = sequences.withColumn("_x", F.flatten("sequence")).drop("sequence")
    found = moments(flat.filter(F.col(cutoff_split) == "train"), "_x", "forward_return")
    model = fit_linear_from_moments(sequences.sparkSession, *found, 0.1, max_iter)
    coefficients, intercept = model.coefficients.toArray(), model.intercept

    @F.pandas_udf("double")
    def forecast(x: pd.Series) -> pd.Series:
        parts = [np.stack(x.iloc[at : at + 1024].to_numpy()) @ coefficients for at in range(0, len(x), 1024)]
        return pd.Series(np.concatenate(parts) + intercept if parts else np.zeros(0))

    predicted = stage_table(flat.withColumn("predicted_return", forecast("_x")).drop("_x"), "forecasts")
    return predicted.withColumns(
        {
            "actual_return": F.col("forward_return"),
            "actual_price": F.col("future_close"),
            "predicted_price": target_price(F.col("prev_close"), F.col("predicted_return")),
        }
    )


def text_classifier(
    articles: DataFrame, text: str, label: str, split: str = s.SPLIT, dimensions: int = 1 << 12, max_iter: int = 10
) -> DataFrame:
    """Class-weighted linear text classifier: fit on train rows, (probability, prediction) for all rows.

    Words are counted once, while the rows are staged: all passes of the fit and the prediction read the counts and no text.
    """
    known = articles.filter(F.col(text).isNotNull() & F.col(label).isNotNull())
    words = Tokenizer(inputCol=text, outputCol="_words").transform(known.withColumn(label, F.col(label).cast("double")))
    counted = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dimensions).transform(words)
    known = stage_table(counted.drop("_words"), "texts")
    # A class number and its weight per row: the number of classes is what the classifier has outputs for.
    weights = class_weights(known.filter(F.col(split) == "train"), label).select(label, "weight").collect()
    lookup = F.create_map(*[F.lit(v) for row in weights for v in (row[label], row["weight"])])
    table = known.withColumn("weight", F.coalesce(F.try_element_at(lookup, F.col(label)), F.lit(0.0)))
    pipeline = Pipeline(
        stages=[
            IDF(inputCol="_counts", outputCol=FEATURES),
            LogisticRegression(featuresCol=FEATURES, labelCol=label, weightCol="weight", maxIter=max_iter),
        ]
    )
    model = pipeline.fit(table.filter(F.col(split) == "train"))
    predicted = model.transform(table)
    return predicted.withColumn("confidence", F.array_max(vector_to_array("probability"))).drop(
        "_counts", FEATURES, "rawPrediction", "probability", "weight"
    )
