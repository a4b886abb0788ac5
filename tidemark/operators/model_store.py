"""Fitted boosted models in tables: what was fitted, on which columns in which order, with which scaling and scores.

A model is two things below one path: its nodes, and a row of the registry that is written last, so a model is either whole or
not there. Reading checks the caller's feature order and column types against what the model was fitted on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.boosting import Forest

_REGISTRY = (
    "model string, features array<string>, fingerprint string, base double, depth int, trees int, edges array<array<double>>, "
    "ranges map<string,struct<low:double,high:double>>, metrics map<string,double>, saved_at timestamp"
)
_NODES = "model string, tree int, node int, feature int, cut int, value double, cover double"


class WrongColumns(ValueError):
    """The given columns are not those that the model was fitted on."""


def fingerprint(schema: StructType, features: Sequence[str]) -> str:
    """Names and types of the features, in order."""
    text = ",".join(f"{c}:{schema[c].dataType.simpleString()}" for c in features)
    return hashlib.sha256(text.encode()).hexdigest()


def save_forest(
    table: DataFrame,
    path: str,
    model: str,
    forest: Forest,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    metrics: Mapping[str, float] | None = None,
) -> None:
    """Store a model fitted on ``table``'s columns; a name that is taken is an error."""
    spark = table.sparkSession
    if not registry(spark, path).where(F.col("model") == model).isEmpty():
        raise ValueError(f"there is a model {model} at {path}")
    filled = np.argwhere(forest.cover > 0)
    nodes = [
        (model, int(t), int(k), int(forest.feature[t, k]), int(forest.cut[t, k]), float(forest.value[t, k]), float(forest.cover[t, k]))
        for t, k in filled
    ]
    spark.createDataFrame(nodes, _NODES).coalesce(1).write.mode("append").partitionBy("model").parquet(f"{path}/nodes")
    row = (
        model, list(forest.features), fingerprint(table.schema, forest.features), float(forest.base), forest.depth, forest.trees,
        [[float(v) for v in e] for e in forest.edges], {k: (float(a), float(b)) for k, (a, b) in (ranges or {}).items()},
        {k: float(v) for k, v in (metrics or {}).items()}, None,
    )
    made = spark.createDataFrame([row], _REGISTRY).withColumn("saved_at", F.current_timestamp())
    made.coalesce(1).write.mode("append").parquet(f"{path}/registry")


def registry(spark: SparkSession, path: str) -> DataFrame:
    """All stored models; none where nothing has been saved."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/registry")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], _REGISTRY)
    return spark.read.schema(_REGISTRY).parquet(f"{path}/registry")


def load_forest(
    spark: SparkSession, path: str, model: str, features: Sequence[str], schema: StructType
) -> tuple[Forest, dict[str, tuple[float, float]], dict[str, float]]:
    """(model, ranges, metrics), if it was fitted on these features in this order and on columns of these types."""
    row = registry(spark, path).where(F.col("model") == model).first()
    if row is None:
        raise KeyError(model)
    if row["features"] != list(features):
        raise WrongColumns(f"{model} was fitted on {row['features']}")
    if row["fingerprint"] != fingerprint(schema, features):
        raise WrongColumns(f"{model} was fitted on columns of other types")
    size = 2 ** (row["depth"] + 1) - 1
    feature, cut, value, cover = (np.full((row["trees"], size), v, k) for v, k in ((-1, np.int64), (0, np.int64), (0, float), (0, float)))
    # A model has a fixed number of nodes, whatever it was fitted on.
    for n in spark.read.schema(_NODES).parquet(f"{path}/nodes").where(F.col("model") == model).collect():
        at = n["tree"], n["node"]
        feature[at], cut[at], value[at], cover[at] = n["feature"], n["cut"], n["value"], n["cover"]
    edges = tuple(np.array(e, float) for e in row["edges"])
    forest = Forest(tuple(features), edges, row["base"], row["depth"], feature, cut, value, cover)
    return forest, {k: (v["low"], v["high"]) for k, v in row["ranges"].items()}, dict(row["metrics"])
