"""Stored models predict what they predicted, and refuse other columns."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import boosting, model_store


def test_saved_model_is_the_same(spark, tmp_path):
    path = f"file://{tmp_path}/models"
    table = spark.range(300).select((F.col("id") % 7).cast("double").alias("a"), F.col("id").cast("int").alias("b"))
    table = table.withColumn("y", F.col("a") * 2 + F.sqrt("b"))
    (forest,) = boosting.fit_boosted(table, ["a", "b"], "y", trees=3, depth=3, bins=8)
    assert model_store.registry(spark, path).count() == 0
    model_store.save_forest(table, path, "first", forest, {"a": (0.0, 6.0)}, {"rmse": 0.5})
    model_store.save_forest(table, path, "second", forest)
    loaded, ranges, metrics = model_store.load_forest(spark, path, "first", ["a", "b"], table.schema)
    assert ranges == {"a": (0.0, 6.0)} and metrics == {"rmse": 0.5} and loaded.expected == forest.expected
    before, after = (boosting.tree_attributions(boosting.predict_boosted(table, f), f).orderBy("b").collect() for f in (forest, loaded))
    assert before == after and len(before) == 300

    with pytest.raises(ValueError, match="there is a model"):
        model_store.save_forest(table, path, "first", forest)
    with pytest.raises(model_store.WrongColumns):
        model_store.load_forest(spark, path, "first", ["b", "a"], table.schema)
    with pytest.raises(model_store.WrongColumns, match="types"):
        model_store.load_forest(spark, path, "first", ["a", "b"], table.withColumn("b", F.col("b").cast("long")).schema)
    with pytest.raises(KeyError):
        model_store.load_forest(spark, path, "third", ["a", "b"], table.schema)
    assert {r["model"] for r in model_store.registry(spark, path).collect()} == {"first", "second"}
