"""Reports on labels and predictions. Every report is a groupBy with partial aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.market import map_values, two_way_direction
from tidemark.operators.ordered import cumulative, exact_quantiles, ordered_places
from tidemark.session import stage_table


def _share(count: str, by: Sequence[str] = ()) -> Column:
    """Share of a group total in percent, over an already aggregated table."""
    return F.col(count) / F.sum(count).over(Window.partitionBy(*by)) * 100


def label_share(df: DataFrame, label: str, move: str | None = None) -> DataFrame:
    """Rows, share in percent and, with ``move``, the mean move per label."""
    measures = [F.count(F.lit(1)).alias("n")] + ([F.avg(move).alias("mean_move")] if move else [])
    return df.groupBy(label).agg(*measures).withColumn("pct", _share("n"))


def frequency_order(df: DataFrame, value: str) -> DataFrame:
    """Values by how often they occur, most frequent first, ties by value (nulls first): (value, n, place)."""
    counted = df.groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    return ordered_places(counted, [F.desc("n"), F.asc_nulls_first(value)])


def label_stats(df: DataFrame, label: str, value: str) -> DataFrame:
    """Mean, sample deviation, count and standard error per label."""
    stats = df.groupBy(label).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count(value).alias("n")
    )
    return stats.withColumn("se", F.col("std") / F.sqrt("n"))


def label_box(df: DataFrame, label: str, value: str) -> DataFrame:
    """Five-number summary per label."""
    marks = {"minimum": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "maximum": 1.0}
    return exact_quantiles(df, value, marks, [label])


def label_box_approx(df: DataFrame, label: str, value: str, accuracy: int = 10000) -> DataFrame:
    """Five-number summary in one pass with mergeable sketches."""
    names = ["minimum", "q1", "median", "q3", "maximum"]
    marks = F.percentile_approx(value, [0.0, 0.25, 0.5, 0.75, 1.0], accuracy)
    boxed = df.groupBy(label).agg(F.count(value).alias("rows"), marks.alias("_box"))
    return boxed.select(label, "rows", *[F.col("_box")[i].alias(n) for i, n in enumerate(names)])


def hit_rate(df: DataFrame, hit: Column, by: Sequence[str] = (), name: str = "accuracy") -> DataFrame:
    """Mean of a boolean and the number of rows, overall or per group."""
    return df.groupBy(*by).agg(F.avg(hit.cast("double")).alias(name), F.count(F.lit(1)).alias("n"))


def equal_width_edges(low: Column, high: Column, bins: int) -> list[Column]:
    """Inner edges of ``bins`` equal parts; a single value gets a small range around itself."""
    flat = F.when(low == 0, F.lit(0.001)).otherwise(F.abs(low) * 0.001)
    start = F.when(low == high, low - flat).otherwise(low)
    stop = F.when(low == high, high + flat).otherwise(high)
    step = (stop - start) / F.lit(float(bins))
    return [start + step * F.lit(float(i)) for i in range(1, bins)]


def right_closed_bin(value: Column, edges: Sequence[Column]) -> Column:
    """1-based bin whose intervals include their upper edge; the lowest value belongs to bin 1."""
    return sum((F.when(value > edge, 1).otherwise(0) for edge in edges), F.lit(1))


def with_range(df: DataFrame, column: str) -> DataFrame:
    """Add ``_low`` and ``_high`` of the whole column, as one scalar subquery (no join)."""
    ends = df.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high"))).scalar()
    ranged = df.withColumn("_range", ends)
    return ranged.withColumns({"_low": F.col("_range.low"), "_high": F.col("_range.high")}).drop("_range")


def confidence_bins(df: DataFrame, confidence: str, hit: Column, keep: Column, bins: int = 5) -> DataFrame:
    """Accuracy per equal-width confidence bin. Edges come from all rows, the accuracy from those with ``keep``.

    Rows with a null or NaN confidence are in no bin.
    """
    usable = df.filter(F.col(confidence).isNotNull() & ~F.isnan(F.col(confidence).cast("double")))
    ranged = with_range(usable, confidence).filter(keep)
    edges = equal_width_edges(F.col("_low"), F.col("_high"), bins)
    placed = ranged.withColumn("bin", right_closed_bin(F.col(confidence), edges))
    return placed.groupBy("bin").agg(F.avg(hit.cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels: Sequence) -> DataFrame:
    """One row per actual label of the list, one count column per predicted label; absent pairs are 0."""
    counted = (
        df.filter(F.col(actual).isin(*labels) & F.col(predicted).isin(*labels))
        .groupBy(actual)
        .pivot(predicted, list(labels))
        .agg(F.count(F.lit(1)))
    )
    spine = df.sparkSession.createDataFrame([(x,) for x in labels], df.select(actual).schema)
    names = {str(x): f"pred_{x}" for x in labels}
    whole = spine.join(counted, actual, "left")
    return whole.select(actual, *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(n) for c, n in names.items()])


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per label, plus macro and weighted means and the accuracy.

    Undefined ratios count as 0. One pass: pair counts, then arithmetic over labels.
    """
    pairs = df.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("n"))
    # Every pair contributes to its actual and to its predicted label.
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col(actual).cast("string").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("found")),
                F.struct(F.col(predicted).cast("string").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("found")),
            )
        ).alias("_s"),
        F.when(F.col(actual) == F.col(predicted), F.col("n")).otherwise(0).alias("hits"),
    )
    totals = sides.groupBy("_s.label").agg(
        F.sum("_s.support").alias("support"), F.sum("_s.found").alias("found"), (F.sum("hits") / 2).alias("hits")
    )
    ratio = {
        "precision": F.when(F.col("found") > 0, F.col("hits") / F.col("found")).otherwise(0.0),
        "recall": F.when(F.col("support") > 0, F.col("hits") / F.col("support")).otherwise(0.0),
    }
    p, r = F.col("precision"), F.col("recall")
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    per_label = totals.withColumns(ratio).withColumn("f1", f1)
    # Each label's row also counts, with its weight, towards the three summary rows.
    hit_share = F.when(F.col("support") > 0, F.col("hits") / F.col("support")).otherwise(0.0)

    def entry(label: Column, weight: Column, values: Sequence[Column]) -> Column:
        names = ("precision", "recall", "f1")
        return F.struct(label.alias("label"), weight.cast("double").alias("w"), *[v.alias(n) for v, n in zip(values, names)])

    own, by_support = F.lit(1.0), F.col("support")
    measured = [F.col("precision"), F.col("recall"), F.col("f1")]
    entries = F.array(
        entry(F.col("label"), own, measured),
        entry(F.lit("macro avg"), own, measured),
        entry(F.lit("weighted avg"), by_support, measured),
        entry(F.lit("accuracy"), by_support, [hit_share] * 3),
    )
    spread = per_label.select("support", F.explode(entries).alias("_e"))
    means = [
        F.try_divide(F.sum(F.col("_e.w") * F.col(f"_e.{m}")), F.sum("_e.w")).alias(m)
        for m in ("precision", "recall", "f1")
    ]
    return spread.groupBy(F.col("_e.label").alias("label")).agg(*means, F.sum("support").alias("support"))


def roc_points(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """One point per distinct score, from the highest down: (threshold, true and false positives and rates).

    Rows with a null or NaN score take no part, neither in the points nor in the totals.
    """
    hit = F.col(label) == F.lit(positive)
    value = F.col(score).cast("double")
    counts = df.filter(value.isNotNull() & ~F.isnan(value)).groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(hit).alias("_pos"), F.count_if(~hit).alias("_neg")
    )
    staged = stage_table(counts, "roc-counts")
    running = cumulative(staged, "threshold", {"true_pos": "_pos", "false_pos": "_neg"}, descending=True)
    totals = staged.agg(F.struct(F.sum("_pos").alias("p"), F.sum("_neg").alias("n"))).scalar()
    rated = running.withColumn("_all", totals)
    return rated.select(
        "threshold",
        "true_pos",
        "false_pos",
        (F.col("true_pos") / F.nullif(F.col("_all.p"), F.lit(0))).alias("tpr"),
        (F.col("false_pos") / F.nullif(F.col("_all.n"), F.lit(0))).alias("fpr"),
        "_pos",
        "_neg",
    )


def auc(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """Area under the ROC curve: each point adds the trapezoid between it and the point before it.

    The previous point's true positives are the running count without the point's own, so no neighbour look-up is
    needed and the area is one sum of integers.
    """
    points = roc_points(df, label, score, positive)
    twice = F.sum(F.col("_neg").cast("double") * (2 * F.col("true_pos") - F.col("_pos")).cast("double"))
    positives, negatives = F.sum("_pos"), F.sum("_neg")
    area = twice / (2.0 * positives.cast("double") * negatives.cast("double"))
    return points.agg(
        F.when((positives > 0) & (negatives > 0), area).alias("auc"),
        positives.alias("positives"),
        negatives.alias("negatives"),
    )


def metric_columns(actual: str, predicted: str) -> list[Column]:
    """Aggregates n, rmse, mae, r2 and mape (with 1e-8 added to the actual); r2 is null below two rows.

    The squared deviations of r2 come from the engine's variance, which merges partial results stably.
    """
    y, p = F.col(actual), F.col(predicted)
    error = y - p
    spread = F.var_pop(y) * F.count(y)
    n = F.count(F.lit(1))
    return [
        n.alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.when((n > 1) & (spread > 0), 1 - F.sum(error * error) / spread).alias("r2"),
        (F.avg(F.abs(error / (y + F.lit(1e-8)))) * 100).alias("mape"),
    ]


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*metric_columns(actual, predicted))


def slice_metrics(df: DataFrame, actual: str, predicted: str, slice_column: str) -> DataFrame:
    """RMSE, R2 and mean prediction per slice with at least two rows."""
    made = df.groupBy(slice_column).agg(*metric_columns(actual, predicted), F.avg(predicted).alias("mean_pred"))
    return made.filter(F.col("n") > 1).select(slice_column, "n", "rmse", "r2", "mean_pred")


def magnitude_group(predicted: Column, threshold: float = 0.05) -> Column:
    return F.when(F.abs(predicted) < threshold, "near_zero").otherwise("normal")


def directional_loss(df: DataFrame, actual: str, predicted: str, weight: float = 2.0, by: Sequence[str] = ()) -> DataFrame:
    """Squared error plus ``weight`` times the actual's magnitude where the signs differ (sign of 0 is 0)."""
    y, p = F.col(actual), F.col(predicted)
    wrong = (F.signum(p) != F.signum(y)).cast("double")
    return df.groupBy(*by).agg(
        F.avg((p - y) * (p - y) + wrong * F.abs(y) * weight).alias("directional_loss"), F.count(F.lit(1)).alias("n")
    )


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Rows per equal-width bin with its lower edge; all ``bins`` bins, the last one includes the maximum."""
    known = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    ends = known.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()

    def edges(frame: DataFrame) -> DataFrame:
        pad = F.when(F.col("_ends.low") == F.col("_ends.high"), 0.5).otherwise(0.0)
        return frame.withColumn("_ends", ends).withColumns(
            {"_low": F.col("_ends.low") - pad, "_width": F.col("_ends.high") - F.col("_ends.low") + 2 * pad}
        )

    index = F.least(F.floor((F.col(value) - F.col("_low")) / F.col("_width") * bins).cast("int"), F.lit(bins - 1))
    counts = edges(known.select(value)).groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return edges(spine.join(counts, "bin", "left")).select(
        "bin",
        F.coalesce("_n", F.lit(0)).alias("n"),
        (F.col("_low") + F.col("_width") * F.col("bin") / bins).alias("bin_start"),
    )


def label_distribution_compare(df: DataFrame, actual: str, predicted: str, labels: Sequence[str]) -> DataFrame:
    """Actual and predicted counts side by side for a fixed label list; absent labels count 0. One pass."""
    measures = []
    for i, label in enumerate(labels):
        measures.append(F.count_if(F.col(actual) == label).alias(f"_a{i}"))
        measures.append(F.count_if(F.col(predicted) == label).alias(f"_p{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"), F.col(f"_a{i}").alias("actual_n"), F.col(f"_p{i}").alias("predicted_n")
            )
            for i, label in enumerate(labels)
        ]
    )
    return df.agg(*measures).select(F.inline(rows))


def degenerate_check(df: DataFrame, label: str, confidence: str) -> DataFrame:
    """Whether all rows carry one label, the largest label share and the number of distinct confidences."""
    shares = label_share(df, label)
    top = shares.agg(F.max("pct").alias("top_pct"), F.count(F.lit(1)).alias("labels")).select(
        F.struct("top_pct", "labels")
    )
    return df.agg(F.countDistinct(confidence).alias("distinct_confidences")).select(
        "distinct_confidences",
        top.scalar()["top_pct"].alias("top_pct"),
        top.scalar()["labels"].alias("labels"),
        (top.scalar()["labels"] <= 1).alias("one_label_only"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Inverse class frequencies scaled to add up to the number of classes."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()
    inverse = F.lit(1.0) / F.col("n")
    return counts.withColumn("weight", inverse / F.sum(inverse).over(everything) * F.count(F.lit(1)).over(everything))


def forecast_report(df: DataFrame, by: Sequence[str] = ("symbol",), split: str = "split") -> DataFrame:
    """Prediction rows with directions, hit flag and each symbol's test accuracy."""
    up_actual = (F.col("actual_return") > 0).cast("int")
    up_predicted = (F.col("predicted_return") > 0).cast("int")
    flagged = df.withColumns(
        {
            "actual_direction": up_actual,
            "predicted_direction": up_predicted,
            "direction_correct": (up_actual == up_predicted).cast("int"),
        }
    )
    accuracy = flagged.groupBy(*by).agg(
        F.avg(F.when(F.col(split) == "test", F.col("direction_correct"))).alias("symbol_test_accuracy")
    )
    return flagged.join(accuracy, list(by), "left")


def symbol_accuracy(df: DataFrame, by: Sequence[str] = ("symbol", "split")) -> DataFrame:
    """Mean and count of the hit flag per group."""
    hit = (F.col("actual_return") > 0) == (F.col("predicted_return") > 0)
    return hit_rate(df, hit, by, "mean").withColumnRenamed("n", "count")


def symbol_errors(df: DataFrame, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Price errors and direction accuracy (percent) per symbol over the given rows."""
    error = F.col("actual_price") - F.col("predicted_price")
    hit = (F.col("actual_return") > 0) == (F.col("predicted_return") > 0)
    return df.groupBy(*by).agg(
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(hit.cast("double")) * 100).alias("direction_accuracy"),
    )


def top_bottom(df: DataFrame, value: str, tie: str, k: int = 5) -> DataFrame:
    """First and last ``k`` rows by a value (ties by name), tagged."""
    top = df.orderBy(F.col(value).desc(), F.col(tie).asc()).limit(k).withColumn("rank_group", F.lit("top"))
    bottom = df.orderBy(F.col(value).asc(), F.col(tie).desc()).limit(k).withColumn("rank_group", F.lit("bottom"))
    return top.unionByName(bottom)


def sentiment_direction_accuracy(
    df: DataFrame, sentiment: str, move: str, mapping: Mapping[str, str], flat: str = "neutral"
) -> DataFrame:
    """Accuracy of the labels read as directions, without the flat label; a label that is no direction is a miss."""
    hit = map_values(F.col(sentiment), mapping) == two_way_direction(F.col(move))
    return hit_rate(df.filter(F.col(sentiment) != flat), F.coalesce(hit, F.lit(False)))
