"""Reports and runs put together from the operators. Each returns named DataFrames; nothing is computed until read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.functions.market import sentiment_hit, three_way_direction, two_way_direction
from tidemark.functions.text import SENTIMENT_TO_DIRECTION
from tidemark.operators import diagnosis, evaluation, modeling
from tidemark.operators.indicator_sequences import indicator_sequences
from tidemark.session import stage_table

_MOVE = s.TARGET


def sentiment_report(scored: DataFrame, confident: float = 0.9) -> dict[str, DataFrame]:
    """Evaluation of scored articles that carry the next bar's move."""
    hit = sentiment_hit(F.col("sentiment"), F.col(_MOVE))
    decided = F.col("sentiment") != "neutral"
    return {
        "labels": evaluation.label_share(scored, "sentiment", _MOVE),
        "moves": evaluation.label_stats(scored, "sentiment", _MOVE),
        "box": evaluation.label_box(scored, "sentiment", _MOVE),
        "accuracy": evaluation.hit_rate(scored.filter(decided), hit, ["sentiment"]),
        "accuracy_overall": evaluation.hit_rate(scored.filter(decided), hit),
        "accuracy_confident": evaluation.hit_rate(scored.filter(decided & (F.col("confidence") > confident)), hit),
        "accuracy_by_confidence": evaluation.confidence_bins(scored, "confidence", hit, decided),
        "as_direction": evaluation.sentiment_direction_accuracy(scored, "sentiment", _MOVE, SENTIMENT_TO_DIRECTION),
    }


def sentiment_summary(scored: DataFrame, confident: float = 0.9) -> DataFrame:
    """The figures of :func:`sentiment_report` per label and for all rows (label ``all``) from one aggregate.

    Accuracies are over rows that are not neutral; rows without a label are a group of their own, with a null label.
    """
    hit = sentiment_hit(F.col("sentiment"), F.col(_MOVE)).cast("double")
    decided = F.coalesce(F.col("sentiment") != "neutral", F.lit(False))
    sure = decided & F.coalesce((F.col("confidence") > confident) & ~F.isnan("confidence"), F.lit(False))
    rows = scored.select("sentiment", _MOVE, hit.alias("_hit"), decided.alias("_decided"), sure.alias("_sure"))
    made = rows.groupingSets([("sentiment",), ()], "sentiment").agg(
        F.grouping("sentiment").alias("_all"),
        F.count("*").alias("n"),
        F.avg(_MOVE).alias("mean_move"),
        F.stddev_samp(_MOVE).alias("std_move"),
        (F.stddev_samp(_MOVE) / F.sqrt(F.count(_MOVE))).alias("se_move"),
        F.min(_MOVE).alias("lowest_move"),
        F.max(_MOVE).alias("highest_move"),
        F.count_if("_decided").alias("n_decided"),
        F.avg(F.when(F.col("_decided"), F.col("_hit"))).alias("accuracy"),
        F.count_if("_sure").alias("n_confident"),
        F.avg(F.when(F.col("_sure"), F.col("_hit"))).alias("accuracy_confident"),
    )
    label = F.when(F.col("_all") == 1, F.lit("all")).otherwise(F.col("sentiment"))
    # One row per label: the window is over the aggregate, and the row of all is its largest.
    pct = F.try_divide(F.col("n"), F.max("n").over(Window.partitionBy())) * 100
    return made.withColumns({"sentiment": label, "pct": pct}).drop("_all")


def direction_report(predicted: DataFrame, label: str = "predicted_direction") -> dict[str, DataFrame]:
    """Evaluation of up/down/stable predictions: distributions with the dead band, accuracy on up and down only."""
    labelled = predicted.withColumns(
        {"actual_direction": three_way_direction(F.col(_MOVE)), "actual_binary": two_way_direction(F.col(_MOVE))}
    )
    decided = labelled.filter(F.col(label) != "stable")
    hit = F.col(label) == F.col("actual_binary")
    return {
        "distribution": evaluation.label_distribution_compare(
            labelled, "actual_direction", label, ["up", "stable", "down"]
        ),
        "accuracy": evaluation.hit_rate(decided, hit, [label]),
        "accuracy_overall": evaluation.hit_rate(decided, hit),
        "confusion": evaluation.confusion_matrix(decided, "actual_binary", label, ["up", "down"]),
        "report": evaluation.classification_report(decided, "actual_binary", label),
        "degenerate": evaluation.degenerate_check(labelled, label, "prediction_confidence"),
    }


def forecast_dataset(
    bars: DataFrame,
    cutoff: str = s.TRAIN_CUTOFF,
    features: Sequence[str] = tuple(s.INDICATOR_FEATURES),
    on: str = "bar_date",
    fit_on_train: bool = False,
) -> DataFrame:
    """Indicators, per-symbol scaling, sequences with forward returns, and the target-date split.

    By default the scaling range covers all rows of a symbol; with ``fit_on_train`` only bars before the cut-off.
    """
    return indicator_sequences(bars, list(features), cutoff, on=on, fit_on_train=fit_on_train)


def forecast_tables(predictions: DataFrame) -> dict[str, DataFrame]:
    """Prediction table with flags, per-symbol errors on test rows, accuracies and split ranges."""
    test = predictions.filter(F.col(s.SPLIT) == "test")
    errors = evaluation.symbol_errors(test)
    return {
        "predictions": evaluation.forecast_report(predictions),
        "symbol_errors": errors,
        "mean_accuracy": errors.agg(F.avg("direction_accuracy").alias("mean_direction_accuracy")),
        "top_bottom": evaluation.top_bottom(errors, "direction_accuracy", "symbol"),
        "accuracy": evaluation.symbol_accuracy(predictions),
        "test_accuracy": evaluation.symbol_accuracy(test, ["symbol"]),
    }


def boosted_run(
    feature_set: DataFrame,
    features: Sequence[str] = tuple(s.MODEL_FEATURES),
    trees: int = 100,
    rate: float = 0.1,
    depth: int = 6,
    folds: int = 5,
) -> tuple[Model, dict[str, DataFrame]]:
    """Null profile, scaling fitted on train, cross-validation on train, final fit, predictions and metrics."""
    table = stage_table(diagnosis.with_availability(feature_set), "feature-set")
    ranges = modeling.fit_minmax(table.filter(F.col(s.SPLIT) == "train"), features)
    keep = [*s.KEY_COLUMNS, s.TARGET, s.SPLIT, "pattern"]
    scaled = modeling.apply_minmax(table.filter(F.col(s.TARGET).isNotNull()), ranges)
    training = modeling.training_table(scaled, features, keep)
    estimator = modeling.boosted_trees(s.TARGET, trees, rate, depth)
    per_fold = modeling.cross_validate(
        training.filter(F.col(s.SPLIT) == "train"), estimator, s.TARGET, s.KEY_COLUMNS, folds
    )
    model, predicted = modeling.fit_and_predict(training, estimator)
    residuals = predicted.withColumn("residual", F.col(s.TARGET) - F.col("predicted"))
    train = predicted.filter(F.col(s.SPLIT) == "train")
    return model, {
        "null_profile": diagnosis.null_profile(table, features),
        "null_share": diagnosis.null_share_by_group(table),
        "patterns": diagnosis.availability_patterns(table),
        "cv_folds": per_fold,
        "cv_summary": modeling.cross_validation_summary(per_fold),
        "predictions": predicted.drop(modeling.FEATURES),
        "metrics": evaluation.regression_metrics(predicted, s.TARGET, "predicted", [s.SPLIT]),
        "metrics_by_pattern": evaluation.slice_metrics(train, s.TARGET, "predicted", "pattern"),
        "residuals": evaluation.histogram(residuals, "residual"),
    }


def prediction_diagnosis(
    predicted: DataFrame, raw: DataFrame, features: Sequence[str], threshold: float = 0.05
) -> dict[str, DataFrame]:
    """Near-zero predictions against the others: metrics, feature gaps, symbols, ranges and raw feature cohorts.

    ``predicted`` holds keys, target, prediction and the (scaled) features; ``raw`` the unscaled feature set.
    """
    grouped = predicted.withColumn("pred_group", evaluation.magnitude_group(F.col("predicted"), threshold))
    near: Column = F.col("pred_group") == "near_zero"
    profile = diagnosis.group_profile(grouped, near)
    tagged = raw.join(profile.select("symbol", "pct_near_zero"), "symbol")
    return {
        "metrics": evaluation.slice_metrics(grouped, s.TARGET, "predicted", "pred_group"),
        "feature_gaps": diagnosis.mean_gaps(grouped, near, features),
        "only_near_zero": diagnosis.only_in_group(grouped, near),
        "ranges": diagnosis.group_ranges(grouped, "pred_group", "prediction_date", "fin_days_since_release"),
        "profile": profile,
        "top_near_zero": diagnosis.top_k(profile, "near_zero_records"),
        "top_normal": diagnosis.top_k(profile, "normal_records"),
        "extremes": diagnosis.profile_extremes(profile),
        "cohorts": diagnosis.cohort_ratios(
            tagged, F.col("pct_near_zero") >= 90, F.col("pct_near_zero") <= 10, _COHORT_FEATURES
        ),
    }


def prediction_summary(
    predicted: DataFrame, threshold: float = 0.05, actual: str = s.TARGET, prediction: str = "predicted"
) -> DataFrame:
    """Near-zero predictions against the others, from one aggregate per (symbol, group): errors, hits, dates, symbols,
    symbols that occur in no other group, and the share of the symbol with most rows.

    Rows without a target or a prediction take no part.
    """
    known = predicted.where(F.col(actual).isNotNull() & F.col(prediction).isNotNull())
    error = F.col(actual).cast("double") - F.col(prediction)
    core = known.groupBy("symbol", evaluation.magnitude_group(F.col(prediction), threshold).alias("pred_group")).agg(
        F.count("*").alias("_n"),
        F.sum(error * error).alias("_square"),
        F.sum(F.abs(error)).alias("_abs"),
        F.count_if((F.col(actual) > 0) == (F.col(prediction) > 0)).alias("_hits"),
        F.min("prediction_date").alias("_first"),
        F.max("prediction_date").alias("_last"),
    )
    # At most two rows a symbol.
    groups = core.withColumn("_groups", F.count("*").over(Window.partitionBy("symbol")))
    n = F.sum("_n")
    return groups.groupBy("pred_group").agg(
        n.alias("n"),
        F.sqrt(F.sum("_square") / n).alias("rmse"),
        (F.sum("_abs") / n).alias("mae"),
        (F.sum("_hits") / n).alias("direction_accuracy"),
        F.min("_first").alias("first_date"),
        F.max("_last").alias("last_date"),
        F.count("*").alias("symbols"),
        F.count_if(F.col("_groups") == 1).alias("only_symbols"),
        (F.max("_n") / n).alias("largest_share"),
    )


# Raw features compared between cohorts.
_COHORT_FEATURES = [
    "is_total_revenue",
    "bs_total_assets",
    "is_net_income",
    "cf_operating_cash_flow",
    "econ_high_yield_spread",
]


def attribution_report(
    attributions: DataFrame, features: Sequence[str], prediction: str = "predicted", threshold: float = 0.05
) -> dict[str, DataFrame]:
    """Importance of every feature, overall and in the high against the near-zero predictions of the train rows."""
    importance = diagnosis.attribution_importance(attributions, features)
    compared = diagnosis.attribution_by_group(
        attributions.filter(F.col(s.SPLIT) == "train"), features, F.abs(F.col(prediction)) >= threshold
    )
    return {
        "importance": importance,
        "top_importance": diagnosis.top_k(importance, "importance", 30, "feature"),
        "by_group": compared,
        "top_high": diagnosis.top_k(compared, "high_sum", 20, "feature"),
        "top_low": diagnosis.top_k(compared, "low_sum", 20, "feature"),
    }


def attribution_summary(
    attributions: DataFrame, features: Sequence[str], prediction: str = "predicted", threshold: float = 0.05
) -> DataFrame:
    """The tables of :func:`attribution_report` as one, from one aggregate: importance of every feature over all rows, with its
    rank (ties by name), and in the high against the near-zero predictions of the train rows."""
    train = F.coalesce(F.col(s.SPLIT) == "train", F.lit(False))
    high = F.coalesce(F.abs(prediction) >= threshold, F.lit(False))
    parts = {"importance": F.lit(True), "high_sum": F.col("_part") == "high", "low_sum": F.col("_part") == "low"}
    part = F.when(train & high, "high").when(train, "low").otherwise("test")
    # One sum per feature and group over the rows; the three figures come from the three groups.
    groups = attributions.groupBy(part.alias("_part")).agg(
        *[F.sum(F.abs(f"shap_{c}")).alias(f"_{i}") for i, c in enumerate(features)]
    )
    sums = groups.agg(
        *[
            F.coalesce(F.sum(F.when(p, F.col(f"_{i}"))), F.lit(0.0)).alias(f"_{n}{i}")
            for i in range(len(features))
            for n, p in parts.items()
        ]
    )
    rows = {c: [F.col(f"_{n}{i}") for n in parts] for i, c in enumerate(features)}
    long = sums.select(diagnosis.melt(rows, list(parts), "feature"))
    whole = Window.partitionBy()  # one row per feature
    share = lambda c: F.try_divide(F.col(c), F.sum(c).over(whole)) * 100
    made = long.withColumns({"pct": share("importance"), "high_pct": share("high_sum"), "low_pct": share("low_sum")})
    place = F.row_number().over(Window.orderBy(F.desc("importance"), "feature"))
    return made.withColumns({"place": place, "pct_diff": F.col("high_pct") - F.col("low_pct")})
