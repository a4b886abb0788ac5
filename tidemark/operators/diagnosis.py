"""Data availability, prediction groups and attribution roll-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.functions.market import availability_pattern, has_value

FEATURE_GROUPS = {
    "sentiment": s.SENTIMENT_FEATURES,
    "financial": s.FINANCIAL_FEATURES,
    "economic": s.MACRO_FEATURES,
}


def columns_starting(df: DataFrame, *prefixes: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefixes)]


def feature_columns(df: DataFrame, excluded: Sequence[str] = ()) -> list[str]:
    """Model inputs of a feature set: everything but keys, target, split and the bar's own columns."""
    skip = {*s.KEY_COLUMNS, s.TARGET, s.SPLIT, *s.BAR_FEATURES, *excluded}
    return [c for c in df.columns if c not in skip]


def melt(rows: Mapping[str, Sequence[Column]], names: Sequence[str], key: str) -> Column:
    """Turn one wide row into several: ``inline`` of an array with one struct per key."""
    items = [
        F.struct(F.lit(name).alias(key), *[value.alias(n) for n, value in zip(names, values)])
        for name, values in rows.items()
    ]
    return F.inline(F.array(*items))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values (null, or NaN in a floating column) and their share in percent, from one aggregate."""
    names = list(columns or df.columns)
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    there = {c: F.when(F.col(c).isNotNull() & ~F.isnan(c), 1) if c in floating else F.col(c) for c in names}
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(there[c]).alias(f"_{i}") for i, c in enumerate(names)]
    )
    missing = {c: F.col("_rows") - F.col(f"_{i}") for i, c in enumerate(names)}
    rows = {c: [n, n / F.nullif(F.col("_rows"), F.lit(0)) * 100] for c, n in missing.items()}
    return counts.select(melt(rows, ["nulls", "null_pct"], "column_name"))


def null_share_by_group(df: DataFrame, groups: Mapping[str, Sequence[str]] = FEATURE_GROUPS) -> DataFrame:
    """Null share averaged over the columns of each group."""
    columns = [c for group in groups.values() for c in group]
    profile = null_profile(df, columns)
    label = F.lit(None).cast("string")
    for name, group in groups.items():
        label = F.when(F.col("column_name").isin(*group), F.lit(name)).otherwise(label)
    return profile.groupBy(label.alias("feature_group")).agg(F.avg("null_pct").alias("null_pct"))


def with_availability(
    df: DataFrame, articles: str = "fingpt_total_articles", statement: str = "is_total_revenue"
) -> DataFrame:
    """Add ``has_sentiment``, ``has_financials`` and the four-way ``pattern``."""
    flagged = df.withColumns(
        {"has_sentiment": has_value(F.col(articles), positive=True), "has_financials": has_value(F.col(statement))}
    )
    return flagged.withColumn("pattern", availability_pattern(F.col("has_sentiment"), F.col("has_financials")))


def availability_patterns(df: DataFrame) -> DataFrame:
    """Rows and share per flag combination."""
    counts = df.groupBy("has_sentiment", "has_financials").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.col("n") / F.sum("n").over(Window.partitionBy()) * 100)


def group_profile(df: DataFrame, near_zero: Column, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Rows of each key in the two prediction groups, their total and the near-zero share.

    One conditional aggregate; it gives what an outer merge of two counts with zeros for missing keys gives.
    """
    flag = F.coalesce(near_zero, F.lit(False))
    counted = df.groupBy(*by).agg(
        F.count_if(flag).alias("near_zero_records"), F.count_if(~flag).alias("normal_records")
    )
    total = F.col("near_zero_records") + F.col("normal_records")
    return counted.withColumn("total", total).withColumn(
        "pct_near_zero", F.col("near_zero_records") / F.col("total") * 100
    )


def merge_counts(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Full outer merge of two count tables; a key missing on one side counts 0."""
    counts = [c for c in [*left.columns, *right.columns] if c not in by]
    return left.join(right, list(by), "full_outer").na.fill(0, counts)


def profile_extremes(profile: DataFrame, high: float = 90.0, low: float = 10.0) -> DataFrame:
    """Keys and rows of the keys that are almost always, or almost never, near zero."""
    is_high, is_low = F.col("pct_near_zero") >= high, F.col("pct_near_zero") <= low
    counted = profile.agg(
        F.count_if(is_high).alias("_high"),
        F.coalesce(F.sum(F.when(is_high, F.col("near_zero_records"))), F.lit(0)).alias("_high_rows"),
        F.count_if(is_low).alias("_low"),
        F.coalesce(F.sum(F.when(is_low, F.col("normal_records"))), F.lit(0)).alias("_low_rows"),
    )
    rows = {"high": [F.col("_high"), F.col("_high_rows")], "low": [F.col("_low"), F.col("_low_rows")]}
    return counted.select(melt(rows, ["symbols", "records"], "cohort"))


def mean_gaps(df: DataFrame, group: Column, columns: Sequence[str], at_least: float = 0.1) -> DataFrame:
    """Means of each column inside and outside a group, where they differ by more than ``at_least``."""
    inside = F.coalesce(group, F.lit(False))
    measures = []
    for i, c in enumerate(columns):
        measures += [F.avg(F.when(inside, F.col(c))).alias(f"_in{i}"), F.avg(F.when(~inside, F.col(c))).alias(f"_out{i}")]
    means = df.agg(*measures)
    rows = {c: [F.col(f"_in{i}"), F.col(f"_out{i}")] for i, c in enumerate(columns)}
    long = means.select(melt(rows, ["mean_in_group", "mean_outside"], "feature"))
    return long.filter(F.abs(F.col("mean_in_group") - F.col("mean_outside")) > at_least)


def cohort_ratios(df: DataFrame, high: Column, low: Column, columns: Sequence[str]) -> DataFrame:
    """Per column: mean and nulls of two cohorts and the ratio of the means (infinite over a zero mean). NaN counts as null."""
    measures = []
    for i, c in enumerate(columns):
        for name, mask in (("h", high), ("l", low)):
            missing = F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
            measures.append(F.avg(F.when(mask & ~missing, F.col(c))).alias(f"_{name}{i}"))
            measures.append(F.count_if(mask & missing).alias(f"_{name}n{i}"))
    means = df.agg(*measures)
    rows = {}
    for i, c in enumerate(columns):
        h, low_mean = F.col(f"_h{i}"), F.col(f"_l{i}")
        ratio = F.when(low_mean == 0, F.lit(float("inf"))).otherwise(h / low_mean)
        rows[c] = [h, low_mean, F.col(f"_hn{i}"), F.col(f"_ln{i}"), ratio]
    return means.select(melt(rows, ["high_mean", "low_mean", "high_nulls", "low_nulls", "ratio"], "feature"))


def cohort_members(df: DataFrame, profile: DataFrame, cohort: Column, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Rows of the keys in a cohort."""
    return df.join(profile.filter(cohort).select(*by), list(by), "left_semi")


def group_ranges(df: DataFrame, group: str, day: str, recency: str | None = None) -> DataFrame:
    """Date range, rows, distinct symbols and mean statement age per group."""
    measures = [
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("symbol").alias("symbols"),
    ]
    if recency:
        measures.append(F.avg(recency).alias("mean_recency"))
    return df.groupBy(group).agg(*measures)


def only_in_group(df: DataFrame, group: Column, key: str = "symbol") -> DataFrame:
    """Keys that occur inside the group and nowhere else (a set difference in one aggregate)."""
    inside = F.coalesce(group, F.lit(False))
    return df.groupBy(key).agg(F.bool_and(inside).alias("_only")).filter("_only").select(key)


def top_k(df: DataFrame, value: str, k: int = 20, tie: str = "symbol") -> DataFrame:
    """``k`` largest rows by a value, ties by name."""
    return df.orderBy(F.col(value).desc(), F.col(tie).asc()).limit(k)


def attribution_importance(attributions: DataFrame, features: Sequence[str], prefix: str = "shap_") -> DataFrame:
    """Sum of absolute attributions per feature and its share of the total in percent."""
    sums = attributions.agg(*[F.sum(F.abs(F.col(f"{prefix}{c}"))).alias(f"_{i}") for i, c in enumerate(features)])
    rows = {c: [F.col(f"_{i}")] for i, c in enumerate(features)}
    long = sums.select(melt(rows, ["importance"], "feature"))
    total = F.sum("importance").over(Window.partitionBy())
    return long.withColumn("pct", F.try_divide(F.col("importance"), total) * 100)


def attribution_by_group(
    attributions: DataFrame, features: Sequence[str], high: Column, prefix: str = "shap_"
) -> DataFrame:
    """Importance per feature in the high and the low prediction group, shares in percent and their gap."""
    inside = F.coalesce(high, F.lit(False))
    measures = []
    for i, c in enumerate(features):
        size = F.abs(F.col(f"{prefix}{c}"))
        measures += [
            F.coalesce(F.sum(F.when(inside, size)), F.lit(0.0)).alias(f"_h{i}"),
            F.coalesce(F.sum(F.when(~inside, size)), F.lit(0.0)).alias(f"_l{i}"),
        ]
    sums = attributions.agg(*measures)
    rows = {c: [F.col(f"_h{i}"), F.col(f"_l{i}")] for i, c in enumerate(features)}
    long = sums.select(melt(rows, ["high_sum", "low_sum"], "feature"))
    everything = Window.partitionBy()
    shares = {
        "high_pct": F.try_divide(F.col("high_sum"), F.sum("high_sum").over(everything)) * 100,
        "low_pct": F.try_divide(F.col("low_sum"), F.sum("low_sum").over(everything)) * 100,
    }
    return long.withColumns(shares).withColumn("pct_diff", F.col("high_pct") - F.col("low_pct"))
