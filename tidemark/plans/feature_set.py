"""Point-in-time feature set: one row per bar with everything known the day before."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.functions.market import availability_date, daily_move, split_label
from tidemark.operators.asof import latest_per_key
from tidemark.operators.financials import combined_statements, latest_financials
from tidemark.operators.macro import pivot_series, series_features, vintages_as_of
from tidemark.operators.news import label_counts
from tidemark.operators.series import shift, with_frames
from tidemark.session import stage_table


def feature_spine(
    bars: DataFrame, day: str = "bar_date", calendar: str = "calendar", lag_days: int = 1
) -> DataFrame:
    """Distinct bars with target and feature date.

    calendar  ``calendar``: the previous calendar day; ``trading``: the symbol's previous bar day (null for its
              first bar).
    """
    if calendar not in ("calendar", "trading"):
        raise ValueError(f"unknown calendar {calendar!r}")
    spine = bars.select(
        "symbol",
        F.to_date(day).alias("prediction_date"),
        daily_move().alias(s.TARGET),
        *[F.col(name.removeprefix("sd_")).alias(name) for name in s.BAR_FEATURES],
        availability_date(F.col(day), lag_days).alias("feature_date"),
    ).distinct()
    if calendar == "calendar":
        return spine
    return with_frames(
        spine,
        ["symbol"],
        "prediction_date",
        lambda rows, window: rows.withColumn("feature_date", shift("prediction_date", 1, window)),
        before=1,
    )


def point_in_time_features(
    bars: DataFrame,
    income: DataFrame,
    balance: DataFrame,
    cashflow: DataFrame,
    earnings: DataFrame,
    vintages: DataFrame,
    scored: dict[str, tuple[DataFrame, str]],
    cutoff: str | date = s.TRAIN_CUTOFF,
    day: str = "bar_date",
    calendar: str = "calendar",
    macro_order: str = "published",
    forecasts: DataFrame | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The 100-column feature set, or those of its ``columns`` that are named, for the same rows.

    ``scored`` maps a prefix to (scored articles, name of the confidence column). Every right side has one row
    per join key, so joins keep the bars as they are and the result is distinct because the spine is.
    ``forecasts`` (symbol, prediction_date, ...) is an optional extra left join. The planner cannot see into the rows that the
    as-of joins carry, nor past written tables, so columns are chosen here, once rows are distinct and the latest is found.
    """
    result_columns = [c for c in s.FEATURE_SET_COLUMNS if columns is None or c in columns]
    spine = feature_spine(bars, day, calendar)
    spine = spine.select(*s.KEY_COLUMNS, *[c for c in result_columns if c in (s.TARGET, *s.BAR_FEATURES)], "feature_date")
    for prefix in s.SENTIMENT_PREFIXES:
        measures = [c for c in result_columns if c in [f"{prefix}_{m}" for m in s.SENTIMENT_MEASURES]]
        if not measures:
            continue
        articles, confidence = scored[prefix]
        daily = label_counts(articles, prefix, confidence).select("symbol", "news_date", *measures)
        if calendar == "calendar":
            # By the bar's own day: bars that are grouped by symbol and day are not shuffled again for these joins.
            keys, daily = s.KEY_COLUMNS, daily.withColumn("news_date", F.date_add("news_date", 1)).withColumnRenamed("news_date", "prediction_date")
        else:
            keys, daily = ["symbol", "feature_date"], daily.withColumnRenamed("news_date", "feature_date")
        spine = spine.join(daily, list(keys), "left")
    # Columns that the feature set has already stay as they are; of several forecasts for a key the greatest counts.
    extra = [c for c in forecasts.columns if c not in s.FEATURE_SET_COLUMNS] if forecasts is not None else []
    if extra:
        unique = latest_per_key(forecasts.select(*s.KEY_COLUMNS, *extra), s.KEY_COLUMNS, [])
        spine = spine.join(unique.select(*s.KEY_COLUMNS, F.struct(*extra).alias("_forecast")), s.KEY_COLUMNS, "left")
    # Read for the rows and for the days of the macro series.
    spine = stage_table(spine, "spine")
    joined = spine
    statements = [c for c in result_columns if c in s.FINANCIAL_FEATURES]
    if statements:
        # Narrow joins first: the statement and macro columns are attached last and are never shuffled.
        # Statements that come last decide last between rows of one release, so they matter to no column before theirs.
        cash = cashflow if set(statements) & set(s.CASHFLOW_FEATURES) else None
        sheet = balance if cash is not None or set(statements) & set(s.BALANCE_FEATURES) else None
        combined = combined_statements(income, sheet, cash, earnings)
        joined = latest_financials(spine, combined, columns=None if columns is None else statements)
    series = {name: feature for name, feature in series_features().items() if feature in result_columns}
    if series:
        known = vintages_as_of(spine, vintages, list(series), order=macro_order)
        # One row per calendar day. As a written table its size is known when the join is planned: the planner broadcasts
        # it below the broadcast threshold and shuffles beyond.
        macro_days = stage_table(pivot_series(known, columns=series), "macro-days")
        joined = joined.join(macro_days, "feature_date", "left")
    result = joined.withColumn(s.SPLIT, split_label(F.col("prediction_date"), cutoff))
    return result.select(*result_columns, *[F.col("_forecast")[c].alias(c) for c in extra])


def split_ranges(
    df: DataFrame, dates: Sequence[tuple[str, str]] = (("target_date", "target"), ("prediction_date", "pred"))
) -> DataFrame:
    """First and last date per split."""
    measures = []
    for column, name in dates:
        measures += [F.min(column).alias(f"first_{name}"), F.max(column).alias(f"last_{name}")]
    return df.groupBy(s.SPLIT).agg(*measures)
