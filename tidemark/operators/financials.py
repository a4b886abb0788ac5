"""Statements, their release dates and the latest statement known on a day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.functions.market import guarded_ratio
from tidemark.operators.asof import asof_join, latest_per_key


def _name(column: str) -> Column:
    return F.col(f"`{column}`")


def rename_columns(df: DataFrame, keys: list[str], columns: Mapping[str, str]) -> DataFrame:
    """Keys plus the listed vendor columns under their feature names."""
    return df.select(*keys, *[_name(vendor).alias(feature) for vendor, feature in columns.items()])


def add_ratios(df: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    return df.withColumns({name: guarded_ratio(F.col(n), F.col(d)) for name, (n, d) in ratios.items()})


def _statement(df: DataFrame, columns: Mapping[str, str], ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    dated = df.withColumn("fiscal_period_end", F.to_date("fiscal_period_end"))
    return add_ratios(rename_columns(dated, ["symbol", "fiscal_period_end"], columns), ratios)


def income_features(income: DataFrame) -> DataFrame:
    return _statement(income, s.INCOME_COLUMNS, s.INCOME_RATIOS)


def balance_features(balance: DataFrame) -> DataFrame:
    return _statement(balance, s.BALANCE_COLUMNS, s.BALANCE_RATIOS)


def cashflow_features(cashflow: DataFrame) -> DataFrame:
    return _statement(cashflow, s.CASHFLOW_COLUMNS, {})


def release_features(earnings: DataFrame) -> DataFrame:
    """One row per symbol and release day; two rows of one day are decided by their earnings columns."""
    dated = earnings.withColumn("release_date", F.to_date("release_date")).filter(F.col("release_date").isNotNull())
    renamed = rename_columns(dated, ["symbol", "release_date"], s.EARNINGS_COLUMNS)
    return latest_per_key(renamed, ["symbol", "release_date"], s.EARNINGS_FEATURES)


def statement_releases(statement: DataFrame, earnings: DataFrame, how: str = "left") -> DataFrame:
    """Attach the first release strictly after the period end, with its earnings columns."""
    return asof_join(
        statement,
        release_features(earnings),
        by=["symbol"],
        left_on="fiscal_period_end",
        right_on="release_date",
        direction="forward",
        allow_exact=False,
        right_unique=True,
        how=how,
    )


def combined_statements(
    income: DataFrame, balance: DataFrame | None, cashflow: DataFrame | None, earnings: DataFrame
) -> DataFrame:
    """Released income statements with the other two of the same period and the earnings row of their release.

    A statement that is None is left out, with its columns.
    """
    joined = statement_releases(income_features(income), earnings, how="inner")
    period, features = ["symbol", "fiscal_period_end"], [*s.EARNINGS_FEATURES, *s.INCOME_FEATURES]
    if balance is not None:
        joined, features = joined.join(balance_features(balance), period, "left"), [*features, *s.BALANCE_FEATURES]
    if cashflow is not None:
        joined, features = joined.join(cashflow_features(cashflow), period, "left"), [*features, *s.CASHFLOW_FEATURES]
    return joined.select(*period, "release_date", *features)


def latest_financials(
    days: DataFrame, combined: DataFrame, on: str = "feature_date", how: str = "left", columns: Sequence[str] | None = None
) -> DataFrame:
    """For each row of ``days`` (symbol, ``on``, ...) the newest statement released on or before that day.

    Equivalent to joining all earlier releases and keeping rank one by release date, then period end, both
    descending, but no row pairs are formed. ``fin_days_since_release`` is the age of the statement. Of the statement's other
    columns only ``columns`` are attached, if given; which statement is the newest is decided by all of them.
    """
    statements = combined.withColumnRenamed("release_date", "fin_release_date")
    if columns is not None:
        known = statements.dropna(subset=["symbol", "fin_release_date"])
        newest = latest_per_key(known, ["symbol", "fin_release_date"], ["fiscal_period_end"])
        statements = newest.select("symbol", "fin_release_date", *[c for c in newest.columns if c in columns])
    found = asof_join(
        days,
        statements,
        by=["symbol"],
        left_on=on,
        right_on="fin_release_date",
        ties=["fiscal_period_end"],
        how=how,
        right_unique=columns is not None,
    )
    return found.withColumn("fin_days_since_release", F.datediff(F.col(on), F.col("fin_release_date")))
