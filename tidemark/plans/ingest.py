"""Load plans: symbol universe, bars, statements, news and the macro vintage store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import is_plain_ticker, strip, ticker_form
from tidemark.operators.asof import latest_per_key
from tidemark.operators.macro import first_release, revision_counts
from tidemark.operators.news import dedupe_articles, flatten_articles
from tidemark.sources.payloads import json_observations, transpose_statement
from tidemark.sources.sinks import load_manifest, write_table
from tidemark.sources.tables import union_frames


def symbol_universe(listed: DataFrame, holdings: DataFrame, column: str = "symbol") -> DataFrame:
    """Distinct symbols of a listing (share-class dots become dashes) and of fund holdings (plain tickers only)."""
    from_list = listed.select(ticker_form(F.col(column)).alias("symbol"))
    trimmed = holdings.select(strip(F.col(column)).alias("symbol"))
    plain = trimmed.filter(F.col("symbol").isNotNull() & is_plain_ticker(F.col("symbol")))
    both = from_list.unionByName(plain).filter(F.col("symbol").isNotNull() & (F.col("symbol") != ""))
    return both.distinct()


def since(day: str, as_of: Column | str, days: int) -> Column:
    """Rows of the last ``days`` days before ``as_of`` (a parameter, never the clock)."""
    end = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return (F.to_date(day) >= F.date_sub(end, days)) & (F.to_date(day) <= end)


def load_statements(
    vendor: Mapping[str, DataFrame], periods: Sequence[str], metrics: Mapping[str, Sequence[str]], metric: str = "metric"
) -> dict[str, DataFrame]:
    """Transpose every statement of a vendor layout (symbol, metric, one column per period)."""
    return {name: transpose_statement(df, metric, periods, metrics[name]) for name, df in vendor.items()}


def load_news(articles: Sequence[DataFrame]) -> DataFrame:
    """Flatten article objects of several fetches and keep the latest version of each article."""
    return dedupe_articles(union_frames([flatten_articles(a) for a in articles]))


def load_bars(frames: Sequence[DataFrame], key: str = "symbol", on: str = "bar_date") -> DataFrame:
    """Union of bar frames with one row per symbol and day; of several versions the greatest by its columns stays."""
    return latest_per_key(union_frames(frames), [key, on], [])


def load_macro(payloads: DataFrame, payload: str = "payload") -> dict[str, DataFrame]:
    """Vintage store from JSON payloads: all vintages, revision counts and the first-release view."""
    vintages = json_observations(payloads, payload)
    return {
        "vintages": vintages,
        "revisions": revision_counts(vintages),
        "first_release": first_release(vintages),
    }


def store(tables: Mapping[str, DataFrame], folder: str, key: str = "symbol") -> DataFrame:
    """Write every table below a fresh folder and return the manifest of what was written."""
    written = {}
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}")
        written[name] = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")
    return load_manifest(written, key)
