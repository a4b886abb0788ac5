"""Articles: per-symbol rows, daily roll-ups, the next bar's move and daily label counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import null_safe_join
from tidemark.functions.market import availability_date, daily_move
from tidemark.functions.text import ARTICLE_SEPARATOR, article_text, join_symbols, symbol_list
from tidemark.operators.asof import latest_per_key

_ROLLUP_SLICE_SECONDS = 300
_ROLLUP_PIECE_ARTICLES = 1000


def flatten_articles(articles: DataFrame) -> DataFrame:
    """Vendor article objects to flat rows; the symbol array becomes a comma list (empty text if none)."""
    return articles.select(
        "id",
        "headline",
        "summary",
        "author",
        "created_at",
        "updated_at",
        "url",
        join_symbols(F.col("symbols")).alias("symbols"),
        "source",
    )


def dedupe_articles(news: DataFrame) -> DataFrame:
    """One row per article id, the latest update; equal updates are decided by the remaining columns."""
    return latest_per_key(news, ["id"], ["updated_at"])


def explode_symbols(news: DataFrame) -> DataFrame:
    """One row per article and mentioned symbol; empty entries of the list give no row."""
    return news.withColumn("symbol", F.explode(symbol_list(F.col("symbols"))))


def bar_moves(bars: DataFrame, day: str = "bar_date") -> DataFrame:
    """Move of each bar keyed by the day its features must be known."""
    return bars.select(
        "symbol",
        availability_date(F.col(day)).alias("news_date"),
        daily_move().alias("percent_daily_price_change"),
    )


def article_next_bar(
    news: DataFrame, bars: DataFrame, with_summary: bool = False, day: str = "bar_date"
) -> DataFrame:
    """Distinct article x symbol rows with the open-to-close move of the following day's bar.

    Distinct runs on the articles before they are multiplied by their symbols; a repeated symbol inside one list
    is removed from the list.
    """
    summary = F.col("summary") if with_summary else None
    articles = news.select(
        F.col("id").alias("news_article_id"),
        F.to_date("created_at").alias("news_date"),
        "created_at",
        "symbols",
        article_text(F.col("headline"), summary).alias("article_text"),
    ).distinct()
    per_symbol = articles.select(
        "news_article_id",
        F.explode(F.array_distinct(symbol_list(F.col("symbols")))).alias("symbol"),
        "news_date",
        "article_text",
    )
    return per_symbol.join(bar_moves(bars, day), ["symbol", "news_date"]).select(
        "news_article_id", "symbol", "news_date", "article_text", "percent_daily_price_change"
    )


def number_articles(news: DataFrame, slice_seconds: int = _ROLLUP_SLICE_SECONDS) -> DataFrame:
    """Number a symbol's distinct articles within their day by creation time (then headline, symbol list).

    A single symbol-day may hold very many articles, so counts per time slice give the offsets and
    ``row_number`` runs inside a slice only.
    """
    rows = (
        news.select(F.to_date("created_at").alias("news_date"), "created_at", "symbols", "headline")
        .distinct()
        .withColumn("symbol", F.explode(F.array_distinct(symbol_list(F.col("symbols")))))
        .withColumn("_slice", F.floor(F.unix_seconds(F.col("created_at").cast("timestamp")) / slice_seconds))
    )
    key = ["symbol", "news_date"]
    before = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*key, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*key, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*key, "_slice").orderBy("created_at", "headline", "symbols")
    return null_safe_join(rows, offsets, [*key, "_slice"]).select(
        *key, "created_at", "headline", (F.col("_offset") + F.row_number().over(inside)).alias("article_no")
    )


def daily_rollup(news: DataFrame, piece_articles: int = _ROLLUP_PIECE_ARTICLES) -> DataFrame:
    """All headlines of a symbol's day in creation order as one text, one row per symbol and day.

    A large day is joined in two levels: pieces of ``piece_articles`` articles on many tasks, then the few pieces. A null
    headline has no text and is left out, its number stays; a day with null headlines only has an empty text.
    """
    numbered = number_articles(news)
    piece = F.floor((F.col("article_no") - 1) / piece_articles).cast("int")
    label = F.concat(F.lit("Article "), F.col("article_no").cast("string"), F.lit(": "), F.col("headline"))
    day = ["symbol", "news_date"]
    pieces = numbered.groupBy(*day, piece.alias("_piece")).agg(_joined("article_no", label).alias("_text"))
    whole = F.coalesce(_joined("_piece", F.col("_text")), F.lit(""))
    return pieces.groupBy(*day).agg(whole.alias("daily_news_text"))


def _joined(order: str, text: Column) -> Column:
    """Aggregate: non-null texts in order; null if there are none."""
    ordered = F.array_sort(F.collect_list(F.when(text.isNotNull(), F.struct(order, text.alias("text")))))
    return F.when(F.size(ordered) > 0, F.array_join(F.transform(ordered, lambda a: a["text"]), ARTICLE_SEPARATOR))


def rollup_next_bar(news: DataFrame, bars: DataFrame, day: str = "bar_date") -> DataFrame:
    """Daily roll-up joined to the following day's move."""
    return daily_rollup(news).join(bar_moves(bars, day), ["symbol", "news_date"]).select(
        "symbol", "news_date", "daily_news_text", "percent_daily_price_change"
    )


def label_counts(
    scored: DataFrame,
    prefix: str,
    confidence: str = "confidence",
    labels: Sequence[str] = ("positive", "neutral", "negative"),
) -> DataFrame:
    """Per symbol and news day: articles per label, all articles and mean confidence."""

    def hits(label: str) -> Column:
        return F.count_if(F.col("sentiment") == label).alias(f"{prefix}_{label}_count")

    return scored.groupBy("symbol", F.to_date("news_date").alias("news_date")).agg(
        *[hits(label) for label in labels],
        F.count(F.lit(1)).alias(f"{prefix}_total_articles"),
        F.avg(confidence).alias(f"{prefix}_avg_confidence"),
    )


def symbol_day_articles(news: DataFrame, symbol: str, day: str) -> DataFrame:
    """Articles that mention a symbol on a day."""
    return explode_symbols(
        news.filter((F.to_date("created_at") == F.to_date(F.lit(day))) & F.col("symbols").contains(symbol))
    ).filter(F.col("symbol") == symbol)
