"""Market tables derived from the given tables, as DataFrames.

Symbols are suppliers, trades are line items, articles are documents dated by orders, macro series are order
counts by customer nation. Everything is computed from whole tables; money is summed as integer cents and divided
once, so results do not depend on row order. ``checks.views`` states the same views for the SQL side.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views
from tidemark import schemas as s
from tidemark.functions.market import daily_move, split_label, target_price
from tidemark.functions.text import article_text, lexicon_label, symbol_list
from tidemark.operators.news import bar_moves
from tidemark.operators.sequences import forward_returns
from tidemark.session import stage_table

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _whole(column: str, factor: int = 100) -> Column:
    return F.round(F.col(column) * factor).cast("long")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        F.to_date("l_shipdate").alias("d"),
        _whole("l_extendedprice").alias("pc"),
        _whole("l_discount").alias("dp"),
        _whole("l_tax").alias("tp"),
        F.col("l_quantity").cast("long").alias("q"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stock_data: one bar per symbol and trading day."""
    pc, q = F.col("pc"), F.col("q")
    units = F.sum("q").cast("double")
    price = pc.cast("double") / (F.lit(1e2) * q.cast("double"))
    daily = trades(spark, sf_dir).groupBy("symbol", F.col("d").alias("bar_date")).agg(
        (F.sum(pc * (100 - F.col("dp"))).cast("double") / (F.lit(1e4) * units)).alias("open"),
        (F.sum(pc * (100 - F.col("tp"))).cast("double") / (F.lit(1e4) * units)).alias("close"),
        F.max(price).alias("mx"),
        F.min(price).alias("mn"),
        units.alias("volume"),
        (F.sum("pc").cast("double") / (F.lit(1e2) * units)).alias("vwap"),
        F.count(F.lit(1)).cast("double").alias("trade_count"),
    )
    return daily.select(
        "symbol",
        "bar_date",
        "open",
        F.greatest("mx", "open", "close").alias("high"),
        F.least("mn", "open", "close").alias("low"),
        "close",
        "volume",
        "trade_count",
        "vwap",
    )


def stored_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as a stored table, for operators that read their input more than once."""
    return stage_table(bars(spark, sf_dir), "bars")


def earnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    pc, dp, total = F.col("pc"), F.col("dp"), F.sum("pc").cast("double")
    surprise = F.sum(pc * (5 - dp)).cast("double") / (F.lit(0.95) * total)
    return (
        trades(spark, sf_dir)
        .groupBy("symbol", F.year("d"), F.quarter("d"))
        .agg(
            F.date_add(F.last_day(F.max("d")), (30 + F.sum("q") % 15).cast("int")).alias("release_date"),
            (total * F.lit(0.95) / F.lit(1e8)).alias("EPS Estimate"),
            (F.sum(pc * (100 - dp)).cast("double") / F.lit(1e10)).alias("Reported EPS"),
            F.when(F.count(F.lit(1)) >= 15, surprise).alias("Surprise(%)"),
        )
        .select("symbol", "release_date", *[F.col(f"`{c}`") for c in s.EARNINGS_COLUMNS])
    )


def _statement(spark: SparkSession, sf_dir: str, metrics: dict[str, str], filed: str | None = None) -> DataFrame:
    yearly = trades(spark, sf_dir).groupBy("symbol", F.year("d").alias("_year"))
    measures = [F.expr(expression).alias(name) for name, expression in metrics.items()]
    if filed:
        measures.append(F.expr(filed).alias("_filed"))
    made = yearly.agg(*measures)
    if filed:
        made = made.filter("_filed")
    period = F.make_date("_year", F.lit(12), F.lit(31)).alias("fiscal_period_end")
    return made.select("symbol", period, *[F.col(f"`{name}`") for name in metrics])


def statements(
    spark: SparkSession, sf_dir: str, wanted: Collection[str] | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(income, balance, cashflow) from one pass over the trades: a stored table with a row per symbol and year.

    Of the metrics only those in ``wanted`` are computed, if given; the others are null.
    """
    parts = [(views.INCOME, None), (views.BALANCE, views.BALANCE_FILED), (views.CASHFLOW, views.CASHFLOW_FILED)]
    metrics = {name: expression for part, _ in parts for name, expression in part.items()}
    measures = {n: x if wanted is None or n in wanted else "CAST(NULL AS DOUBLE)" for n, x in metrics.items()}
    measures |= {f"_filed{k}": filed for k, (_, filed) in enumerate(parts) if filed}
    yearly = stage_table(_statement(spark, sf_dir, measures), "statements")
    made = [yearly if filed is None else yearly.filter(f"_filed{k}") for k, (_, filed) in enumerate(parts)]
    return tuple(y.select("symbol", "fiscal_period_end", *[F.col(f"`{n}`") for n in m]) for y, (m, _) in zip(made, parts))


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statement(spark, sf_dir, views.INCOME)


def balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statement(spark, sf_dir, views.BALANCE, views.BALANCE_FILED)


def cashflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statement(spark, sf_dir, views.CASHFLOW, views.CASHFLOW_FILED)


def vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """alfred_economic_data: monthly order counts per customer nation, each published three times."""
    ids = [F.lit(name) for name in s.MACRO_SERIES]
    titles = [F.lit(title) for _, title in s.MACRO_SERIES.values()]
    monthly = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.to_date(F.date_trunc("month", "o_orderdate")).alias("date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return monthly.withColumn("v", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).select(
        F.get(F.array(*ids), F.col("c_nationkey")).alias("series_id"),
        F.get(F.array(*titles), F.col("c_nationkey")).alias("series_name"),
        "date",
        F.date_add(F.last_day("date"), 20 + 30 * F.col("v")).alias("realtime_start"),
        F.date_add(F.last_day("date"), 49 + 30 * F.col("v")).alias("realtime_end"),
        F.when(
            F.month("date") + F.col("v") != 11, (F.col("n") * (100 + F.col("v"))).cast("double") / F.lit(1e2)
        ).alias("value"),
    )


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents: the first line is the headline, the rest the summary."""
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.substring_index(text, "\n", 1).alias("headline"),
        F.when(text.contains("\n"), F.substring(text, F.locate("\n", text) + 1, F.length(text))).alias("summary"),
        F.concat(F.lit("desk-"), F.col("lang")).alias("author"),
        "n_chars",
        F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string")).alias("url"),
        "source",
    )


def _dated(articles: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date articles by the order of the same key; its suppliers are the symbols mentioned."""
    mentioned = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"))
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(F.array_join(F.array_sort(F.collect_set("symbol")), ",").alias("symbols"))
    )
    dates = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderdate")
    return (
        articles.join(dates, "id")
        .join(mentioned, "id", "left")
        .withColumns(
            {
                "created_at": F.col("o_orderdate") + F.make_dt_interval(secs=F.col("n_chars")),
                "updated_at": F.col("o_orderdate") + F.make_dt_interval(secs=2 * F.col("n_chars")),
                "symbols": F.coalesce("symbols", F.lit("")),
            }
        )
    )


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """news_data."""
    return _dated(_articles(spark, sf_dir), spark, sf_dir).select(
        "id", "headline", "summary", "author", "created_at", "updated_at", "url", "symbols", "source"
    )


def _scored(spark: SparkSession, sf_dir: str, with_summary: bool, terms, confidence: str) -> DataFrame:
    # Scored where the documents are read: once per article, before any text would have to be shuffled.
    text = article_text(F.col("headline"), F.col("summary") if with_summary else None)
    judged = (
        _articles(spark, sf_dir)
        .withColumn("article_text", text)
        .withColumn("_score", lexicon_label(F.col("article_text"), *terms))
    )
    return _dated(judged, spark, sf_dir).select(
        F.col("id").alias("news_article_id"),
        F.explode(symbol_list(F.col("symbols"))).alias("symbol"),
        F.to_date("created_at").alias("news_date"),
        "article_text",
        F.col("_score.label").alias("sentiment"),
        F.col("_score.confidence").alias(confidence),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """finbert_news_classifications: scored on the headline."""
    return _scored(spark, sf_dir, False, views.TERMS_A, "confidence")


def scored_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fingpt_sentiment_checkpoint: scored on headline and summary, that is the whole document."""
    return _scored(spark, sf_dir, True, views.TERMS_B, "sentiment_confidence")


def scored_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored headlines that meet a next-day bar, with its move."""
    return scored(spark, sf_dir).join(bar_moves(bars(spark, sf_dir)), ["symbol", "news_date"])


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lstm_predictions core: five-bar return against the bar's own move as a naive forecast."""
    ahead = forward_returns(bars(spark, sf_dir)).filter(F.col("future_close").isNotNull())
    move = daily_move()
    return ahead.select(
        "symbol",
        split_label(F.col("target_date"), views.CUTOFF, inclusive=False).alias("split"),
        F.col("bar_date").alias("prediction_date"),
        "target_date",
        F.col("forward_return").alias("actual_return"),
        move.alias("predicted_return"),
        "close",
        F.col("future_close").alias("actual_price"),
        target_price(F.col("close"), move).alias("predicted_price"),
    )
