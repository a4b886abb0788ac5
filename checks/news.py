"""Articles, roll-ups and daily label counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standin as t
from checks.registry import check, rounded, rounded_sql
from checks.views import with_views
from tidemark.functions import text as tx
from tidemark.operators import news as n


@check(
    "news_symbol_explode",
    with_views("exploded", "SELECT id, symbol, headline, symbols FROM exploded"),
)
def news_symbol_explode(spark, sf_dir):
    return n.explode_symbols(t.news(spark, sf_dir)).select("id", "symbol", "headline", "symbols")


@check(
    "news_symbol_day_filter",
    with_views(
        "exploded",
        """SELECT id, symbol, headline, CAST(created_at AS DATE) AS news_date FROM exploded
           WHERE symbol = 'S3' AND CAST(created_at AS DATE) = DATE '1995-08-13'""",
    ),
)
def news_symbol_day_filter(spark, sf_dir):
    found = n.symbol_day_articles(t.news(spark, sf_dir), "S3", "1995-08-13")
    return found.select("id", "symbol", "headline", F.to_date("created_at").alias("news_date"))


_COPIES = """copies AS (
  SELECT id, headline, symbols, created_at AS updated_at FROM news
  UNION ALL SELECT id, headline, symbols, updated_at FROM news)"""


@check(
    "news_dedup_latest",
    with_views(
        "news",
        """SELECT id, headline, symbols, updated_at FROM copies
           QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, headline DESC, symbols DESC) = 1""",
        _COPIES,
    ),
)
def news_dedup_latest(spark, sf_dir):
    """The same article fetched for several symbols: first as created, then as updated."""
    base = t.news(spark, sf_dir)
    fetched = base.select("id", "headline", "symbols", F.col("created_at").alias("updated_at")).unionByName(
        base.select("id", "headline", "symbols", "updated_at")
    )
    return n.dedupe_articles(fetched)


_ARTICLE_COLUMNS = ["news_article_id", "symbol", "news_date", "article_text", "percent_daily_price_change"]


def _article_sql(text: str) -> str:
    return with_views(
        "exploded moves",
        f"""SELECT DISTINCT e.id AS news_article_id, e.symbol, m.news_date, {text} AS article_text,
              m.percent_daily_price_change
            FROM exploded e JOIN moves m ON e.symbol = m.symbol AND CAST(e.created_at AS DATE) = m.news_date""",
    )


@check("article_next_bar", _article_sql("concat('Headline: ', headline)"))
def article_next_bar(spark, sf_dir):
    return n.article_next_bar(t.news(spark, sf_dir), t.bars(spark, sf_dir))


@check(
    "article_next_bar_with_summary",
    _article_sql("concat('Headline: ', headline, ' Summary: ', coalesce(summary, ''))"),
)
def article_next_bar_with_summary(spark, sf_dir):
    return n.article_next_bar(t.news(spark, sf_dir), t.bars(spark, sf_dir), with_summary=True)


@check(
    "daily_news_rollup",
    with_views(
        "exploded moves",
        """SELECT r.symbol, r.news_date, r.daily_news_text, m.percent_daily_price_change
           FROM (SELECT symbol, news_date, string_agg(concat('Article ', CAST(article_no AS VARCHAR), ': ', headline),
                   ' /n ' ORDER BY article_no) AS daily_news_text
                 FROM numbered GROUP BY symbol, news_date) r
           JOIN moves m ON r.symbol = m.symbol AND r.news_date = m.news_date""",
        """numbered AS (
  SELECT symbol, news_date, headline, row_number() OVER (PARTITION BY symbol, news_date
    ORDER BY created_at, headline, symbols) AS article_no
  FROM (SELECT DISTINCT symbol, CAST(created_at AS DATE) AS news_date, created_at, headline, symbols FROM exploded) d)""",
    ),
)
def daily_news_rollup(spark, sf_dir):
    return n.rollup_next_bar(t.news(spark, sf_dir), t.bars(spark, sf_dir))


@check(
    "article_numbers",
    with_views(
        "exploded",
        """SELECT symbol, news_date, created_at, headline, row_number() OVER (PARTITION BY symbol, news_date
             ORDER BY created_at, headline, symbols) AS article_no
           FROM (SELECT DISTINCT symbol, CAST(created_at AS DATE) AS news_date, created_at, headline, symbols
                 FROM exploded) d""",
    ),
)
def article_numbers(spark, sf_dir):
    return n.number_articles(t.news(spark, sf_dir))


def _counts(prefix: str, source: str, confidence: str) -> str:
    labels = ", ".join(
        f"count(*) FILTER (WHERE sentiment = '{x}') AS {prefix}_{x}_count" for x in ("positive", "neutral", "negative")
    )
    return with_views(
        source,
        f"""SELECT symbol, news_date, {labels}, count(*) AS {prefix}_total_articles,
              {rounded_sql(f"avg({confidence})", f"{prefix}_avg_confidence")}
            FROM {source} GROUP BY symbol, news_date""",
    )


@check("sentiment_daily_agg", _counts("finbert", "scored", "confidence"))
def sentiment_daily_agg(spark, sf_dir):
    return rounded(n.label_counts(t.scored(spark, sf_dir), "finbert"), ["finbert_avg_confidence"])


@check("sentiment_daily_agg_full_text", _counts("fingpt", "scored_full", "sentiment_confidence"))
def sentiment_daily_agg_full_text(spark, sf_dir):
    counts = n.label_counts(t.scored_full(spark, sf_dir), "fingpt", "sentiment_confidence")
    return rounded(counts, ["fingpt_avg_confidence"])


@check(
    "scored_articles",
    with_views(
        "scored_full",
        "SELECT news_article_id, symbol, news_date, article_text, sentiment, sentiment_confidence FROM scored_full",
    ),
)
def scored_articles(spark, sf_dir):
    return t.scored_full(spark, sf_dir)


_REPLIES = """replies AS (
  SELECT news_article_id, symbol, article_text, sentiment, confidence,
    concat('Instruction: What is the sentiment of this news? Please choose an answer from {negative/neutral/positive}.',
      chr(10), 'Input: ', article_text, chr(10), 'Answer: ', upper(sentiment), '.', chr(10)) AS reply
  FROM scored)"""


def _replies(spark, sf_dir):
    scored = t.scored(spark, sf_dir)
    prompt = tx.render_prompt(tx.SENTIMENT_PROMPT, article_text=F.col("article_text"))
    return scored.withColumn("reply", F.concat(prompt, F.upper("sentiment"), F.lit(".\n")))


@check(
    "model_reply_label",
    with_views(
        "scored",
        """SELECT news_article_id, symbol, reply,
             CASE WHEN answer LIKE '%positive%' THEN 'positive' WHEN answer LIKE '%negative%' THEN 'negative'
               ELSE 'neutral' END AS label,
             CASE WHEN answer LIKE '%positive%' OR answer LIKE '%negative%' THEN 0.85e0 ELSE 0.7e0 END AS label_confidence
           FROM (SELECT *, lower(trim(split_part(reply, 'Answer:', -1), ' ' || chr(10))) AS answer FROM replies) r""",
        _REPLIES,
    ),
)
def model_reply_label(spark, sf_dir):
    label = tx.reply_label(F.col("reply"))
    return _replies(spark, sf_dir).withColumn("_label", label).select(
        "news_article_id",
        "symbol",
        "reply",
        F.col("_label.label").alias("label"),
        F.col("_label.confidence").alias("label_confidence"),
    )


@check(
    "model_reply_direction",
    with_views(
        "scored",
        """SELECT news_article_id, symbol,
             CASE sentiment WHEN 'positive' THEN 'up' WHEN 'negative' THEN 'down' ELSE 'stable' END AS predicted_direction,
             CASE sentiment WHEN 'neutral' THEN 0.6e0 ELSE 0.7e0 END AS prediction_confidence
           FROM scored""",
    ),
)
def model_reply_direction(spark, sf_dir):
    scored = t.scored(spark, sf_dir)
    prompt = tx.render_prompt(tx.DIRECTION_PROMPT, symbol=F.col("symbol"), article_text=F.col("article_text"))
    answer = tx.market_direction(F.col("sentiment"))
    reply = F.concat(prompt, answer, F.lit("\n"))
    label = tx.reply_label(reply, tx.DIRECTION_MARKER, tx.DIRECTION_LABELS, tx.DIRECTION_DEFAULT, tx.FAILED_DIRECTION)
    return scored.withColumn("_label", label).select(
        "news_article_id",
        "symbol",
        F.col("_label.label").alias("predicted_direction"),
        F.col("_label.confidence").alias("prediction_confidence"),
    )


@check(
    "model_reply_json",
    with_views(
        "scored",
        """SELECT news_article_id, symbol, CASE WHEN sentiment = 'neutral' THEN 'neutral' ELSE sentiment END AS label,
             CASE WHEN sentiment = 'neutral' THEN 0.5e0 ELSE confidence END AS label_confidence FROM scored""",
    ),
)
def model_reply_json(spark, sf_dir):
    """Fenced JSON replies; the reply for a neutral text is cut off and falls back to the failure row."""
    scored = t.scored(spark, sf_dir)
    body = F.to_json(F.struct("sentiment", "confidence"))
    whole = F.concat(F.lit("```json\n"), body, F.lit("\n```"))
    reply = F.when(F.col("sentiment") == "neutral", F.lit('```json\n{"sentiment": "posi')).otherwise(whole)
    return scored.withColumn("_label", tx.json_label(reply)).select(
        "news_article_id",
        "symbol",
        F.col("_label.label").alias("label"),
        F.col("_label.confidence").alias("label_confidence"),
    )


@check(
    "chat_reply_label",
    """SELECT conv_id, turn, role, text AS analysis,
         CASE WHEN role = 'assistant' THEN 'Up' WHEN role = 'user' THEN 'Down' ELSE 'Neutral' END AS prediction
       FROM conversations""",
)
def chat_reply_label(spark, sf_dir):
    """Whole turns as chat answers: the instruction echo is removed, the prediction found by pattern."""
    turns = t.table(spark, sf_dir, "conversations")
    verdict = F.when(F.col("role") == "assistant", "PREDICTION: Increase").when(
        F.col("role") == "user", "Prediction:  decline"
    ).otherwise("no view")
    raw = F.concat(F.lit("<s>[INST] echo\n of the prompt [/INST]  "), F.col("text"), F.lit("\n"), verdict)
    answer = tx.chat_answer(raw)
    # The verdict has no line end, so it is the last line; looking for it by pattern would try every line of the text.
    verdict_line = F.substring_index(answer, "\n", -1)
    return turns.select(
        "conv_id",
        "turn",
        "role",
        F.left(answer, F.length(answer) - F.length(verdict_line) - 1).alias("analysis"),
        tx.pattern_label(verdict_line).alias("prediction"),
    )
