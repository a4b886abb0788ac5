"""Tables with missing values: null keys, dates, values and scores, NaN, unknown labels, several versions of a bar."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standin as t
from checks.registry import check, rounded, rounded_sql
from checks.views import CUTOFF, with_views
from checks.indicators import _ALL, _NUMBERED, _RECURSION, KEYS
from tidemark import schemas as s
from tidemark.functions import market as m
from tidemark.functions.text import SENTIMENT_TO_DIRECTION
from tidemark.operators import diagnosis as d
from tidemark.operators import evaluation as e
from tidemark.operators import indicators as ind
from tidemark.operators import modeling
from tidemark.operators.series import ema, number_rows
from tidemark.plans import ingest, reports

_DAY = "(year(bar_date) * 372 + month(bar_date) * 31 + day(bar_date))"
# Valid in both engines: no value at the start of a year, on scattered days and over one month.
_NO_CLOSE = f"({_DAY} % 7 = 3 OR month(bar_date) = 5 OR bar_date < DATE '1992-02-15')"


def _bars(spark, sf_dir):
    return t.bars(spark, sf_dir)


@check(
    "row_positions_with_gaps",
    with_views(
        "bars",
        """SELECT symbol, bar_date, row_number() OVER (PARTITION BY symbol ORDER BY bar_date NULLS FIRST) - 1 AS position
           FROM gapped""",
        f"""gapped AS (SELECT CASE WHEN {_DAY} % 11 = 0 THEN NULL ELSE symbol END AS symbol,
              CASE WHEN {_DAY} % 13 = 0 THEN NULL ELSE bar_date END AS bar_date FROM bars)""",
    ),
)
def row_positions_with_gaps(spark, sf_dir):
    gapped = _bars(spark, sf_dir).selectExpr(
        f"CASE WHEN {_DAY} % 11 = 0 THEN NULL ELSE symbol END AS symbol",
        f"CASE WHEN {_DAY} % 13 = 0 THEN NULL ELSE bar_date END AS bar_date",
    )
    return number_rows(gapped, ["symbol"], "bar_date", position="position")


def _mean_step(n: int) -> str:
    weight = f"pow(1 - 2e0 / {n + 1}, r.gap + 1)"
    return f"""CASE WHEN b.x IS NULL THEN r.e{n} WHEN r.e{n} IS NULL THEN b.x
      ELSE ({weight} * r.e{n} + 2e0 / {n + 1} * b.x) / ({weight} + 2e0 / {n + 1}) END"""


@check(
    "ema_with_gaps",
    with_views(
        "bars",
        f"SELECT symbol, bar_date, {rounded_sql('e5', 'ema_5', 6)}, {rounded_sql('e34', 'ema_34', 6)} FROM means",
        f"""gapped AS (SELECT symbol, bar_date, CASE WHEN {_NO_CLOSE} THEN NULL ELSE close END AS x,
  row_number() OVER (PARTITION BY symbol ORDER BY bar_date) AS i FROM bars),
means AS (
  SELECT symbol, bar_date, i, x AS e5, x AS e34, 0 AS gap FROM gapped WHERE i = 1
  UNION ALL
  SELECT b.symbol, b.bar_date, b.i, {_mean_step(5)}, {_mean_step(34)},
    CASE WHEN b.x IS NULL THEN r.gap + 1 ELSE 0 END
  FROM means r JOIN gapped b ON b.symbol = r.symbol AND b.i = r.i + 1)""",
        recursive=True,
    ),
)
def ema_with_gaps(spark, sf_dir):
    gapped = _bars(spark, sf_dir).selectExpr("symbol", "bar_date", f"CASE WHEN {_NO_CLOSE} THEN NULL ELSE close END AS x")
    means = ema(gapped, ["symbol"], "bar_date", "x", [5, 34])
    return rounded(means.select(*KEYS, "ema_5", "ema_34"), ["ema_5", "ema_34"], 6)


_W = "PARTITION BY symbol ORDER BY bar_date"


@check(
    "any_period_indicators",
    with_views(
        "bars",
        f"""SELECT symbol, bar_date,
              {rounded_sql(f"CASE WHEN i >= 12 THEN avg(close) OVER ({_W} ROWS 11 PRECEDING) / close - 1 END", "sma_12", 6)},
              {rounded_sql(f"CASE WHEN i >= 10 THEN 100 - 100 / (1 + avg(gain) OVER ({_W} ROWS 8 PRECEDING)"
                           f" / (avg(loss) OVER ({_W} ROWS 8 PRECEDING) + 1e-10)) END", "rsi_9", 6)},
              {rounded_sql(f"CASE WHEN i >= 13 THEN 4 * stddev_samp(close) OVER ({_W} ROWS 12 PRECEDING) / close END", "bb_width_13", 6)}
            FROM moved""",
        _NUMBERED,
    ),
)
def any_period_indicators(spark, sf_dir):
    names = ["sma_12", "rsi_9", "bb_width_13"]
    return rounded(ind.indicators(t.stored_bars(spark, sf_dir), features=names).select(*KEYS, *names), names, 6)


def _score_gaps(score: str) -> str:
    """A null score on some days, NaN on others; the text is valid in both engines."""
    return f"""CASE WHEN day(prediction_date) % 5 = 0 THEN NULL
      WHEN day(prediction_date) % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE {score} END"""


def _gapped_scores(spark, sf_dir):
    y = m.two_way_direction(F.col("actual_return"), 1, 0).alias("y")
    return t.preds(spark, sf_dir).select(y, F.expr(_score_gaps("predicted_return")).alias("score"))


@check(
    "auc_with_gaps",
    with_views(
        "preds",
        """SELECT round(CAST(sum(neg * (2 * below + pos)) AS DOUBLE) / (2e0 * sum(pos) * sum(neg)), 9) + 0e0 AS auc,
             CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
           FROM (SELECT score, sum(y) AS pos, sum(1 - y) AS neg,
               coalesce(sum(sum(y)) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
             FROM scored_rows WHERE score IS NOT NULL AND NOT isnan(score) GROUP BY score) r""",
        f"""scored_rows AS (SELECT CASE WHEN actual_return > 0 THEN 1 ELSE 0 END AS y,
              {_score_gaps("predicted_return")} AS score FROM preds)""",
    ),
)
def auc_with_gaps(spark, sf_dir):
    return rounded(e.auc(_gapped_scores(spark, sf_dir), "y", "score"), ["auc"])


_MOVE = "percent_daily_price_change"
_ODD_LABEL = "CASE WHEN day(news_date) % 4 = 0 THEN 'Error' ELSE sentiment END"
_ODD_CONFIDENCE = "CASE WHEN day(news_date) % 3 = 0 THEN NULL ELSE confidence END"


def _gapped_moves(spark, sf_dir):
    moves = t.scored_moves(spark, sf_dir)
    return moves.selectExpr(f"{_ODD_LABEL} AS sentiment", f"{_ODD_CONFIDENCE} AS confidence", _MOVE)


_GAPPED_MOVES = f"gapped AS (SELECT {_ODD_LABEL} AS sentiment, {_ODD_CONFIDENCE} AS confidence, {_MOVE} FROM scored_moves)"


@check(
    "confidence_bins_with_gaps",
    with_views(
        "scored_moves",
        f"""SELECT CAST(1 + CAST(confidence > lo + w AS INT) + CAST(confidence > lo + w * 2e0 AS INT)
                + CAST(confidence > lo + w * 3e0 AS INT) + CAST(confidence > lo + w * 4e0 AS INT) AS INT) AS bin,
              {rounded_sql(f"avg(CAST(({_MOVE} > 0) AS DOUBLE))", "accuracy")}, count(*) AS n
            FROM gapped, (SELECT min(confidence) AS lo, (max(confidence) - min(confidence)) / 5e0 AS w FROM gapped) r
            WHERE sentiment <> 'neutral' AND confidence IS NOT NULL GROUP BY 1""",
        _GAPPED_MOVES,
    ),
)
def confidence_bins_with_gaps(spark, sf_dir):
    made = e.confidence_bins(_gapped_moves(spark, sf_dir), "confidence", F.col(_MOVE) > 0, F.col("sentiment") != "neutral")
    return rounded(made, ["accuracy"])


@check(
    "sentiment_direction_accuracy_with_unknown",
    with_views(
        "scored_moves",
        f"""SELECT {rounded_sql(f"avg(CAST(CASE sentiment WHEN 'positive' THEN {_MOVE} > 0 WHEN 'negative' THEN {_MOVE} <= 0 "
                                "ELSE false END AS DOUBLE))", "accuracy")}, count(*) AS n
            FROM gapped WHERE sentiment <> 'neutral'""",
        _GAPPED_MOVES,
    ),
)
def sentiment_direction_accuracy_with_unknown(spark, sf_dir):
    made = e.sentiment_direction_accuracy(_gapped_moves(spark, sf_dir), "sentiment", _MOVE, SENTIMENT_TO_DIRECTION)
    return rounded(made, ["accuracy"])


@check(
    "null_profile_with_nan",
    with_views(
        "preds",
        """SELECT 'score' AS column_name, count(*) - count(CASE WHEN NOT isnan(score) THEN 1 END) AS nulls,
             round((count(*) - count(CASE WHEN NOT isnan(score) THEN 1 END)) * 100e0 / count(*), 9) + 0e0 AS null_pct FROM scored_rows""",
        f"scored_rows AS (SELECT {_score_gaps('predicted_return')} AS score FROM preds)",
    ),
)
def null_profile_with_nan(spark, sf_dir):
    return rounded(d.null_profile(_gapped_scores(spark, sf_dir), ["score"]), ["null_pct"])


@check(
    "bars_load_versions",
    with_views("bars", "SELECT symbol, bar_date, greatest(open, open + 1) AS open, close FROM bars"),
)
def bars_load_versions(spark, sf_dir):
    """Two versions of every bar; the greater one stays."""
    bars = _bars(spark, sf_dir).select("symbol", "bar_date", "open", "close")
    return ingest.load_bars([bars, bars.withColumn("open", F.col("open") + 1)])


_SCALED = [f"({f} - min({f}) OVER s) / CASE WHEN max({f}) OVER s = min({f}) OVER s THEN 1 ELSE max({f}) OVER s - min({f}) OVER s END" for f in s.INDICATOR_FEATURES]
_READY = (
    f"{_NUMBERED},\n{_RECURSION},\nmade AS (SELECT moved.*, "
    + ", ".join(f"{_ALL[f]} AS {f}" for f in s.INDICATOR_FEATURES)
    + " FROM moved JOIN ema USING (symbol, i)),\nready AS (SELECT * FROM made WHERE i > 50 AND "
    + " AND ".join(f"{f} IS NOT NULL" for f in s.INDICATOR_FEATURES)
    + "),\nstep AS (SELECT symbol, bar_date, close, row_number() OVER o AS p, count(*) OVER s AS rows_, "
    + " + ".join(_SCALED)
    + " AS total FROM ready WINDOW s AS (PARTITION BY symbol), o AS (PARTITION BY symbol ORDER BY bar_date)),\n"
    + f"""framed AS (SELECT *, sum(total) OVER (o ROWS 39 PRECEDING) AS sums, lead(bar_date, 5) OVER o AS target_date,
        lead(close, 5) OVER o AS future_close FROM step WINDOW o AS (PARTITION BY symbol ORDER BY bar_date)),
      whole AS (SELECT *, CASE WHEN target_date < DATE '{CUTOFF}' THEN 'train' ELSE 'test' END AS split
        FROM framed WHERE p >= 40 AND target_date IS NOT NULL AND rows_ >= {40 + 5 + s.MIN_EXTRA_ROWS})"""
)


@check(
    "forecast_dataset",
    with_views(
        "bars",
        f"""SELECT symbol, bar_date AS prediction_date, target_date, close AS prev_close, future_close,
              {rounded_sql("(future_close - close) / close", "forward_return")}, split, CAST(40 AS INT) AS steps,
              CAST({len(s.INDICATOR_FEATURES)} AS INT) AS width, {rounded_sql("sums", "sequence_sum", 4)},
              {rounded_sql("total", "last_step_sum", 5)}
            FROM whole WHERE symbol IN (SELECT symbol FROM whole GROUP BY symbol
              HAVING count(*) FILTER (WHERE split = 'train') >= {s.MIN_TRAIN_ROWS}
                AND count(*) FILTER (WHERE split = 'test') >= {s.MIN_TEST_ROWS})""",
        _READY,
        recursive=True,
    ),
)
def forecast_dataset(spark, sf_dir):
    """All 32 indicators, scaled, in sequences of 40 steps; the sums stand for the arrays."""
    made = reports.forecast_dataset(t.stored_bars(spark, sf_dir), CUTOFF)
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, b: a + b)
    made = made.select(
        "symbol", "prediction_date", "target_date", "prev_close", "future_close", "forward_return", "split",
        F.size("sequence").alias("steps"), F.size(F.col("sequence")[0]).alias("width"),
        total(F.flatten("sequence")).alias("sequence_sum"), total(F.element_at("sequence", -1)).alias("last_step_sum"),
    )
    return rounded(rounded(rounded(made, ["forward_return"]), ["sequence_sum"], 4), ["last_step_sum"], 5)


@check("sequence_forecast_values")
def sequence_forecast_values(spark, sf_dir):
    """The forecast return and price themselves."""
    return e.forecast_report(modeling.sequence_forecast(reports.forecast_dataset(t.stored_bars(spark, sf_dir), CUTOFF)))


@check(
    "sequence_forecast",
    with_views(
        "bars",
        f"""SELECT symbol, bar_date AS prediction_date, target_date, split, true AS consistent
            FROM whole WHERE symbol IN (SELECT symbol FROM whole GROUP BY symbol
              HAVING count(*) FILTER (WHERE split = 'train') >= {s.MIN_TRAIN_ROWS}
                AND count(*) FILTER (WHERE split = 'test') >= {s.MIN_TEST_ROWS})""",
        _READY,
        recursive=True,
    ),
)
def sequence_forecast(spark, sf_dir):
    """A forecast from all 32 indicators; the forecast price is the previous close times 1 + the forecast return."""
    made = sequence_forecast_values(spark, sf_dir)
    price = F.col("prev_close") * (1 + F.col("predicted_return"))
    consistent = F.abs(F.col("predicted_price") - price) <= 1e-9 * F.abs(price)
    return made.select("symbol", "prediction_date", "target_date", "split", consistent.alias("consistent"))
