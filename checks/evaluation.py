"""Label reports, regression metrics and forecast reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standin as t
from checks.registry import check, rounded, rounded_sql
from checks.views import with_views
from tidemark import schemas as s
from tidemark.functions import market as m
from tidemark.functions.text import SENTIMENT_TO_DIRECTION
from tidemark.operators import evaluation as e
from tidemark.operators.news import bar_moves
from tidemark.plans.feature_set import split_ranges

_MOVE = "percent_daily_price_change"
_HIT = f"""coalesce(sentiment IN ('positive', 'negative')
  AND sentiment = CASE WHEN {_MOVE} > 0 THEN 'positive' ELSE 'negative' END, false)"""


def _hit():
    return m.sentiment_hit(F.col("sentiment"), F.col(_MOVE))


def _no_neutral():
    return F.col("sentiment") != "neutral"


@check(
    "label_share",
    with_views(
        "scored_moves",
        f"""SELECT sentiment, count(*) AS n, {rounded_sql(f"avg({_MOVE})", "mean_move", 6)},
              {rounded_sql("count(*) * 100e0 / sum(count(*)) OVER ()", "pct", 6)}
            FROM scored_moves GROUP BY sentiment""",
    ),
)
def label_share(spark, sf_dir):
    return rounded(e.label_share(t.scored_moves(spark, sf_dir), "sentiment", _MOVE), ["mean_move", "pct"], 6)


@check(
    "sentiment_label_stats",
    with_views(
        "scored_moves",
        f"""SELECT sentiment, {rounded_sql(f"avg({_MOVE})", "mean", 6)}, {rounded_sql(f"stddev_samp({_MOVE})", "std", 6)},
              count({_MOVE}) AS n, {rounded_sql(f"stddev_samp({_MOVE}) / sqrt(count({_MOVE}))", "se", 6)}
            FROM scored_moves GROUP BY sentiment""",
    ),
)
def sentiment_label_stats(spark, sf_dir):
    return rounded(e.label_stats(t.scored_moves(spark, sf_dir), "sentiment", _MOVE), ["mean", "std", "se"], 6)


_BOX = ["minimum", "q1", "median", "q3", "maximum"]


def _box_sql(source: str, label: str, value: str) -> str:
    marks = ", ".join(rounded_sql(f"quantile_cont({value}, {p}e0)", n) for n, p in zip(_BOX, (0, 0.25, 0.5, 0.75, 1)))
    return f"SELECT {label}, count({value}) AS rows, {marks} FROM {source} GROUP BY {label}"


@check("sentiment_box", with_views("scored_moves", _box_sql("scored_moves", "sentiment", _MOVE)))
def sentiment_box(spark, sf_dir):
    return rounded(e.label_box(t.scored_moves(spark, sf_dir), "sentiment", _MOVE), _BOX)


@check("return_box_by_split", with_views("preds", _box_sql("preds", "split", "actual_return")))
def return_box_by_split(spark, sf_dir):
    return rounded(e.label_box(t.preds(spark, sf_dir), "split", "actual_return"), _BOX)


@check(
    "sentiment_box_approx",
    with_views("scored_moves", f"SELECT sentiment, count({_MOVE}) AS rows, true AS within FROM scored_moves GROUP BY sentiment"),
)
def sentiment_box_approx(spark, sf_dir):
    """Sketched values whose rank is within one thousandth of all rows (or one row) of the rank asked for."""
    moves = t.scored_moves(spark, sf_dir)
    boxes = e.label_box_approx(moves, "sentiment", _MOVE)
    within = F.lit(True)
    for name, place in zip(_BOX, (0.0, 0.25, 0.5, 0.75, 1.0)):
        wanted, slack = place * F.col("rows"), F.greatest(F.lit(1.0), F.col("rows") / 1000)
        below, upto = F.count_if(F.col(_MOVE) < F.col(name)), F.count_if(F.col(_MOVE) <= F.col(name))
        within = within & (below <= wanted + slack) & (upto >= wanted - slack)
    return moves.join(boxes, "sentiment").groupBy("sentiment", "rows").agg(within.alias("within"))


@check(
    "sentiment_accuracy",
    with_views(
        "scored_moves",
        f"""SELECT sentiment, {rounded_sql(f"avg(CAST({_HIT} AS DOUBLE))", "accuracy")}, count(*) AS n
            FROM scored_moves WHERE sentiment <> 'neutral' GROUP BY sentiment""",
    ),
)
def sentiment_accuracy(spark, sf_dir):
    scored = t.scored_moves(spark, sf_dir).filter(_no_neutral())
    return rounded(e.hit_rate(scored, _hit(), ["sentiment"]), ["accuracy"])


@check(
    "sentiment_accuracy_overall",
    with_views(
        "scored_moves",
        f"""SELECT {rounded_sql(f"avg(CAST({_HIT} AS DOUBLE))", "accuracy")}, count(*) AS n
            FROM scored_moves WHERE sentiment <> 'neutral' AND confidence > 0.55e0""",
    ),
)
def sentiment_accuracy_overall(spark, sf_dir):
    confident = t.scored_moves(spark, sf_dir).filter(_no_neutral() & (F.col("confidence") > 0.55))
    return rounded(e.hit_rate(confident, _hit()), ["accuracy"])


@check(
    "sentiment_direction_accuracy",
    with_views(
        "scored_moves",
        f"""SELECT {rounded_sql(f"avg(CAST((sentiment = 'positive') = ({_MOVE} > 0) AS DOUBLE))", "accuracy")},
              count(*) AS n FROM scored_moves WHERE sentiment <> 'neutral'""",
    ),
)
def sentiment_direction_accuracy(spark, sf_dir):
    made = e.sentiment_direction_accuracy(t.scored_moves(spark, sf_dir), "sentiment", _MOVE, SENTIMENT_TO_DIRECTION)
    return rounded(made, ["accuracy"])


@check(
    "confidence_bins",
    with_views(
        "scored_moves",
        f"""SELECT CAST(1 + CAST(confidence > lo + w AS INT) + CAST(confidence > lo + w * 2e0 AS INT)
                + CAST(confidence > lo + w * 3e0 AS INT) + CAST(confidence > lo + w * 4e0 AS INT) AS INT) AS bin,
              {rounded_sql(f"avg(CAST({_HIT} AS DOUBLE))", "accuracy")}, count(*) AS n
            FROM scored_moves, (SELECT min(confidence) AS lo, (max(confidence) - min(confidence)) / 5e0 AS w
              FROM scored_moves) r
            WHERE sentiment <> 'neutral' GROUP BY 1""",
    ),
)
def confidence_bins(spark, sf_dir):
    made = e.confidence_bins(t.scored_moves(spark, sf_dir), "confidence", _hit(), _no_neutral())
    return rounded(made, ["accuracy"])


_THREE = "CASE WHEN {0} > 0.005e0 THEN 'up' WHEN {0} < -0.005e0 THEN 'down' ELSE 'stable' END"


def _directions(spark, sf_dir):
    return t.preds(spark, sf_dir).select(
        "symbol",
        "prediction_date",
        m.three_way_direction(F.col("actual_return")).alias("actual"),
        m.three_way_direction(F.col("predicted_return")).alias("predicted"),
    )


_DIRECTIONS = f"""directions AS (
  SELECT symbol, prediction_date, {_THREE.format("actual_return")} AS actual,
    {_THREE.format("predicted_return")} AS predicted FROM preds)"""


@check("direction_three_way", with_views("preds", "SELECT * FROM directions", _DIRECTIONS))
def direction_three_way(spark, sf_dir):
    return _directions(spark, sf_dir)


@check(
    "direction_two_way",
    with_views(
        "moves",
        f"""SELECT symbol, news_date, CASE WHEN {_MOVE} > 0 THEN 'up' ELSE 'down' END AS zero_is_down,
              CAST(CASE WHEN {_MOVE} >= 0 THEN 1 ELSE 0 END AS INT) AS zero_is_up,
              CAST(CASE WHEN {_MOVE} > 0.005e0 THEN 1 WHEN {_MOVE} < -0.005e0 THEN 0 ELSE 2 END AS INT) AS price_class
            FROM moves""",
    ),
)
def direction_two_way(spark, sf_dir):
    move = F.col(_MOVE)
    return bar_moves(t.bars(spark, sf_dir)).select(
        "symbol",
        "news_date",
        m.two_way_direction(move).alias("zero_is_down"),
        m.two_way_direction(move, 1, 0, zero_is_up=True).alias("zero_is_up"),
        m.price_class(move).alias("price_class"),
    )


_LABELS = ["up", "stable", "down"]


@check(
    "confusion_matrix",
    with_views(
        "preds",
        "SELECT actual, "
        + ", ".join(f"count(*) FILTER (WHERE predicted = '{x}') AS pred_{x}" for x in _LABELS)
        + " FROM directions GROUP BY actual",
        _DIRECTIONS,
    ),
)
def confusion_matrix(spark, sf_dir):
    return e.confusion_matrix(_directions(spark, sf_dir), "actual", "predicted", _LABELS)


@check(
    "classification_report",
    with_views(
        "preds",
        f"""SELECT label, {rounded_sql("p", "precision")}, {rounded_sql("r", "recall")}, {rounded_sql("f", "f1")},
              CAST(support AS BIGINT) AS support
            FROM (SELECT label, p, r, f, support FROM per_label
              UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM per_label
              UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
                sum(f * support) / sum(support), sum(support) FROM per_label
              UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support),
                sum(support) FROM per_label) x""",
        _DIRECTIONS
        + """,
counted AS (SELECT l.label, count(*) FILTER (WHERE actual = l.label) AS support,
    count(*) FILTER (WHERE predicted = l.label) AS found,
    CAST(count(*) FILTER (WHERE actual = l.label AND predicted = l.label) AS DOUBLE) AS hits
  FROM directions, (VALUES ('up'), ('stable'), ('down')) l(label) GROUP BY l.label),
rated AS (SELECT *, coalesce(hits / NULLIF(found, 0), 0) AS p, coalesce(hits / NULLIF(support, 0), 0) AS r FROM counted),
per_label AS (SELECT *, coalesce(2 * p * r / NULLIF(p + r, 0), 0) AS f FROM rated)""",
    ),
)
def classification_report(spark, sf_dir):
    made = e.classification_report(_directions(spark, sf_dir), "actual", "predicted")
    return rounded(made, ["precision", "recall", "f1"])


@check(
    "accuracy_score",
    with_views(
        "preds",
        f"""SELECT {rounded_sql("avg(CAST(actual = predicted AS DOUBLE))", "accuracy")}, count(*) AS n FROM directions""",
        _DIRECTIONS,
    ),
)
def accuracy_score(spark, sf_dir):
    hit = F.col("actual") == F.col("predicted")
    return rounded(e.hit_rate(_directions(spark, sf_dir), hit), ["accuracy"])


def _scored_rows(spark, sf_dir):
    return t.preds(spark, sf_dir).select(
        m.two_way_direction(F.col("actual_return"), 1, 0).alias("y"), F.col("predicted_return").alias("score")
    )


_SCORED_ROWS = """scored_rows AS (
  SELECT CASE WHEN actual_return > 0 THEN 1 ELSE 0 END AS y, predicted_return AS score FROM preds)"""


@check(
    "roc_points",
    with_views(
        "preds",
        f"""SELECT threshold, true_pos, false_pos, {rounded_sql("true_pos / sum(p) OVER ()", "tpr")},
              {rounded_sql("false_pos / sum(n) OVER ()", "fpr")}
            FROM (SELECT score AS threshold, CAST(sum(sum(y)) OVER w AS BIGINT) AS true_pos,
                CAST(sum(sum(1 - y)) OVER w AS BIGINT) AS false_pos, sum(y) AS p, sum(1 - y) AS n
              FROM scored_rows GROUP BY score WINDOW w AS (ORDER BY score DESC)) r""",
        _SCORED_ROWS,
    ),
)
def roc_points(spark, sf_dir):
    points = e.roc_points(_scored_rows(spark, sf_dir), "y", "score").drop("_pos", "_neg")
    return rounded(points, ["tpr", "fpr"])


_AUC = """SELECT round(CAST(sum(neg * (2 * below + pos)) AS DOUBLE) / (2e0 * sum(pos) * sum(neg)), 9) + 0e0 AS auc,
  CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
FROM (SELECT score, sum(y) AS pos, sum(1 - y) AS neg,
    coalesce(sum(sum(y)) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM scored_rows GROUP BY score) r"""


@check("auc", with_views("preds", _AUC, _SCORED_ROWS))
def auc(spark, sf_dir):
    return rounded(e.auc(_scored_rows(spark, sf_dir), "y", "score"), ["auc"])


@check(
    "auc_document_labels",
    "WITH scored_rows AS (SELECT quality AS y, CAST(n_chars AS DOUBLE) AS score FROM labels JOIN documents USING (doc_id))\n"
    + _AUC,
)
def auc_document_labels(spark, sf_dir):
    lengths = t.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    rows = t.table(spark, sf_dir, "labels").join(lengths, "doc_id")
    return rounded(e.auc(rows, "quality", "n_chars"), ["auc"])


@check(
    "label_distribution_compare",
    with_views(
        "preds",
        """SELECT label, count(*) FILTER (WHERE actual = label) AS actual_n,
             count(*) FILTER (WHERE predicted = label) AS predicted_n
           FROM directions, (VALUES ('up'), ('stable'), ('down'), ('unknown')) l(label) GROUP BY label""",
        _DIRECTIONS,
    ),
)
def label_distribution_compare(spark, sf_dir):
    labels = [*_LABELS, "unknown"]
    return e.label_distribution_compare(_directions(spark, sf_dir), "actual", "predicted", labels)


@check(
    "degenerate_prediction_check",
    with_views(
        "scored",
        f"""SELECT count(DISTINCT confidence) AS distinct_confidences,
              (SELECT {rounded_sql("max(c) * 100e0 / sum(c)", "x")} FROM counts) AS top_pct,
              (SELECT count(*) FROM counts) AS labels, (SELECT count(*) <= 1 FROM counts) AS one_label_only
            FROM scored""",
        "counts AS (SELECT sentiment, count(*) AS c FROM scored GROUP BY sentiment)",
    ),
)
def degenerate_prediction_check(spark, sf_dir):
    return rounded(e.degenerate_check(t.scored(spark, sf_dir), "sentiment", "confidence"), ["top_pct"])


@check(
    "class_weights",
    with_views(
        "preds",
        f"""SELECT actual, n, {rounded_sql("(1e0 / n) / sum(1e0 / n) OVER () * count(*) OVER ()", "weight")}
            FROM (SELECT actual, count(*) AS n FROM directions GROUP BY actual) c""",
        _DIRECTIONS,
    ),
)
def class_weights(spark, sf_dir):
    return rounded(e.class_weights(_directions(spark, sf_dir), "actual"), ["weight"])


_ERROR = "(actual_return - predicted_return)"
_METRICS = f"""count(*) AS n, {rounded_sql(f"sqrt(avg({_ERROR} * {_ERROR}))", "rmse", 6)},
  {rounded_sql(f"avg(abs({_ERROR}))", "mae", 6)},
  {rounded_sql(f"1 - sum({_ERROR} * {_ERROR}) / (var_pop(actual_return) * count(*))", "r2", 6)}"""


@check(
    "regression_metrics",
    with_views(
        "preds",
        f"""SELECT split, {_METRICS},
              {rounded_sql(f"avg(abs({_ERROR} / (actual_return + 1e-8))) * 100", "mape", 2)}
            FROM preds GROUP BY split""",
    ),
)
def regression_metrics(spark, sf_dir):
    made = e.regression_metrics(t.preds(spark, sf_dir), "actual_return", "predicted_return", ["split"])
    return rounded(rounded(made, ["rmse", "mae", "r2"], 6), ["mape"], 2)


@check(
    "metrics_by_magnitude",
    with_views(
        "preds",
        f"""SELECT CASE WHEN abs(predicted_return) < 0.05e0 THEN 'near_zero' ELSE 'normal' END AS pred_group,
              count(*) AS n, {rounded_sql(f"sqrt(avg({_ERROR} * {_ERROR}))", "rmse", 6)},
              {rounded_sql(f"1 - sum({_ERROR} * {_ERROR}) / (var_pop(actual_return) * count(*))", "r2", 6)},
              {rounded_sql("avg(predicted_return)", "mean_pred", 6)}
            FROM preds GROUP BY 1 HAVING count(*) > 1""",
    ),
)
def metrics_by_magnitude(spark, sf_dir):
    grouped = t.preds(spark, sf_dir).withColumn("pred_group", e.magnitude_group(F.col("predicted_return")))
    made = e.slice_metrics(grouped, "actual_return", "predicted_return", "pred_group")
    return rounded(made, ["rmse", "r2", "mean_pred"], 6)


@check(
    "directional_loss",
    with_views(
        "preds",
        f"""SELECT split, {rounded_sql(
            "avg((predicted_return - actual_return) * (predicted_return - actual_return) + CASE WHEN sign(predicted_return) "
            "<> sign(actual_return) THEN 2 * abs(actual_return) ELSE 0 END)", "directional_loss", 6)}, count(*) AS n
            FROM preds GROUP BY split""",
    ),
)
def directional_loss(spark, sf_dir):
    made = e.directional_loss(t.preds(spark, sf_dir), "actual_return", "predicted_return", by=["split"])
    return rounded(made, ["directional_loss"], 6)


@check(
    "residual_histogram",
    with_views(
        "preds",
        f"""SELECT CAST(b.bin AS INT) AS bin, count(x) AS n, {rounded_sql("lo + (hi - lo) * b.bin / 50", "bin_start")}
            FROM range(50) b(bin) JOIN (SELECT min(x) AS lo, max(x) AS hi FROM residuals) r ON true
            LEFT JOIN residuals ON b.bin = least(CAST(floor((x - lo) / (hi - lo) * 50) AS INT), 49)
            GROUP BY b.bin, lo, hi""",
        f"residuals AS (SELECT {_ERROR} AS x FROM preds)",
    ),
)
def residual_histogram(spark, sf_dir):
    residuals = t.preds(spark, sf_dir).select((F.col("actual_return") - F.col("predicted_return")).alias("x"))
    return rounded(e.histogram(residuals, "x"), ["bin_start"])


_REPORT = """flags AS (
  SELECT *, CAST(actual_return > 0 AS INT) AS actual_direction, CAST(predicted_return > 0 AS INT) AS predicted_direction,
    CAST((actual_return > 0) = (predicted_return > 0) AS INT) AS direction_correct FROM preds)"""


@check(
    "forecast_report",
    with_views(
        "preds",
        """SELECT symbol, split, prediction_date, target_date, actual_return, predicted_return, actual_direction,
             predicted_direction, direction_correct, actual_price, predicted_price,
             round(avg(CASE WHEN split = 'test' THEN CAST(direction_correct AS DOUBLE) END)
               OVER (PARTITION BY symbol), 9) + 0e0 AS symbol_test_accuracy
           FROM flags""",
        _REPORT,
    ),
)
def forecast_report(spark, sf_dir):
    made = e.forecast_report(t.preds(spark, sf_dir))
    columns = [f.name for f in s.SCHEMAS["lstm_predictions"].fields]
    return rounded(made.select(*columns), ["symbol_test_accuracy"])


@check(
    "symbol_accuracy",
    with_views(
        "preds",
        f"""SELECT symbol, split, {rounded_sql("avg(CAST(direction_correct AS DOUBLE))", "mean")}, count(*) AS count
            FROM flags GROUP BY symbol, split""",
        _REPORT,
    ),
)
def symbol_accuracy(spark, sf_dir):
    return rounded(e.symbol_accuracy(t.preds(spark, sf_dir)), ["mean"])


_PRICE_ERROR = "(actual_price - predicted_price)"
_ERRORS = f"""SELECT symbol, {rounded_sql(f"avg({_PRICE_ERROR} * {_PRICE_ERROR})", "mse", 3)},
  {rounded_sql(f"avg(abs({_PRICE_ERROR}))", "mae", 6)}, {rounded_sql(f"sqrt(avg({_PRICE_ERROR} * {_PRICE_ERROR}))", "rmse", 6)},
  {rounded_sql("avg(CAST((actual_return > 0) = (predicted_return > 0) AS DOUBLE)) * 100", "direction_accuracy")}
FROM preds WHERE split = 'test' GROUP BY symbol"""


def _errors(spark, sf_dir):
    made = e.symbol_errors(t.preds(spark, sf_dir).filter(F.col("split") == "test"))
    return rounded(rounded(rounded(made, ["mse"], 3), ["mae", "rmse"], 6), ["direction_accuracy"])


@check("symbol_errors", with_views("preds", _ERRORS))
def symbol_errors(spark, sf_dir):
    return _errors(spark, sf_dir)


@check(
    "mean_symbol_accuracy",
    with_views(
        "preds",
        f"""SELECT {rounded_sql("avg(direction_accuracy)", "mean_direction_accuracy", 6)}, count(*) AS symbols
            FROM ({_ERRORS}) x""",
    ),
)
def mean_symbol_accuracy(spark, sf_dir):
    made = _errors(spark, sf_dir).agg(
        F.avg("direction_accuracy").alias("mean_direction_accuracy"), F.count(F.lit(1)).alias("symbols")
    )
    return rounded(made, ["mean_direction_accuracy"], 6)


@check(
    "top_bottom_symbols",
    with_views(
        "preds",
        f"""(SELECT symbol, direction_accuracy, 'top' AS rank_group FROM ({_ERRORS}) x
              ORDER BY direction_accuracy DESC, symbol LIMIT 5)
            UNION ALL (SELECT symbol, direction_accuracy, 'bottom' FROM ({_ERRORS}) x
              ORDER BY direction_accuracy, symbol DESC LIMIT 5)""",
    ),
)
def top_bottom_symbols(spark, sf_dir):
    errors = _errors(spark, sf_dir).select("symbol", "direction_accuracy")
    return e.top_bottom(errors, "direction_accuracy", "symbol")


@check(
    "split_ranges",
    with_views(
        "preds",
        """SELECT split, min(target_date) AS first_target, max(target_date) AS last_target,
             min(prediction_date) AS first_pred, max(prediction_date) AS last_pred FROM preds GROUP BY split""",
    ),
)
def split_ranges_query(spark, sf_dir):
    return split_ranges(t.preds(spark, sf_dir))


@check(
    "softmax_label",
    """SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INT) AS label,
         round(1 / list_sum(list_transform(embedding, lambda x: exp(CAST(x AS DOUBLE) - CAST(list_max(embedding) AS DOUBLE)))), 9)
           + 0e0 AS confidence
       FROM embeddings""",
)
def softmax_label(spark, sf_dir):
    vectors = t.table(spark, sf_dir, "embeddings").withColumn("_top", m.softmax_label(F.col("embedding")))
    made = vectors.select("vec_id", F.col("_top.label").alias("label"), F.col("_top.confidence").alias("confidence"))
    return rounded(made, ["confidence"])


@check(
    "exchange_calendar",
    """SELECT event_id, CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) AS exchange_day,
         CAST(CAST(ts AS DATE) - 365 AS DATE) AS look_back_start FROM events""",
)
def exchange_calendar(spark, sf_dir):
    events = t.table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        m.exchange_date(F.col("ts").cast("timestamp")).alias("exchange_day"),
        m.look_back_start(F.to_date("ts"), 365).alias("look_back_start"),
    )


