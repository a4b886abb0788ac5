"""Availability, splits, prediction diagnosis, models and attributions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from checks import standin as t
from checks.features import FEATURE_CTES, FEATURE_VIEWS, features
from checks.registry import check, rounded, rounded_sql
from checks.views import CUTOFF, TERMS_B, with_views
from tidemark import schemas as s
from tidemark.functions.market import price_class
from tidemark.functions import text as tx
from tidemark.operators import boosting as b
from tidemark.operators import diagnosis as d
from tidemark.operators import evaluation as e
from tidemark.operators import indicators as ind
from tidemark.operators import modeling as m
from tidemark.operators import per_key, scoring, splits
from tidemark.operators import sequences as seq
from tidemark.operators.news import article_next_bar
from tidemark.session import stage_table


def _on_features(query: str) -> str:
    return with_views(FEATURE_VIEWS, query, FEATURE_CTES)


_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, "
    f"round((count(*) - count({c})) * 100e0 / count(*), 9) + 0e0 AS null_pct FROM features"
    for c in s.FEATURE_SET_COLUMNS
)


@check("null_profile", _on_features(_NULLS))
def null_profile(spark, sf_dir):
    return rounded(d.null_profile(features(spark, sf_dir)), ["null_pct"])


def _group_share(name: str, columns: list[str]) -> str:
    missing = " + ".join(f"(count(*) - count({c})) * 100e0 / count(*)" for c in columns)
    return f"SELECT '{name}' AS feature_group, {rounded_sql(f'({missing}) / {len(columns)}', 'null_pct', 6)} FROM features"


@check(
    "null_share_by_group",
    _on_features(" UNION ALL ".join(_group_share(n, c) for n, c in d.FEATURE_GROUPS.items())),
)
def null_share_by_group(spark, sf_dir):
    return rounded(d.null_share_by_group(features(spark, sf_dir)), ["null_pct"], 6)


#: Columns that the availability flags are read from.
_AVAILABILITY = ["fingpt_total_articles", "is_total_revenue"]
_FLAGS = """(coalesce(fingpt_total_articles, 0) > 0) AS has_sentiment, (is_total_revenue IS NOT NULL) AS has_financials"""


@check(
    "availability_patterns",
    _on_features(
        f"""SELECT has_sentiment, has_financials, count(*) AS n,
              {rounded_sql("count(*) * 100e0 / sum(count(*)) OVER ()", "pct")}
            FROM (SELECT {_FLAGS} FROM features) f GROUP BY 1, 2"""
    ),
)
def availability_patterns(spark, sf_dir):
    made = features(spark, sf_dir, columns=_AVAILABILITY)
    return rounded(d.availability_patterns(d.with_availability(made)), ["pct"])


_PATTERN = """CASE WHEN has_sentiment AND has_financials THEN 'Both' WHEN has_sentiment THEN 'Sentiment Only'
  WHEN has_financials THEN 'Financials Only' ELSE 'Neither' END"""


@check(
    "metrics_by_slice",
    _on_features(
        f"""SELECT {_PATTERN} AS pattern, count(*) AS n, {rounded_sql("sqrt(avg((y - p) * (y - p)))", "rmse", 6)},
              {rounded_sql("CASE WHEN var_pop(y) > 0 THEN 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END", "r2", 6)},
              {rounded_sql("avg(p)", "mean_pred", 6)}
            FROM (SELECT {_FLAGS}, percent_daily_price_change AS y, (sd_vwap - sd_open) / sd_open AS p FROM features) f
            GROUP BY 1 HAVING count(*) > 1"""
    ),
)
def metrics_by_slice(spark, sf_dir):
    """Naive forecast from the volume-weighted price, per availability pattern."""
    made = d.with_availability(features(spark, sf_dir, columns=[s.TARGET, "sd_vwap", "sd_open", *_AVAILABILITY])).withColumn(
        "predicted", (F.col("sd_vwap") - F.col("sd_open")) / F.col("sd_open")
    )
    return rounded(e.slice_metrics(made, s.TARGET, "predicted", "pattern"), ["rmse", "r2", "mean_pred"], 6)


_FILLED = ["is_total_revenue", "bs_current_ratio", "cf_free_cash_flow", "econ_cpi", "fingpt_total_articles"]


@check(
    "fillna_zero",
    _on_features(
        "SELECT symbol, prediction_date, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _FILLED) + " FROM features"
    ),
)
def fillna_zero(spark, sf_dir):
    return m.fill_missing(features(spark, sf_dir, columns=[*s.KEY_COLUMNS, *_FILLED]), _FILLED).select(*s.KEY_COLUMNS, *_FILLED)


_SCALED = ["is_net_margin", "bs_debt_to_equity", "econ_fedfunds", "fin_days_since_release"]


def _scaled(c: str) -> str:
    value = f"CAST(coalesce({c}, 0) AS DOUBLE)"
    lo, hi = f"min({value}) FILTER (WHERE split = 'train') OVER ()", f"max({value}) FILTER (WHERE split = 'train') OVER ()"
    return rounded_sql(f"({value} - {lo}) / CASE WHEN {hi} = {lo} THEN 1 ELSE {hi} - {lo} END", c)


@check(
    "minmax_fit_apply",
    _on_features(f"SELECT symbol, prediction_date, split, {', '.join(_scaled(c) for c in _SCALED)} FROM features"),
)
def minmax_fit_apply(spark, sf_dir):
    table = stage_table(features(spark, sf_dir, columns=[*s.KEY_COLUMNS, s.SPLIT, *_SCALED]), "features")
    ranges = m.fit_minmax(table.filter(F.col("split") == "train"), _SCALED)
    return rounded(m.apply_minmax(table, ranges).select(*s.KEY_COLUMNS, "split", *_SCALED), _SCALED)


def _bucket(text: str) -> str:
    return f"CASE WHEN substring(md5({text}), 1, 2) < 'cd' THEN 'train' ELSE 'test' END AS split"


@check(
    "group_split",
    with_views(
        "scored",
        f"SELECT news_article_id, symbol, {_bucket('concat_ws(chr(124), CAST(news_article_id AS VARCHAR), chr(52) || chr(50))')} FROM scored",
    ),
)
def group_split(spark, sf_dir):
    return splits.key_split(t.scored(spark, sf_dir), ["news_article_id"]).select("news_article_id", "symbol", "split")


@check(
    "row_split",
    with_views(
        "scored",
        f"""SELECT news_article_id, symbol,
              {_bucket("concat_ws('|', CAST(news_article_id AS VARCHAR), symbol, '42')")} FROM scored""",
    ),
)
def row_split(spark, sf_dir):
    made = splits.row_split(t.scored(spark, sf_dir), identity=["news_article_id", "symbol"])
    return made.select("news_article_id", "symbol", "split")


@check(
    "membership_filter",
    with_views(
        "bars earnings",
        """SELECT symbol, bar_date, symbol IN (SELECT symbol FROM earnings WHERE "Surprise(%)" > 0.05e0) AS listed
           FROM bars""",
    ),
)
def membership_filter(spark, sf_dir):
    """Semi and anti join in one pass: a symbol is listed if it meets its one row among the listed ones."""
    bars = t.bars(spark, sf_dir).select("symbol", "bar_date")
    listed = t.earnings(spark, sf_dir).filter(F.col("`Surprise(%)`") > 0.05).select("symbol").distinct()
    # One row per symbol, so its share of a task is small: hashed, the bars need no sort.
    marked = listed.withColumn("listed", F.lit(True)).hint("shuffle_hash")
    return bars.join(marked, "symbol", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))


# --- prediction groups ----------------------------------------------------------------------------------------


def _near_zero():
    return F.abs("predicted_return") < 0.05


_PROFILE = """profile AS (
  SELECT symbol, near_zero_records, normal_records, near_zero_records + normal_records AS total,
    near_zero_records * 100e0 / (near_zero_records + normal_records) AS pct_near_zero
  FROM (SELECT symbol, count(*) FILTER (WHERE abs(predicted_return) < 0.05e0) AS near_zero_records,
      count(*) FILTER (WHERE abs(predicted_return) >= 0.05e0) AS normal_records FROM preds GROUP BY symbol) p)"""


def _profile(spark, sf_dir):
    return d.group_profile(t.preds(spark, sf_dir), _near_zero())


@check(
    "near_zero_symbol_profile",
    with_views(
        "preds",
        f"SELECT symbol, near_zero_records, normal_records, total, {rounded_sql('pct_near_zero', 'pct_near_zero')} FROM profile",
        _PROFILE,
    ),
)
def near_zero_symbol_profile(spark, sf_dir):
    return rounded(_profile(spark, sf_dir), ["pct_near_zero"])


@check(
    "near_zero_count_merge",
    with_views("preds", "SELECT symbol, near_zero_records, normal_records FROM profile", _PROFILE),
)
def near_zero_count_merge(spark, sf_dir):
    preds = t.preds(spark, sf_dir)
    near = preds.filter(_near_zero()).groupBy("symbol").agg(F.count(F.lit(1)).alias("near_zero_records"))
    normal = preds.filter(~_near_zero()).groupBy("symbol").agg(F.count(F.lit(1)).alias("normal_records"))
    return d.merge_counts(near, normal, ["symbol"])


@check(
    "near_zero_extremes",
    with_views(
        "preds",
        """SELECT 'high' AS cohort, count(*) AS symbols, CAST(coalesce(sum(near_zero_records), 0) AS BIGINT) AS records
           FROM profile WHERE pct_near_zero >= 76
           UNION ALL SELECT 'low', count(*), CAST(coalesce(sum(normal_records), 0) AS BIGINT)
           FROM profile WHERE pct_near_zero <= 74""",
        _PROFILE,
    ),
)
def near_zero_extremes(spark, sf_dir):
    return d.profile_extremes(_profile(spark, sf_dir), high=76.0, low=74.0)


@check(
    "top_k_symbols",
    with_views(
        "preds",
        """SELECT symbol, near_zero_records, normal_records FROM profile
           ORDER BY near_zero_records DESC, symbol LIMIT 20""",
        _PROFILE,
    ),
)
def top_k_symbols(spark, sf_dir):
    return d.top_k(_profile(spark, sf_dir), "near_zero_records").select("symbol", "near_zero_records", "normal_records")


@check(
    "cohort_symbols_sample",
    with_views(
        "preds",
        """SELECT symbol, prediction_date, predicted_return FROM preds WHERE symbol IN (SELECT symbol FROM profile
             WHERE pct_near_zero >= 75 ORDER BY pct_near_zero DESC, symbol LIMIT 5)""",
        _PROFILE,
    ),
)
def cohort_symbols_sample(spark, sf_dir):
    """All rows of the first five symbols of a cohort."""
    cohort = d.top_k(_profile(spark, sf_dir).filter(F.col("pct_near_zero") >= 75), "pct_near_zero", k=5)
    rows = d.cohort_members(t.preds(spark, sf_dir), cohort, F.lit(True))
    return rows.select("symbol", "prediction_date", "predicted_return")


_GAP_FEATURES = ["open", "high", "low", "close", "volume", "trade_count", "vwap"]


def _bar_preds(spark, sf_dir):
    bars = t.bars(spark, sf_dir).withColumnRenamed("bar_date", "prediction_date")
    return t.preds(spark, sf_dir).drop("close").join(bars, ["symbol", "prediction_date"])


_BAR_PREDS = """bar_preds AS (
  SELECT p.* EXCLUDE (close), b.* EXCLUDE (symbol, bar_date)
  FROM preds p JOIN bars b ON b.symbol = p.symbol AND b.bar_date = p.prediction_date)"""


@check(
    "cohort_mean_gap",
    with_views(
        "preds",
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(avg({c}) FILTER (WHERE abs(predicted_return) < 0.05e0), 6) + 0e0 AS mean_in_group,"
            f" round(avg({c}) FILTER (WHERE abs(predicted_return) >= 0.05e0), 6) + 0e0 AS mean_outside FROM bar_preds"
            for c in _GAP_FEATURES
        )
        + ") x WHERE abs(mean_in_group - mean_outside) > 0.1e0",
        _BAR_PREDS,
    ),
)
def cohort_mean_gap(spark, sf_dir):
    gaps = d.mean_gaps(_bar_preds(spark, sf_dir), _near_zero(), _GAP_FEATURES)
    return rounded(gaps, ["mean_in_group", "mean_outside"], 6)


_RATIO_FEATURES = ["is_total_revenue", "bs_total_assets", "is_net_income", "cf_operating_cash_flow", "econ_high_yield_spread"]
_HIGH, _LOW = "prediction_date < DATE '1998-01-01'", "prediction_date >= DATE '1998-01-01'"


@check(
    "cohort_ratio",
    _on_features(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, round(avg({c}) FILTER (WHERE {_HIGH}), 2) + 0e0 AS high_mean,
                  round(avg({c}) FILTER (WHERE {_LOW}), 2) + 0e0 AS low_mean,
                  count(*) FILTER (WHERE {_HIGH} AND {c} IS NULL) AS high_nulls,
                  count(*) FILTER (WHERE {_LOW} AND {c} IS NULL) AS low_nulls,
                  round(avg({c}) FILTER (WHERE {_HIGH}) / avg({c}) FILTER (WHERE {_LOW}), 6) + 0e0 AS ratio
                FROM features"""
            for c in _RATIO_FEATURES
        )
    ),
)
def cohort_ratio(spark, sf_dir):
    table = features(spark, sf_dir, columns=["prediction_date", *_RATIO_FEATURES])
    made = d.cohort_ratios(table, F.expr(_HIGH), F.expr(_LOW), _RATIO_FEATURES)
    return rounded(rounded(made, ["high_mean", "low_mean"], 2), ["ratio"], 6)


@check(
    "group_ranges",
    with_views(
        "preds",
        f"""SELECT CASE WHEN abs(predicted_return) < 0.05e0 THEN 'near_zero' ELSE 'normal' END AS pred_group,
              min(prediction_date) AS first_date, max(prediction_date) AS last_date, count(*) AS n,
              count(DISTINCT symbol) AS symbols,
              {rounded_sql("avg(target_date - prediction_date)", "mean_recency", 6)}
            FROM preds GROUP BY 1""",
    ),
)
def group_ranges(spark, sf_dir):
    grouped = t.preds(spark, sf_dir).withColumns(
        {
            "pred_group": e.magnitude_group(F.col("predicted_return")),
            "gap_days": F.datediff("target_date", "prediction_date"),
        }
    )
    return rounded(d.group_ranges(grouped, "pred_group", "prediction_date", "gap_days"), ["mean_recency"], 6)


@check(
    "only_in_group",
    with_views(
        "preds",
        """SELECT symbol FROM preds WHERE predicted_return < 0.85e0
           EXCEPT SELECT symbol FROM preds WHERE predicted_return >= 0.85e0""",
    ),
)
def only_in_group(spark, sf_dir):
    return d.only_in_group(t.preds(spark, sf_dir), F.col("predicted_return") < 0.85)


# --- attributions from a fixed linear model -------------------------------------------------------------------

_COEFFICIENTS = {"open": 0.5, "volume": -0.001, "vwap": 0.25, "trade_count": 2.0}
_SHAP = ", ".join(
    f"{b}e0 * ({c} - avg({c}) OVER ()) AS shap_{c}" for c, b in _COEFFICIENTS.items()
)
_ATTRIBUTED = f"attributed AS (SELECT symbol, bar_date, open, close, {_SHAP} FROM bars)"


def _attributed(spark, sf_dir):
    bars = t.stored_bars(spark, sf_dir)
    means = m.feature_means(bars, list(_COEFFICIENTS))
    return m.linear_attributions(bars, _COEFFICIENTS, means)


@check(
    "linear_attribution",
    with_views(
        "bars",
        "SELECT symbol, bar_date, "
        + ", ".join(rounded_sql(f"shap_{c}", f"shap_{c}", 5) for c in _COEFFICIENTS)
        + " FROM attributed",
        _ATTRIBUTED,
    ),
)
def linear_attribution(spark, sf_dir):
    names = [f"shap_{c}" for c in _COEFFICIENTS]
    return rounded(_attributed(spark, sf_dir).select("symbol", "bar_date", *names), names, 5)


_IMPORTANCE = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, sum(abs(shap_{c})) AS importance FROM attributed" for c in _COEFFICIENTS
)


@check(
    "attribution_importance",
    with_views(
        "bars",
        f"""SELECT feature, {rounded_sql("importance", "importance", 2)},
              {rounded_sql("importance * 100 / sum(importance) OVER ()", "pct", 6)} FROM ({_IMPORTANCE}) i""",
        _ATTRIBUTED,
    ),
)
def attribution_importance(spark, sf_dir):
    made = d.attribution_importance(_attributed(spark, sf_dir), list(_COEFFICIENTS))
    return rounded(rounded(made, ["importance"], 2), ["pct"], 6)


_HIGH_MOVE = "abs((close - open) / open) >= 0.05e0"
_GROUP_SUMS = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, sum(abs(shap_{c})) FILTER (WHERE {_HIGH_MOVE}) AS high_sum,
      sum(abs(shap_{c})) FILTER (WHERE NOT {_HIGH_MOVE}) AS low_sum FROM attributed"""
    for c in _COEFFICIENTS
)


@check(
    "attribution_group_compare",
    with_views(
        "bars",
        f"""SELECT feature, {rounded_sql("high_sum", "high_sum", 2)}, {rounded_sql("low_sum", "low_sum", 2)},
              {rounded_sql("high_sum * 100 / sum(high_sum) OVER ()", "high_pct", 6)},
              {rounded_sql("low_sum * 100 / sum(low_sum) OVER ()", "low_pct", 6)},
              {rounded_sql("high_sum * 100 / sum(high_sum) OVER () - low_sum * 100 / sum(low_sum) OVER ()", "pct_diff", 6)}
            FROM ({_GROUP_SUMS}) g""",
        _ATTRIBUTED,
    ),
)
def attribution_group_compare(spark, sf_dir):
    high = F.abs((F.col("close") - F.col("open")) / F.col("open")) >= 0.05
    made = d.attribution_by_group(_attributed(spark, sf_dir), list(_COEFFICIENTS), high)
    return rounded(rounded(made, ["high_sum", "low_sum"], 2), ["high_pct", "low_pct", "pct_diff"], 6)


@check(
    "per_symbol_regression",
    with_views(
        "preds",
        f"""SELECT symbol, {rounded_sql("regr_slope(actual_return, predicted_return)", "slope", 6)},
              {rounded_sql("regr_intercept(actual_return, predicted_return)", "intercept", 6)}, count(*) AS train_rows
            FROM preds WHERE split = 'train' GROUP BY symbol""",
    ),
)
def per_symbol_regression(spark, sf_dir):
    made = m.fit_per_key(
        t.preds(spark, sf_dir), ["symbol"], "predicted_return", "actual_return", F.col("split") == "train"
    )
    return rounded(made, ["slope", "intercept"], 6)


@check(
    "per_symbol_ridge",
    with_views(
        "preds",
        f"""SELECT symbol, {rounded_sql("regr_slope(actual_return, predicted_return)", "slope", 6)},
              {rounded_sql("regr_intercept(actual_return, predicted_return)", "intercept", 6)}, count(*) AS train_rows
            FROM preds WHERE split = 'train' AND actual_return IS NOT NULL AND predicted_return IS NOT NULL GROUP BY symbol""",
    ),
)
def per_symbol_ridge(spark, sf_dir):
    """The regression of many features with one feature and no penalty is the least-squares line."""
    made = per_key.fit_ridge_per_key(
        t.preds(spark, sf_dir), ["symbol"], ["predicted_return"], "actual_return", 0.0, F.col("split") == "train"
    )
    made = made.select("symbol", F.col("coefficients")[0].alias("slope"), "intercept", "train_rows")
    return rounded(made, ["slope", "intercept"], 6)


@check(
    "per_symbol_forecast",
    with_views(
        "preds",
        f"""SELECT p.symbol, p.prediction_date, p.split,
              {rounded_sql("f.a + f.b * p.predicted_return", "forecast", 6)}
            FROM preds p JOIN (SELECT symbol, regr_slope(actual_return, predicted_return) AS b,
                regr_intercept(actual_return, predicted_return) AS a
              FROM preds WHERE split = 'train' GROUP BY symbol) f ON f.symbol = p.symbol""",
    ),
)
def per_symbol_forecast(spark, sf_dir):
    preds = t.preds(spark, sf_dir)
    parameters = m.fit_per_key(preds, ["symbol"], "predicted_return", "actual_return", F.col("split") == "train")
    made = m.predict_per_key(preds, parameters, ["symbol"], "predicted_return", "forecast")
    return rounded(made.select("symbol", "prediction_date", "split", "forecast"), ["forecast"], 6)


@check(
    "scored_articles_pluggable",
    with_views(
        "scored_full",
        "SELECT news_article_id, symbol, news_date, sentiment, sentiment_confidence FROM scored_full",
    ),
)
def scored_articles_pluggable(spark, sf_dir):
    """The term-counting scorer as a batch model behind the pluggable interface, on whole texts."""
    articles = t.scored_full(spark, sf_dir).drop("sentiment", "sentiment_confidence")
    score = scoring.score_column(F.col("article_text"), scoring.lexicon_scorer(*TERMS_B))
    made = scoring.score_articles(articles, score, confidence="sentiment_confidence")
    return made.drop("article_text")


def _answer_model():
    """Stands for a generative model: answers from the letters of the article inside the prompt."""

    def reply(prompts):
        article = prompts.str.extract(r"(?s)Input: (.*)\nAnswer: $")[0]
        p, q = article.str.count("a"), article.str.count("o")
        answer = pd.Series("neutral", index=prompts.index)
        answer[p * 100 > q * 105] = "Positive."
        answer[q * 100 > p * 105] = " negative\n"
        return prompts + answer

    return reply


@check(
    "prompted_articles",
    with_views(
        "scored",
        """SELECT news_article_id, symbol, sentiment, CASE sentiment WHEN 'neutral' THEN 0.7e0 ELSE 0.85e0 END AS confidence
           FROM scored""",
    ),
)
def prompted_articles(spark, sf_dir):
    """Prompt, pluggable batch model, reply parsed by native expressions."""
    articles = t.scored(spark, sf_dir).select("news_article_id", "symbol", "article_text")
    prompt = tx.render_prompt(tx.SENTIMENT_PROMPT, article_text=F.col("article_text"))
    replied = articles.withColumn("reply", scoring.reply_column(prompt, _answer_model))
    made = scoring.score_articles(replied, tx.reply_label(F.col("reply")))
    return made.drop("article_text", "reply")


# --- fitted models: what SQL can state about them ---------------------------------------------------------------

_MODEL_FEATURES = [*s.FINANCIAL_FEATURES, *s.MACRO_FEATURES, *s.SENTIMENT_FEATURES]


def _known(spark, sf_dir):
    table = stage_table(features(spark, sf_dir, columns=[*s.KEY_COLUMNS, s.TARGET, s.SPLIT, *_MODEL_FEATURES]), "features")
    ranges = m.fit_minmax(table.filter(F.col("split") == "train"), _MODEL_FEATURES)
    return m.apply_minmax(table, ranges).filter(F.col(s.TARGET).isNotNull())


def _training(spark, sf_dir):
    return m.training_table(_known(spark, sf_dir), _MODEL_FEATURES, [*s.KEY_COLUMNS, s.TARGET, s.SPLIT])


def _trees():
    return m.boosted_trees(s.TARGET, trees=3, depth=3)


def _reference_trees():
    """100 trees of depth 6 of the general estimator."""
    return m.boosted_trees(s.TARGET)


@check(
    "gbt_predictions",
    _on_features(f"SELECT symbol, prediction_date, split, {s.TARGET}, true AS predicted FROM features WHERE {s.TARGET} IS NOT NULL"),
)
def gbt_predictions(spark, sf_dir):
    """Every row with a target gets a number."""
    _, predicted = m.fit_and_predict(_training(spark, sf_dir), _trees())
    number = F.col("predicted").isNotNull() & ~F.isnan("predicted")
    return predicted.select(*s.KEY_COLUMNS, s.SPLIT, s.TARGET, number.alias("predicted"))


#: Trees and depth of the reference, for the queries that return what the model says.
_TREES = {"trees": 100, "depth": 6}


def _boosted(spark, sf_dir, folds=0, trees=_TREES):
    """Scaled rows with a target, and the models fitted on their train part: one per fold, and that of all rows last."""
    known = stage_table(_known(spark, sf_dir).select(*s.KEY_COLUMNS, s.TARGET, s.SPLIT, *_MODEL_FEATURES), "known")
    fold = splits.fold_column(s.KEY_COLUMNS, folds) if folds else None
    return known, b.fit_boosted(known.where(F.col(s.SPLIT) == "train"), _MODEL_FEATURES, s.TARGET, fold, folds, **trees)


@check("gbt_prediction_values")
def gbt_prediction_values(spark, sf_dir):
    """The predictions themselves, of the trees of the reference."""
    known, forests = _boosted(spark, sf_dir)
    return b.predict_boosted(known, forests[-1]).select(*s.KEY_COLUMNS, s.SPLIT, s.TARGET, "predicted")


def _attributed_trees(spark, sf_dir):
    known, forests = _boosted(spark, sf_dir)
    return b.tree_attributions(b.predict_boosted(known, forests[-1]), forests[-1]), forests[-1].expected


@check(
    "tree_attribution",
    _on_features(
        f"""SELECT symbol, prediction_date, split, {len(_MODEL_FEATURES)} AS n_features, true AS adds_up
            FROM features WHERE {s.TARGET} IS NOT NULL"""
    ),
)
def tree_attribution(spark, sf_dir):
    """The attributions of every row add up to its prediction minus the mean prediction of the model."""
    made, expected = _attributed_trees(spark, sf_dir)
    names = [f"shap_{c}" for c in _MODEL_FEATURES]
    total = F.aggregate(F.array(*names), F.lit(0.0), lambda a, x: a + x)
    adds_up = F.abs(total - (F.col("predicted") - expected)) <= 1e-9 * (1 + F.abs("predicted"))
    return made.select("symbol", "prediction_date", "split", F.size(F.array(*names)).alias("n_features"), adds_up.alias("adds_up"))


@check("tree_attribution_values")
def tree_attribution_values(spark, sf_dir):
    """Prediction and one attribution per model feature."""
    made, _ = _attributed_trees(spark, sf_dir)
    return made.select(*s.KEY_COLUMNS, s.SPLIT, "predicted", *[f"shap_{c}" for c in _MODEL_FEATURES])


_FOLD = "CAST(('0x' || substr(md5(concat_ws('|', symbol, CAST(prediction_date AS VARCHAR), '42')), 1, 2)) AS INT) % 5"


@check(
    "cv_scores",
    _on_features(
        f"""SELECT {_FOLD} AS fold, count(*) AS n, true AS beats_nothing FROM features
            WHERE split = 'train' AND {s.TARGET} IS NOT NULL GROUP BY 1"""
    ),
)
def cv_scores(spark, sf_dir):
    """Folds over the train rows; no fold is worse than twice the deviation of the target. The models of all folds grow together."""
    known, forests = _boosted(spark, sf_dir, folds=5, trees={"trees": 3, "depth": 3})
    train = known.where(F.col(s.SPLIT) == "train").withColumn("fold", splits.fold_column(s.KEY_COLUMNS, 5))
    per_fold = e.regression_metrics(b.cross_predicted(train, forests, F.col("fold")), s.TARGET, "predicted", ["fold"])
    spread = train.agg(F.stddev_pop(s.TARGET)).scalar()
    return per_fold.select("fold", "n", (F.col("rmse") <= 2 * spread).alias("beats_nothing"))


@check("cv_score_values")
def cv_score_values(spark, sf_dir):
    """Scores of each fold, of the trees of the reference, each row with their mean and deviation over the folds.

    The models of all folds grow together.
    """
    known, forests = _boosted(spark, sf_dir, folds=5)
    train = known.where(F.col(s.SPLIT) == "train").withColumn("fold", splits.fold_column(s.KEY_COLUMNS, 5))
    scored = b.cross_predicted(train, forests, F.col("fold"))
    per_fold = stage_table(e.regression_metrics(scored, s.TARGET, "predicted", ["fold"]), "fold-scores")
    summary = m.cross_validation_summary(per_fold).first().asDict()
    return per_fold.withColumns({k: F.lit(v) for k, v in summary.items()})


_ABLATED = ["open", "volume", "vwap", "trade_count"]


_BAR_KEYS = "SELECT symbol, bar_date, {} FROM bars"


@check(
    "ablation_attribution",
    with_views("bars", "SELECT symbol, bar_date, feature, true AS attributed FROM bars, (VALUES ('open'), ('volume'), ('vwap'), ('trade_count')) f(feature)"),
)
def ablation_attribution(spark, sf_dir):
    bars = t.stored_bars(spark, sf_dir)
    table = m.training_table(bars, _ABLATED, ["symbol", "bar_date", "close"])
    model = m.boosted_trees("close", trees=3, depth=3).fit(table)
    made = m.ablation_attributions(model, bars, ["symbol", "bar_date"], _ABLATED, m.feature_means(bars, _ABLATED))
    # Not isNotNull(): the difference is never null, so Spark would score no row.
    number = F.abs("attribution") < F.lit(float("inf"))
    return made.select("symbol", "bar_date", "feature", number.alias("attributed"))


@check("ablation_attribution_values")
def ablation_attribution_values(spark, sf_dir):
    """The attributions themselves, over all model features, of the trees of the reference."""
    known = stage_table(_known(spark, sf_dir), "known")
    table = m.training_table(known, _MODEL_FEATURES, [*s.KEY_COLUMNS, s.TARGET, s.SPLIT])
    train = F.col(s.SPLIT) == "train"
    model = _reference_trees().fit(table.filter(train))
    means = m.feature_means(known.filter(train), _MODEL_FEATURES)
    return m.ablation_attributions(model, known, s.KEY_COLUMNS, _MODEL_FEATURES, means)


def _linear(spark, sf_dir):
    bars = t.stored_bars(spark, sf_dir)
    fitted = m.fit_linear(m.training_table(bars, _ABLATED, ["symbol", "bar_date", "close"]), "close")
    coefficients = dict(zip(_ABLATED, [float(b) for b in fitted.coefficients]))
    means = m.feature_means(bars, _ABLATED)
    return m.linear_attributions(bars, coefficients, means), coefficients, means


@check("fitted_linear_attribution_values")
def fitted_linear_attribution_values(spark, sf_dir):
    """The attributions themselves."""
    return _linear(spark, sf_dir)[0]


@check("fitted_linear_attribution", with_views("bars", _BAR_KEYS.format("true AS adds_up")))
def fitted_linear_attribution(spark, sf_dir):
    made, coefficients, means = _linear(spark, sf_dir)
    # The attributions of a row add up to its prediction minus the prediction at the mean.
    predicted = sum((F.lit(b) * F.col(c) for c, b in coefficients.items()), F.lit(0.0))
    at_mean = sum(b * means[c] for c, b in coefficients.items())
    total = sum((F.col(f"shap_{c}") for c in _ABLATED), F.lit(0.0))
    adds_up = F.abs(total - (predicted - at_mean)) <= 1e-6 * (1 + F.abs(predicted) + abs(at_mean))
    return made.select("symbol", "bar_date", adds_up.alias("adds_up"))


def _classified(spark, sf_dir):
    articles = article_next_bar(t.news(spark, sf_dir), t.bars(spark, sf_dir), with_summary=True)
    labelled = splits.key_split(articles, ["news_article_id"]).withColumn(
        "price_class", price_class(F.col("percent_daily_price_change"))
    )
    return m.text_classifier(labelled, "article_text", "price_class")


@check("text_classifier_values")
def text_classifier_values(spark, sf_dir):
    """Class and confidence of every row."""
    return _classified(spark, sf_dir).drop("article_text")


@check(
    "text_classifier",
    with_views(
        "exploded moves",
        """SELECT DISTINCT e.id AS news_article_id, e.symbol, CAST(e.created_at AS DATE) AS news_date, true AS confident
           FROM exploded e JOIN moves m ON e.symbol = m.symbol AND CAST(e.created_at AS DATE) = m.news_date
           WHERE e.headline IS NOT NULL AND m.percent_daily_price_change IS NOT NULL""",
    ),
)
def text_classifier(spark, sf_dir):
    made = _classified(spark, sf_dir)
    confident = F.col("confidence").between(1 / 3, 1) & F.col("prediction").isin(0.0, 1.0, 2.0)
    return made.select("news_article_id", "symbol", "news_date", confident.alias("confident")).distinct()
