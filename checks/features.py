"""Feature set, statements and macro series."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standin as t
from checks.registry import check, rounded, rounded_sql
from checks.views import CUTOFF, with_views
from tidemark import schemas as s
from tidemark.operators import financials, macro
from tidemark.operators.asof import known_on
from tidemark.plans import feature_set

_SPINE = """spine AS (
  SELECT DISTINCT symbol, bar_date AS prediction_date, (close - open) / NULLIF(open, 0) AS percent_daily_price_change,
    open AS sd_open, high AS sd_high, low AS sd_low, close AS sd_close, volume AS sd_volume, vwap AS sd_vwap,
    trade_count AS sd_trade_count, bar_date - 1 AS feature_date
  FROM bars)"""


def _renamed(columns: dict[str, str], ratios: dict[str, tuple[str, str]]) -> str:
    names = [f'"{vendor}" AS {feature}' for vendor, feature in columns.items()]
    vendor_of = {feature: vendor for vendor, feature in columns.items()}
    for name, (n, d) in ratios.items():
        names.append(f'CASE WHEN "{vendor_of[d]}" > 0 THEN "{vendor_of[n]}" / "{vendor_of[d]}" END AS {name}')
    return ", ".join(names)


_STATEMENTS = f"""releases AS (
  SELECT symbol, release_date, "EPS Estimate" AS ed_eps_estimate, "Reported EPS" AS ed_reported_eps,
    "Surprise(%)" AS ed_surprise_pct
  FROM earnings WHERE release_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY symbol, release_date ORDER BY "EPS Estimate" DESC NULLS LAST,
    "Reported EPS" DESC NULLS LAST, "Surprise(%)" DESC NULLS LAST) = 1),
income_f AS (
  SELECT symbol, fiscal_period_end, (SELECT min(e.release_date) FROM earnings e
      WHERE e.symbol = i.symbol AND e.release_date > i.fiscal_period_end) AS release_date,
    {_renamed(s.INCOME_COLUMNS, s.INCOME_RATIOS)} FROM income i),
balance_f AS (SELECT symbol, fiscal_period_end, {_renamed(s.BALANCE_COLUMNS, s.BALANCE_RATIOS)} FROM balance),
cashflow_f AS (SELECT symbol, fiscal_period_end, {_renamed(s.CASHFLOW_COLUMNS, {})} FROM cashflow),
combined AS (
  SELECT i.symbol, i.fiscal_period_end, i.release_date, {", ".join(s.EARNINGS_FEATURES)},
    {", ".join(s.INCOME_FEATURES)}, {", ".join(s.BALANCE_FEATURES)}, {", ".join(s.CASHFLOW_FEATURES)}
  FROM income_f i
  LEFT JOIN balance_f b ON i.symbol = b.symbol AND i.fiscal_period_end = b.fiscal_period_end
  LEFT JOIN cashflow_f c ON i.symbol = c.symbol AND i.fiscal_period_end = c.fiscal_period_end
  LEFT JOIN releases r ON i.symbol = r.symbol AND i.release_date = r.release_date
  WHERE i.release_date IS NOT NULL)"""

_RANKED = """ranked AS (
  SELECT d.symbol, d.feature_date, c.release_date AS fin_release_date,
    CAST(d.feature_date - c.release_date AS INT) AS fin_days_since_release, c.* EXCLUDE (symbol, release_date)
  FROM (SELECT DISTINCT symbol, feature_date FROM spine) d
  JOIN combined c ON c.symbol = d.symbol AND c.release_date <= d.feature_date
  QUALIFY row_number() OVER (PARTITION BY d.symbol, d.feature_date
    ORDER BY c.release_date DESC, c.fiscal_period_end DESC) = 1)"""

_KNOWN = """known AS (
  SELECT d.feature_date, v.series_id, v.value, v.date, v.realtime_start, v.realtime_end
  FROM (SELECT DISTINCT feature_date FROM spine) d JOIN vintages v ON v.realtime_start <= d.feature_date
  QUALIFY row_number() OVER (PARTITION BY d.feature_date, v.series_id
    ORDER BY v.realtime_start DESC, v.date DESC, v.realtime_end DESC) = 1)"""

_PIVOT = "pivoted AS (SELECT feature_date, " + ", ".join(
    f"max(CASE WHEN series_id = '{series}' THEN value END) AS {feature}"
    for series, (feature, _) in s.MACRO_SERIES.items()
) + " FROM known GROUP BY feature_date)"


def _daily(prefix: str, source: str, confidence: str) -> str:
    counts = ", ".join(
        f"CAST(count(*) FILTER (WHERE sentiment = '{label}') AS BIGINT) AS {prefix}_{label}_count"
        for label in ("positive", "neutral", "negative")
    )
    return f"""{prefix}_daily AS (
  SELECT symbol, news_date, {counts}, count(*) AS {prefix}_total_articles,
    {rounded_sql(f"avg({confidence})", f"{prefix}_avg_confidence")}
  FROM {source} GROUP BY symbol, news_date)"""


_DAILY = _daily("fingpt", "scored_full", "sentiment_confidence") + ",\n" + _daily("finbert", "scored", "confidence")

_SENTIMENT_AVERAGES = ["fingpt_avg_confidence", "finbert_avg_confidence"]

FEATURE_VIEWS = "bars earnings income balance cashflow vintages scored scored_full"
FEATURE_CTES = ",\n".join([_SPINE, _STATEMENTS, _RANKED, _KNOWN, _PIVOT, _DAILY]) + f""",
features AS (
  SELECT spine.symbol, prediction_date, percent_daily_price_change, {", ".join(s.BAR_FEATURES)},
    {", ".join(s.MODEL_FEATURES)},
    CASE WHEN prediction_date <= DATE '{CUTOFF}' THEN 'train' ELSE 'test' END AS split
  FROM spine
  LEFT JOIN ranked ON ranked.symbol = spine.symbol AND ranked.feature_date = spine.feature_date
  LEFT JOIN pivoted ON pivoted.feature_date = spine.feature_date
  LEFT JOIN fingpt_daily fg ON fg.symbol = spine.symbol AND fg.news_date = spine.feature_date
  LEFT JOIN finbert_daily fb ON fb.symbol = spine.symbol AND fb.news_date = spine.feature_date)"""


def features(spark, sf_dir, forecasts=None, columns=None):
    """The feature set over the stand-in tables, or the named columns of it."""
    metrics = None
    if columns is not None:
        ratios = s.INCOME_RATIOS | s.BALANCE_RATIOS
        used = {x for c in columns for x in (c, *ratios.get(c, ()))}
        vendor = {**s.INCOME_COLUMNS, **s.BALANCE_COLUMNS, **s.CASHFLOW_COLUMNS}
        # One statement per symbol and year, so the metrics that are left out decide nothing.
        metrics = [name for name, feature in vendor.items() if feature in used]
    made = feature_set.point_in_time_features(
        t.bars(spark, sf_dir),
        *t.statements(spark, sf_dir, metrics),
        t.earnings(spark, sf_dir),
        t.vintages(spark, sf_dir),
        {
            "fingpt": (t.scored_full(spark, sf_dir), "sentiment_confidence"),
            "finbert": (t.scored(spark, sf_dir), "confidence"),
        },
        cutoff=CUTOFF,
        forecasts=forecasts,
        columns=columns,
    )
    return rounded(made, [c for c in _SENTIMENT_AVERAGES if c in made.columns])


def _spine(spark, sf_dir):
    return feature_set.feature_spine(t.bars(spark, sf_dir))


def _combined(spark, sf_dir):
    return financials.combined_statements(
        t.income(spark, sf_dir), t.balance(spark, sf_dir), t.cashflow(spark, sf_dir), t.earnings(spark, sf_dir)
    )


check(
    "pit_feature_set",
    with_views(FEATURE_VIEWS, f"SELECT {', '.join(s.FEATURE_SET_COLUMNS)} FROM features", FEATURE_CTES),
)(features)


@check(
    "pit_feature_set_with_forecasts",
    with_views(
        f"{FEATURE_VIEWS} preds",
        f"""SELECT {', '.join('f.' + c for c in s.FEATURE_SET_COLUMNS)}, p.predicted_return, p.predicted_price
            FROM features f LEFT JOIN preds p USING (symbol, prediction_date)""",
        FEATURE_CTES,
    ),
)
def pit_feature_set_with_forecasts(spark, sf_dir):
    """The feature set next to a forecast table with a split of its own and two rows for every key."""
    forecasts = t.preds(spark, sf_dir).select("symbol", "prediction_date", "split", "predicted_return", "predicted_price")
    worse = forecasts.withColumn("predicted_return", F.lit(None).cast("double")).withColumn("predicted_price", F.lit(None).cast("double"))
    return features(spark, sf_dir, forecasts.unionByName(worse))


@check("feature_spine", with_views("bars", "SELECT * FROM spine", _SPINE))
def feature_spine(spark, sf_dir):
    return _spine(spark, sf_dir)


@check(
    "feature_spine_trading_calendar",
    with_views(
        "bars",
        "SELECT symbol, prediction_date, lag(prediction_date) OVER (PARTITION BY symbol ORDER BY prediction_date) "
        "AS feature_date FROM spine",
        _SPINE,
    ),
)
def feature_spine_trading_calendar(spark, sf_dir):
    spine = feature_set.feature_spine(t.bars(spark, sf_dir), calendar="trading")
    return spine.select("symbol", "prediction_date", "feature_date")


@check(
    "statement_release_forward_asof",
    with_views(
        "income earnings",
        """SELECT symbol, fiscal_period_end, (SELECT min(e.release_date) FROM earnings e
             WHERE e.symbol = i.symbol AND e.release_date > i.fiscal_period_end) AS release_date FROM income i""",
    ),
)
def statement_release_forward_asof(spark, sf_dir):
    income = financials.income_features(t.income(spark, sf_dir))
    released = financials.statement_releases(income, t.earnings(spark, sf_dir))
    return released.select("symbol", "fiscal_period_end", "release_date")


@check(
    "statements_combined",
    with_views("income balance cashflow earnings", "SELECT * FROM combined", _STATEMENTS),
)
def statements_combined(spark, sf_dir):
    return _combined(spark, sf_dir)


_FOUND = ["symbol", "feature_date", "fiscal_period_end", "fin_release_date", "fin_days_since_release"]
_FOUND += ["ed_surprise_pct", "is_net_margin", "bs_debt_to_equity", "cf_end_cash_position"]


@check(
    "financials_backward_asof",
    with_views(
        "bars income balance cashflow earnings",
        f"""SELECT s.symbol, s.feature_date, c.fiscal_period_end, c.release_date AS fin_release_date,
              CAST(s.feature_date - c.release_date AS INT) AS fin_days_since_release, {", ".join(_FOUND[5:])}
            FROM spine s ASOF LEFT JOIN (SELECT * FROM combined QUALIFY row_number() OVER (
              PARTITION BY symbol, release_date ORDER BY fiscal_period_end DESC) = 1) c
            ON s.symbol = c.symbol AND s.feature_date >= c.release_date""",
        ",\n".join([_SPINE, _STATEMENTS]),
    ),
)
def financials_backward_asof(spark, sf_dir):
    days = _spine(spark, sf_dir).select("symbol", "feature_date")
    return financials.latest_financials(days, _combined(spark, sf_dir)).select(*_FOUND)


@check(
    "financials_range_join_ranked",
    with_views(
        "bars income balance cashflow earnings",
        "SELECT * FROM ranked",
        ",\n".join([_SPINE, _STATEMENTS, _RANKED]),
    ),
)
def financials_range_join_ranked(spark, sf_dir):
    """Rank one of all earlier releases per symbol and day, found without forming the pairs."""
    days = _spine(spark, sf_dir).select("symbol", "feature_date").distinct()
    return financials.latest_financials(days, _combined(spark, sf_dir), how="inner")


_SERIES = list(s.MACRO_SERIES)


@check(
    "macro_vintage_asof",
    with_views(
        "bars vintages",
        """SELECT d.feature_date, v.series_id, v.value, v.date, v.realtime_start, v.realtime_end
           FROM (SELECT * FROM (SELECT DISTINCT feature_date FROM spine), (SELECT DISTINCT series_id FROM vintages)) d
           ASOF JOIN (SELECT * FROM vintages QUALIFY row_number() OVER (PARTITION BY series_id, realtime_start
             ORDER BY date DESC, realtime_end DESC) = 1) v
           ON d.series_id = v.series_id AND d.feature_date >= v.realtime_start""",
        _SPINE,
    ),
)
def macro_vintage_asof(spark, sf_dir):
    return macro.vintages_as_of(_spine(spark, sf_dir), t.vintages(spark, sf_dir), _SERIES)


@check(
    "macro_newest_observation_asof",
    with_views(
        "bars vintages",
        """SELECT d.feature_date, v.series_id, v.value, v.date, v.realtime_start, v.realtime_end
           FROM (SELECT DISTINCT feature_date FROM spine) d JOIN vintages v ON v.realtime_start <= d.feature_date
           QUALIFY row_number() OVER (PARTITION BY d.feature_date, v.series_id
             ORDER BY v.date DESC, v.realtime_start DESC, v.realtime_end DESC) = 1""",
        _SPINE,
    ),
)
def macro_newest_observation_asof(spark, sf_dir):
    return macro.vintages_as_of(_spine(spark, sf_dir), t.vintages(spark, sf_dir), _SERIES, order="observation")


@check(
    "macro_pivot",
    with_views("bars vintages", "SELECT * FROM pivoted", ",\n".join([_SPINE, _KNOWN, _PIVOT])),
)
def macro_pivot(spark, sf_dir):
    return macro.pivot_series(macro.vintages_as_of(_spine(spark, sf_dir), t.vintages(spark, sf_dir), _SERIES))


@check(
    "macro_theta_ranked",
    with_views(
        "bars vintages",
        "SELECT feature_date, series_id, value, CAST(1 AS INT) AS econ_rn FROM known",
        ",\n".join([_SPINE, _KNOWN]),
    ),
)
def macro_theta_ranked(spark, sf_dir):
    """Rank one of the dates x vintages join, found without the join."""
    known = macro.vintages_as_of(_spine(spark, sf_dir), t.vintages(spark, sf_dir), _SERIES)
    return known.select("feature_date", "series_id", "value", F.lit(1).alias("econ_rn"))


@check(
    "macro_first_release",
    with_views(
        "vintages",
        """SELECT series_id, date, min(series_name) AS series_name, min(realtime_start) AS realtime_start,
             min(realtime_end) AS realtime_end, arg_min(value, realtime_start) FILTER (WHERE value IS NOT NULL) AS value
           FROM vintages GROUP BY series_id, date""",
    ),
)
def macro_first_release(spark, sf_dir):
    return macro.first_release(t.vintages(spark, sf_dir))


@check(
    "macro_first_vintage_row",
    with_views(
        "vintages",
        """SELECT series_id, series_name, date, realtime_start, realtime_end, value FROM vintages
           QUALIFY row_number() OVER (PARTITION BY series_id, date ORDER BY realtime_start, realtime_end) = 1""",
    ),
)
def macro_first_vintage_row(spark, sf_dir):
    return macro.first_release(t.vintages(spark, sf_dir), skip_nulls=False)


@check(
    "macro_revision_metadata",
    with_views(
        "vintages",
        """SELECT series_id, min(series_name) AS series_name, count(DISTINCT date) AS unique_dates,
             count(*) AS total_records, count(*) - count(DISTINCT date) AS revisions
           FROM vintages GROUP BY series_id""",
    ),
)
def macro_revision_metadata(spark, sf_dir):
    return macro.revision_counts(t.vintages(spark, sf_dir))


@check(
    "macro_known_on_date",
    with_views(
        "vintages",
        """SELECT series_id, date, realtime_start, realtime_end, value FROM vintages
           WHERE realtime_start <= DATE '1998-03-31' AND realtime_end >= DATE '1998-03-31'""",
    ),
)
def macro_known_on_date(spark, sf_dir):
    known = known_on(t.vintages(spark, sf_dir), "1998-03-31", current_only=True)
    return known.select("series_id", "date", "realtime_start", "realtime_end", "value")


@check(
    "macro_validity_intervals",
    with_views(
        "vintages",
        """SELECT series_id, date, realtime_start, realtime_end, value,
             lead(realtime_start) OVER (PARTITION BY series_id, date ORDER BY realtime_start, realtime_end) - 1 AS valid_to
           FROM vintages""",
    ),
)
def macro_validity_intervals(spark, sf_dir):
    return macro.validity_intervals(t.vintages(spark, sf_dir)).drop("series_name")


@check(
    "macro_series_dimension",
    with_views(
        "vintages",
        """SELECT series_id, min(series_name) AS series_name, count(*) AS total_records,
             count(value) AS known_values FROM vintages GROUP BY series_id""",
    ),
)
def macro_series_dimension(spark, sf_dir):
    """Titles come from the fixed series table, joined to the counts."""
    titles = spark.createDataFrame(
        [(series, title) for series, (_, title) in s.MACRO_SERIES.items()], "series_id string, series_name string"
    )
    counts = t.vintages(spark, sf_dir).groupBy("series_id").agg(
        F.count(F.lit(1)).alias("total_records"), F.count("value").alias("known_values")
    )
    return counts.join(titles, "series_id")
