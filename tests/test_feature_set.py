"""Edge rows of statements, macro vintages and the feature set on hand-made tables."""

import datetime

import pytest

from tidemark import schemas as s
from tidemark.operators import financials, macro
from tidemark.plans import feature_set

D = datetime.date


def income(spark, rows):
    names = list(s.INCOME_COLUMNS)
    data = [(sym, end, *[values.get(n) for n in names]) for sym, end, values in rows]
    return spark.createDataFrame(data, s.SCHEMAS["income_statement"])


def empty(spark, name):
    return spark.createDataFrame([], s.SCHEMAS[name])


def earnings(spark, rows):
    schema = "symbol string, release_date date, `EPS Estimate` double, `Reported EPS` double, `Surprise(%)` double"
    return spark.createDataFrame(rows, schema)


def test_release_is_strictly_after_period_end(spark):
    statements = financials.income_features(income(spark, [("A", D(2024, 12, 31), {}), ("B", D(2024, 12, 31), {})]))
    releases = earnings(
        spark,
        [("A", D(2024, 12, 31), 1.0, 1.0, 0.0), ("A", D(2025, 2, 1), 2.0, 2.0, 0.0), ("A", None, 9.0, 9.0, 9.0)],
    )
    got = {r["symbol"]: r["release_date"] for r in financials.statement_releases(statements, releases).collect()}
    assert got == {"A": D(2025, 2, 1), "B": None}


def test_two_earnings_rows_on_one_day_keep_one_statement_row(spark):
    combined = financials.combined_statements(
        income(spark, [("A", D(2024, 12, 31), {"Net Income": 5.0})]),
        empty(spark, "balance_sheet"),
        empty(spark, "cashflow"),
        earnings(spark, [("A", D(2025, 2, 1), 1.0, 3.0, 0.1), ("A", D(2025, 2, 1), 2.0, 1.0, 0.2)]),
    ).collect()
    assert len(combined) == 1 and combined[0]["ed_eps_estimate"] == 2.0 and combined[0]["is_net_income"] == 5.0


def test_same_release_for_two_periods_takes_the_newer_and_age_zero_matches(spark):
    combined = financials.combined_statements(
        income(spark, [("A", D(2023, 12, 31), {"Net Income": 1.0}), ("A", D(2024, 12, 31), {"Net Income": 2.0})]),
        empty(spark, "balance_sheet"),
        empty(spark, "cashflow"),
        earnings(spark, [("A", D(2025, 2, 1), 1.0, 1.0, 0.1)]),
    )
    days = spark.createDataFrame([("A", D(2025, 2, 1)), ("A", D(2025, 1, 31)), ("A", D(2025, 2, 11))], "symbol string, feature_date date")
    got = {r["feature_date"]: (r["is_net_income"], r["fin_days_since_release"]) for r in financials.latest_financials(days, combined).collect()}
    assert got == {D(2025, 2, 1): (2.0, 0), D(2025, 1, 31): (None, None), D(2025, 2, 11): (2.0, 10)}


@pytest.mark.parametrize("revenue, margin", [(4.0, 0.5), (0.0, None), (-1.0, None), (None, None)])
def test_guarded_ratio(spark, revenue, margin):
    made = financials.income_features(
        income(spark, [("A", D(2024, 12, 31), {"Total Revenue": revenue, "Net Income": 2.0})])
    )
    assert made.first()["is_net_margin"] == margin


VINTAGE = "series_id string, series_name string, date date, realtime_start date, realtime_end date, value double"


def test_macro_ties_and_null_values(spark):
    vintages = spark.createDataFrame(
        [
            ("GDP", "g", D(2024, 1, 1), D(2024, 5, 1), D(2024, 5, 31), 1.0),
            ("GDP", "g", D(2024, 2, 1), D(2024, 5, 1), D(2024, 5, 31), 2.0),
            ("GDP", "g", D(2024, 1, 1), D(2024, 6, 1), D(2024, 6, 30), None),
            ("VIXCLS", "v", D(2024, 1, 1), D(2024, 6, 2), D(2024, 6, 30), 7.0),
        ],
        VINTAGE,
    )
    days = spark.createDataFrame([(D(2024, 4, 30),), (D(2024, 5, 1),), (D(2024, 6, 1),), (D(2024, 6, 2),)], "feature_date date")
    known = macro.vintages_as_of(days, vintages, ["GDP", "VIXCLS"])
    wide = {r["feature_date"]: (r["econ_gdp"], r["econ_vix"]) for r in macro.pivot_series(known).collect()}
    # The newest publication counts even when its value is missing.
    assert wide == {D(2024, 5, 1): (2.0, None), D(2024, 6, 1): (None, None), D(2024, 6, 2): (None, 7.0)}
    newest = macro.vintages_as_of(days, vintages, ["GDP"], order="observation")
    assert {r["feature_date"]: r["value"] for r in newest.collect()}[D(2024, 6, 2)] == 2.0


def test_first_release_modes(spark):
    vintages = spark.createDataFrame(
        [
            ("GDP", "g", D(2024, 1, 1), D(2024, 5, 1), D(2024, 5, 31), None),
            ("GDP", "g", D(2024, 1, 1), D(2024, 6, 1), D(2024, 6, 30), 3.0),
        ],
        VINTAGE,
    )
    filled = macro.first_release(vintages).first()
    assert (filled["realtime_start"], filled["value"]) == (D(2024, 5, 1), 3.0)
    assert macro.first_release(vintages, skip_nulls=False).first()["value"] is None


def bars(spark, rows):
    columns = "symbol string, bar_date date, open double, high double, low double, close double, volume double, trade_count double, vwap double"
    return spark.createDataFrame([(sym, at, o, o, o, c, 1.0, 1.0, o) for sym, at, o, c in rows], columns)


def build(spark, bar_rows, **options):
    scored = spark.createDataFrame(
        [("A", D(2025, 10, 24), "positive", 0.8), ("A", D(2025, 10, 24), "neutral", 0.6), ("A", D(2025, 10, 26), "negative", 0.9)],
        "symbol string, news_date date, sentiment string, confidence double",
    )
    return feature_set.point_in_time_features(
        bars(spark, bar_rows),
        empty(spark, "income_statement"),
        empty(spark, "balance_sheet"),
        empty(spark, "cashflow"),
        earnings(spark, []),
        spark.createDataFrame([], VINTAGE),
        {"fingpt": (scored, "confidence"), "finbert": (scored, "confidence")},
        **options,
    )


ROWS = [("A", D(2025, 10, 24), 10.0, 11.0), ("A", D(2025, 10, 25), 0.0, 5.0), ("A", D(2025, 10, 27), 10.0, 9.0)]


def test_feature_set_columns_and_edges(spark):
    made = build(spark, ROWS + ROWS[:1])
    assert made.columns == s.FEATURE_SET_COLUMNS and len(made.columns) == 100
    got = {r["prediction_date"].day: r for r in made.collect()}
    assert set(got) == {24, 25, 27}  # the repeated bar is there once
    assert got[24]["split"] == "train" and got[25]["split"] == "test"  # cut-off day trains
    assert got[25][s.TARGET] is None  # zero open
    assert (got[25]["fingpt_total_articles"], got[25]["finbert_positive_count"]) == (2, 1)
    assert got[25]["fingpt_avg_confidence"] == pytest.approx(0.7)
    assert got[27]["finbert_negative_count"] == 1  # a Monday bar looks at Sunday
    assert got[24]["fingpt_total_articles"] is None


def test_trading_calendar_looks_at_the_previous_bar(spark):
    got = {r["prediction_date"].day: r["fingpt_total_articles"] for r in build(spark, ROWS, calendar="trading").collect()}
    assert got == {24: None, 25: 2, 27: None}


def test_flagship_plan(spark):
    from __spark_entry__ import entry

    plan = entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "l_comment" not in plan and "ReadSchema" in plan


def test_optional_forecasts(spark):
    forecasts = spark.createDataFrame([("A", D(2025, 10, 24), 0.5)], "symbol string, prediction_date date, lstm double")
    made = build(spark, ROWS, forecasts=forecasts)
    assert {r["prediction_date"].day: r["lstm"] for r in made.collect()} == {24: 0.5, 25: None, 27: None}


def test_validity_intervals(spark):
    rows = [("G", "g", D(2024, 1, 1), D(2024, m, 1), D(2024, m, 28), 1.0) for m in (2, 3, 5)]
    got = macro.validity_intervals(spark.createDataFrame(rows, VINTAGE)).orderBy("realtime_start").collect()
    assert [r["valid_to"] for r in got] == [D(2024, 2, 29), D(2024, 4, 30), None]


def test_unknown_options(spark):
    with pytest.raises(ValueError):
        feature_set.feature_spine(bars(spark, ROWS), calendar="lunar")
    with pytest.raises(ValueError):
        macro.vintages_as_of(spark.createDataFrame([(D(2024, 1, 1),)], "feature_date date"), spark.createDataFrame([], VINTAGE), ["GDP"], order="x")


def test_split_ranges(spark):
    df = spark.createDataFrame([("train", D(2024, 1, 1), D(2024, 1, 5)), ("train", D(2024, 2, 1), D(2024, 2, 5))], "split string, prediction_date date, target_date date")
    row = feature_set.split_ranges(df).first()
    assert (row["first_pred"], row["last_target"]) == (D(2024, 1, 1), D(2024, 2, 5))


def test_forecasts_join_the_narrow_rows(spark):
    """Statement and macro columns are not dealt anew for the forecasts, and names on both sides of the statements do not clash."""
    days = [D(1997, 5, 1), D(1997, 5, 2)]
    bars = spark.createDataFrame([("A", d, 1.0, 2.0, 0.5, 1.5, 9.0, 1.0, 1.2) for d in days],
        "symbol string, bar_date date, open double, high double, low double, close double, volume double, trade_count double, vwap double")
    forecasts = spark.createDataFrame([("A", days[0], 1.0, 3), ("A", days[0], 2.0, 1), ("B", days[1], 5.0, 7)],
        "symbol string, prediction_date date, predicted_return double, fiscal_period_end int")
    scored = spark.createDataFrame([("A", D(1997, 4, 30), "positive", 0.5), ("A", D(1997, 5, 2), "negative", 0.7)],
        "symbol string, news_date date, sentiment string, confidence double")
    vintages = spark.createDataFrame([], "series_id string, date date, realtime_start date, realtime_end date, value double")
    tables = [bars, income(spark, [("A", D(1996, 12, 31), {"Net Income": 5.0})]), empty(spark, "balance_sheet"), empty(spark, "cashflow"),
        earnings(spark, [("A", D(1997, 2, 1), 1.0, 3.0, 0.1)]), vintages, {p: (scored, "confidence") for p in s.SENTIMENT_PREFIXES}]
    plain = feature_set.point_in_time_features(*tables)
    made = feature_set.point_in_time_features(*tables, forecasts=forecasts)
    joins = [f._jdf.queryExecution().optimizedPlan().toString().count("Join ") for f in (plain, made)]
    assert joins[0] == joins[1]
    assert made.columns == [*plain.columns, "predicted_return", "fiscal_period_end"]
    rows = {r["prediction_date"]: r for r in made.collect()}
    assert [(rows[d]["predicted_return"], rows[d]["fiscal_period_end"]) for d in days] == [(2.0, 1), (None, None)]
    assert [rows[d]["finbert_positive_count"] for d in days] == [1, None] and all(rows[d]["is_net_income"] == 5.0 for d in days)


def test_named_columns_are_those_of_the_whole_feature_set(spark):
    bars = spark.createDataFrame(
        [("A", D(2025, 2, d), 1.0 * d, 9.0, 0.5, 2.0, 5.0, 1.0, 1.5) for d in (1, 2, 4)] * 2 + [("B", D(2025, 2, 2), 1.0, 2.0, 1.0, 2.0, 5.0, 1.0, 1.5)],
        "symbol string, bar_date date, open double, high double, low double, close double, volume double, trade_count double, vwap double",
    )
    # Two statements of one release and period: the one whose first differing column is greater counts, whatever is asked for.
    rows = [("A", D(2024, 12, 31), {"Total Revenue": 5.0, "Net Income": 1.0}), ("A", D(2024, 12, 31), {"Total Revenue": 4.0, "Net Income": 2.0})]
    vintages = spark.createDataFrame([("GDP", "x", D(2025, 1, 1), D(2025, 1, 31), None, 7.0)], s.SCHEMAS["alfred_economic_data"])
    article = "news_article_id long, symbol string, news_date date, sentiment string, c double"
    scored = {p: (spark.createDataFrame([(1, "A", D(2025, 2, 1), "positive", 0.5)], article), "c") for p in s.SENTIMENT_PREFIXES}
    tables = [bars, income(spark, rows), empty(spark, "balance_sheet"), empty(spark, "cashflow"), earnings(spark, [("A", D(2025, 2, 1), 1.0, 1.0, 0.1)])]
    whole = feature_set.point_in_time_features(*tables, vintages, scored)
    assert whole.count() == 4
    for names in (["symbol", "is_net_income"], ["prediction_date", "econ_gdp", "finbert_total_articles"], ["sd_open", "is_net_margin", "split"], ["symbol"]):
        made = feature_set.point_in_time_features(*tables, vintages, scored, columns=names)
        assert sorted(made.columns) == sorted(names)
        assert sorted(map(str, made.select(names).collect())) == sorted(map(str, whole.select(names).collect()))
