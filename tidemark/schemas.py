"""Table schemas and the column lists of the feature set.

The literals in this module are fixed values: vendor column names, the feature names derived from them, and the
macro series with their titles.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: vendor statement columns -> feature names -------------------------------------------------

INCOME_COLUMNS = {
    "Total Revenue": "is_total_revenue",
    "Gross Profit": "is_gross_profit",
    "Operating Income": "is_operating_income",
    "Net Income": "is_net_income",
    "EBITDA": "is_ebitda",
    "EBIT": "is_ebit",
    "Diluted EPS": "is_diluted_eps",
    "Basic EPS": "is_basic_eps",
    "Cost Of Revenue": "is_cost_of_revenue",
    "Operating Expense": "is_operating_expense",
    "Interest Expense": "is_interest_expense",
    "Tax Provision": "is_tax_provision",
    "Research And Development": "is_research_and_development",
    "Selling General And Administration": "is_selling_general_admin",
}
BALANCE_COLUMNS = {
    "Total Assets": "bs_total_assets",
    "Total Liabilities Net Minority Interest": "bs_total_liabilities",
    "Stockholders Equity": "bs_stockholders_equity",
    "Total Debt": "bs_total_debt",
    "Net Debt": "bs_net_debt",
    "Cash Cash Equivalents And Short Term Investments": "bs_cash_and_equivalents",
    "Current Assets": "bs_current_assets",
    "Current Liabilities": "bs_current_liabilities",
    "Working Capital": "bs_working_capital",
    "Goodwill And Other Intangible Assets": "bs_goodwill_intangibles",
    "Net PPE": "bs_net_ppe",
    "Inventory": "bs_inventory",
    "Accounts Receivable": "bs_accounts_receivable",
    "Accounts Payable": "bs_accounts_payable",
    "Retained Earnings": "bs_retained_earnings",
}
CASHFLOW_COLUMNS = {
    "Operating Cash Flow": "cf_operating_cash_flow",
    "Investing Cash Flow": "cf_investing_cash_flow",
    "Financing Cash Flow": "cf_financing_cash_flow",
    "Free Cash Flow": "cf_free_cash_flow",
    "Capital Expenditure": "cf_capital_expenditure",
    "Depreciation And Amortization": "cf_depreciation_amortization",
    "Stock Based Compensation": "cf_stock_based_compensation",
    "Change In Working Capital": "cf_change_in_working_capital",
    "Cash Dividends Paid": "cf_dividends_paid",
    "Repurchase Of Capital Stock": "cf_stock_repurchase",
    "Net Issuance Payments Of Debt": "cf_net_debt_issuance",
    "End Cash Position": "cf_end_cash_position",
}
EARNINGS_COLUMNS = {
    "EPS Estimate": "ed_eps_estimate",
    "Reported EPS": "ed_reported_eps",
    "Surprise(%)": "ed_surprise_pct",
}
# feature name: (numerator, denominator)
INCOME_RATIOS = {
    "is_gross_margin": ("is_gross_profit", "is_total_revenue"),
    "is_operating_margin": ("is_operating_income", "is_total_revenue"),
    "is_net_margin": ("is_net_income", "is_total_revenue"),
}
BALANCE_RATIOS = {
    "bs_current_ratio": ("bs_current_assets", "bs_current_liabilities"),
    "bs_debt_to_equity": ("bs_total_debt", "bs_stockholders_equity"),
}

# --- fixed values: macro series id -> (feature name, title) ---------------------------------------------------

MACRO_SERIES = {
    "FEDFUNDS": ("econ_fedfunds", "Federal Funds Effective Rate"),
    "DFF": ("econ_dff", "Federal Funds Rate (Daily)"),
    "DGS10": ("econ_dgs10", "10-Year Treasury Constant Maturity Rate"),
    "DGS2": ("econ_dgs2", "2-Year Treasury Constant Maturity Rate"),
    "T10Y2Y": ("econ_t10y2y", "10-Year Treasury Minus 2-Year Treasury (Yield Curve)"),
    "T10Y3M": ("econ_t10y3m", "10-Year Treasury Minus 3-Month Treasury"),
    "CPIAUCSL": ("econ_cpi", "Consumer Price Index (All Urban Consumers)"),
    "CPILFESL": ("econ_core_cpi", "Core CPI (Excluding Food & Energy)"),
    "PCEPI": ("econ_pce", "Personal Consumption Expenditures Price Index"),
    "PCEPILFE": ("econ_core_pce", "Core PCE Price Index"),
    "UNRATE": ("econ_unemployment", "Unemployment Rate"),
    "PAYEMS": ("econ_nonfarm_payrolls", "Total Nonfarm Payrolls"),
    "ICSA": ("econ_initial_claims", "Initial Jobless Claims (Weekly)"),
    "CCSA": ("econ_continued_claims", "Continued Claims (Insured Unemployment)"),
    "GDP": ("econ_gdp", "Gross Domestic Product"),
    "GDPC1": ("econ_real_gdp", "Real Gross Domestic Product"),
    "INDPRO": ("econ_industrial_prod", "Industrial Production Index"),
    "RSAFS": ("econ_retail_sales", "Retail Sales (Advance)"),
    "M2SL": ("econ_m2_money_supply", "M2 Money Supply"),
    "BOGMBASE": ("econ_monetary_base", "Monetary Base"),
    "HOUST": ("econ_housing_starts", "Housing Starts"),
    "PERMIT": ("econ_building_permits", "Building Permits"),
    "CSUSHPINSA": ("econ_home_price_index", "S&P/Case-Shiller U.S. Home Price Index"),
    "UMCSENT": ("econ_consumer_sentiment", "University of Michigan Consumer Sentiment"),
    "MANEMP": ("econ_manufacturing_emp", "Manufacturing Employment"),
    "DGORDER": ("econ_durable_goods", "Durable Goods Orders"),
    "BOPGSTB": ("econ_trade_balance", "Trade Balance (Goods and Services)"),
    "BAMLH0A0HYM2": ("econ_high_yield_spread", "ICE BofA High Yield Option-Adjusted Spread"),
    "VIXCLS": ("econ_vix", "CBOE Volatility Index (VIX)"),
}

# --- fixed values: feature-set columns ------------------------------------------------------------------------

KEY_COLUMNS = ["symbol", "prediction_date"]
TARGET = "percent_daily_price_change"
SPLIT = "split"
BAR_FEATURES = ["sd_open", "sd_high", "sd_low", "sd_close", "sd_volume", "sd_vwap", "sd_trade_count"]
SENTIMENT_PREFIXES = ["fingpt", "finbert"]
SENTIMENT_MEASURES = ["positive_count", "neutral_count", "negative_count", "total_articles", "avg_confidence"]

TRAIN_CUTOFF = "2025-10-24"

# --- fixed values: indicator features -------------------------------------------------------------------------

SMA_PERIODS = [5, 10, 20, 50]
EMA_SPANS = [8, 13, 21, 34]
RSI_PERIODS = [7, 14, 21]
MACD_SPANS = (12, 26, 9)
BOLLINGER_PERIODS = [10, 20]
ATR_PERIODS = [7, 14, 21]
VOLUME_PERIODS = [10, 20]
ROC_PERIODS = [5, 10, 20]
ZSCORE_PERIOD = 20
WARMUP_ROWS = 50
EPSILON = 1e-10

SEQUENCE_LENGTH = 40
PREDICTION_HORIZON = 5
MIN_EXTRA_ROWS = 30
MIN_TRAIN_ROWS = 30
MIN_TEST_ROWS = 10

# --- derived lists --------------------------------------------------------------------------------------------

INCOME_FEATURES = [*INCOME_COLUMNS.values(), *INCOME_RATIOS]
BALANCE_FEATURES = [*BALANCE_COLUMNS.values(), *BALANCE_RATIOS]
CASHFLOW_FEATURES = list(CASHFLOW_COLUMNS.values())
EARNINGS_FEATURES = list(EARNINGS_COLUMNS.values())
FINANCIAL_FEATURES = [
    "fin_days_since_release",
    *EARNINGS_FEATURES,
    *INCOME_FEATURES,
    *BALANCE_FEATURES,
    *CASHFLOW_FEATURES,
]
MACRO_FEATURES = [feature for feature, _ in MACRO_SERIES.values()]
SENTIMENT_FEATURES = [f"{p}_{m}" for p in SENTIMENT_PREFIXES for m in SENTIMENT_MEASURES]
MODEL_FEATURES = [*FINANCIAL_FEATURES, *MACRO_FEATURES, *SENTIMENT_FEATURES]
FEATURE_SET_COLUMNS = [*KEY_COLUMNS, TARGET, *BAR_FEATURES, *MODEL_FEATURES, SPLIT]

INDICATOR_FEATURES = [
    "price_range",
    "body_size",
    "upper_shadow",
    "lower_shadow",
    *[f"sma_{n}" for n in SMA_PERIODS],
    *[f"ema_{n}" for n in EMA_SPANS],
    *[f"rsi_{n}" for n in RSI_PERIODS],
    "macd",
    "macd_signal",
    "macd_hist",
    *[f"bb_{kind}_{n}" for n in BOLLINGER_PERIODS for kind in ("pos", "width")],
    *[f"atr_{n}" for n in ATR_PERIODS],
    *[f"volume_sma_{n}" for n in VOLUME_PERIODS],
    "vwap_diff",
    *[f"roc_{n}" for n in ROC_PERIODS],
    "close_zscore",
]


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


def _statement(columns: dict[str, str]) -> T.StructType:
    head = [T.StructField("symbol", T.StringType()), T.StructField("fiscal_period_end", T.DateType())]
    return T.StructType(head + [T.StructField(name, T.DoubleType()) for name in columns])


_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
_DAY, _TS = T.DateType(), T.TimestampType()

SCHEMAS: dict[str, T.StructType] = {
    "tickers": _table(symbol=_S),
    "stock_data": _table(
        symbol=_S, timestamp=_TS, open=_D, high=_D, low=_D, close=_D, volume=_D, trade_count=_D, vwap=_D
    ),
    "income_statement": _statement(INCOME_COLUMNS),
    "balance_sheet": _statement(BALANCE_COLUMNS),
    "cashflow": _statement(CASHFLOW_COLUMNS),
    "earnings_dates": T.StructType(
        [T.StructField("symbol", _S), T.StructField("release_date", _TS)]
        + [T.StructField(name, _D) for name in EARNINGS_COLUMNS]
    ),
    "news_data": _table(
        id=_L, headline=_S, summary=_S, author=_S, created_at=_TS, updated_at=_TS, url=_S, symbols=_S, source=_S
    ),
    "alfred_economic_data": _table(
        series_id=_S, series_name=_S, date=_DAY, realtime_start=_DAY, realtime_end=_DAY, value=_D
    ),
    "finbert_news_classifications": _table(
        news_article_id=_L,
        symbol=_S,
        news_date=_DAY,
        article_text=_S,
        percent_daily_price_change=_D,
        sentiment=_S,
        confidence=_D,
    ),
    "fingpt_sentiment_checkpoint": _table(
        news_article_id=_L,
        symbol=_S,
        news_date=_DAY,
        article_text=_S,
        percent_daily_price_change=_D,
        sentiment=_S,
        sentiment_confidence=_D,
    ),
    "fingpt_news_classifications": _table(
        news_article_id=_L,
        symbol=_S,
        news_date=_DAY,
        article_text=_S,
        percent_daily_price_change=_D,
        sentiment=_S,
        sentiment_confidence=_D,
        predicted_direction=_S,
        prediction_confidence=_D,
    ),
    "lstm_predictions": _table(
        symbol=_S,
        split=_S,
        prediction_date=_TS,
        target_date=_TS,
        actual_return=_D,
        predicted_return=_D,
        actual_direction=_I,
        predicted_direction=_I,
        direction_correct=_I,
        actual_price=_D,
        predicted_price=_D,
        symbol_test_accuracy=_D,
    ),
}
