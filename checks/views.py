"""The stand-in market tables in SQL, for the DuckDB side of each check."""

from __future__ import annotations

from tidemark import schemas as s

CUTOFF = "2000-07-01"

# Statement metrics as aggregates over one symbol-year of trades; the text is valid in both engines.
INCOME = {
    "Total Revenue": "CAST(sum(pc) AS DOUBLE) / 1e2",
    "Gross Profit": "CAST(sum(pc * (100 - dp)) AS DOUBLE) / 1e4",
    "Operating Income": "CAST(sum(pc * (100 - dp - tp)) AS DOUBLE) / 1e4",
    "Net Income": "CAST(sum(pc * (dp - tp)) AS DOUBLE) / 1e4",
    "EBITDA": "CAST(sum(pc * (95 - dp)) AS DOUBLE) / 1e4",
    "EBIT": "CAST(sum(pc * (90 - dp)) AS DOUBLE) / 1e4",
    "Diluted EPS": "CAST(sum(pc * (dp - tp)) AS DOUBLE) / (1e4 * CAST(sum(q) AS DOUBLE))",
    "Basic EPS": "CAST(sum(pc * dp) AS DOUBLE) / (1e4 * CAST(sum(q) AS DOUBLE))",
    "Cost Of Revenue": "CAST(sum(pc * dp) AS DOUBLE) / 1e4",
    "Operating Expense": "CAST(sum(pc * tp) AS DOUBLE) / 1e4",
    "Interest Expense": "CAST(sum(q * dp) AS DOUBLE)",
    "Tax Provision": "CAST(sum(q * tp) AS DOUBLE)",
    "Research And Development": "CASE WHEN min(q) > 1 THEN NULL ELSE CAST(sum(q) AS DOUBLE) END",
    "Selling General And Administration": "CAST(count(*) AS DOUBLE) * 1e2",
}
BALANCE = {
    "Total Assets": "CAST(sum(pc) AS DOUBLE) / 1e2",
    "Total Liabilities Net Minority Interest": "CAST(sum(pc * dp) AS DOUBLE) / 1e3",
    "Stockholders Equity": "CAST(sum(pc * (dp - 5)) AS DOUBLE) / 1e4",
    "Total Debt": "CAST(sum(q) AS DOUBLE) * 1e2",
    "Net Debt": "CAST(sum(q * (5 - tp)) AS DOUBLE)",
    "Cash Cash Equivalents And Short Term Investments": "CAST(max(pc) AS DOUBLE) / 1e2",
    "Current Assets": "CAST(sum(pc * tp) AS DOUBLE) / 1e4",
    "Current Liabilities": "CASE WHEN max(q) < 50 THEN 0e0 ELSE CAST(sum(pc * dp) AS DOUBLE) / 1e4 END",
    "Working Capital": "CAST(sum(pc * (tp - dp)) AS DOUBLE) / 1e4",
    "Goodwill And Other Intangible Assets": "CASE WHEN max(dp) < 10 THEN NULL ELSE CAST(sum(q) AS DOUBLE) END",
    "Net PPE": "CAST(min(pc) AS DOUBLE) / 1e2",
    "Inventory": "CAST(sum(q * q) AS DOUBLE)",
    "Accounts Receivable": "CAST(sum(q * dp) AS DOUBLE)",
    "Accounts Payable": "CAST(sum(q * tp) AS DOUBLE)",
    "Retained Earnings": "CAST(sum(pc * (dp - tp)) AS DOUBLE) / 1e3",
}
CASHFLOW = {
    "Operating Cash Flow": "CAST(sum(pc * (dp - tp)) AS DOUBLE) / 1e4",
    "Investing Cash Flow": "CAST(sum(q * (4 - dp)) AS DOUBLE)",
    "Financing Cash Flow": "CAST(sum(q * (4 - tp)) AS DOUBLE)",
    "Free Cash Flow": "CAST(sum(pc * (dp - 3)) AS DOUBLE) / 1e4",
    "Capital Expenditure": "CAST(count(*) AS DOUBLE) * -1e3",
    "Depreciation And Amortization": "CAST(max(q) AS DOUBLE)",
    "Stock Based Compensation": "CAST(min(q) AS DOUBLE)",
    "Change In Working Capital": "CAST(sum(tp - dp) AS DOUBLE)",
    "Cash Dividends Paid": "CAST(sum(tp) AS DOUBLE) * -1e0",
    "Repurchase Of Capital Stock": "CAST(sum(dp) AS DOUBLE) * -1e0",
    "Net Issuance Payments Of Debt": "CAST(sum(q * (dp - tp)) AS DOUBLE)",
    "End Cash Position": "CAST(sum(pc * tp) AS DOUBLE) / 1e3",
}
# Periods without a balance sheet or a cash flow statement: those traded in small lots.
BALANCE_FILED = "sum(q) >= 24 * count(*)"
CASHFLOW_FILED = "sum(dp) >= 4 * count(*) + count(*) / 2"

# Term lists of the two native scorers.
TERMS_A = (("a",), ("o",))
TERMS_B = (("in", "re"), ("th",))


def _metrics(metrics: dict[str, str]) -> str:
    return ", ".join(f'{expression} AS "{name}"' for name, expression in metrics.items())


def _count(text: str, term: str) -> str:
    return f"((length({text}) - length(replace({text}, '{term}', ''))) // {len(term)})"


def _scored(name: str, text: str, terms: tuple[tuple[str, ...], tuple[str, ...]], confidence: str) -> str:
    p = " + ".join(_count(text, t) for t in terms[0])
    q = " + ".join(_count(text, t) for t in terms[1])
    return f"""{name} AS (
  SELECT news_article_id, symbol, news_date, article_text,
    CASE WHEN p * 100 > q * 105 THEN 'positive' WHEN q * 100 > p * 105 THEN 'negative' ELSE 'neutral' END AS sentiment,
    0.5e0 + CAST(abs(p - q) AS DOUBLE) / CAST(2 * (p + q + 1) AS DOUBLE) AS {confidence}
  FROM (SELECT e.id AS news_article_id, e.symbol, CAST(e.created_at AS DATE) AS news_date, {text} AS article_text,
      {p} AS p, {q} AS q FROM exploded e) scored_text)"""


_HEADLINE = "concat('Headline: ', headline)"
_WITH_SUMMARY = "concat('Headline: ', headline, ' Summary: ', coalesce(summary, ''))"

_SERIES = ", ".join(f"({i}, '{name}', '{title}')" for i, (name, (_, title)) in enumerate(s.MACRO_SERIES.items()))

VIEWS: dict[str, str] = {
    "trades": """trades AS (
  SELECT concat('S', CAST(l_suppkey AS VARCHAR)) AS symbol, CAST(l_shipdate AS DATE) AS d,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS pc, CAST(round(l_discount * 100) AS BIGINT) AS dp,
    CAST(round(l_tax * 100) AS BIGINT) AS tp, CAST(l_quantity AS BIGINT) AS q
  FROM lineitem)""",
    "bars": """bars AS (
  SELECT symbol, d AS bar_date, o AS open, greatest(mx, o, c) AS high, least(mn, o, c) AS low, c AS close,
    v AS volume, trade_count, w AS vwap
  FROM (SELECT symbol, d, CAST(sum(pc * (100 - dp)) AS DOUBLE) / (1e4 * CAST(sum(q) AS DOUBLE)) AS o,
      CAST(sum(pc * (100 - tp)) AS DOUBLE) / (1e4 * CAST(sum(q) AS DOUBLE)) AS c,
      max(CAST(pc AS DOUBLE) / (1e2 * CAST(q AS DOUBLE))) AS mx,
      min(CAST(pc AS DOUBLE) / (1e2 * CAST(q AS DOUBLE))) AS mn,
      CAST(sum(q) AS DOUBLE) AS v, CAST(sum(pc) AS DOUBLE) / (1e2 * CAST(sum(q) AS DOUBLE)) AS w,
      CAST(count(*) AS DOUBLE) AS trade_count
    FROM trades GROUP BY symbol, d) b)""",
    "earnings": """earnings AS (
  SELECT symbol, CAST(last_day(max(d)) AS DATE) + CAST(30 + sum(q) % 15 AS INT) AS release_date,
    CAST(sum(pc) AS DOUBLE) * 0.95e0 / 1e8 AS "EPS Estimate", CAST(sum(pc * (100 - dp)) AS DOUBLE) / 1e10 AS "Reported EPS",
    CASE WHEN count(*) < 15 THEN NULL ELSE CAST(sum(pc * (5 - dp)) AS DOUBLE) / (0.95e0 * CAST(sum(pc) AS DOUBLE)) END AS "Surprise(%)"
  FROM trades GROUP BY symbol, year(d), quarter(d))""",
    "income": f"""income AS (
  SELECT symbol, make_date(year(d), 12, 31) AS fiscal_period_end, {_metrics(INCOME)}
  FROM trades GROUP BY symbol, year(d))""",
    "balance": f"""balance AS (
  SELECT symbol, make_date(year(d), 12, 31) AS fiscal_period_end, {_metrics(BALANCE)}
  FROM trades GROUP BY symbol, year(d) HAVING {BALANCE_FILED})""",
    "cashflow": f"""cashflow AS (
  SELECT symbol, make_date(year(d), 12, 31) AS fiscal_period_end, {_metrics(CASHFLOW)}
  FROM trades GROUP BY symbol, year(d) HAVING {CASHFLOW_FILED})""",
    "vintages": f"""vintages AS (
  SELECT o.series_id, o.series_name, o.obs_date AS date,
    CAST(last_day(o.obs_date) AS DATE) + CAST(20 + 30 * v.v AS INT) AS realtime_start,
    CAST(last_day(o.obs_date) AS DATE) + CAST(49 + 30 * v.v AS INT) AS realtime_end,
    CASE WHEN o.m + v.v = 11 THEN NULL ELSE CAST(o.n * (100 + v.v) AS DOUBLE) / 1e2 END AS value
  FROM (SELECT ids.name AS series_id, ids.title AS series_name,
      make_date(year(o_orderdate), month(o_orderdate), 1) AS obs_date,
      max(month(o_orderdate)) AS m, count(*) AS n
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN (VALUES {_SERIES}) AS ids(i, name, title) ON ids.i = c_nationkey
    GROUP BY 1, 2, 3) o
  CROSS JOIN (VALUES (0), (1), (2)) AS v(v))""",
    "news": """news AS (
  SELECT d.doc_id AS id, split_part(d.text, chr(10), 1) AS headline,
    CASE WHEN contains(d.text, chr(10)) THEN substr(d.text, strpos(d.text, chr(10)) + 1) END AS summary,
    concat('desk-', d.lang) AS author, o.o_orderdate + d.n_chars * INTERVAL '1' SECOND AS created_at,
    o.o_orderdate + 2 * d.n_chars * INTERVAL '1' SECOND AS updated_at,
    concat('https://news.example/', CAST(d.doc_id AS VARCHAR)) AS url, coalesce(m.symbols, '') AS symbols, d.source
  FROM documents d JOIN orders o ON o.o_orderkey = d.doc_id
  LEFT JOIN (SELECT l_orderkey, string_agg(symbol, ',' ORDER BY symbol) AS symbols
    FROM (SELECT DISTINCT l_orderkey, concat('S', CAST(l_suppkey AS VARCHAR)) AS symbol FROM lineitem) x
    GROUP BY l_orderkey) m ON m.l_orderkey = d.doc_id)""",
    "exploded": """exploded AS (
  SELECT * FROM (SELECT news.*, unnest(string_split(symbols, ',')) AS symbol FROM news) u WHERE symbol <> '')""",
    "scored": _scored("scored", _HEADLINE, TERMS_A, "confidence"),
    "scored_full": _scored("scored_full", _WITH_SUMMARY, TERMS_B, "sentiment_confidence"),
    "moves": """moves AS (
  SELECT symbol, bar_date - 1 AS news_date, (close - open) / NULLIF(open, 0) AS percent_daily_price_change FROM bars)""",
    "scored_moves": """scored_moves AS (
  SELECT s.*, m.percent_daily_price_change FROM scored s JOIN moves m USING (symbol, news_date))""",
    "preds": f"""preds AS (
  SELECT symbol, CASE WHEN target_date < DATE '{CUTOFF}' THEN 'train' ELSE 'test' END AS split,
    bar_date AS prediction_date, target_date, (fclose - close) / close AS actual_return,
    (close - open) / open AS predicted_return, close, fclose AS actual_price,
    close * (1 + (close - open) / open) AS predicted_price
  FROM (SELECT b.*, lead(close, 5) OVER (PARTITION BY symbol ORDER BY bar_date) AS fclose,
      lead(bar_date, 5) OVER (PARTITION BY symbol ORDER BY bar_date) AS target_date FROM bars b) t
  WHERE fclose IS NOT NULL)""",
}

_NEEDS = {
    "bars": ["trades"],
    "earnings": ["trades"],
    "income": ["trades"],
    "balance": ["trades"],
    "cashflow": ["trades"],
    "exploded": ["news"],
    "scored": ["exploded"],
    "scored_full": ["exploded"],
    "moves": ["bars"],
    "scored_moves": ["scored", "moves"],
    "preds": ["bars"],
}


def with_views(names: str, query: str, extra: str = "", recursive: bool = False) -> str:
    """``query`` with the named views (and what they need) in front; ``extra`` adds further CTEs."""
    wanted: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, []):
            need(other)
        if name not in wanted:
            wanted.append(name)

    for name in names.split():
        need(name)
    parts = [VIEWS[name] for name in wanted] + ([extra] if extra else [])
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + query
