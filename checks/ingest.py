"""Sources, sinks and load plans."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import standin as t
from checks.registry import check
from checks.views import INCOME, with_views
from tidemark import schemas as s
from tidemark.functions.text import clean_columns, clean_name, symbol_list
from tidemark.plans import ingest
from tidemark.session import stage_path, stage_table
from tidemark.sources import payloads as p
from tidemark.sources import sinks, tables


def _vendor_income(spark, sf_dir):
    """Vendor layout: one row per symbol and metric, one column per fiscal period; and the period names."""
    income = t.income(spark, sf_dir)
    long = income.unpivot(["symbol", "fiscal_period_end"], [f"`{c}`" for c in INCOME], "metric", "value")
    period = F.date_format("fiscal_period_end", "yyyy-MM-dd")
    # A handful of fiscal years: the column names of the layout.
    periods = sorted(r[0] for r in income.select(period).distinct().collect())
    wide = long.withColumn("_p", period).groupBy("symbol", "metric").pivot("_p", periods).agg(F.first("value"))
    return wide, periods


@check("statement_transpose", with_views("income", "SELECT * FROM income"))
def statement_transpose(spark, sf_dir):
    vendor, periods = _vendor_income(spark, sf_dir)
    return ingest.load_statements({"income": vendor}, periods, {"income": list(INCOME)})["income"]


def _payloads(spark, sf_dir):
    """One JSON page per series and observation date; unreadable values where an October value is missing."""
    missing = F.when(F.month("date") == 10, "n/a").otherwise(".")
    observation = F.struct(
        F.col("date").cast("string").alias("date"),
        F.col("realtime_start").cast("string").alias("realtime_start"),
        F.col("realtime_end").cast("string").alias("realtime_end"),
        F.coalesce(F.col("value").cast("string"), missing).alias("value"),
    )
    pages = t.vintages(spark, sf_dir).groupBy("series_id", "series_name", "date").agg(
        F.collect_list(observation).alias("observations")
    )
    return pages.select("series_id", "series_name", F.to_json(F.struct("observations")).alias("payload"))


_READABLE = "readable AS (SELECT * FROM vintages WHERE NOT (value IS NULL AND month(date) = 10))"


@check(
    "json_observations",
    with_views(
        "vintages",
        "SELECT series_id, series_name, date, realtime_start, realtime_end, value FROM readable",
        _READABLE,
    ),
)
def json_observations(spark, sf_dir):
    return p.json_observations(_payloads(spark, sf_dir), "payload")


@check(
    "macro_store_first_release",
    with_views(
        "vintages",
        """SELECT series_id, date, min(series_name) AS series_name, min(realtime_start) AS realtime_start,
             min(realtime_end) AS realtime_end, arg_min(value, realtime_start) FILTER (WHERE value IS NOT NULL) AS value
           FROM readable GROUP BY series_id, date""",
        _READABLE,
    ),
)
def macro_store_first_release(spark, sf_dir):
    return ingest.load_macro(_payloads(spark, sf_dir))["first_release"]


@check(
    "html_extract",
    r"""SELECT page_id, CAST(pos - 1 AS INT) AS pos, trim(regexp_replace(items[pos], '<[^>]+>', '', 'g')) AS text
        FROM (SELECT page_id, items, unnest(range(1, len(items) + 1)) AS pos
          FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<ul>(.*?)</ul>', 1), '(?s)<li>(.*?)</li>', 1) AS items
            FROM pages) x) y""",
)
def html_extract(spark, sf_dir):
    return p.html_elements(t.table(spark, sf_dir, "pages"), "html", "ul", "li", ["page_id"])


@check(
    "html_table_column",
    """SELECT s_nationkey AS nation, CAST(row_number() OVER (PARTITION BY s_nationkey, s_suppkey // 1000 ORDER BY s_suppkey) - 1 AS INT) AS pos,
         concat('S.', CAST(s_suppkey AS VARCHAR)) AS "Symbol" FROM supplier""",
)
def html_table_column(spark, sf_dir):
    """A listing page per nation and thousand suppliers, with the symbols in a linked second column."""
    row = F.concat(
        F.lit("<tr class='r'><td>"),
        F.col("s_name"),
        F.lit("</td>\n<td><a href='#'>S."),
        F.col("s_suppkey").cast("string"),
        F.lit("</a></td></tr>"),
    )
    listed = t.table(spark, sf_dir, "supplier").groupBy(
        F.col("s_nationkey").alias("nation"), F.floor(F.col("s_suppkey") / 1000).alias("page")
    ).agg(F.array_sort(F.collect_list(F.struct("s_suppkey", row.alias("row")))).alias("rows"))
    html = F.concat(
        F.lit("<html><p>intro</p><table id=a><tr><th>Name</th><th>Symbol</th></tr>"),
        F.array_join(F.transform("rows", lambda x: x["row"]), ""),
        F.lit("</table><table><tr><th>Symbol</th></tr><tr><td>no</td></tr></table></html>"),
    )
    return p.html_table_column(listed.withColumn("html", html), "html", "Symbol", ["nation"])


def _holdings(spark, sf_dir):
    """Holdings files of at most a thousand suppliers, each with a preamble in front of its header."""
    line = F.concat_ws(
        ",",
        F.concat(F.lit('"'), F.replace("s_name", F.lit("#"), F.lit(", ")), F.lit('"')),
        F.col("s_suppkey").cast("string"),
        F.col("s_acctbal").cast("string"),
    )
    body = t.table(spark, sf_dir, "supplier").groupBy(F.floor(F.col("s_suppkey") / 1000).alias("file")).agg(
        F.array_sort(F.collect_list(F.struct("s_suppkey", line.alias("line")))).alias("lines")
    )
    content = F.concat(
        F.lit("Fund Holdings as of,today\nInception,2000\n\nTicker,Key,Balance\n"),
        F.array_join(F.transform("lines", lambda x: x["line"]), "\n"),
        F.lit("\n\n"),
    )
    return body.select("file", content.alias("content"))


_HOLDING = T.StructType(
    [
        T.StructField("Ticker", T.StringType()),
        T.StructField("Key", T.LongType()),
        T.StructField("Balance", T.DoubleType()),
    ]
)


@check(
    "preamble_csv",
    """SELECT s_suppkey // 1000 AS file, CAST(row_number() OVER (PARTITION BY s_suppkey // 1000 ORDER BY s_suppkey) - 1 AS INT) AS pos,
         replace(s_name, '#', ', ') AS "Ticker", s_suppkey AS "Key", s_acctbal AS "Balance" FROM supplier""",
)
def preamble_csv(spark, sf_dir):
    return p.preamble_csv(_holdings(spark, sf_dir), "content", "Ticker,", _HOLDING, ["file"])


@check(
    "symbol_universe",
    r"""SELECT DISTINCT symbol FROM (
          SELECT replace(trim(regexp_replace(unnest(regexp_extract_all(regexp_extract(html, '(?s)<ul>(.*?)</ul>', 1),
            '(?s)<li>(.*?)</li>', 1)), '<[^>]+>', '', 'g')), '.', '-') AS symbol FROM pages
          UNION ALL SELECT word FROM (SELECT trim(unnest(string_split(p_name, ' '))) AS word FROM part) w
            WHERE regexp_matches(word, '^\pL{1,5}$')) x
        WHERE symbol <> ''""",
)
def symbol_universe(spark, sf_dir):
    """Listed names from pages, holdings from the words of part names."""
    listed = p.html_elements(t.table(spark, sf_dir, "pages"), "html", "ul", "li", ["page_id"])
    words = t.table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("symbol"))
    return ingest.symbol_universe(listed.withColumnRenamed("text", "symbol"), words)


@check(
    "load_manifest",
    with_views(
        "bars income balance cashflow earnings news",
        " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, count(*) AS rows, count(DISTINCT symbol) AS keys FROM {n}"
            for n in ("bars", "income", "balance", "cashflow", "earnings")
        )
        + " UNION ALL SELECT 'news', count(*), CAST(NULL AS BIGINT) FROM news",
    ),
)
def load_manifest(spark, sf_dir):
    views = {n: getattr(t, n)(spark, sf_dir) for n in ("bars", "income", "balance", "cashflow", "earnings", "news")}
    return sinks.load_manifest(views)


_EVENT = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("value", T.DoubleType())]
)


def _event_lines(spark, sf_dir):
    """Events as JSON lines; lines of error events are cut off."""
    whole = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), "value"))
    cut = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit(', "kind": "err'))
    line = F.when(F.col("event_type") == "error", cut).otherwise(whole)
    return t.table(spark, sf_dir, "events").select("event_id", line.alias("line"))


@check(
    "quarantine",
    """SELECT event_id, event_id AS id, event_type AS kind, value, CAST(NULL AS VARCHAR) AS rejected
       FROM events WHERE event_type <> 'error'
       UNION ALL SELECT event_id, NULL, NULL, NULL, concat('{"id": ', CAST(event_id AS VARCHAR), ', "kind": "err')
       FROM events WHERE event_type = 'error'""",
)
def quarantine(spark, sf_dir):
    good, bad = p.json_rows(_event_lines(spark, sf_dir), "line", _EVENT, ["event_id"])
    return tables.union_frames([good, bad.withColumnRenamed("line", "rejected")])


@check(
    "event_properties",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def event_properties(spark, sf_dir):
    good, _ = p.json_rows(
        t.table(spark, sf_dir, "events"), "props", T.StructType([T.StructField("k", T.LongType())]), ["event_id"]
    )
    return good


_CLEAN_INCOME = ", ".join(f'"{c}" AS {clean_name(c)}' for c in INCOME)


@check(
    "name_cleanup",
    with_views(
        "income",
        f"""SELECT i.symbol, i.fiscal_period_end AS fiscalperiodend, {_CLEAN_INCOME} FROM income i""",
    ),
)
def name_cleanup(spark, sf_dir):
    return clean_columns(t.income(spark, sf_dir))


@check(
    "name_cleanup_symbols",
    with_views(
        "earnings",
        """SELECT symbol, release_date AS release_date, "EPS Estimate" AS eps_estimate, "Reported EPS" AS reported_eps,
             "Surprise(%)" AS surprise FROM earnings""",
    ),
)
def name_cleanup_symbols(spark, sf_dir):
    made = clean_columns(t.earnings(spark, sf_dir).withColumnRenamed("release_date", "release date"))
    return made


@check(
    "news_flatten",
    with_views(
        "news",
        "SELECT id, headline, summary, author, created_at, updated_at, url, symbols, source FROM news",
    ),
)
def news_flatten(spark, sf_dir):
    """Article objects with a symbol array, fetched twice, to one flat row each."""
    articles = t.news(spark, sf_dir).withColumn(
        "symbols", F.when(F.col("symbols") != "", symbol_list(F.col("symbols")))
    )
    return ingest.load_news([articles, articles])


@check("bars_load", with_views("bars", "SELECT * FROM bars"))
def bars_load(spark, sf_dir):
    """Bars in two frames that overlap in one year."""
    bars = t.bars(spark, sf_dir)
    return ingest.load_bars([bars.filter(F.year("bar_date") <= 1999), bars.filter(F.year("bar_date") >= 1999)])


@check(
    "union_frames",
    with_views(
        "income cashflow",
        """SELECT symbol, fiscal_period_end, "Net Income" AS net_income, CAST(NULL AS DOUBLE) AS free_cash_flow FROM income
           UNION ALL SELECT symbol, fiscal_period_end, NULL, "Free Cash Flow" FROM cashflow""",
    ),
)
def union_frames(spark, sf_dir):
    income = t.income(spark, sf_dir).select("symbol", "fiscal_period_end", F.col("Net Income").alias("net_income"))
    flows = t.cashflow(spark, sf_dir).select(
        "symbol", "fiscal_period_end", F.col("Free Cash Flow").alias("free_cash_flow")
    )
    return tables.union_frames([income, flows])


@check(
    "csv_roundtrip",
    with_views(
        "news", "SELECT id, headline, summary, author, url, symbols, source FROM news"
    ),
)
def csv_roundtrip(spark, sf_dir):
    """Articles with line ends, quotes and commas in their texts through the CSV sink and source."""
    news = t.news(spark, sf_dir).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("created_at", "updated_at")}
    )
    path = stage_path(spark, "news-csv")
    sinks.export_csv(news.select(*[f.name for f in s.SCHEMAS["news_data"].fields]), path)
    read = tables.read_table(spark, "news_data", path, view="news_from_csv")
    return read.drop("created_at", "updated_at")


@check("stage_table_roundtrip", with_views("bars", "SELECT * FROM bars"))
def stage_table_roundtrip(spark, sf_dir):
    return stage_table(t.bars(spark, sf_dir), "bars")


@check("partitioned_table_roundtrip", with_views("bars", "SELECT *, CAST(year(bar_date) AS INT) AS bar_year FROM bars"))
def partitioned_table_roundtrip(spark, sf_dir):
    path = stage_path(spark, "bars-by-year")
    bars = t.bars(spark, sf_dir).withColumn("bar_year", F.year("bar_date"))
    sinks.write_table(bars, path, partition_by=["bar_year"], sort_by=["symbol", "bar_date"])
    return spark.read.parquet(path)


@check(
    "stored_manifest",
    with_views(
        "income cashflow",
        """SELECT 'income' AS table_name, count(*) AS rows, count(DISTINCT symbol) AS keys FROM income
           UNION ALL SELECT 'cashflow', count(*), count(DISTINCT symbol) FROM cashflow""",
    ),
)
def stored_manifest(spark, sf_dir):
    tables_ = {"income": clean_columns(t.income(spark, sf_dir)), "cashflow": clean_columns(t.cashflow(spark, sf_dir))}
    return ingest.store(tables_, stage_path(spark, "statements"))


@check(
    "sql_step",
    with_views(
        "bars",
        """SELECT symbol, min(bar_date) AS first_day, max(bar_date) AS last_day, count(*) AS bars
           FROM bars WHERE volume >= 20 GROUP BY symbol""",
    ),
)
def sql_step(spark, sf_dir):
    """A SQL text over a registered view, with a bound value."""
    tables.register(t.bars(spark, sf_dir), "stock_data")
    return tables.sql_step(
        spark,
        """SELECT symbol, min(bar_date) AS first_day, max(bar_date) AS last_day, count(*) AS bars
           FROM stock_data WHERE volume >= :least GROUP BY symbol;""",
        least=20.0,
    )


@check(
    "sorted_preview",
    with_views(
        "vintages",
        """SELECT series_id, date, realtime_start, value FROM vintages
           ORDER BY series_id, date DESC, realtime_start DESC LIMIT 30""",
    ),
)
def sorted_preview(spark, sf_dir):
    columns = t.vintages(spark, sf_dir).select("series_id", "date", "realtime_start", "value")
    return tables.preview(columns, 30, [F.asc("series_id"), F.desc("date"), F.desc("realtime_start")])


@check(
    "look_back_window",
    with_views(
        "bars",
        """SELECT symbol, bar_date, close FROM bars
           WHERE bar_date >= DATE '1999-12-31' - 365 AND bar_date <= DATE '1999-12-31'""",
    ),
)
def look_back_window(spark, sf_dir):
    bars = t.bars(spark, sf_dir).filter(ingest.since("bar_date", "1999-12-31", 365))
    return bars.select("symbol", "bar_date", "close")
