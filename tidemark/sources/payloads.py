"""Vendor payloads held in a text column: JSON observations, HTML lists and tables, CSV files with a preamble.

Each payload is a row, so files and pages are spread over tasks and everything is parsed by built-in functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import is_missing_number, parse_number, strip
from tidemark.sources.tables import CORRUPT

_TEXT_FIELDS = ["date", "realtime_start", "realtime_end", "value"]
_OBSERVATIONS = T.StructType(
    [
        T.StructField(
            "observations",
            T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in _TEXT_FIELDS])),
        )
    ]
)


def json_observations(payloads: DataFrame, payload: str, keep: Sequence[str] = ("series_id", "series_name")) -> DataFrame:
    """One row per observation of a ``{"observations": [...]}`` payload.

    ``.``, the empty text and null are missing values; a value that is neither missing nor a number drops its row.
    """
    parsed = payloads.select(*keep, F.explode(F.from_json(payload, _OBSERVATIONS)["observations"]).alias("_o"))
    value = F.col("_o.value")
    typed = parsed.select(
        *keep,
        *[F.col(f"_o.{c}").try_cast("date").alias(c) for c in _TEXT_FIELDS[:3]],
        parse_number(value).alias("value"),
        is_missing_number(value).alias("_missing"),
    )
    return typed.filter(F.col("value").isNotNull() | F.col("_missing")).drop("_missing")


def json_rows(df: DataFrame, text: str, schema: T.StructType, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Parse one JSON object per row: (good rows, rejected rows with their text)."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = df.select(
        *keep, text, F.from_json(text, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("_r")
    )
    bad = F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull()
    good = parsed.filter(~bad).select(*keep, *[F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields])
    return good, parsed.filter(bad).select(*keep, text)


def _inner_texts(fragments: Column) -> Column:
    return F.transform(fragments, lambda x: strip(F.regexp_replace(x, "<[^>]+>", "")))


def html_elements(pages: DataFrame, html: str, container: str, item: str, keep: Sequence[str]) -> DataFrame:
    """Texts of the ``item`` elements in the first ``container`` element: (keep, pos, text)."""
    first = F.regexp_extract(html, rf"(?is)<{container}(?:\s[^>]*)?>(.*?)</{container}>", 1)
    items = F.regexp_extract_all(first, F.lit(rf"(?is)<{item}(?:\s[^>]*)?>(.*?)</{item}>"), F.lit(1))
    return pages.select(*keep, F.posexplode(_inner_texts(items)).alias("pos", "text"))


def html_table_column(pages: DataFrame, html: str, column: str, keep: Sequence[str]) -> DataFrame:
    """One named column of the first table of a page: (keep, pos, <column>); pages without it give no row."""
    table = F.regexp_extract(html, r"(?is)<table(?:\s[^>]*)?>(.*?)</table>", 1)
    rows = F.regexp_extract_all(table, F.lit(r"(?is)<tr(?:\s[^>]*)?>(.*?)</tr>"), F.lit(1))
    cell = F.lit(r"(?is)<t[hd](?:\s[^>]*)?>(.*?)</t[hd]>")
    cells = F.transform(rows, lambda r: _inner_texts(F.regexp_extract_all(r, cell, F.lit(1))))
    gridded = pages.select(*keep, cells.alias("_cells")).withColumn(
        "_at", F.array_position(F.get("_cells", F.lit(0)), column).cast("int")
    )
    body = gridded.filter(F.col("_at") > 0).select(
        *keep, "_at", F.posexplode(F.slice("_cells", F.lit(2), F.greatest(F.size("_cells") - 1, F.lit(0)))).alias("pos", "_row")
    )
    return body.select(*keep, "pos", F.get("_row", F.col("_at") - 1).alias(column))


def preamble_csv(
    files: DataFrame, text: str, header_prefix: str, schema: T.StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """Rows of CSV texts whose header line comes after a preamble: (keep, pos, schema columns).

    ``files`` has one whole file text per row (``spark.read.text(path, wholetext=True)``); files are independent, so
    a holdings list per fund or day spreads over tasks. Columns are taken in the order of ``schema``.
    """
    lines = F.split(F.regexp_replace(text, "\r", ""), "\n")
    marked = files.select(*keep, lines.alias("_lines")).withColumn(
        "_at", F.array_position(F.transform("_lines", lambda x: x.startswith(header_prefix)), True).cast("int")
    )
    body = F.slice("_lines", F.col("_at") + 1, F.greatest(F.size("_lines") - F.col("_at"), F.lit(0)))
    rows = marked.filter(F.col("_at") > 0).select(*keep, F.posexplode(body).alias("pos", "_line"))
    parsed = rows.filter(strip(F.col("_line")) != "").select(
        *keep, "pos", F.from_csv("_line", schema.simpleString()[len("struct<") : -1].replace(":", " ")).alias("_r")
    )
    return parsed.select(*keep, "pos", "_r.*")


def transpose_statement(
    vendor: DataFrame, metric: str, periods: Sequence[str], metrics: Sequence[str], by: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Metric rows with one column per period to period rows with one column per metric.

    Periods without any value are left out. The metric list is fixed, so no job looks for it.
    """
    long = vendor.unpivot([*by, metric], list(periods), "fiscal_period_end", "_value").filter(
        F.col("_value").isNotNull()
    )
    wide = long.groupBy(*by, F.to_date("fiscal_period_end").alias("fiscal_period_end")).pivot(metric, list(metrics))
    return wide.agg(F.first("_value"))
