"""CSV files of any size whose table begins after a preamble, read line by line in splits.

The header is found per file, and cells go by the names in it, so files may differ in preamble, order of columns and columns.
A file is never held whole: a line is known by its split and its place there, and counts per split give its number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import strip
from tidemark.session import stage_table

REJECTED = "file string, line long, text string, reason string"


def _cell_count(line: Column) -> Column:
    """Cells of a line, null where a quote is left open."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.when(~bare.contains('"'), F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1)


def _cells(line: Column, width: int) -> Column:
    """A line as an array of ``width`` texts; cells it does not have are null."""
    names = [f"c{i}" for i in range(width)]
    parsed = F.from_csv(line, ", ".join(f"{n} string" for n in names), {"quote": '"', "escape": '"', "maxColumns": str(width + 1)})
    return F.array(*[parsed[n] for n in names])


def _numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, line, text``: every line with its number in the file, from 1."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.regexp_replace("value", "^\ufeff|\r$", "").alias("text"),
    )
    # Written once: places must be the same for all who read them.
    lines = stage_table(raw, "lines")
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("start"))
    return lines.join(starts, ["file", "block"]).select("file", (F.col("start") + F.col("at")).alias("line"), "text")


def read_preamble_csv(
    spark: SparkSession, path: str | list[str], header_prefix: str, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): the tables of all files as ``file, line`` and the columns of ``schema``, and what is not part of one.

    The header is the first line that starts with ``header_prefix``; blank lines behind it are skipped. An empty cell and a
    column that a file does not have are null. Rejected, with file, line, text and reason: lines with another number of cells than
    the header or an open quote ("cells"), cells that are not of the column's type ("value"), and files without a header
    ("header", one row per file without line and text). Cells hold no line ends. An empty file has no header and no lines, so it
    leaves no row.
    """
    numbered = stage_table(_numbered_lines(spark, path), "numbered-lines")
    headers = numbered.where(F.startswith("text", F.lit(header_prefix))).groupBy("file").agg(
        F.min(F.struct("line", "text")).alias("_header")
    )
    headers = stage_table(headers, "headers")
    width = headers.agg(F.max(F.size(F.split("_header.text", ",")))).first()[0] or 1
    headers = headers.select(
        "file", F.col("_header.line").alias("_from"), _cell_count(F.col("_header.text")).alias("_width"),
        F.transform(_cells(F.col("_header.text"), width), strip).alias("_names"),
    )
    body = numbered.join(headers, "file").where((F.col("line") > F.col("_from")) & (strip(F.col("text")) != ""))
    body = body.withColumns({"_cells": _cells(F.col("text"), width), "_whole": F.equal_null(_cell_count(F.col("text")), F.col("_width"))})

    def cell(name: str) -> Column:
        place = F.array_position("_names", F.lit(name)).cast("int")
        return F.when(place > 0, F.get("_cells", place - 1))

    texts = {f"_text_{f.name}": cell(f.name) for f in schema.fields}
    values = {f"_value_{f.name}": F.when(F.col(f"_text_{f.name}") != "", F.col(f"_text_{f.name}").try_cast(f.dataType)) for f in schema.fields}
    parsed = body.withColumns(texts).withColumns(values)
    wrong = F.lit(False)
    for f in schema.fields:
        text = F.coalesce(F.col(f"_text_{f.name}"), F.lit(""))
        wrong = wrong | ((text != "") & F.col(f"_value_{f.name}").isNull())
    reason = F.when(~F.col("_whole"), "cells").when(wrong, "value")
    parsed = parsed.withColumn("reason", reason)
    good = parsed.where(F.col("reason").isNull()).select(
        "file", "line", *[F.col(f"_value_{f.name}").alias(f.name) for f in schema.fields]
    )
    bad = parsed.where(F.col("reason").isNotNull()).select("file", "line", "text", "reason")
    headless = numbered.select("file").distinct().join(headers, "file", "left_anti").select(
        "file", F.lit(None).cast("long").alias("line"), F.lit(None).cast("string").alias("text"), F.lit("header").alias("reason")
    )
    return good, bad.unionByName(headless)
