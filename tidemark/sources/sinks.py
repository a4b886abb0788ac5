"""Table sinks. Writes are parallel and go to fresh paths; an existing path is an error."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.tables import union_frames


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), file_format: str = "parquet"
) -> None:
    """Parquet (default) or another format; ``sort_by`` orders rows inside files so that readers can skip row groups."""
    out = df.sortWithinPartitions(*partition_by, *sort_by) if sort_by else df
    writer = out.write.mode("errorifexists").format(file_format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def export_csv(df: DataFrame, path: str, order: Sequence[str | Column] = ()) -> None:
    """CSV with header, readable by :func:`tidemark.sources.tables.read_csv`; null and an empty text stay apart.

    With ``order`` the part files are ranges of a total order.
    """
    out = df.orderBy(*order) if order else df
    (
        out.write.mode("errorifexists")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", '""')
        .csv(path)
    )


def load_manifest(tables: Mapping[str, DataFrame], key: str = "symbol") -> DataFrame:
    """Rows and distinct keys per loaded table (null where a table has no such key)."""
    rows = []
    for name, df in tables.items():
        keys = F.countDistinct(key) if key in df.columns else F.lit(None).cast("long")
        rows.append(
            df.agg(F.count(F.lit(1)).alias("rows"), keys.alias("keys")).select(F.lit(name).alias("table_name"), "rows", "keys")
        )
    return union_frames(rows)
