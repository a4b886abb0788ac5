"""CSV and parquet tables with declared schemas, SQL steps and previews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as s
from tidemark.functions.text import clean_columns
from tidemark.session import stage_table

CORRUPT = "_corrupt_record"

# Tables whose quoted cells may hold line ends. Such files cannot be split, so large ones should come as many files.
MULTI_LINE_TABLES = {
    "news_data",
    "finbert_news_classifications",
    "fingpt_sentiment_checkpoint",
    "fingpt_news_classifications",
}


# Stands for what lies between two separators; with the default, an empty text in quotes would become null as well.
_NO_VALUE = "\u0001"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multi_line: bool = False,
    clean_names: bool = False,
    view: str | None = None,
) -> DataFrame:
    """CSV with header and ``"`` as quote and escape; nothing is null, ``""`` an empty text. The schema is given, so no pass is spent on inference."""
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", _NO_VALUE)
        .option("multiLine", multi_line)
        .csv(path)
    )
    if clean_names:
        df = clean_columns(df)
    return register(df, view) if view else df


def read_table(spark: SparkSession, name: str, path: str, view: str | None = None) -> DataFrame:
    """A known table by name, registered under that name (or ``view``)."""
    return read_csv(spark, path, s.SCHEMAS[name], name in MULTI_LINE_TABLES, view=view or name)


def read_csv_quarantined(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their text). A bad row or file part does not stop the load.

    The parsed rows are staged once: a reader that needs only some columns would otherwise not parse the others, and
    so not notice that they are broken.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    read = (
        spark.read.schema(wide)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    parsed = stage_table(read, "parsed-csv")
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), parsed.filter(F.col(CORRUPT).isNotNull())


def register(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def sql_step(spark: SparkSession, text: str, **values) -> DataFrame:
    """Run a SQL text over registered views; ``:name`` places are bound to ``values``."""
    return spark.sql(text.rstrip().rstrip(";"), args=values or None)


def sql_file(spark: SparkSession, path: str, **values) -> DataFrame:
    """Run the SQL step held in a file."""
    with open(path, encoding="utf-8") as file:
        return sql_step(spark, file.read(), **values)


def preview(df: DataFrame, rows: int = 20, order: Sequence = ()) -> DataFrame:
    """First rows, in a stated order if one is given."""
    return (df.orderBy(*order) if order else df).limit(rows)


def show_sql(spark: SparkSession, path: str, rows: int = 20, echo: bool = False, **values) -> None:
    """Run a SQL file and print its first rows, optionally with the text."""
    if echo:
        with open(path, encoding="utf-8") as file:
            print(file.read())
    sql_file(spark, path, **values).show(rows, truncate=False)


def with_key(df: DataFrame, key: str, value: str, renames: dict[str, str] | None = None) -> DataFrame:
    """Constant key column in front, with optional renames."""
    return df.withColumnsRenamed(renames or {}).select(F.lit(value).alias(key), "*")


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column missing in a frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def literal_table(spark: SparkSession, values: Sequence[str], column: str = "symbol") -> DataFrame:
    """Small fixed list as a table."""
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def pick_columns(df: DataFrame, first: Sequence[str] = (), without: Sequence[str] = ()) -> DataFrame:
    """Drop columns if present and move some to the front."""
    rest = [c for c in df.columns if c not in first and c not in without]
    return df.select(*[f"`{c}`" for c in [*first, *rest]])
