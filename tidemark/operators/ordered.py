"""Cumulative sums and exact quantiles over a total order, without sorting everything into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import null_safe_join
from tidemark.session import stage_table

BUCKET_ROWS = 100_000


def bucket_count(df: DataFrame, rows_per_bucket: int = BUCKET_ROWS) -> int:
    """Range buckets for a staged table: as many as its rows ask for, and one per shuffle partition at least."""
    wanted = -(-df.count() // rows_per_bucket)
    return max(wanted, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def order_buckets(df: DataFrame, value: str, buckets: int | None = None, column: str = "_bucket") -> DataFrame:
    """Add a range bucket of a double column; buckets hold about the same number of rows.

    The split points are approximate quantiles: a list of less than ``buckets`` numbers on the driver. Any split
    points give right results, they only even out the work. Equal values share a bucket.
    """
    buckets = buckets or bucket_count(df)
    marks = [i / buckets for i in range(1, buckets)]
    inner = sorted({float(x) for x in df.approxQuantile(value, marks, 1.0 / (4 * buckets))})
    splits = [float("-inf"), *inner, float("inf")]
    if len(splits) < 3:
        return df.withColumn(column, F.lit(0))
    placed = Bucketizer(splits=splits, inputCol=value, outputCol=column, handleInvalid="keep").transform(df)
    return placed.withColumn(column, F.col(column).cast("int"))


def ordered_places(df: DataFrame, order: Sequence[Column | str], place: str = "place") -> DataFrame:
    """Add the 1-based place of each row in a total order of all rows.

    A distributed sort into ranges, written once; counts per range give each range's start, and inside a range rows are
    numbered as they lie. No window holds rows.
    """
    ordered = df.orderBy(*order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    ordered = stage_table(ordered, "ordered")
    parts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy().orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = parts.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_start"))
    placed = ordered.join(starts, "_part").withColumn(place, F.col("_start") + F.col("_at"))
    return placed.drop("_part", "_at", "_start")


def cumulative(
    df: DataFrame,
    order: str,
    sums: Mapping[str, str],
    by: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Running sums ``{new column: summed column}`` in ``order``; the order column must be unique per ``by`` group.

    Sums per range bucket are pre-aggregated, their running total (one row per group and bucket) is each bucket's
    start, and the running sum itself stays inside a bucket.
    """
    keys = list(by)
    placed = order_buckets(df, order, buckets)
    totals = placed.groupBy(*keys, "_bucket").agg(*[F.sum(c).alias(f"_total_{n}") for n, c in sums.items()])

    def direction(column: str) -> Column:
        return F.col(column).desc() if descending else F.col(column).asc()

    before = Window.partitionBy(*keys).orderBy(direction("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *keys,
        "_bucket",
        *[F.coalesce(F.sum(f"_total_{n}").over(before), F.lit(0)).alias(f"_start_{n}") for n in sums],
    )
    inside = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(direction(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = {n: F.col(f"_start_{n}") + F.sum(c).over(inside) for n, c in sums.items()}
    return null_safe_join(placed, starts, [*keys, "_bucket"]).withColumns(running).drop("_bucket", *[f"_start_{n}" for n in sums])


def value_counts_table(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "value-counts") -> DataFrame:
    """(by, value, n) for non-null values, written to the shared folder because several passes read it."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    return stage_table(counts, name)


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles (linear interpolation between neighbours) per group, with the group's row count.

    Works on distinct values with their counts and cumulative ranks, so a group of any size is spread over tasks.
    For a single-pass approximation use ``percentile_approx``.
    """
    keys = list(by)
    counts = value_counts_table(df.withColumn(value, F.col(value).cast("double")), value, keys)
    ranked = cumulative(counts, value, {"_upto": "n"}, keys)
    sizes = counts.groupBy(*keys).agg(F.sum("n").alias("rows"))
    joined = null_safe_join(ranked, sizes, keys) if keys else ranked.withColumn("rows", sizes.select("rows").scalar())
    picks = []
    for name, p in probabilities.items():
        place = F.lit(float(p)) * (F.col("rows") - 1)
        for side, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            covers = (F.col("_upto") - F.col("n") <= rank) & (rank < F.col("_upto"))
            picks.append(F.max(F.when(covers, F.col(value))).alias(f"_{side}_{name}"))
    found = joined.groupBy(*keys).agg(F.max("rows").alias("rows"), *picks)
    values = []
    for name, p in probabilities.items():
        place = F.lit(float(p)) * (F.col("rows") - 1)
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        values.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return found.select(*keys, "rows", *values)
