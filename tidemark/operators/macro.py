"""Bitemporal macro series: what was published when, first releases and revisions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.operators.asof import asof_join, latest_per_key
from tidemark.operators.series import shift, with_frames


def series_features() -> dict[str, str]:
    """Series id to feature name."""
    return {series: feature for series, (feature, _) in s.MACRO_SERIES.items()}


def vintages_as_of(
    days: DataFrame, vintages: DataFrame, series: Sequence[str], on: str = "feature_date", order: str = "published"
) -> DataFrame:
    """Per day and series the value known on that day: (``on``, series_id, value, date, realtime_start).

    order  ``published``: the row published last; rows of one publication day are decided by observation date.
           ``observation``: only publications of the newest observation so far count, so a revision of an old
           observation does not replace a newer one.

    The left side is (distinct days) x (the given series): one row per day and series is the size of the result.
    """
    if order not in ("published", "observation"):
        raise ValueError(f"unknown order {order!r}")
    wanted = [F.lit(name) for name in series]
    spine = days.select(on).distinct().select(on, F.explode(F.array(*wanted)).alias("series_id"))
    known = vintages.filter(F.col("series_id").isin(*series)).select(
        "series_id", "realtime_start", "date", "realtime_end", "value"
    )
    return asof_join(
        spine,
        known,
        by=["series_id"],
        left_on=on,
        right_on="realtime_start",
        ties=["date", "realtime_end"],
        prefer=["date", "realtime_start", "realtime_end"] if order == "observation" else None,
        how="inner",
    ).select(on, "series_id", "value", "date", "realtime_start", "realtime_end")


def pivot_series(
    known: DataFrame, on: str = "feature_date", columns: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per day, one column per series. The fixed list spares the job that would look for the values."""
    names = dict(columns) if columns is not None else series_features()
    wide = known.groupBy(on).pivot("series_id", list(names)).agg(F.max("value"))
    return wide.select(on, *[F.col(f"`{series}`").alias(feature) for series, feature in names.items()])


def revision_counts(vintages: DataFrame) -> DataFrame:
    """Per series: observation dates, rows, and how many rows are revisions."""
    return (
        vintages.groupBy("series_id")
        .agg(
            F.min("series_name").alias("series_name"),
            F.countDistinct("date").alias("unique_dates"),
            F.count(F.lit(1)).alias("total_records"),
        )
        .withColumn("revisions", F.col("total_records") - F.col("unique_dates"))
    )


def first_release(vintages: DataFrame, skip_nulls: bool = True) -> DataFrame:
    """Earliest vintage per series and observation date.

    ``skip_nulls`` takes each column's first non-null entry in publication order, so a value that came out as
    missing is filled from its first revision; otherwise the earliest row is returned as it is.
    """
    keys = ["series_id", "date"]
    rest = [c for c in vintages.columns if c not in keys]
    if not skip_nulls:
        return vintages.groupBy(*keys).agg(
            F.min_by(F.struct(*rest), F.struct("realtime_start", "realtime_end", *rest)).alias("_row")
        ).select(*keys, "_row.*").select(*vintages.columns)
    order = F.struct("realtime_start", "realtime_end", *rest)
    firsts = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in rest]
    return vintages.groupBy(*keys).agg(*firsts).select(*vintages.columns)


def validity_intervals(vintages: DataFrame) -> DataFrame:
    """Close each vintage's interval the day before the next vintage of the same observation."""
    return with_frames(
        vintages,
        ["series_id", "date"],
        "realtime_start",
        lambda rows, window: rows.withColumn("valid_to", F.date_sub(shift("realtime_start", -1, window), 1)),
        after=1,
        ties=["realtime_end"],
    )
