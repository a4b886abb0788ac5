"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Only settings that change at run time: they apply to a session somebody else has built.
_RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A symbol-day or a symbol may hold a large share of all rows: let AQE split such join partitions,
    # also where the next operator then needs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Columns that repeat values, feature vectors above all, take many times the bytes in a task that they take in a file.
_SPLIT = "spark.sql.files.maxPartitionBytes"
_SPLIT_BYTES = 32 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's run-time settings to an existing session. Splits of files get smaller, never larger."""
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_SPLIT)) > _SPLIT_BYTES:
        spark.conf.set(_SPLIT, f"{_SPLIT_BYTES}b")
    for key, value in _RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or one below the warehouse where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    if not warehouse:
        raise ValueError("spark.checkpoint.dir or spark.sql.warehouse.dir must name a folder shared by all executors")
    return f"{warehouse.rstrip('/')}/_shared"


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; an earlier stage is never overwritten."""
    path = f"{shared_dir(spark)}/stages/{name}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    return path


_scopes: list[list[str]] = []


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the stages written inside the block when it ends; what is read from them must be written by then."""
    _scopes.append(made := [])
    try:
        yield
    finally:
        _scopes[:] = [scope for scope in _scopes if scope is not made]
        remove_stages(spark, made)


@contextmanager
def recorded_stages() -> Iterator[list[str]]:
    """The paths of the stages written inside the block, for somebody who removes them later."""
    _scopes.append(made := [])
    try:
        yield made
    finally:
        _scopes[:] = [scope for scope in _scopes if scope is not made]


def remove_stages(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    paths.clear()


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Cuts the lineage so that several consumers (or a lost executor) do not recompute it, and keeps column
    pruning and filter push-down for the readers.
    """
    path = stage_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
