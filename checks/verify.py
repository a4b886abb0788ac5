"""Compare every registered query with its SQL on DuckDB: ``python -m checks.verify --sf 0.01 [names]``."""

from __future__ import annotations

import argparse
import datetime
import math
import time

import duckdb
from pyspark.sql import SparkSession

from checks import load

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else (repr(value),)
    if isinstance(value, datetime.datetime):
        return (value.replace(tzinfo=None).isoformat(),)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, _plain(v)) for k, v in value.items())
    return (type(value).__name__, str(value))


def compare(spark: SparkSession, connection, sf_dir: str, name: str) -> tuple[str, int]:
    queries, sql = load()
    df = queries[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = [tuple(_plain(row[c]) for c in columns) for row in df.collect()]
    if name not in sql:
        return "rows only", len(ours)
    result = connection.execute(sql[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns differ: {sorted(set(names) ^ set(columns))}", len(ours)
    order = [names.index(c) for c in columns]
    theirs = [tuple(_plain(row[i]) for i in order) for row in result.fetchall()]
    if len(ours) != len(theirs):
        return f"rows differ: {len(ours)} and {len(theirs)}", len(ours)
    ours.sort()
    theirs.sort()
    for mine, other in zip(ours, theirs):
        if mine != other:
            wrong = [(c, m, o) for c, m, o in zip(columns, mine, other) if m != o]
            return f"values differ: {str(wrong)[:600]} in {str(mine)[:300]}", len(ours)
    return "ok", len(ours)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    sf_dir = f"/root/testdata/sf{options.sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    queries, _ = load()
    failures = 0
    for name in options.names or queries:
        start = time.time()
        try:
            verdict, rows = compare(spark, connection, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            verdict, rows = f"error: {str(error)[:500]}", -1
        failures += verdict not in ("ok", "rows only")
        print(f"{name:34s} {rows:8d} rows {time.time() - start:6.1f}s  {verdict}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    raise SystemExit(main())
