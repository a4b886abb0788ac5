"""Files whose table begins after a preamble."""

import os

from pyspark.sql import types as T

from tidemark.sources.preamble import read_preamble_csv

_SCHEMA = T.StructType().add("Ticker", "string").add("Weight", "double").add("Shares", "long")


def _read(spark, folder, files, **conf):
    for name, text in files.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as file:
            file.write(text)
    good, bad = read_preamble_csv(spark, f"file://{folder}/*.csv", "Ticker,", _SCHEMA)
    base = lambda r: (os.path.basename(r["file"]), *r[1:])
    return sorted(map(base, good.collect()), key=str), sorted(map(base, bad.collect()), key=str)


def test_headers_orders_quotes_and_rejects(spark, tmp_path):
    good, bad = _read(
        spark,
        tmp_path,
        {
            "a.csv": "As of,today\n\nTicker,Name,Weight,Shares\n\"A, B\",x,1.5,10\nC,\"say \"\"hi\"\"\",,20\n\nThe end, of it\n",
            "b.csv": "﻿Ticker, Shares ,Extra\r\nD,7,z\r\nE,seven,z\r\n\"F,8,z\r\n",
            "c.csv": "no table here\n",
            "d.csv": "",
        },
    )
    assert good == [("a.csv", 4, "A, B", 1.5, 10), ("a.csv", 5, "C", None, 20), ("b.csv", 2, "D", None, 7)]
    assert bad == [
        ("a.csv", 7, "The end, of it", "cells"),
        ("b.csv", 3, "E,seven,z", "value"),
        ("b.csv", 4, '"F,8,z', "cells"),
        ("c.csv", None, None, "header"),
    ]


def test_a_file_in_many_splits(spark, tmp_path):
    n = 4000
    text = "preamble\nTicker,Weight,Shares\n" + "".join(f"T{i},{i}.25,{i}\n" for i in range(n))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 8192)
    try:
        good, bad = _read(spark, tmp_path, {"big.csv": text})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert not bad and len(good) == n
    assert {(line, ticker) for _, line, ticker, _, _ in good} == {(i + 3, f"T{i}") for i in range(n)}


def test_no_header_anywhere(spark, tmp_path):
    good, bad = _read(spark, tmp_path, {"x.csv": "Name,Weight\nA,1\n"})
    assert good == [] and bad == [("x.csv", None, None, "header")]
