"""Labels, texts, replies and payloads on edge values."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import market as m
from tidemark.functions import text as x
from tidemark.operators import news, splits
from tidemark.sources import payloads, tables


def one(spark, value, dtype, build):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(build(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "move, two, up, three",
    [(0.0, "down", 1, "stable"), (0.005, "up", 1, "stable"), (-0.005, "down", 0, "stable"), (0.0051, "up", 1, "up"),
     (-0.0051, "down", 0, "down"), (None, "down", 0, "stable")],
)
def test_directions(spark, move, two, up, three):
    assert one(spark, move, "double", m.two_way_direction) == two
    assert one(spark, move, "double", lambda v: m.two_way_direction(v, 1, 0, zero_is_up=True)) == up
    assert one(spark, move, "double", m.three_way_direction) == three


@pytest.mark.parametrize("day, inclusive, label", [("2025-10-24", True, "train"), ("2025-10-24", False, "test"), ("2025-10-25", True, "test")])
def test_split_label(spark, day, inclusive, label):
    assert one(spark, day, "string", lambda v: m.split_label(F.to_date(v), "2025-10-24", inclusive)) == label


@pytest.mark.parametrize("value, want", [(-1.0, 0.0), (2.0, 1.0), (0.5, 0.5), (None, None)])
def test_clip(spark, value, want):
    assert one(spark, value, "double", lambda v: m.clip(v, 0.0, 1.0)) == want


def test_softmax(spark):
    got = one(spark, [1.0, 3.0, 2.0], "array<double>", lambda v: m.softmax_label(v, ["down", "up", "flat"]))
    total = sum(math.exp(i - 3) for i in (1, 3, 2))
    assert got["label"] == "up" and got["confidence"] == pytest.approx(1 / total)
    whole = one(spark, [1.0, 3.0, 2.0], "array<double>", m.softmax)
    assert sum(whole) == pytest.approx(1.0) and max(whole) == pytest.approx(got["confidence"])
    assert one(spark, [1000.0, 999.0], "array<double>", m.softmax_label)["label"] == 0


@pytest.mark.parametrize(
    "reply, want",
    [("Input: positive Answer: Negative.", ("negative", 0.85)), ("Answer: Positive!\n", ("positive", 0.85)),
     ("Answer: mixed", ("neutral", 0.7)), ("no marker but positive", ("positive", 0.85)), (None, ("neutral", 0.5))],
)
def test_reply_label(spark, reply, want):
    assert tuple(one(spark, reply, "string", x.reply_label)) == want


@pytest.mark.parametrize(
    "reply, want",
    [('```json\n{"sentiment": "negative", "confidence": 0.8}\n```', ("negative", 0.8)),
     ('{"sentiment": "positive", "confidence": 1}', ("positive", 1.0)), ('{"sentiment": "pos', ("neutral", 0.5)),
     ('{"confidence": 0.3}', ("neutral", 0.5)), (None, ("neutral", 0.5))],
)
def test_json_label(spark, reply, want):
    assert tuple(one(spark, reply, "string", x.json_label)) == want


@pytest.mark.parametrize(
    "text, want",
    [("x [/INST] Prediction: up a lot", "Up"), ("PREDICTION DECLINE", "Down"), ("prediction:\n rise", "Up"), ("up", "Neutral")],
)
def test_chat_label(spark, text, want):
    assert one(spark, text, "string", lambda v: x.pattern_label(x.chat_answer(v))) == want


def test_prompts(spark):
    whole = one(spark, "abc" * 1000, "string", lambda v: x.render_prompt(x.SENTIMENT_PROMPT, article_text=v))
    assert "{negative/neutral/positive}" in whole and whole.count("abc") == 1000 and whole.endswith("Answer: ")


def test_article_text_nulls(spark):
    df = spark.createDataFrame([("h", None), (None, "s")], "h string, s string")
    got = [r[0] for r in df.select(x.article_text(F.col("h"), F.col("s"))).collect()]
    assert got == ["Headline: h Summary: ", None]
    assert tuple(one(spark, None, "string", lambda v: x.lexicon_label(v, ["a"], ["b"]))) == ("neutral", 0.5)


@pytest.mark.parametrize("symbols, want", [("", []), ("A,,B", ["A", "B"]), (None, []), ("A", ["A"])])
def test_symbol_list(spark, symbols, want):
    assert one(spark, symbols, "string", x.symbol_list) == want


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], ["Surprise(%)", "EPS Estimate"])
    assert x.clean_columns(df).columns == ["surprise", "eps_estimate"]
    with pytest.raises(ValueError):
        x.clean_columns(spark.createDataFrame([(1, 2)], ["a(", "A"]))


@pytest.mark.parametrize("ticker, ok", [("AAPL", True), ("ABCDEF", False), ("BRK.B", False), ("", False), ("Ünix", True)])
def test_tickers(spark, ticker, ok):
    assert one(spark, ticker, "string", x.is_plain_ticker) is ok


def test_observation_values(spark):
    page = '{"observations":[' + ",".join(
        f'{{"date":"2024-01-0{i}","realtime_start":"2024-02-01","realtime_end":"2024-02-09","value":{v}}}'
        for i, v in enumerate(['"."', '""', '"abc"', '"1.5"', "null"], 1)
    ) + "]}"
    df = spark.createDataFrame([("S", "s", page), ("T", "t", "broken")], "series_id string, series_name string, payload string")
    got = {r["date"].day: r["value"] for r in payloads.json_observations(df, "payload").collect()}
    assert got == {1: None, 2: None, 4: 1.5, 5: None}


def test_quarantine(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": "x"',), (None,)], "line string")
    good, bad = payloads.json_rows(df, "line", T.StructType([T.StructField("a", T.LongType())]))
    assert [r["a"] for r in good.collect()] == [1] and bad.count() == 2


def test_html_and_preamble(spark):
    page = "<table><tr><th>Symbol</th><th>N</th></tr><tr><td><a>BRK.B</a> </td><td>1</td></tr></table>"
    df = spark.createDataFrame([(1, page), (2, "<p>none</p>")], "id int, html string")
    assert [(r["id"], r["Symbol"]) for r in payloads.html_table_column(df, "html", "Symbol", ["id"]).collect()] == [(1, "BRK.B")]
    schema = T.StructType([T.StructField("Ticker", T.StringType()), T.StructField("W", T.DoubleType())])
    files = spark.createDataFrame([(1, 'as of\n\nTicker,W\r\n"A, B",1.5\nC,\n\n'), (2, "nothing here")], "f int, t string")
    got = payloads.preamble_csv(files, "t", "Ticker,", schema, ["f"]).orderBy("pos").collect()
    assert [(r["f"], r["Ticker"], r["W"]) for r in got] == [(1, "A, B", 1.5), (1, "C", None)]


def test_rollup_parts_join_to_the_whole(spark):
    rows = [(i, f"h{i}" if i != 3 else None, f"2024-01-01 {i % 24:02d}:00:{i % 60:02d}", "A,B") for i in range(50)]
    df = spark.createDataFrame(rows, "id int, headline string, created_at string, symbols string")
    df = df.withColumn("created_at", F.to_timestamp("created_at"))
    whole = {r["symbol"]: r["daily_news_text"] for r in news.daily_rollup(df).collect()}
    parts = {r["symbol"]: r["daily_news_text"] for r in news.daily_rollup(df, piece_articles=7).collect()}
    assert parts == whole
    assert whole["A"].startswith("Article 1: h0 /n Article 2: h24") and whole["A"].count("Article ") == 49


def test_splits_are_stable(spark):
    df = spark.range(4000).withColumn("k", F.col("id") % 1000)
    a = splits.key_split(df, ["k"])
    assert a.groupBy("k").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0
    b = splits.key_split(df.repartition(7), ["k"])
    assert a.exceptAll(b).count() == 0
    share = a.filter("split = 'train'").count() / 4000
    assert 0.75 < share < 0.85
    assert df.select(splits.fold_column(["id"]).alias("f")).distinct().count() == 5


def test_csv_round_trip_and_quarantine(spark, tmp_path):
    from tidemark.sources import sinks

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    df = spark.createDataFrame([(1, 'a "quoted", text\nwith lines'), (2, "plain"), (3, None), (4, ""), (None, "x")], schema)
    path = str(tmp_path / "out")
    sinks.export_csv(df, path, order=["id"])
    assert tables.read_csv(spark, path, schema, multi_line=True).count() == 5
    assert tables.read_csv(spark, path, schema, multi_line=True).exceptAll(df).count() == 0
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        sinks.export_csv(df, path)
    (tmp_path / "bad.csv").write_text("id,t\n1,ok\nx,bad\n")
    good, bad = tables.read_csv_quarantined(spark, str(tmp_path / "bad.csv"), schema)
    assert [r["id"] for r in good.collect()] == [1] and bad.count() == 1


def test_sql_file_and_preview(spark, tmp_path):
    tables.register(spark.range(10), "numbers")
    path = tmp_path / "step.sql"
    path.write_text("SELECT id FROM numbers WHERE id >= :least\n;\n")
    made = tables.sql_file(spark, str(path), least=7)
    assert sorted(r["id"] for r in made.collect()) == [7, 8, 9]
    assert [r["id"] for r in tables.preview(made, 2, [F.desc("id")]).collect()] == [9, 8]
    keyed = tables.with_key(made, "symbol", "A", {"id": "n"})
    assert keyed.columns == ["symbol", "n"]
    assert tables.pick_columns(keyed, ["n"], ["index", "symbol"]).columns == ["n"]
