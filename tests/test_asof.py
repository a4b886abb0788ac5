"""As-of joins against the naive join + rank, with blocks far shorter than the histories."""

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join, known_on, latest_per_key

DAY = datetime.date(1999, 1, 1)


def day(n):
    return DAY + datetime.timedelta(n)


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(5)
    left = [(k, i, day(rng.randrange(3000))) for k in "abcd" for i in range(rng.randrange(1, 120))]
    left += [("a", -1, None), (None, -2, day(10)), ("hot", 500, day(3))]
    left += [("hot", i, day(1500)) for i in range(200)]
    right = [(k, day(rng.randrange(3000)), rng.randrange(3), None if rng.random() < 0.2 else rng.random())
             for k in "abce" for _ in range(rng.randrange(1, 60))]
    right += [("hot", day(5), 1, 0.5), ("hot", day(1500), 1, None), ("hot", day(2900), 0, 2.0), ("b", None, 1, 1.0)]
    return (
        spark.createDataFrame(left, "k string, id int, at date").repartition(3),
        spark.createDataFrame(right, "k string, seen date, rank int, value double").repartition(3),
    )


def naive(left, right, direction, allow_exact):
    condition = {
        ("backward", True): F.col("seen") <= F.col("at"),
        ("backward", False): F.col("seen") < F.col("at"),
        ("forward", True): F.col("seen") >= F.col("at"),
        ("forward", False): F.col("seen") > F.col("at"),
    }[direction, allow_exact]
    joined = left.join(right.withColumnRenamed("k", "k2"), (F.col("k") == F.col("k2")) & condition, "left")
    near = F.desc("seen") if direction == "backward" else F.asc("seen")
    rank = Window.partitionBy("k", "id").orderBy(near, F.desc("rank"), F.desc_nulls_last("value"))
    return joined.withColumn("rn", F.row_number().over(rank)).filter("rn = 1").drop("rn", "k2")


def rows(df):
    return sorted((tuple(r) for r in df.select("k", "id", "at", "seen", "rank", "value").collect()), key=str)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("allow_exact", [True, False])
@pytest.mark.parametrize("block_days", [30, 700, 100000])
def test_equals_naive(sides, direction, allow_exact, block_days):
    left, right = sides
    got = asof_join(left, right, ["k"], "at", "seen", direction, allow_exact, ties=["rank"], block_days=block_days)
    assert rows(got) == rows(naive(left, right, direction, allow_exact))


def test_salts_do_not_change_the_result(sides):
    left, right = sides
    got = asof_join(left, right, ["k"], "at", "seen", ties=["rank"], block_days=100, salts=5)
    assert rows(got) == rows(naive(left, right, "backward", True))


def test_inner_drops_unmatched(sides):
    left, right = sides
    got = asof_join(left, right, ["k"], "at", "seen", ties=["rank"], how="inner", block_days=50)
    assert rows(got) == rows(naive(left, right, "backward", True).filter("seen IS NOT NULL"))


def test_prefer_takes_greatest_so_far(sides):
    left, right = sides
    got = asof_join(left, right, ["k"], "at", "seen", prefer=["rank", "seen", "value"], how="inner", block_days=40)
    joined = left.join(right.withColumnRenamed("k", "k2"), (F.col("k") == F.col("k2")) & (F.col("seen") <= F.col("at")))
    order = Window.partitionBy("k", "id").orderBy(F.desc("rank"), F.desc("seen"), F.desc_nulls_last("value"))
    want = joined.withColumn("rn", F.row_number().over(order)).filter("rn = 1")
    assert rows(got) == rows(want)


def test_no_look_ahead(sides):
    left, right = sides
    early = right.filter(F.col("seen") <= day(1200))
    full = asof_join(left, right, ["k"], "at", "seen", ties=["rank"], block_days=60).filter(F.col("at") <= day(1200))
    part = asof_join(left, early, ["k"], "at", "seen", ties=["rank"], block_days=60).filter(F.col("at") <= day(1200))
    assert rows(full) == rows(part)


def test_left_rows_are_kept(sides):
    left, right = sides
    assert asof_join(left, right, ["k"], "at", "seen", block_days=60).count() == left.count()


def test_dates_outside_the_carry_bound(spark):
    left = spark.createDataFrame([("x", datetime.date(2500, 1, 1)), ("x", datetime.date(2100, 6, 1))], "k string, at date")
    right = spark.createDataFrame(
        [("x", datetime.date(1700, 1, 1), 1), ("x", datetime.date(2400, 1, 1), 2)], "k string, seen date, v int"
    )
    got = asof_join(left, right, ["k"], "at", "seen")
    assert {r["at"].year: r["v"] for r in got.collect()} == {2500: 2, 2100: 1}
    back = spark.createDataFrame([("x", datetime.date(1600, 1, 1)), ("x", datetime.date(1800, 1, 1))], "k string, at date")
    got = asof_join(back, right, ["k"], "at", "seen", "forward")
    assert {r["at"].year: r["v"] for r in got.collect()} == {1600: 1, 1800: 2}


def test_plan_has_no_pairwise_join(sides):
    left, right = sides
    plan = asof_join(left, right, ["k"], "at", "seen")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Join" not in plan


def test_rejects_bad_arguments(sides):
    left, right = sides
    with pytest.raises(ValueError):
        asof_join(left, right, ["k"], "at", "seen", "sideways")
    with pytest.raises(ValueError):
        asof_join(left, right.withColumnRenamed("value", "id"), ["k"], "at", "seen")


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 2, "a"), (1, 2, "b"), (1, 1, "z"), (2, None, "q")], "id int, at int, v string")
    got = {r["id"]: (r["at"], r["v"]) for r in latest_per_key(df, ["id"], ["at"]).collect()}
    assert got == {1: (2, "b"), 2: (None, "q")}


def test_known_on(spark):
    df = spark.createDataFrame(
        [("s", day(0), day(9), 1), ("s", day(10), day(19), 2), ("s", day(20), day(29), 3)],
        "series_id string, realtime_start date, realtime_end date, v int",
    )
    assert {r["v"] for r in known_on(df, str(day(10))).collect()} == {1, 2}
    assert {r["v"] for r in known_on(df, str(day(10)), current_only=True).collect()} == {2}
