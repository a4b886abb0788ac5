"""Learnt operators, nearest neighbours and tool calls: held-out accuracy and brute force on awkward tables."""

import json
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from tidemark.llm import neighbours, quality_model, rules, tool_calls, toxicity
from tidemark.llm.common import smallest

SF = "/root/testdata/sf0.01"


def fold(parts):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def judged(scored, labels, name):
    rows = scored.join(labels.select("doc_id", F.col(name).alias("label")), "doc_id").where("held_out")
    return rows.select("label", "predicted", "score").collect()


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    scored = quality_model.score(docs, labels, fold(3) == 1)
    assert scored.count() == docs.count()
    assert scored.where("score < 0 OR score > 1 OR predicted <> CAST(score >= 0.5 AS INT)").count() == 0
    rows = judged(scored, labels, "quality")
    assert np.mean([r["label"] == r["predicted"] for r in rows]) >= 0.97


def test_quality_ignores_held_out_labels(tables):
    docs, labels = tables
    held = fold(3) == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (
        {r["doc_id"]: r["score"] for r in quality_model.score(docs, x, held).collect()} for x in (labels, turned)
    )
    assert max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_isotonic_is_monotone_and_pools():
    at, share = quality_model.pool_adjacent(np.array([0.1, 0.4, 1.2, 0.0, 4.0]), np.array([1, 0, 1, 0, 4]), np.array([1, 1, 2, 0, 4]))
    assert (np.diff(share) > 0).all() and (np.diff(at) > 0).all()


def test_rules_on_labels(tables):
    docs, labels = tables
    stats = rules.statistics(docs).persist()
    learnt = rules.learn(stats, labels)
    assert 1 <= len(learnt) <= 8
    rows = rules.apply(stats, learnt).where("NOT base_failed").join(labels, "doc_id").select("quality", "kept").collect()
    count = Counter((r["quality"], r["kept"]) for r in rows)
    assert count[0, False] >= 0.9 * (count[0, False] + count[0, True])
    assert count[1, False] <= 0.01 * (count[1, False] + count[1, True])
    kept = rules.keep(rules.described(docs), learnt)
    assert kept.columns == docs.columns
    assert kept.count() == rules.apply(stats, learnt).where("kept").count()


def segments_by_definition(values):
    """All maximal-scoring segments: the best segment, then those left and right of it, and so on."""
    best, sums = None, np.concatenate([[0.0], np.cumsum(values)])
    for i in range(len(values)):
        for j in range(i + 1, len(values) + 1):
            key = (sums[j] - sums[i], -(j - i))
            if sums[j] - sums[i] > 1e-12 and (best is None or key > best[0]):
                best = (key, i, j)
    if best is None:
        return []
    _, i, j = best
    right = [(a + j, b + j, s) for a, b, s in segments_by_definition(values[j:])]
    return [*segments_by_definition(values[:i]), (i, j - 1, sums[j] - sums[i]), *right]


def test_segments_equal_their_definition():
    rng = random.Random(1)
    for _ in range(300):
        neutral = rng.choice([0.31, 0.77, 1.9])
        hits = [(i, rng.choice([0.5, 1.13, 2.7, 4.1])) for i in range(rng.randint(0, 24)) if rng.random() < 0.4]
        values = [-neutral] * ((hits[-1][0] if hits else 0) + 2)
        for i, s in hits:
            values[i] = s
        found = [(a, b, round(s, 6)) for a, b, s in toxicity.maximal_segments(hits, neutral)]
        assert found == [(a, b, round(s, 6)) for a, b, s in segments_by_definition(values)]


def test_smallest_is_a_sorted_limit(spark):
    rows = spark.range(3000).select((F.col("id") % 700).alias("id"), F.xxhash64(F.col("id") % 700).alias("mark"))
    for n in (1, 50, 2999, 5000):
        assert smallest(rows, "mark", ["id"], n).collect() == rows.orderBy("mark", "id").limit(n).collect()
    assert smallest(rows.limit(0), "mark", ["id"], 5).count() == 0


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        words = plain.sentence(rng, rng.randint(30, 200)).split()
        toxic = i % 9 == 0
        for _ in range(rng.randint(2, 6) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["Nasty,", "awful###", "VILE"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    scored = toxicity.score(docs, labels, fold(5) == 0).persist()
    held = judged(scored, labels, "toxic")
    assert all(r["label"] == r["predicted"] for r in held)
    assert scored.where("score < 0 OR score > 1 OR predicted <> CAST(score >= 0.5 AS INT)").count() == 0
    passage = scored.where("predicted = 1").first()["passages"][0]
    assert passage["first"] <= passage["last"] and passage["score"] > 0


@pytest.mark.parametrize("operator, column", [(quality_model.score, "quality"), (toxicity.score, "toxic")])
def test_scores_of_awkward_documents(spark, operator, column):
    docs = plain.awkward(spark)
    good = [(i, i % 2) for i in range(22)]
    for rows in (good, [], [(1, 1)], [(None, 1), (2, None), (999, 0)]):
        labels = spark.createDataFrame(rows, f"doc_id long, {column} int")
        scored = operator(docs, labels, fold(3) == 1).collect()
        assert Counter(r["doc_id"] for r in scored) == Counter(r[0] for r in plain.awkward_rows())
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored)
        assert operator(docs.limit(0), labels, fold(3) == 1).count() == 0


def test_rules_of_awkward_documents(spark):
    docs = plain.awkward(spark)
    for rows in ([(i, i % 2) for i in range(22)], [], [(1, 1)], [(None, 1), (2, None), (999, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        assert rules.judge(docs, labels).count() == docs.count()
        assert rules.judge(docs.limit(0), labels).count() == 0


def brute_neighbours(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.setdefault((i, tuple(v)), None)
    out = set()
    for i, v in good:
        if i % 20:
            continue
        found = set()
        for j, u in good:
            if j != i and len(u) == len(v):
                total = v[0] * u[0]
                for a, b in zip(v[1:], u[1:]):
                    total += a * b
                found.add((-total, j))
        out |= {(i, rank + 1, j, -s) for rank, (s, j) in enumerate(sorted(found)[:k])}
    return out


def test_neighbours_are_exact(spark, monkeypatch):
    rng = np.random.default_rng(6)
    hot = rng.normal(size=7).tolist()
    rows = [(i, (rng.normal(size=7) * 10.0 ** rng.integers(-3, 4)).tolist()) for i in range(200)]
    rows += [(i, hot) for i in range(200, 300)] + [(i, [round(x, 1) for x in rng.normal(size=7).tolist()]) for i in range(300, 400)]
    rows += [
        (400, None), (420, []), (440, [0.0] * 7), (460, [float("nan")] + [1.0] * 6), (480, [float("inf")] + [1.0] * 6),
        (500, [None] + [1.0] * 6), (520, [1.0, 2.0]), (521, [1.0, 3.0]), (None, hot), (0, rows[0][1]), (540, [1e-310] * 7),
    ]
    table = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<double>, rank int, score double")
    monkeypatch.setattr(neighbours, "TILE", 16)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    found = neighbours.nearest(table, F.col("id") % 20 == 0).collect()
    assert {tuple(r) for r in found} == brute_neighbours(rows, 20)
    assert len(found) == len({tuple(r) for r in found})
    assert neighbours.nearest(table.limit(0), F.col("id") % 20 == 0).count() == 0


def test_tiles_are_exact_for_long_vectors():
    rng = np.random.default_rng(8)
    own, other = rng.normal(size=(5, 2500)), rng.normal(size=(300, 2500))
    row, col, score = neighbours.best_in_tile(own, np.arange(5), other, np.arange(100, 400), 20)
    exact = np.argsort(-(own @ other.T), axis=1)[:, :20] + 100
    assert (col.reshape(5, 20) == exact).all()


@pytest.mark.parametrize("kind", ["equal", "one id", "close"])
def test_tiles_of_repeated_ids_and_vectors_stay_small(kind):
    rng = np.random.default_rng(9)
    own, base = rng.normal(size=(512, 64)), rng.normal(size=64)
    other = base + rng.normal(size=(8192, 64)) * {"equal": 0.0, "one id": 1.0, "close": 1e-6}[kind]
    ids = np.full(8192, 7) if kind == "one id" else np.arange(10_000, 18_192)
    tracemalloc.start()
    row, col, score = neighbours.best_in_tile(own, np.arange(512) + 100_000, other, ids, 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 << 20
    exact = np.zeros((50, 8192))
    for d in range(64):
        exact += own[:50, d, None] * other[:, d]
    for i in range(50):
        best = sorted(set(zip((-exact[i]).tolist(), ids.tolist())))[:20]
        assert [(-s, j) for s, j in zip(score[row == i].tolist(), col[row == i].tolist())] == best


SCHEMAS = {"find": {"city": ("string", True), "days": ("integer", False)}}


def test_tool_calls_are_linked_ordered_and_validated(spark):
    calls = spark.createDataFrame(
        [
            (1, "a", 1, "find", '{"days": 3,  "city": "Rom\\n"}', None),
            (1, "b", 2, "find", '{"city": 5}', "a"),
            (1, "c", 3, "find", '{"city": "x", "more": 1}', "b"),
            (1, "d", 4, "lost", "{}", "c"),
            (1, "d", 5, "find", '{"city": "later"}', None),
            (1, "e", 6, "find", "not json", "gone"),
            (1, "f", 7, "find", None, "g"),
            (1, "g", 8, "find", '["city"]', "f"),
            (2, "a", 1, "find", '{"city": "y"}', None),
            (None, "a", 1, "find", '{"city": "y"}', None),
        ],
        "conv_id long, call_id string, place long, tool string, arguments string, after string",
    )
    results = spark.createDataFrame(
        [(1, "a", 2, "sunny"), (1, "a", 9, "again"), (1, "z", 3, "stray"), (2, "a", 2, None)],
        "conv_id long, call_id string, place long, content string",
    )
    found = {(r["conv_id"], r["call_id"]): r for r in tool_calls.link(calls, results, SCHEMAS).collect()}
    assert {k: (r["step"], r["status"], r["valid"], r["repeats"]) for k, r in found.items()} == {
        (1, "a"): (0, "linked", True, 1), (1, "b"): (1, "open", False, 0), (1, "c"): (2, "open", False, 0),
        (1, "d"): (3, "open", False, 1), (1, "e"): (0, "open", False, 0), (1, "f"): (None, "open", False, 0),
        (1, "g"): (None, "open", False, 0), (1, "z"): (None, "stray", False, 0), (2, "a"): (0, "linked", True, 0),
        (None, "a"): (0, "open", True, 0),
    }
    line = {"arguments": {"city": "Rom\n", "days": 3}, "id": "a", "result": "sunny", "step": 0, "tool": "find", "valid": True}
    assert found[1, "a"]["json"] == json.dumps(line, separators=(",", ":"), sort_keys=True)
    none = tool_calls.link(calls.limit(0), results.limit(0), SCHEMAS)
    assert none.count() == 0


def test_rows_without_keys_come_back(spark):
    calls = spark.createDataFrame(
        [(None, "a", 1, "find", '{"city": "y"}', "b"), (1, None, 2, "find", "{}", "a"), (1, None, 2, "find", "{}", "a")],
        "conv_id long, call_id string, place long, tool string, arguments string, after string",
    )
    results = spark.createDataFrame([(None, "a", 1, "x"), (1, None, 1, "y")], "conv_id long, call_id string, place long, content string")
    found = sorted((r["conv_id"] or 0, r["call_id"] or "", r["status"], r["step"], r["valid"], r["repeats"]) for r in tool_calls.link(calls, results, SCHEMAS).collect())
    assert found == [
        (0, "a", "open", 0, True, 0), (0, "a", "stray", None, False, 0),
        (1, "", "open", 0, False, 0), (1, "", "open", 0, False, 0), (1, "", "stray", None, False, 0),
    ]


def plain_steps(after):
    """Longest path to every call by definition; null on and behind cycles."""
    known, left = {}, dict(after)
    while ready := [c for c, before in left.items() if all(b in known or b not in after for b in before)]:
        known |= {c: max((known[b] + 1 for b in left[c] if b in after), default=0) for c in ready}
        left = {c: b for c, b in left.items() if c not in known}
    return known | dict.fromkeys(left)


def test_steps_of_calls_that_need_several_results(spark):
    rng = random.Random(12)
    graphs = {g: {i: [rng.randrange(-2, i + (2 if g % 3 else 0)) for _ in range(rng.choice((0, 1, 1, 1, 2, 3)))] for i in range(40)} for g in range(6)}
    graphs[6] = {0: [], 1: [0], 2: [1], 3: [2], 4: [0, 3, 3, None], 5: [4], 6: [5, 0], 7: [7], 8: [7, 0], 9: [10], 10: [9], 11: [10], 12: None}
    rows = [(g, i, after) for g, calls in graphs.items() for i, after in calls.items()]
    found = tool_calls.steps(spark.createDataFrame(rows, "conv_id int, call_id int, after array<int>")).collect()
    assert len(found) == len(rows)
    for g, calls in graphs.items():
        assert {r["call_id"]: r["step"] for r in found if r["conv_id"] == g} == plain_steps({i: [x for x in a or [] if x is not None] for i, a in calls.items()})


def test_exchanges_take_turns_of_any_role(spark):
    turns = [(1, 0, "tool", "a"), (1, 1, None, "b"), (1, 2, "assistant", "c"), (None, 3, "user", "d"), (1, None, "assistant", None)]
    calls, results = tool_calls.exchanges(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string"))
    found = sorted((r["conv_id"] or 0, r["call_id"] or 0, r["status"]) for r in tool_calls.link(calls, results, tool_calls.REPLY).collect())
    assert found == [(0, 3, "open"), (1, 0, "open"), (1, 0, "stray"), (1, 1, "linked")]


def test_steps_of_a_long_chain(spark):
    calls = spark.createDataFrame([(1, i, i - 1) for i in range(300)], "conv_id int, call_id int, after int")
    assert all(r["step"] == r["call_id"] for r in tool_calls.steps(calls).collect())
