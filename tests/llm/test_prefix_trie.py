"""Prefix trie and tree contraction against plain recursion."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie
from tidemark.llm.contraction import subtree_totals

SCHEMA = "conv_id long, turn long, role string, text string, digest string, at int, part int, node string"


def head_of(c):
    return zlib.crc32(str(c).encode()) % 6


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [(x[3], x[4]) for x in sorted(v)] for c, v in own.items()}
    made = {c: tuple(turns.get(c - c % 100, [])[: head_of(c)] + turns[c][head_of(c) :]) for c in turns}
    members = defaultdict(list)
    for c, said in made.items():
        for d in range(len(said) + 1):
            members[said[:d]].append(c)
    out = []
    for p, convs in members.items():
        inside = [q for q in members if q[: len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in convs if made[c] == p)))
        out.append(
            (
                min(convs),
                len(p),
                min(members[p[:-1]]) if p else None,
                len(convs),
                sum(len(q) == len(p) + 1 for q in inside),
                sum(not any(len(x) == len(q) + 1 and x[: len(q)] == q for x in inside) for q in inside),
                sum((len(members[q]) - 1) * len(q[-1][1]) for q in inside if q),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def trie(spark, rows):
    turns, conversations = prefix_trie.numbered(spark.createDataFrame(rows, SCHEMA))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    made = prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns, conversations, F.col("conv_id") - F.col("conv_id") % 100, head))
    return sorted((tuple(r) for r in made.collect()), key=str)


def awkward_turns():
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 40), *range(200, 215), 301, 302, 707]:
        for turn in range(rng.choice([1, 2, 3, 5, 7])):
            said = rng.choice(["hi", "héllo 😀", "", None, "go on"]) if turn < 3 else f"{c % 4} {turn}"
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["user", None, "assistant"]) if turn else "user", said))
    rows += [(3, 1, "user", "same")] * 3 + [(None, 0, "user", "lost"), (None, None, None, None)]
    return [(*r, "clash", 9, 9, "n") for r in rows]


def test_trie_equals_plain(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 2)
    monkeypatch.setattr(prefix_trie, "ENDS", 3)
    rows = awkward_turns()
    assert trie(spark, rows) == plain_trie(rows)


def test_long_conversation_and_hot_beginning(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    rows = [(1, t, "user", f"turn {t}", "", 0, 0, "") for t in range(150)]
    rows += [(c, 0, "user", "common", "", 0, 0, "") for c in range(1000, 1120)]
    assert trie(spark, rows) == plain_trie(rows)


def test_no_conversations(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "x", "", 0, 0, "")]) == []


@pytest.mark.parametrize("with_level", [True, False])
def test_contraction_of_any_forest(spark, with_level):
    rng = random.Random(8)
    parent, level = {0: None, 1: None}, {0: 0, 1: 0}
    for v in range(2, 260):
        p = v - 1 if 20 < v < 190 else rng.randrange(v)  # a long chain with bushes above and below
        parent[v], level[v] = p, level[p] + 1
    rows = [(v, p, level[v], v * 7 + 1, 1) for v, p in parent.items()]
    tree = spark.createDataFrame(rows, "node long, parent long, level long, x long, n long")
    found = subtree_totals(tree if with_level else tree.drop("level"), ["x", "n"])
    want = {v: [v * 7 + 1, 1] for v in parent}
    for v in sorted(parent, key=level.get, reverse=True):
        if parent[v] is not None:
            for k in (0, 1):
                want[parent[v]][k] += want[v][k]
    kids = defaultdict(int)
    for p in parent.values():
        kids[p] += 1
    assert {r["node"]: [r["x"], r["n"]] for r in found.collect()} == want
    assert {r["node"]: r["kids"] for r in found.collect()} == {v: kids[v] for v in parent}
