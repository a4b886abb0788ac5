"""Operators on single texts or on repeats between texts, against plain versions on awkward documents."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import plain
from tidemark.llm import bpe, packing, pii, repeats, rules, simhash

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")

@lru_cache
def whole_tokenizer():
    return Tokenizer.from_file(WORD_FILE)


ODD = st.text(alphabet=st.sampled_from(list("abTh's'll 12\n\t\r\x0b\x85\x1c\xa0éß中😀.,!#$<|>endoftxİΣ́")), max_size=40)


@pytest.fixture(scope="module")
def rows():
    return plain.awkward_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return plain.awkward(spark)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD, max_size=4))
def test_bpe_equals_the_library(texts):
    ranks = bpe.encoder(RANKS, PATTERN)
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks.ranks, special_tokens={})
    assert [np.frombuffer(x, np.int32).tolist() for x in ranks.encode(texts)] == [own.encode_ordinary(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD, min_size=1, max_size=6))
def test_bpe_of_batches_equals_the_library(texts):
    ranks = bpe.encoder(RANKS, PATTERN)
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks.ranks, special_tokens={})
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["doc_id", "text"])
    found = {k: ids[a:b].tolist() for rows, ids, at in bpe._encoded(ranks, batch) for k, a, b in zip(rows.to_pylist(), at, at[1:])}
    assert [found[k] for k in range(len(texts))] == [own.encode_ordinary(t) for t in texts]


def test_bpe_of_long_matches(reference):
    own = bpe.encoder(RANKS, PATTERN)
    for text in ("a" * 30_000, "ab" * 20_000, "th" * 5_000 + "é" * 5_000, "=" * 9_999):
        assert np.frombuffer(own.encode([text])[0], np.int32).tolist() == reference.encode_ordinary(text)


def test_bpe_round_trip_of_every_row(docs, rows, reference):
    found = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert sorted(map(str, found)) == sorted(map(str, bpe.round_trip(docs, RANKS, PATTERN).collect()))
    expected = Counter((r[0], tuple(reference.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in rows)
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in found) == expected


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD, max_size=4))
def test_words_equal_the_tokenizer(texts):
    whole = whole_tokenizer()
    ids, bounds = packing.words_of(WORD_FILE).encode(pa.array(texts, pa.string()))
    own = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert own == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_and_places(docs, rows):
    whole = Tokenizer.from_file(WORD_FILE)
    table = packing.pieces(docs, WORD_FILE, capacity=256).withColumn("crc", F.crc32("ids")).drop("ids")
    found = packing.pack(table, capacity=256, group_sequences=8).collect()
    expected = Counter()
    for r in rows:
        ids = whole.encode(r[1] or "", add_special_tokens=False).ids + [0]
        for at in range(0, len(ids), 256):
            part = np.array(ids[at : at + 256], "<u4")
            expected[r[0], at // 256, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["crc"]) for r in found) == expected
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 256
    assert len(sequences) <= 1.15 * sum(r["length"] for r in found) / 256 + 3


def test_sum_of_squares_places_each_piece_where_the_sum_is_least():
    rng = np.random.default_rng(5)
    lengths, capacity = rng.integers(1, 20, 400), 20
    sequence, offset = packing.sum_of_squares(lengths, capacity)
    filled: dict[int, int] = {}
    for size, own, at in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):
        def after(place, size=size):
            gaps = Counter(capacity - f - (size if k == place else 0) for k, f in filled.items())
            if place is None:
                gaps[capacity - size] += 1
            return sum(n * n for gap, n in gaps.items() if gap)
        options = [k for k, f in filled.items() if f + size <= capacity] + [None]
        assert after(own if own in filled else None) == min(map(after, options))
        assert filled.get(own, 0) == at
        filled[own] = at + size


def test_repeats(docs, rows):
    for width, prefix, group in ((35, 8, 4096), (12, 3, 4096), (12, 3, 1)):
        found = repeats.remove_repeats(docs, width=width, prefix=prefix, group=group).collect()
        expected = Counter(zip([r[0] for r in rows], plain.repeats(rows, width)))
        assert Counter((r["doc_id"], (r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest())) for r in found) == expected


def test_large_groups_are_split_without_joins(spark):
    rows = [(i % 2, i, 2, " ".join(["a", "b", *"pqr", *(f"w{i}{k}" for k in range(4))]).encode()) for i in range(8)]
    around = spark.createDataFrame(rows, "h long, around long, left int, words binary")
    for part in repeats._split_trees(around, 6, 3, 2):
        assert "Join" not in part._jdf.queryExecution().optimizedPlan().toString()
        # Windows of 6 words from the first or the second word on have w<i>0 in them, so none is a repeat.
        assert part.count() == 0
    same = around.withColumn("words", F.lit(b"a b p q r s t u v"))
    marked = reduce(lambda a, b: a.unionByName(b), repeats._split_trees(same, 6, 3, 2))
    assert {(r["around"], r["m"]) for r in marked.groupBy("around").agg(F.bit_or("mask").alias("m")).collect()} == {(i, 7) for i in range(8)}


def test_large_groups_settle_shared_ranges_at_once(spark):
    shared = [f"s{k}" for k in range(60)]
    rows = [(1, i, 27, " ".join([f"x{i}", *shared, f"y{i}"]).encode()) for i in range(12)]
    rows += [(1, 12 + i, 20, " ".join([*shared[6:], f"z{i}"]).encode()) for i in range(3)]  # texts that begin in the passage
    found = repeats._split_trees(spark.createDataFrame(rows, "h long, around long, left int, words binary"), 35, 8, 2)
    marked = [(r["around"], r["mask"]) for part in found for r in part.collect()]
    masks = dict.fromkeys(range(15), 0)
    for around, mask in marked:
        masks[around] |= mask
    assert [masks[i] for i in range(15)] == repeats.deep_nodes([r[2:] for r in rows], 35, 0, 27)
    assert masks[0] == (1 << 27) - 2 and masks[12] == (1 << 21) - 2
    # Two rows a level for the ranges in which the passage begins or ends, not one for each of the 26 windows.
    assert len(marked) <= 15 * 2 * 4


def test_repeats_within_one_text(spark):
    text = " ".join(f"w{i % 50}" for i in range(200)) + " end"
    found = repeats.remove_repeats(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert found["n_removed"] == plain.repeats([(1, text)], 35)[0][1] > 0


def test_base_statistics(docs, rows):
    found = rules.apply(rules.statistics(docs), []).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r["doc_id"], tuple(r[n] for n in names)) for r in found) == Counter((r[0], plain.base_statistics(r[1])) for r in rows)
    assert all(r["kept"] == (not r["base_failed"]) for r in found)


def test_near_duplicates(docs, rows):
    for limit in (4, 0, 6):
        found = simhash.near_duplicates(docs, limit=limit).collect()
        prints = [plain.fingerprint(r[1]) for r in rows]
        labels = plain.groups(prints, lambda a, b: (a ^ b).bit_count() <= limit)
        least = {}
        for label, row in zip(labels, rows):
            if row[0] is not None:
                least[label] = min(least.get(label, row[0]), row[0])
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        expected = Counter((r[0], signed(p), least.get(label)) for r, p, label in zip(rows, prints, labels))
        assert Counter((r["doc_id"], r["fp"], r["component_id"]) for r in found) == expected


def test_links_lose_no_pair_whatever_the_partitions(spark):
    rng = np.random.default_rng(2)
    seeds = rng.integers(0, 1 << 63, 60)
    prints = {0, -1}
    for seed in seeds.tolist():
        for _ in range(12):
            prints.add(seed ^ int(sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 7), replace=False))))
    prints = sorted(prints)
    fps = spark.createDataFrame([(p,) for p in prints], "fp long")
    expected = plain.groups(prints, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 4)
    order = simhash.bit_order(fps)
    assert sorted(order) == list(range(64))
    distances = simhash.block_distances(fps, order)
    for count, block in ((len(prints), 2048), (10**9, 2048), (1000, 5)):
        partitions = simhash.allocate(distances, order, count, 4)
        assert sum(t + 1 for _, t in partitions) == 5
        links = simhash.links(simhash.tiles(simhash.entries(fps, partitions), block), 4)
        found = {r["node"]: r["component"] for r in simhash.components(links).collect()}
        labels = [found.get(p, p) for p in prints]
        assert len(set(zip(labels, expected))) == len(set(labels)) == len(set(expected))


def test_personal_data(docs, rows):
    found = pii.find(docs).collect()
    spans = lambda row: tuple((s["kind"], s["s"], s["e"]) for s in row["base"])
    assert Counter((r["doc_id"], spans(r)) for r in found) == Counter((r[0], tuple(plain.base_spans(r[1]))) for r in rows)


@pytest.mark.parametrize(
    "text, spans",
    [
        ("1 2" * 40_000, []),  # one long run of digits
        ("a" * 200_000 + "@", []),
        ("+1" + " (" * 50_000, []),
        ("a@b" + ".c" * 50_000, [("email", 0, 100_003)]),
        ("1.2.3.4," * 2_000, [("ip", 8 * i, 8 * i + 7) for i in range(2_000)]),
    ],
)
def test_personal_data_in_hostile_texts(spark, text, spans):
    found = pii.find(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert [(s["kind"], s["s"], s["e"]) for s in found["base"]] == spans


def test_trees_add_assigned_secrets_and_redact(spark):
    import random

    rng = random.Random(4)
    rows = []
    for i in range(400):
        secret = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        odd = "".join(rng.choice("abcdefghijk0123456789") for _ in range(18))
        rows.append((i, f"one {odd} two {rng.randrange(10**7, 10**9)}" + (f' token = "{secret}" x me@site.org' if i % 2 else "")))
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    model = pii.learn(docs)
    found = pii.redact(docs, model).collect()
    marked = sum("[secret]" in r["text"] for r in found if r["doc_id"] % 2)
    assert marked >= 190
    assert not any("[secret]" in r["text"] for r in found if not r["doc_id"] % 2)
    assert all(("[email]" in r["text"]) == bool(r["doc_id"] % 2) for r in found)
    assert pii.redact(spark.createDataFrame([(1, None)], "doc_id int, text string"), model).first()["text"] is None


def test_all_candidates_reach_the_fit(spark, monkeypatch):
    import random

    rng = random.Random(5)
    kinds = ["0123456789", "abcdefghij", "ABCDEFGHIJ", "_/+-"]
    one = lambda: "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(60, 99))) + "0"
    docs = spark.createDataFrame([(i, " ".join(one() for _ in range(300))) for i in range(100)], "doc_id int, text string")
    different = pii.find(docs).select(F.explode("candidates").alias("x")).select("x.kind_name", "x.f").distinct().count()

    class Seen(Exception):
        pass

    class Fit:
        def __init__(self, **options):
            pass

        def fit(self, vectors):
            raise Seen(vectors.count())

    monkeypatch.setattr(pii, "GBTClassifier", Fit)
    telling = docs.unionByName(spark.createDataFrame([(-1, 'token = "' + "a1" * 12 + '"')], docs.schema))
    with pytest.raises(Seen) as seen:
        pii.learn(telling)
    assert different > 22_000 and seen.value.args[0] > 0.7 * different


def test_empty_tables(spark):
    none = spark.createDataFrame([], plain.SCHEMA)
    assert bpe.decode(bpe.encode(none, RANKS, PATTERN), RANKS, PATTERN).count() == 0
    assert packing.pack(packing.pieces(none, WORD_FILE)).count() == 0
    assert repeats.remove_repeats(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert rules.statistics(none).count() == 0
    assert pii.with_spans(pii.find(none), pii.learn(none)).count() == 0


def _many_spans(n, seed=3):
    """A text with ``n`` mixed values between words, some next to each other, and characters outside the first plane."""
    draw = random.Random(seed)
    values = [
        lambda i: f"u{i}@m{i}.example.org", lambda i: f"10.{i % 300}.3.4", lambda i: f"+49 30 {1000000 + i}",
        lambda i: "4111 1111 1111 1111", lambda i: f"token=aB3dE5fG7hJ9kL{i:05d}", lambda i: f"name{i}@host", lambda i: "\U0001f600é",
    ]
    return " ".join(draw.choice(values)(i) + draw.choice(["", ",", " word", "\U0001f600"]) for i in range(n))


@pytest.mark.parametrize("n", [60, 700])
def test_many_spans_in_a_long_text_equal_the_plain_search(spark, n):
    """Slices of arrays, pieces of texts and the look-up by halving: same spans, same overlaps, same redacted text."""
    text = _many_spans(n)
    docs = spark.createDataFrame([(1, text), (2, "a@b.cd")], "doc_id int, text string")
    found = pii.find(docs).where("doc_id = 1").first()
    base = [(x["kind"], x["s"], x["e"]) for x in found["base"]]
    assert base == plain.base_spans(text)
    for x in found["candidates"]:
        assert re.fullmatch(pii.PROPOSED[x["kind_name"]], text[x["s"] : x["e"]])
    everything = pii.Model(((1.0, 0.0),), {kind: 0.0 for kind in pii.PROPOSED})
    spans = [(x["kind"], x["s"], x["e"]) for x in pii.with_spans(pii.find(docs), everything).where("doc_id = 1").first()["spans"]]
    free = [
        (x["kind_name"], x["s"], x["e"]) for x in found["candidates"] if not any(s < x["e"] and x["s"] < e for _, s, e in base)
    ]
    assert spans == base + free and free
    out, at = "", 0
    for s, e, kind in sorted((s, e, kind) for kind, s, e in spans):
        out += text[at : max(s, at)] + ("" if s < at else f"[{kind}]")
        at = max(at, e)
    redacted = {r["doc_id"]: r["text"] for r in pii.redact(docs, everything).collect()}
    assert redacted == {1: out + text[at:], 2: "[email]"}


def test_word_hashes_do_not_depend_on_parts(monkeypatch):
    texts = [b"", b" \t", b"a" * 16, b"a" * 16 + b" b", b"x " * 50 + b"y" * 300 + b" x", b" " * 40 + "é ü".encode(), b"b\x0bx\nx"]
    for part in (16, 64, 1 << 20):
        monkeypatch.setattr(repeats, "PART", part)
        known = {}
        for text in texts:
            own, words_ = repeats.word_hashes(text).tolist(), text.split()
            assert len(own) == len(words_)
            for word, value in zip(words_, own):
                assert known.setdefault(word, value) == value
        assert len(set(known.values())) == len(known)
