"""SentencePiece by prefix table against the library."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import plain
from tidemark.llm import queries, sentencepieces
from tidemark.llm.common import Recent

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [*"abeThrs'12 \n\t\r\x0b\x85\x00éß中😀.,!#<|>İ▁", "the", "   ", "</s>", "<0x0A>"]
ODD = st.lists(st.sampled_from(PARTS), max_size=40).map("".join)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def own(text):
    return memoryview(sentencepieces.pieces(MODEL).encode([text])[0]).cast("i").tolist()


@settings(max_examples=400, deadline=None)
@given(ODD)
def test_equals_the_library(text):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = library.encode(text, add_eos=True)
    assert own(text) == want
    assert sentencepieces.pieces(MODEL).decode(want) == library.decode(want)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 300) | st.integers(0, 31999), max_size=8))
def test_decodes_any_ids_like_the_library(ids):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert sentencepieces.pieces(MODEL).decode(ids) == library.decode(ids)


def test_long_texts(library):
    for text in ("a" * 50_000, " " * 3_000, "ab " * 20_000, "中文" * 9_000, "=" * 9_999, "x" + " " * 777 + "y"):
        assert own(text) == library.encode(text, add_eos=True)


def test_pairs_are_compatible_as_merging_says(library):
    pieces = sentencepieces.pieces(MODEL)
    some = sorted(pieces.text_of)[259::379]
    for a in some:
        for b in some[::7]:
            assert pieces.compatible(a, b) == (pieces.merge(pieces.text_of[a] + pieces.text_of[b])[0] == [a, b])


def test_frames(spark, library):
    rows, docs = plain.awkward_rows(), plain.awkward(spark)
    want = sorted(
        (str(r[0]), ids := library.encode(r[1] or "", add_eos=True), library.decode(ids)) for r in rows
    )
    for made in (sentencepieces.round_trip(docs, MODEL), sentencepieces.decode(sentencepieces.encode(docs, MODEL), MODEL)):
        assert sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in made.collect()) == want
    empty = sentencepieces.round_trip(docs.limit(0), MODEL)
    assert empty.columns == ["doc_id", "ids", "decoded"] and empty.count() == 0


def test_query_equals_the_library(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_sentence_pieces(spark, sf_dir).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for row in docs:
        ids = library.encode(row["text"] or "", add_eos=True)
        assert found[row["doc_id"]] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
    assert len(found) == len(docs)


def test_recent_keeps_what_is_used():
    known = Recent(10)
    for turn in range(20):
        known.turn()
        for word in known.missing({"always", f"word {turn}"}):
            known.put(word, word.upper(), len(word))
            assert word != "always" or turn == 0
        assert known.young["always"] == "ALWAYS"
        assert len(known.young) + len(known.old) <= 6
