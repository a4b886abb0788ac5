"""The pipeline stage by stage against plain versions, and as a whole."""

import os

import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tests.llm import plain
from tidemark.llm import pii
from tidemark.session import stage_table

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not there")


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage_table(stage(spark, docs, SF), name)
        out.append((name, docs, after))
        docs = after
    return out


def rows_of(df):
    return df.select("doc_id", "text").collect()


def test_stages_are_five_and_keep_the_columns(stages):
    assert [n for n, _, _ in stages] == [n for n, _ in corpus_pipeline.STAGES] and len(stages) == 5
    for _, before, after in stages[:-1]:
        assert after.schema.names == before.schema.names
        assert after.count() <= before.count()


def test_rejected_documents_go(stages, spark):
    _, before, after = stages[0]
    kept = {r["doc_id"] for r in rows_of(after)}
    for r in rows_of(before):
        assert r["doc_id"] not in kept or not plain.base_statistics(r["text"])[-1]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r["doc_id"] for r in rows_of(before) if labels.get(r["doc_id"]) == 1 and not plain.base_statistics(r["text"])[-1]]
    assert sum(i in kept for i in good) >= 0.97 * len(good)


def test_one_document_of_each_group_stays(stages):
    _, before, after = stages[1]
    rows = sorted((r["doc_id"], r["text"]) for r in rows_of(before))
    labels = plain.groups([plain.fingerprint(t) for _, t in rows], lambda a, b: (a ^ b).bit_count() <= 4)
    assert sorted(r["doc_id"] for r in rows_of(after)) == sorted({rows[label][0] for label in labels})


def test_repeated_windows_go(stages):
    _, before, after = stages[2]
    rows = [(r["doc_id"], r["text"]) for r in rows_of(before)]
    found = {r["doc_id"]: r["text"] for r in rows_of(after)}
    for (doc_id, text), (n, removed, _) in zip(rows, plain.repeats(rows, 35)):
        if removed == 0:
            assert found[doc_id] == text
        elif removed < n:
            assert len(plain.words(found[doc_id])) == n - removed
        else:
            assert doc_id not in found
    assert after.where(F.length("text") != F.col("n_chars")).count() == 0


def test_personal_data_goes(stages):
    _, before, after = stages[3]
    found = {r["doc_id"]: r["text"] for r in rows_of(after)}
    for r in rows_of(before):
        spans = plain.base_spans(r["text"])
        if spans:
            assert all(r["text"][a:b] not in found[r["doc_id"]] for _, a, b in spans)
            assert f"[{spans[0][0]}]" in found[r["doc_id"]]
        elif "[" not in found[r["doc_id"]]:
            assert found[r["doc_id"]] == r["text"]


def test_all_tokens_are_packed(stages):
    _, before, after = stages[4]
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = sum(len(whole.encode(r["text"], add_special_tokens=False).ids) + 1 for r in rows_of(before))
    assert after.agg(F.sum("length")).first()[0] == total
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_stages_take_awkward_documents(spark):
    docs = plain.awkward(spark)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert labels.count() > 0
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[1:]:
            out = stage(spark, stage_table(table, name), SF)
            rows = out.count()
            if name != "packed_sequences":
                assert out.columns == docs.columns and rows <= table.count()
            else:
                assert rows >= table.count()


def test_run_is_registered(spark):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_model_without_trees_keeps_base_spans(spark):
    docs = spark.createDataFrame([(1, "a@b.cd and 1.2.3.4")], "doc_id int, text string")
    assert pii.redact(docs, pii.Model((), {})).first()["text"] == "[email] and [ip]"
