"""From raw documents to packed token sequences: five stages, each over all that the one before it kept.

Every stage but the last returns the columns of ``documents``. A row is known by its place in the table that the stage reads
(a written table, so the place is the same however often a task runs): ids may be null or repeat.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import packing, pii, repeats, rules, simhash
from tidemark.llm.common import prepare, read
from tidemark.session import recorded_stages, remove_stages, stage_table

#: What the stage before has written for its own use.
_inner: list[str] = []


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage whose inner tables go when the next one begins: its result has been written, and is read again, by then."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove_stages(spark, _inner)
        with recorded_stages() as made:
            out = work(spark, docs, sf_dir)
        _inner.extend(made)
        return out

    return run_stage


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``n_chars`` of the new text, as far as the table has that column."""
    length = {"n_chars": F.length("text").cast("long")} if "n_chars" in columns else {}
    return docs.withColumns(length).select(*columns)


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the decision list learnt from ``labels`` reject go."""
    prepare(spark)
    rows = rules.described(docs)
    return rules.keep(rows, rules.learn(rows, read(spark, sf_dir, "labels")))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of fingerprints linked by 4 or fewer differing bits (4-word shingles) the document with the smallest id stays (nulls first; of equal ids the first row)."""
    prepare(spark)
    # Written once: another job over docs may deal the files to other partitions, and so number the rows anew.
    place = F.struct(F.col("doc_id"), F.monotonically_increasing_id().alias("row"))
    placed = stage_table(docs.select(F.struct("*").alias("_row"), "text", place.alias("_place")), "placed")
    found = simhash.near_duplicates(placed, words=4, limit=4, id_column="_place")
    stays = found.select(F.col("component_id").alias("_place")).distinct()
    return placed.join(stays, "_place", "left_semi").select("_row.*")


@_stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated windows go; a text without any stays as it is, one without other words goes."""
    prepare(spark)
    others = [F.col(c) for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others, F.col("text").isNull().alias("_no_text")).alias("_row"), "text")
    found = repeats.kept_words(rows, id_column="_row", as_is=True).where("n_removed = 0 OR n_removed < n_words")
    text = F.when(~F.col("doc_id._no_text"), F.decode("kept", "UTF-8"))
    return _with_length(found.select("doc_id.*", text.alias("text")), docs.columns)


@_stage
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    prepare(spark)
    return _with_length(pii.redact(docs, pii.learn(docs)), docs.columns)


@_stage
def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents (``ids``: little-endian unsigned 32-bit numbers) and their places in sequences of 2048."""
    prepare(spark)
    pieces = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    pieces = pieces.withColumns({"ids_crc32": F.crc32("ids"), "row": F.monotonically_increasing_id()})
    pieces = stage_table(pieces, "token-pieces")
    places = packing.pack(pieces.select("row", "length")).drop("length")  # only lengths are packed
    return pieces.join(places, "row").drop("row")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packed_sequences", packed_sequences),
]

#: No SQL for the learnt and hashed stages; the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
