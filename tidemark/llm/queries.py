"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    neighbours,
    packing,
    pii,
    prefix_trie,
    quality_model,
    repeats,
    rules,
    sentencepieces,
    simhash,
    tool_calls,
    toxicity,
    whitening,
)
from tidemark.llm.common import read


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    found = bpe.round_trip(read(spark, sf_dir, "documents"), ranks, pattern)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.link(*tool_calls.exchanges(read(spark, sf_dir, "conversations")), tool_calls.REPLY)


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.kept_words(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = pii.with_spans(pii.find(docs), pii.learn(docs))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *map(count, pii.BASE),
        F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def _fold(parts: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op3_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return quality_model.score(docs, labels, _fold(3) == 1)


def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), _fold(5) == 0)
    return found.select("doc_id", "held_out", "score", "predicted")


def op9_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op1_block_matrix_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, conversations = prefix_trie.numbered(read(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns, conversations, F.col("conv_id") - F.col("conv_id") % 100, head))


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentencepieces.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           list_reduce(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]), lambda a, b: a + b) AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM scored
QUALIFY rank <= 20
"""

OP2_SQL = """
WITH RECURSIVE turns AS (
    SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, coalesce(text, '') AS said FROM conversations
), answers AS (
    SELECT conv_id, turn - 1 AS call_id, said FROM turns WHERE role = 'assistant'
), calls AS (
    SELECT a.conv_id, a.turn AS call_id, a.said,
           a.turn - CASE WHEN EXISTS (SELECT 1 FROM answers b WHERE b.conv_id = a.conv_id AND b.call_id = a.turn - 2)
                         THEN 2 ELSE 1 END AS after
    FROM turns a WHERE a.role IS DISTINCT FROM 'assistant'
), steps AS (
    SELECT conv_id, call_id, said, CAST(0 AS BIGINT) AS step FROM calls c
    WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.call_id = c.after)
    UNION ALL
    SELECT c.conv_id, c.call_id, c.said, s.step + 1
    FROM calls c JOIN steps s ON c.conv_id = s.conv_id AND c.after = s.call_id
)
SELECT coalesce(s.conv_id, a.conv_id) AS conv_id, coalesce(s.call_id, a.call_id) AS call_id, s.step,
       CASE WHEN s.conv_id IS NULL THEN 'stray' WHEN a.conv_id IS NULL THEN 'open' ELSE 'linked' END AS status,
       s.conv_id IS NOT NULL AS valid, CAST(0 AS BIGINT) AS repeats,
       '{' || CASE WHEN s.conv_id IS NULL THEN '' ELSE
                '"arguments":{"text":' || CAST(to_json(s.said) AS VARCHAR) || ',"turn":' || s.call_id || '},' END
           || '"id":' || coalesce(s.call_id, a.call_id)
           || CASE WHEN a.conv_id IS NULL THEN '' ELSE ',"result":' || CAST(to_json(a.said) AS VARCHAR) END
           || CASE WHEN s.conv_id IS NULL THEN '' ELSE ',"step":' || s.step || ',"tool":"reply"' END
           || ',"valid":' || CASE WHEN s.conv_id IS NULL THEN 'false' ELSE 'true' END || '}' AS json
FROM steps s FULL JOIN answers a ON s.conv_id = a.conv_id AND s.call_id = a.call_id
"""

OP4_SQL = """
WITH texts AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS w
    FROM texts, unnest(range(1, greatest(1, len(ws) - 33))) AS t(i)
), hits AS (
    SELECT doc_id, i FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)
), gone AS (
    SELECT DISTINCT doc_id, i + k AS p FROM hits, range(35) AS r(k)
), words AS (
    SELECT doc_id, p, ws[p] AS word FROM texts, unnest(range(1, len(ws) + 1)) AS t(p)
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS words
    FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(t.ws) AS BIGINT) AS n_words, CAST(len(t.ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.words, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""

#: crc32 byte by byte: eight shifts for each digit of the id.
_CRC32 = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
    list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substring(CAST(conv_id AS VARCHAR), CAST(i AS INT), 1)) AS BIGINT))),
    lambda c, d: list_reduce(list_concat([xor(c, d)], list_transform(range(8), lambda k: CAST(0 AS BIGINT))),
        lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

OP11_SQL = f"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || ':' || t)) - 1 AS at,
           r || chr(1) || t AS said, CAST(length(t) AS BIGINT) AS chars
    FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL) x
), convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC32} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns) c
), parts AS (
    SELECT c.conv_id, 0 AS own, t.at, t.said, t.chars FROM convs c JOIN turns t ON t.conv_id = c.base AND t.at < c.h
    UNION ALL SELECT c.conv_id, 1, t.at, t.said, t.chars FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.at >= c.h
), rebuilt AS (
    SELECT c.conv_id, coalesce(list(p.said ORDER BY p.own, p.at) FILTER (WHERE p.said IS NOT NULL), []) AS said,
           coalesce(list(p.chars ORDER BY p.own, p.at) FILTER (WHERE p.said IS NOT NULL), []) AS chars
    FROM convs c LEFT JOIN parts p ON p.conv_id = c.conv_id GROUP BY c.conv_id
), members AS (
    SELECT conv_id, CAST(d AS BIGINT) AS depth, said[1:d] AS prefix, coalesce(chars[d], 0) AS chars, d = len(said) AS last
    FROM rebuilt, unnest(range(0, len(said) + 1)) AS r(d)
), nodes AS (
    SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
    FROM members GROUP BY prefix, depth
), kids AS (
    SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2
), below AS (
    SELECT n.prefix[1:d] AS prefix, d AS depth, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS leaves,
           sum((n.n_convs - 1) * n.chars) AS saved
    FROM nodes n LEFT JOIN kids k ON k.prefix = n.prefix AND k.depth = n.depth, unnest(range(0, n.depth + 1)) AS r(d)
    GROUP BY 1, 2
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.prefix = n.prefix AND b.depth = n.depth
    LEFT JOIN kids k ON k.prefix = n.prefix AND k.depth = n.depth
    LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = n.prefix[1:n.depth - 1] AND p.depth = n.depth - 1
"""

QUERIES = {
    "op11_prefix_trie": op11_prefix_trie,
    "op12_sentence_pieces": op12_sentence_pieces,
    "op13_cholesky_whitening": op13_cholesky_whitening,
    "op1_block_matrix_neighbours": op1_block_matrix_neighbours,
    "op10_personal_data": op10_personal_data,
    "op2_tool_calls": op2_tool_calls,
    "op3_fourier_quality": op3_fourier_quality,
    "op4_repeated_passages": op4_repeated_passages,
    "op5_decision_list": op5_decision_list,
    "op6_simhash_pigeonhole": op6_simhash_pigeonhole,
    "op7_bpe_round_trip": op7_bpe_round_trip,
    "op8_toxic_segments": op8_toxic_segments,
    "op9_sum_of_squares_packing": op9_sum_of_squares_packing,
}
SQL: dict[str, str] = {
    "op1_block_matrix_neighbours": OP1_SQL,
    "op2_tool_calls": OP2_SQL,
    "op4_repeated_passages": OP4_SQL,
    "op11_prefix_trie": OP11_SQL,
}
