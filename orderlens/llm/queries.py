"""The registered queries of this subpackage, one for each operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (align, ann, bpe, chat, exact_dedup, langid, lattice_lm, lexical_rank, near_dedup, packing, scratch,
               suffix_dedup, token_counts, token_files)
from .ship import ship

BPE_JSON = public_tokenizers.path("byte_bpe_50k.json")
BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), BPE_JSON)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.new_path(spark, "token-files")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path, BPE_JSON)
    return token_files.checksums(token_files.read_documents(spark, path))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents")).drop("uid")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # A conversation whose texts look like the template itself.
    odd = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    formatted = scratch.materialise(chat.segments(turns.unionByName(odd)), "chat")
    return chat.read_turns(formatted).drop("valid")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), BPE_RANKS)


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "id % 100 = 0", k=10)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=80)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~langid.held_out()))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), BPE_JSON, rule="first")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_rank.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.scores(_table(spark, sf_dir, "documents"), PIECES)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignments(_table(spark, sf_dir, "documents"), BPE_JSON, PIECES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_token_files": op2_token_files,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_chat": op4_chat,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_near_dedup": op7_near_dedup,
    "op8_language_id": op8_language_id,
    "op9_token_counts": op9_token_counts,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_lm_scoring": op12_lm_scoring,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op4_chat": r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok'
  FROM range(2) r(i)),
f AS (
  -- headings and closings add "### Role: " and "</turn>" with a line feed; escapes add one character for
  -- each backslash, each "##" and each "</turn>".
  SELECT *, length(text) + 4 + length(role) + 2 + 8
    + length(text) - length(replace(text, '\', ''))
    + len(regexp_extract_all(text, '</turn>'))
    + len(list_filter(range(1, length(text)), lambda i: text[i:i + 2] = '###')) AS chars
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id""",
    "op11_lexical_search": r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
d AS (SELECT r, len(terms) AS n FROM t WHERE len(terms) > 0),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM d),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM t) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE item_id IS NOT NULL)
  GROUP BY ALL),
s AS (
  SELECT item_id, p.r,
    sum(q * floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT
        * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN p USING (term) JOIN d ON d.r = p.r CROSS JOIN c
  GROUP BY item_id, p.r),
o AS (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM s JOIN t ON t.r = s.r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 20""",
}
