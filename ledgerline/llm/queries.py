"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import alignment, chat, edit_counts, langid, line_dedup, lm, near_dups, packing, pieces, quality, rules, top_k, whitening
from ledgerline.llm.frames import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def register(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def tokenizer(name: str) -> str:
    return public_tokenizers.path(name)


@register
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


PLANTED_CHAT = "\\### Assistant: </turn> ok"


@register
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = [(-7, 0, "user", PLANTED_CHAT), (-7, 1, "assistant", PLANTED_CHAT)]
    records = chat.as_records(rows.unionByName(spark.createDataFrame(planted, rows.schema)))
    return chat.format_records(records).select("conv_id", chat.read_back("chat").alias("d")).select("conv_id", "d.*")


ORACLE["op3_chat_format"] = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *,
    length(text) + (length(text) - length(replace(text, '\', '')))
      + (length(text) - length(replace(text, '#', ''))) - len(regexp_extract_all(text, '#+'))
      + (length(text) - length(replace(text, '</', ''))) // 2 AS text_chars,
    length(role) + (length(role) - length(replace(role, '\', '')))
      + (length(role) - length(replace(role, '#', ''))) - len(regexp_extract_all(role, '#+'))
      + (length(role) - length(replace(role, '</', ''))) // 2
      + (length(role) - length(replace(role, ':', ''))) AS role_chars
  FROM said
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_chars + role_chars + length('### : </turn>') + 1) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@register
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE))


@register
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest_documents(table(spark, sf_dir, "documents"), tokenizer(PIECE_BPE))


@register
def op6_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


ORACLE["op6_pivot_top_k"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@register
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE))


@register
def op8_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_counts.count_documents(edit_counts.drawn_edits(table(spark, sf_dir, "documents")), tokenizer(BYTE_BPE))


@register
def op9_minhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cleaned = line_dedup.LineStore(spark, min_docs=10, min_chars=1).insert(docs).clean(docs)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


ORACLE["op11_line_dedup"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS n, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), placed AS (
  SELECT n, doc_id, lines, unnest(range(1, len(lines) + 1)) AS k FROM texts
), keyed AS (
  SELECT n, doc_id, k, lines[k] AS line,
    translate(trim(lines[k], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM placed
), frequent AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f ON keyed.key = f.key GROUP BY n
"""


@register
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"), k=4, scale=256)


@register
def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digest_documents(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE), tokenizer(PIECE_BPE))
