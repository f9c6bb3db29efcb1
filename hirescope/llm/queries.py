"""The registered corpus queries: name -> (Spark callable, DuckDB SQL or None).

Each runs its operator, with production parameters, over its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.llm import audit, chat, decontaminate, langid, lines, lm, merkle, mixing, periodic, pii, quality, simhash, toxicity
from hirescope.llm.common import table

PROBE = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return chat.chat_digest(given.unionByName(probe))


OP1_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
steps AS (
  SELECT *, coalesce(lag(role) OVER w, 'start') || '>' || role AS step,
         lead(role) OVER w IS NULL AS is_last,
         length(regexp_replace(text, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|/INST\]|INST\]|/s>|s>)', '\1\\\2\3', 'g')) AS text_chars,
         length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'),
                               '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|/INST\]|INST\]|/s>|s>)', '\1\\\2\3', 'g')) AS role_chars
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(12 + role_chars + 1 + text_chars + 11)::BIGINT AS formatted_chars,
       bool_and(step IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user'))
         AND bool_or(is_last AND role = 'assistant') AS valid
FROM steps GROUP BY conv_id
"""


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_digest(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP7_SQL = r"""
WITH words AS (
  SELECT id, is_doc, string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w
  FROM (SELECT doc_id AS id, true AS is_doc, text FROM documents UNION ALL SELECT item_id, false, text FROM benchmark)
  WHERE id IS NOT NULL AND text IS NOT NULL),
items AS (
  SELECT id AS item_id, least(len(w), 5) AS size, w FROM words WHERE NOT is_doc AND w[1] <> ''),
item_shingles AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM items)),
sizes AS (SELECT DISTINCT size FROM items),
doc_shingles AS (
  SELECT DISTINCT doc_id, size, array_to_string(w[i:i + size - 1], ' ') AS shingle
  FROM (SELECT id AS doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, sizes WHERE is_doc)),
totals AS (SELECT item_id, count(*) AS n_shingles FROM item_shingles GROUP BY item_id),
found AS (
  SELECT doc_id, item_id, count(*) AS n_found
  FROM doc_shingles JOIN item_shingles USING (size, shingle) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_found, n_found / n_shingles AS containment
FROM found JOIN totals USING (item_id) WHERE n_found >= 0.8 * n_shingles - 1e-9
"""


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digest(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.runs_digest(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprint_digest(spark, table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_chat_format": (op1_chat_format, OP1_SQL),
    "op2_language_id": (op2_language_id, None),
    "op3_pii": (op3_pii, None),
    "op4_toxicity": (op4_toxicity, None),
    "op5_lm_score": (op5_lm_score, None),
    "op6_simhash": (op6_simhash, None),
    "op7_decontamination": (op7_decontamination, OP7_SQL),
    "op8_line_dedup": (op8_line_dedup, None),
    "op9_mixing": (op9_mixing, mixing.oracle_sql()),
    "op10_quality_rules": (op10_quality_rules, None),
    "op11_periodic_runs": (op11_periodic_runs, None),
    "op12_merkle": (op12_merkle, None),
    "op13_filter_audit": (op13_filter_audit, audit.SQL),
}
