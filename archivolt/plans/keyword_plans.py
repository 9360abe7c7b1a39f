"""Keyword queries over ``documents`` (surface words stand in for lemmas: the table has no morphology)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from archivolt.operators import keywords as K
from archivolt.operators.tasks import dealt


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ker_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted top keywords of every document."""
    return K.weighted_top_lemmas(K.surface_words(dealt(_docs(spark, sf_dir).select("doc_id", "text"), "text", "doc_id")))


_STOP = ", ".join(f"'{x}'" for x in K.ADMIN_LEMMAS)

KER_SQL = f"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos
  FROM (SELECT doc_id, string_split_regex(lower(trim(text)), '[ \\t\\n\\x0B\\f\\r]+') AS w FROM documents)),
counted AS (
  SELECT doc_id, word, count(*) AS n, min(pos) AS first_pos FROM words
  WHERE regexp_full_match(word, '\\p{{L}}+') AND length(word) > 1 GROUP BY doc_id, word),
head AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first_pos) AS rank_n FROM counted
  QUALIFY rank_n <= 20),
scored AS (
  SELECT doc_id, word, rank_n, CASE WHEN word IN ({_STOP}) THEN n * CAST(0.3 AS DOUBLE) ELSE CAST(n AS DOUBLE) END AS score
  FROM head),
ranked AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, rank_n) AS INTEGER) AS rank, word AS keyword, score
  FROM scored)
SELECT doc_id, rank, keyword, score FROM ranked WHERE rank <= 10
"""

QUERIES = {"ker_topk": ker_topk}
ORACLES = {"ker_topk": KER_SQL}
