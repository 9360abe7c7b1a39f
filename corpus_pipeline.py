"""The training-data pipeline: five stages, each written as Parquet and read again as the next one's documents.

Defined results, for every stage: without documents there are no rows. Columns of the documents beside the five that the
stages return are dropped, so none can clash. Rows that agree in id and text share a decision and stay or go together; near
duplicates and personal data take ids as numbers that fit a long. A null id is kept unless its text is rejected, and links
with nothing. A null or empty text has no words: the quality rules reject it, the later stages keep it as it is and give it
no tokens. A null host (source) is a host of its own. A very long text is a row like any other; no stage cuts texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.llm import decontamination, line_rules, near_duplicates, pii, piece_codec
from archivolt.llm._common import table, written
from archivolt.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or are depleted; removes lines above their host's limit from the others."""
    found = line_rules.line_quality(docs, with_text=True).where("kept")
    return found.select("doc_id", F.col("clean_text").alias("text"), "lang", "source", F.length("clean_text").cast("long").alias("n_chars"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one text, with the smallest id, of every group of near-duplicate texts; rows go by id and text, so that a text
    never goes because its id has another one."""
    found = near_duplicates.near_duplicates(docs, rows=True).where("not survives")
    out = written(found.select(F.col("doc_id").alias("__av_id"), F.col("text_hash").alias("__av_th")).distinct(), "dropped")
    if out.count() <= near_duplicates.BROADCAST_IDS:
        out = F.broadcast(out)
    same = (F.col("doc_id").cast("long") == F.col("__av_id")) & (F.xxhash64("text") == F.col("__av_th"))
    return docs.join(out, same, "left_anti").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more is benchmark text."""
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), carry=COLUMNS)
    return found.where("not contaminated").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; removes or generalises terms that disclose it."""
    cleaned = pii.sanitise(docs.select(*COLUMNS))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document, checked by what they decode to."""
    found = piece_codec.encode_decode(docs, tokenizer_path("piece_bpe_32k.model"), carry=["doc_id", "lang", "source"], with_ids=True)
    return found.select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", dedup),
    ("decontamination", decontaminate),
    ("personal data", personal_data),
    ("tokens", tokens),
]

#: SQL can't express all stages; tests compare each with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
