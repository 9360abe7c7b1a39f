"""The registered queries of the training-data operators, with the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.llm import (
    centroids,
    decontamination,
    divergence,
    line_rules,
    near_duplicates,
    oracles,
    pii,
    piece_codec,
    quality_model,
    secret_scan,
    sharding,
    token_files,
    top_search,
    warc,
)
from archivolt.llm._common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and the verdict of cross-document line frequency."""
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words"]
    return line_rules.line_quality(table(spark, sf_dir, "documents")).select(*columns)


def op2_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under a model of the documents labelled good, and the verdict by language."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_model.classify(table(spark, sf_dir, "documents"), good)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base patterns, and strings that pass the randomness tests."""
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    base = secret_scan.KINDS[:3]
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(secret_scan.KINDS).alias("spans"),
    )


def tokenizer_path(name: str) -> str:
    """Path of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every whole text, and the text that they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_codec.encode_decode(docs, tokenizer_path("piece_bpe_32k.model"), carry=["doc_id"])


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards whose row counts differ by one at most."""
    docs = table(spark, sf_dir, "documents").withColumn("law", F.lit("rows"))
    found = sharding.text_digests(sharding.shuffle_into_shards(docs, 16), carry=["doc_id", "law", "shard", "slot"])
    return found.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, and the terms that disclose it."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    counts = [
        F.size(F.filter("base", lambda x: x["k"] == 0)).cast("long").alias("n_email"),
        F.size(F.filter("base", lambda x: x["k"] == 1)).cast("long").alias("n_ip"),
        F.size(F.filter("base", lambda x: x["k"] == 2)).cast("long").alias("n_card"),
        F.size(F.filter("base", lambda x: x["k"] == 3)).cast("long").alias("n_phone"),
    ]
    return found.select("doc_id", *counts, F.sha2(pii.span_text(), 256).alias("base_sha256"), pii.span_text(terms="terms").alias("spans"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to seekable files in ascending order of doc_id and read back from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.token_file_round_trip(docs, tokenizer_path("byte_bpe_50k.json"), end_id=2)


def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page's response."""
    responses = warc.responses_of_pages(table(spark, sf_dir, "pages"))
    found = warc.derive_records(responses, carry=["page_id"])
    return found.select(
        "page_id", "warc_type", "record_id", "refers_to", "target_uri", "source_digest", "block_digest", "content_type", "content_length", F.sha2("block", 256).alias("block_sha256")
    )


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns of benchmark decontamination over all documents."""
    found = decontamination.decontaminate(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), carry=["doc_id"]
    )
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors of 64 components after five rounds of Lloyd with 40 centroids."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of every language by divergence from each other, and the terms that mark them in their language."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_top_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors of highest inner product for every row whose id is divisible by 50, among all rows."""
    return top_search.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def queries() -> dict[str, Query]:
    """Name to callable."""
    return {
        "op1_line_quality": op1_line_quality,
        "op2_quality_model": op2_quality_model,
        "op3_secret_scan": op3_secret_scan,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_sharding": op5_sharding,
        "op6_pii": op6_pii,
        "op7_token_files": op7_token_files,
        "op8_warc_derivatives": op8_warc_derivatives,
        "op9_near_duplicates": op9_near_duplicates,
        "op10_decontamination": op10_decontamination,
        "op11_centroids": op11_centroids,
        "op12_divergence": op12_divergence,
        "op13_top_search": op13_top_search,
    }


def oracle_sql() -> dict[str, str]:
    """Name to DuckDB SQL; the other queries are tested against brute force."""
    return dict(oracles.ORACLES)
