"""Readers of text, line tables and annotated tokens, by any path that Spark can read.

``files`` frames have the columns path and text, one row for each file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from archivolt.functions.scalars import doc_id_of, safe_double
from archivolt.operators.tasks import dealt

#: Parts of speech that give keywords.
KEYWORD_POS = ("NOUN", "PROPN", "ADJ")
CONLLU = ("id", "form", "lemma", "upos", "xpos", "feats", "head", "deprel", "deps", "misc")


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of text files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def input_kind(path: Column, text: Column) -> Column:
    """Kind of an input by its name's ending, then by its beginning: record, conllu, xml, csv, text; null for others."""
    low, head = F.lower(path), F.ltrim(F.substring(text, 1, 4096))
    return (
        F.when(low.endswith(".json"), "record")
        .when(low.endswith(".conllu"), "conllu")
        .when(low.endswith(".xml"), "xml")
        .when(low.endswith(".csv"), "csv")
        .when(low.endswith(".txt"), "text")
        .when(F.startswith(head, F.lit("{")), "record")
        .when(F.startswith(head, F.lit("<")), "xml")
    )


def text_lines(files: DataFrame) -> DataFrame:
    """Non-empty trimmed lines: (doc_id, pos, page, line, text). A form feed ends a page; lines are numbered from 1 in each."""
    own = dealt(files.select(doc_id_of(F.col("path")).alias("doc_id"), "text"), "text", "doc_id")
    pages = own.select("doc_id", F.posexplode(F.split("text", "\f")).alias("p", "body"))
    lines = pages.select("doc_id", (F.col("p") + 1).cast("string").alias("page"), F.col("p"), F.posexplode(F.split("body", r"\r\n|\r|\n")).alias("i", "raw"))
    kept = lines.withColumn("text", F.trim("raw")).where("text <> ''")
    number = F.row_number().over(Window.partitionBy("doc_id", "p").orderBy("i"))
    order = F.row_number().over(Window.partitionBy("doc_id").orderBy("p", "i"))
    return kept.select("doc_id", order.alias("pos"), "page", number.alias("line"), "text")


def line_table(spark: SparkSession, path: str) -> DataFrame:
    """Line tables with a header: (doc_id, pos, page, line, text, categ, quality_score); the page is page_num, else page, else 1.

    Fails when there is no text column. Columns are read as text; blank quality is unknown.
    """
    raw = spark.read.option("header", True).option("multiLine", True).csv(path)
    raw = raw.toDF(*(c.strip().lstrip("﻿") for c in raw.columns))
    if "text" not in raw.columns:
        raise ValueError("a line table needs a 'text' column")
    own = lambda c: F.nullif(F.trim(F.col(c)), F.lit("")) if c in raw.columns else F.lit(None).cast("string")
    order = F.row_number().over(Window.partitionBy("doc_id").orderBy("at"))
    rows = raw.select(
        F.coalesce(own("file"), doc_id_of(F.col("_metadata.file_path"))).alias("doc_id"),
        F.monotonically_increasing_id().alias("at"),
        F.coalesce(own("page_num"), own("page"), F.lit("1")).alias("page"),
        F.coalesce(own("line_num"), own("line")).alias("line"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(own("categ"), F.lit("")).alias("categ"),
        safe_double(own("quality_score")).alias("quality_score"),
    )
    return rows.withColumn("pos", order).select("doc_id", "pos", "page", "line", "text", "categ", "quality_score")


def conllu_tokens(files: DataFrame) -> DataFrame:
    """(doc_id, sent, pos, and the ten columns) of token lines; comments, short rows and ids with - or . are left out."""
    own = dealt(files.select(doc_id_of(F.col("path")).alias("doc_id"), "text"), "text", "doc_id")
    lines = own.select("doc_id", F.posexplode(F.split("text", r"\r?\n")).alias("pos", "raw"))
    blank = (F.trim("raw") == "").cast("int")
    lines = lines.withColumn("sent", F.sum(blank).over(Window.partitionBy("doc_id").orderBy("pos")))
    cols = F.split(F.trim("raw"), "\t")
    token = lines.where((F.trim("raw") != "") & ~F.startswith(F.trim("raw"), F.lit("#"))).withColumn("c", cols).where(F.size("c") >= 10)
    token = token.where(~F.col("c")[0].rlike("[-.]"))
    return token.select("doc_id", "sent", "pos", *(F.col("c")[i].alias(n) for i, n in enumerate(CONLLU)))


def surface_sentences(tokens: DataFrame) -> DataFrame:
    """(doc_id, sent, text): forms with spaces as SpaceAfter has them."""
    form = F.concat("form", F.when(F.contains("misc", F.lit("SpaceAfter=No")), "").otherwise(" "))
    parts = F.sort_array(F.collect_list(F.struct("pos", form.alias("t"))))
    text = F.trim(F.array_join(F.transform(parts, lambda x: x["t"]), ""))
    return tokens.groupBy("doc_id", "sent").agg(text.alias("text")).where("text <> ''")


def keyword_lemmas(tokens: DataFrame, min_length: int = 2) -> DataFrame:
    """(doc_id, pos, word): lower-cased alphabetic lemmas of nouns, proper nouns and adjectives."""
    fit = F.col("upos").isin(*KEYWORD_POS) & (F.col("lemma") != "_") & (F.length("lemma") >= min_length) & F.col("lemma").rlike(r"^\p{L}+$")
    return tokens.where(fit).select("doc_id", "pos", F.lower("lemma").alias("word"))
