"""Enrichment: an ordered map over a document's lines through an injected model call, and the checks of its replies."""

from __future__ import annotations

import sys
from collections.abc import Callable

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.functions.scalars import stable_unit

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ITEMS = "doc_id {key}, pos long, status string, reply string"


def stub_reply(line: Column) -> Column:
    """Deterministic reply of a stand-in model: a JSON object whose confidence follows from the line's hash."""
    words = F.filter(F.split(F.lower(line), r"\W+"), lambda w: F.length(w) > 3)
    return F.to_json(
        F.struct(
            F.slice(F.array_distinct(words), 1, 3).alias("extracted_keywords_cs"),
            F.coalesce(F.get(words, F.lit(0)), F.lit("none")).alias("category"),
            F.round(stable_unit(line), 6).alias("confidence_score"),
        )
    )


def enrich_in_order(lines: DataFrame, reply: Callable[[str], str], key: str = "long", max_consecutive_errors: int = 10) -> DataFrame:
    """Calls ``reply`` for each document's lines in order: (doc_id, pos, status, reply).

    Status is processed, error or unprocessed: after ``max_consecutive_errors`` failures in a row a document is given up and
    its further lines are unprocessed. ``lines``: doc_id, pos, prompt. A document is one group, so it bounds a task.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out, failed = [], 0
        for row in pdf.sort_values("pos").itertuples():
            if failed >= max_consecutive_errors:
                out.append((row.doc_id, row.pos, "unprocessed", None))
                continue
            try:
                out.append((row.doc_id, row.pos, "processed", reply(row.prompt)))
                failed = 0
            except Exception as problem:  # noqa: BLE001  any failure of the call is the line's
                out.append((row.doc_id, row.pos, "error", str(problem)))
                failed += 1
        return pd.DataFrame(out, columns=["doc_id", "pos", "status", "reply"])

    return lines.select("doc_id", "pos", "prompt").groupBy("doc_id").applyInPandas(run, ITEMS.format(key=key))


def abort_points(results: DataFrame, max_consecutive_errors: int = 10) -> DataFrame:
    """(doc_id, abort_pos): where a document of recorded outcomes would be given up, by gaps and islands.

    ``results``: doc_id, pos, failed.
    """
    from pyspark.sql import Window

    order = Window.partitionBy("doc_id").orderBy("pos")
    runs = results.withColumn("island", F.sum(F.when(F.col("failed"), 0).otherwise(1)).over(order))
    counted = runs.where("failed").withColumn("k", F.row_number().over(Window.partitionBy("doc_id", "island").orderBy("pos")))
    return counted.where(F.col("k") == max_consecutive_errors).groupBy("doc_id").agg(F.min("pos").alias("abort_pos"))


def clamped(value: Column, least: float = 0.0, most: float = 1.0) -> Column:
    """A number within bounds; null where there is none, as ``least`` and ``greatest`` pass over nulls."""
    return F.when(value.isNotNull() & ~F.isnan(value), F.greatest(F.lit(least), F.least(F.lit(most), value)))


def checked_reply(reply: Column, schema: str) -> Column:
    """Struct of a reply's fields, null where it is no object: confidence clamped to [0, 1]."""
    parsed = F.from_json(reply, schema)
    confidence = clamped(parsed["confidence_score"].try_cast("double"))
    return F.when(parsed.isNotNull() & confidence.isNotNull(), parsed.withField("confidence_score", confidence))


_REPLY = "category string, keywords_cs array<string>, keywords_en array<string>, confidence_score string"


def checked_replies(replies: DataFrame, variants: DataFrame | None = None, *, sentinel: str | None = None) -> DataFrame:
    """The replies with category, keywords_cs, keywords_en, confidence and problem, read leniently from the JSON in ``reply``.

    Confidence is clamped to [0, 1], whether it is a number or text of one. A category that is a variant is replaced by its
    label (``variants``: variant, label; of two labels of one variant the smaller). The sentinel, as a category, has no
    keywords. A reply that is no object, or has no confidence or category, has a problem and nothing else.
    """
    text = F.trim("reply")
    parsed = F.from_json(F.when(F.startswith(text, F.lit("{")) & F.try_parse_json(text).isNotNull(), text), _REPLY)
    confidence = clamped(parsed["confidence_score"].try_cast("double"))
    df = replies.withColumn("__r", parsed).withColumn("__said", F.nullif(F.trim("__r.category"), F.lit("")))
    df = df.withColumn("confidence", confidence)
    label = F.col("__said")
    if variants is not None:
        look = variants.groupBy(F.col("variant").alias("__said")).agg(F.min("label").alias("__label"))
        df, label = df.join(look, "__said", "left"), F.coalesce("__label", "__said")
    problem = F.when(F.col("__r").isNull(), "no object").when(F.col("confidence").isNull(), "no confidence").when(label.isNull(), "no category")
    none = F.array().cast("array<string>")
    silent = label.eqNullSafe(F.lit(sentinel)) if sentinel is not None else F.lit(False)
    words = [F.when(silent, none).otherwise(F.coalesce(f"__r.{c}", none)) for c in ("keywords_cs", "keywords_en")]
    found = {"category": label, "keywords_cs": words[0], "keywords_en": words[1], "confidence": F.col("confidence")}
    return df.select(*replies.columns, *(F.when(problem.isNull(), v).alias(c) for c, v in found.items()), problem.alias("problem"))


def _folded(value: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(value), r"(?U)\s+", " "))


_BARE = r"\s*\([^()]*\)\s*$"
_FIELDS = "page string, category string, keywords string, confidence_score string"


def _keyword_list(raw: Column) -> Column:
    """Keywords of a JSON list, or of one string with separators."""
    listed = F.when(F.startswith(F.ltrim(raw), F.lit("[")), F.from_json(raw, "array<string>")).otherwise(F.split(raw, "[;,]"))
    return F.coalesce(F.filter(F.transform(listed, lambda w: F.trim(w)), lambda w: w != ""), F.array().cast("array<string>"))


def repair_replies(replies: DataFrame, allowed: list[str], id_type: str = "long") -> DataFrame:
    """Items of near-miss document replies: (doc_id, at, page, category, keywords, confidence, problem).

    A bare list counts as the items; keywords may be one string; the category is resolved exactly, by folding, or without
    its bracketed tail. A dropped item has a problem; a reply that is no JSON, has no items, or of which none survives, has
    one row with at = -1. Everything is built-in JSON functions and one join with the labels by their folded form.
    """
    spark = replies.sparkSession
    text = F.trim(F.col("reply"))
    listed = F.when(F.startswith(text, F.lit("[")), text).otherwise(F.get_json_object(text, "$.items"))
    items = F.when(F.startswith(F.ltrim(listed), F.lit("[")), F.from_json(listed, "array<string>"))
    valid = F.try_parse_json("reply").isNotNull()
    read = replies.select(F.col("doc_id").cast(id_type).alias("doc_id"), valid.alias("valid"), items.alias("items"))

    rows = read.where("valid and items is not null").select("doc_id", F.posexplode("items").alias("at", "raw"))
    f = F.from_json(F.when(F.startswith(F.ltrim("raw"), F.lit("{")), F.col("raw")), _FIELDS)
    page = F.nullif(F.trim(F.regexp_replace(f["page"], r"^(-?\d+)\.0+$", "$1")), F.lit(""))
    confidence = clamped(f["confidence_score"].try_cast("double"))
    rows = rows.select(
        "doc_id", "at", f.isNotNull().alias("object"), page.alias("page"), f["category"].alias("said"),
        F.regexp_replace(f["category"], _BARE, "").alias("bare"), _keyword_list(f["keywords"]).alias("keywords"), confidence.alias("confidence"),
    )
    labels = spark.createDataFrame(list(enumerate(allowed)) or [(0, None)], "i int, label string").where("label is not null")
    labels = labels.groupBy(_folded(F.col("label")).alias("f")).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "label"))), lambda x: x["label"]).alias("l"))
    for name in ("said", "bare"):
        look = labels.select(F.col("f").alias(f"__f_{name}"), F.col("l").alias(f"__l_{name}"))
        rows = rows.withColumn(f"__f_{name}", _folded(F.col(name))).join(look, f"__f_{name}", "left")
    found = [F.when(F.array_contains(f"__l_{n}", F.col(n)), F.col(n)).otherwise(F.get(f"__l_{n}", F.lit(0))) for n in ("said", "bare")]
    rows = rows.withColumn("category", F.coalesce(*found))
    problem = F.when(~F.col("object"), "not an object").when(F.col("category").isNull(), "unknown category").when(F.col("confidence").isNull(), "no confidence")
    rows = rows.withColumn("problem", problem)
    columns = ["doc_id", "at", "page", "category", "keywords", "confidence", "problem"]

    whole = read.where("not valid or items is null").select("doc_id", F.when(F.col("valid"), "no items").otherwise("no JSON").alias("problem"))
    none = rows.groupBy("doc_id").agg(F.count_if(F.col("problem").isNull()).alias("good")).where("good = 0").select("doc_id", F.lit("none survived").alias("problem"))
    empty = {"at": F.lit(-1), "page": F.lit(None).cast("string"), "category": F.lit(None).cast("string"), "keywords": F.array().cast("array<string>"), "confidence": F.lit(None).cast("double")}
    return rows.select(*columns).union(whole.union(none).withColumns(empty).select(*columns))


def contributing(items: DataFrame, errors: DataFrame) -> DataFrame:
    """Items of documents without any error: a document's block is written as a whole or not at all."""
    return items.join(errors.select("doc_id").distinct(), "doc_id", "left_anti")
