"""Readers of JSON records, run folders, nested vocabularies, review sheets and configuration."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from archivolt.functions.scalars import stems
from archivolt.operators import versions

LINE = "page string, line string, text string, categ string, quality_score double, lemma string, upos string, unit string"
RECORD = f"schema_version string, doc_id string, lines array<struct<{LINE.replace(' string', ':string').replace(' double', ':double')}>>, content struct<text:string>"
ENRICHED = (
    "file_id string, page string, line string, categ string, quality_score double, original_text string,"
    " enrichment struct<extracted_keywords_cs:array<string>,extracted_keywords_en:array<string>,teater_category:string,confidence_score:double>"
)


def records(spark: SparkSession, path: str) -> DataFrame:
    """Document records, one file each; unreadable files have ``_corrupt_record``."""
    return spark.read.schema(RECORD + ", _corrupt_record string").option("multiLine", True).json(path)


def record_lines(frame: DataFrame) -> DataFrame:
    """(doc_id, pos, page, line, text, categ, quality_score, lemma, upos): lines with text that aren't Trash or Empty; the
    record's plain text where it has none. The page is 1 where it is missing. Records without text give no rows."""
    rows = frame.select("doc_id", "content", F.posexplode_outer("lines").alias("pos", "r"))
    text = F.trim(F.coalesce("r.text", F.lit("")))
    kept = rows.where((text != "") & ~F.coalesce("r.categ", F.lit("")).isin("Trash", "Empty"))
    kept = kept.select("doc_id", "pos", F.coalesce("r.page", F.lit("1")).alias("page"), "r.line", text.alias("text"), "r.categ", "r.quality_score", "r.lemma", "r.upos")
    bare = frame.join(kept.select("doc_id").distinct(), "doc_id", "left_anti").where(F.trim(F.coalesce("content.text", F.lit(""))) != "")
    body = bare.select("doc_id", F.posexplode(F.split("content.text", r"\r?\n")).alias("pos", "t")).where(F.trim("t") != "")
    null = F.lit(None).cast("string")
    body = body.select("doc_id", "pos", F.lit("1").alias("page"), (F.col("pos") + 1).cast("string").alias("line"), F.trim("t").alias("text"), null.alias("categ"), F.lit(None).cast("double").alias("quality_score"), null.alias("lemma"), null.alias("upos"))
    return kept.unionByName(body)


def empty_records(frame: DataFrame) -> DataFrame:
    """(doc_id): records with neither lines nor a text, which can't be read."""
    blank = F.trim(F.coalesce("content.text", F.lit(""))) == ""
    return frame.where(blank & (F.size(F.coalesce("lines", F.array().cast(frame.schema["lines"].dataType))) <= 0)).select("doc_id")


def taxonomy(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The frames of a configuration file: themes (theme, priority, in_prompt), maps and labels (rule, ...), notes (rule,
    status), covers (rule), tie_break (pos, theme). Keys of rules are in canonical form; other keys are no themes."""
    text = spark.read.text(path, wholetext=True)
    top = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("theme", "raw"))
    settings = text.select(F.get_json_object("value", "$._settings").alias("s"), F.get_json_object("value", "$._exclusions").alias("x"))
    listed = lambda at: settings.select(F.posexplode(F.from_json(F.get_json_object("s", at), "array<string>")).alias("pos", "value"))

    def ruled(name: str, kind: str, value: str) -> DataFrame:
        pairs = settings.select(F.explode(F.from_json(F.get_json_object("s", f"$.{name}"), "map<string,string>")).alias("k", value))
        return pairs.select(F.concat(F.lit(f"{kind}:"), "k").alias("rule"), value)

    theme = F.from_json("raw", "priority int, in_prompt boolean")
    notes = settings.select(F.explode(F.from_json("x", "map<string,struct<status:string,reason:string>>")).alias("k", "n"))
    return {
        "themes": top.where(~F.startswith("theme", F.lit("_"))).select("theme", F.coalesce(theme["priority"], F.lit(0)).alias("priority"), theme["in_prompt"].alias("in_prompt")),
        "maps": ruled("heslar_map", "heslar", "theme").union(ruled("teater_branch_map", "teater", "theme")),
        "labels": ruled("heslar_labels", "heslar", "label").union(ruled("teater_branch_labels", "teater", "label")),
        "notes": notes.where(~F.startswith("k", F.lit("_"))).select(exclusion_key(F.col("k")).alias("rule"), "n.status", "n.reason"),
        "covers": listed("$.geo_guardrail.covers").select(F.col("value").alias("rule")),
        "tie_break": listed("$.tie_break").select("pos", F.col("value").alias("theme")),
    }


def run_picks(spark: SparkSession, path: str, pattern: str = "*/*_enriched.json") -> tuple[DataFrame, DataFrame]:
    """(picks, unreadable) of run folders, ``path``/<run>/*_enriched.json: run, file_id, page, line, category, confidence,
    supported, file, pos. Supported: the category shares a word stem with the line's text or keywords."""
    raw = spark.read.schema(ENRICHED + ", _corrupt_record string").option("multiLine", True).json(f"{path}/{pattern}")
    file = F.col("_metadata.file_path")
    raw = raw.withColumns({"file": F.regexp_extract(file, r"([^/]+)$", 1), "run": F.regexp_extract(file, r"([^/]+)/[^/]+$", 1), "pos": F.monotonically_increasing_id()}).cache()
    e = F.col("enrichment")
    context = F.concat_ws(" ", F.coalesce("original_text", F.lit("")), F.array_join(F.coalesce(e["extracted_keywords_cs"], F.array().cast("array<string>")), " "))
    supported = F.arrays_overlap(stems(e["teater_category"]), stems(context))
    picks = raw.where("_corrupt_record is null").select(
        "run", "file_id", F.col("page").try_cast("int").alias("page"), F.col("line").try_cast("int").alias("line"), e["teater_category"].alias("category"),
        e["confidence_score"].alias("confidence"), supported.alias("supported"), "file", "pos",
    )
    picks = picks.where("page is not null and line is not null and category is not null")
    return picks, raw.where("_corrupt_record is not null").select("run", "file").distinct()


def nested_terms(spark: SparkSession, path: str) -> DataFrame:
    """(theme, label, entry): terms of a nested vocabulary file; keys that begin with _ are left out."""
    entry = "struct<en:string,sub:string,source:string,source_id:string,bare_cs:string>"
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string,map<string,{entry}>>").alias("m"))
    themes = text.select(F.posexplode(F.map_entries("m")).alias("theme_rank", "t")).where(~F.startswith("t.key", F.lit("_")))
    terms = themes.select("theme_rank", F.col("t.key").alias("theme"), F.posexplode(F.map_entries("t.value")).alias("term_rank", "e"))
    return terms.select("theme_rank", "theme", "term_rank", F.col("e.key").alias("cs"), "e.value.*")


def flat_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """Records of a flat vocabulary archive, with markup stripped from the edges of labels."""
    fields = "cs:string,en:string,de:string,source:string,source_id:string,uri:string,scheme:string,sub:string,broader:array<string>,sort:int,alt_cs:array<string>,alt_en:array<string>,note_cs:string,note_en:string,exact_match:array<string>,close_match:array<string>,broad_match:array<string>,related_match:array<string>"
    raw = spark.read.schema(f"terms array<struct<{fields}>>").option("multiLine", True).json(path).select(F.explode("terms").alias("t")).select("t.*")
    return raw.withColumns({c: clean_label(F.col(c)) for c in ("cs", "en", "de")})


def clean_label(value: Column) -> Column:
    """A label without * and _ at its edges; null when nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(F.trim(value), r"^[*_]+\s*|\s*[*_]+$", "")), F.lit(""))


def clean_alternatives(values: Column, preferred: Column) -> Column:
    """Distinct cleaned labels in order, without the preferred one."""
    kept = F.filter(F.transform(values, clean_label), lambda v: v.isNotNull() & (F.lower(v) != F.lower(F.coalesce(preferred, F.lit("")))))
    return F.array_distinct(kept)


def review_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A review sheet with ``decision``: the reviewer's verdict, else the automatic one."""
    raw = spark.read.option("header", True).option("multiLine", True).csv(path)
    own = lambda c: F.nullif(F.trim(F.col(c)), F.lit("")) if c in raw.columns else F.lit(None).cast("string")
    return raw.withColumn("decision", F.coalesce(own("verdict"), own("auto_verdict")))


def accepted_halves(sheet: DataFrame) -> DataFrame:
    """(half, composite) of a review sheet's accepted rows; a half that is accepted for two composites can't map back to one,
    and is left out."""
    half, composite = F.trim("half"), F.trim("composite")
    rows = sheet.where((F.col("decision") == "accept") & (half != "") & (composite != "")).select(half.alias("half"), composite.alias("composite"))
    return rows.groupBy("half").agg(F.min("composite").alias("composite"), F.max("composite").alias("__m")).where("composite = __m").drop("__m")


def exclusion_key(key: Column) -> Column:
    """Canonical form of an exclusion's key: a branch id, or the name of a list."""
    text = F.trim(key)
    kind, rest = F.lower(F.split_part(text, F.lit(":"), F.lit(1))), F.trim(F.regexp_replace(text, "^[^:]*:", ""))
    return (
        F.when(F.lower(text).rlike("^(teater|heslar):"), F.concat(kind, F.lit(":"), rest))
        .when(F.startswith(F.lower(text), F.lit("teater ")), F.concat(F.lit("teater:"), F.trim(F.regexp_replace(text, r"^\S+\s+", ""))))
        .when(text.rlike("^[0-9]+$"), F.concat(F.lit("teater:"), text))
        .otherwise(F.concat(F.lit("heslar:"), text))
    )


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """A vocabulary table that was built before, its newest version if it has any; reading never builds or harvests one, so a
    missing table raises."""
    try:
        if versions.numbers(spark, path):
            return versions.read(spark, path)
        return spark.read.parquet(path)
    except AnalysisException as problem:
        raise FileNotFoundError(f"{path}: build the vocabulary first") from problem


def vocabulary_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of the side-car of a vocabulary, ``<path>.meta.json``; values that are no text stay JSON."""
    text = spark.read.text(f"{path}.meta.json", wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "value"))


def ordered_terms(terms: DataFrame, withheld: DataFrame, sentinel: str) -> DataFrame:
    """(pos, theme, cs, ids): the terms that a prompt offers, the sentinel first, each with its own id and those it displaced.

    ``terms``: theme_rank, term_rank, theme, cs, source, source_id, discarded (source, id). ``withheld``: theme, lower case.
    """
    shown = terms.join(withheld.select(F.col("theme").alias("__t")).distinct(), F.lower("theme") == F.col("__t"), "left_anti")
    own = F.when(F.col("source_id").isNotNull(), F.array(F.struct("source", F.col("source_id").alias("id")))).otherwise(F.array().cast("array<struct<source:string,id:string>>"))
    lost = F.transform("discarded", lambda d: F.struct(d["source"].alias("source"), d["id"].alias("id")))
    every = F.concat(own, F.coalesce(lost, F.array().cast("array<struct<source:string,id:string>>")))
    # a set of texts is hashed, one of structs would compare all pairs
    texts = F.array_distinct(F.transform(every, lambda x: F.to_json(x)))
    shown = shown.withColumn("ids", F.from_json(F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")), "array<struct<source:string,id:string>>"))
    by = Window.partitionBy("theme_rank").orderBy("term_rank", "cs")
    sizes = shown.groupBy("theme_rank").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("theme_rank", F.coalesce(F.sum("n").over(Window.orderBy("theme_rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rows = shown.withColumn("k", F.row_number().over(by)).join(before, "theme_rank").select((F.col("before") + F.col("k")).cast("int").alias("pos"), "theme", "cs", "ids")
    first = terms.sparkSession.createDataFrame([(0, None, sentinel, [])], rows.schema)
    return first.union(rows)
