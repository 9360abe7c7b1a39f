"""Vocabulary operators: winners, placement, links between composite labels, lookups and label variants.

Records have the columns cs, en, source, source_id, and where needed scheme, sub, sort, broader (ids from the root down).
``norm`` columns are compared labels; pass ``norm=F.lower`` for plain tables or ``norm_label`` for Unicode labels.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivolt.operators.placement import OTHER, place

EXCLUDE = "__exclude__"
Norm = Callable[[Column], Column]


def record_order() -> list[Column]:
    """Canonical order: source, numeric id, id, label."""
    digits = F.when(F.col("source_id").rlike("^[0-9]+$"), F.col("source_id")).otherwise("0")
    return [F.asc("source"), digits.cast("decimal(38,0)").asc(), F.asc("source_id"), F.asc("cs")]


def merge_labels(records: DataFrame, precedence: Sequence[str], norm: Norm = F.lower) -> DataFrame:
    """One record for each label: the earliest source in ``precedence`` wins, then canonical order. Rows without ``en`` stay."""
    rank = F.array_position(F.array(*(F.lit(s) for s in precedence)), F.col("source"))
    df = records.withColumns({"__n": norm(F.col("cs")), "__r": rank}).where((F.col("__n") != "") & (F.col("__r") > 0))
    first = Window.partitionBy("__n").orderBy("__r", *record_order())
    return df.withColumn("__k", F.row_number().over(first)).where("__k = 1").drop("__n", "__r", "__k")


def label_winners(records: DataFrame, norm: Norm = F.lower, root_source: str | None = None) -> DataFrame:
    """One record for each label, with the ids of those it displaced in canonical order (``discarded``: source, id, cs, en).

    Needs both labels; roots (no broader) of ``root_source`` are dropped.
    """
    df = records.where((F.coalesce("cs", F.lit("")) != "") & (F.coalesce("en", F.lit("")) != ""))
    if root_source is not None:
        df = df.where(~((F.col("source") == root_source) & (F.size("broader") <= 0)))
    df = df.withColumn("__n", norm(F.col("cs")))
    order = Window.partitionBy("__n").orderBy(*record_order())
    df = df.withColumn("__k", F.row_number().over(order))
    losers = F.sort_array(F.collect_list(F.when(F.col("__k") > 1, F.struct(F.col("__k").alias("k"), "source", F.col("source_id").alias("id"), "cs", "en"))))
    grouped = df.groupBy("__n").agg(
        F.min_by(F.struct(*(F.col(c) for c in records.columns)), "__k").alias("w"),
        F.transform(losers, lambda x: F.struct(x["source"].alias("source"), x["id"].alias("id"), x["cs"].alias("cs"), x["en"].alias("en"))).alias("discarded"),
    )
    return grouped.select("w.*", "discarded")


def split_qualified(records: DataFrame, qualifiers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(qualified, plain): records with a qualifier get the label "cs (qualifier)" and keep their bare label."""
    q = qualifiers.select("source", F.col("id").alias("source_id"), "qualifier")
    both = records.join(q, ["source", "source_id"], "left")
    label = F.format_string("%s (%s)", "cs", "qualifier")
    flagged = both.where("qualifier is not null").withColumns({"bare_cs": F.col("cs"), "cs": label}).drop("qualifier")
    return flagged, both.where("qualifier is null").withColumn("bare_cs", F.lit(None).cast("string")).drop("qualifier")


def rescue(placed: DataFrame, labels: DataFrame, norm: Norm = F.lower) -> DataFrame:
    """Terms that no rule placed take the theme of their label in ``labels`` (norm, theme)."""
    look = labels.select(F.col("norm").alias("__n"), F.col("theme").alias("__t"))
    both = placed.withColumn("__n", norm(F.col("cs"))).join(look, "__n", "left")
    use = (F.col("theme") == OTHER) & F.col("__t").isNotNull()
    return both.withColumns({"placed_by": F.when(use, "rescue").otherwise(F.col("placed_by")), "theme": F.when(use, F.col("__t")).otherwise(F.col("theme"))}).drop("__n", "__t")


def drop_excluded(placed: DataFrame) -> DataFrame:
    """Records whose rule excludes them go; this comes before labels are made unique, by design."""
    return placed.where(F.col("theme") != EXCLUDE)


def nested_order(placed: DataFrame, boilerplate: Sequence[str], theme_rank: DataFrame) -> DataFrame:
    """Adds theme_rank and term_rank: boilerplate last, then the source's order, then the label."""
    low = F.lower(F.col("cs"))
    admin = F.lit(False)
    for w in boilerplate:
        admin = admin | F.contains(low, F.lit(w))
    order = Window.partitionBy("theme").orderBy(admin.cast("int"), F.coalesce("sort", F.lit(10**9)), "cs")
    return placed.withColumn("term_rank", F.row_number().over(order)).join(theme_rank, "theme", "left")


def build_nested(
    records: DataFrame, overrides: DataFrame, maps: DataFrame, keywords: DataFrame, labels: DataFrame, boilerplate: Sequence[str], theme_rank: DataFrame, norm: Norm = F.lower
) -> tuple[DataFrame, DataFrame]:
    """(nested, audit): records placed, rescued by label, made unique and ordered; the audit has every placed record, also
    those that a rule excludes."""
    audit = rescue(place(records, overrides, maps, keywords), labels, norm)
    return nested_order(label_winners(drop_excluded(audit), norm), boilerplate, theme_rank), audit


def composite_links(terms: DataFrame, separator: str = "/", norm: Norm = F.lower) -> DataFrame:
    """(theme, cs, part_theme, part_cs): labels whose parts between separators are labels themselves."""
    by_label = terms.select(F.col("theme").alias("part_theme"), F.col("cs").alias("part_cs"), norm(F.col("cs")).alias("n"))
    last = Window.partitionBy("n").orderBy(F.desc("part_theme"), F.desc("part_cs"))
    by_label = by_label.withColumn("k", F.row_number().over(last)).where("k = 1").drop("k")
    parts = F.filter(F.transform(F.split("cs", separator), lambda p: F.trim(p)), lambda p: p != "")
    split = terms.select("theme", "cs", parts.alias("parts")).where(F.size("parts") > 1)
    split = split.select("theme", "cs", norm(F.col("cs")).alias("own"), F.explode("parts").alias("part")).withColumn("n", norm(F.col("part")))
    return split.join(by_label, "n").where("n <> own").select("theme", "cs", "part_theme", "part_cs").distinct()


def same_as(links: DataFrame, extra: DataFrame | None = None, suppress: DataFrame | None = None) -> DataFrame:
    """(cs, same_as): symmetric links without suppressed pairs, extra ones added, each once, in order."""
    pair = [F.least("cs", "part_cs").alias("a"), F.greatest("cs", "part_cs").alias("b")]
    found = links.select(*pair)
    if extra is not None:
        found = found.union(extra.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    if suppress is not None:
        found = found.join(suppress.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    found = found.where("a <> b").distinct()
    both = found.select(F.col("a").alias("cs"), F.col("b").alias("other")).union(found.select("b", "a"))
    return both.groupBy("cs").agg(F.sort_array(F.collect_list("other")).alias("same_as"))


def composite_halves(terms: DataFrame, separator: str = "/", norm: Norm = F.lower) -> DataFrame:
    """(cs, half, position, shared_with, n_starts, verdict): parts of composite labels that are no labels."""
    labels = terms.select(F.col("cs").alias("label"), norm(F.col("cs")).alias("n")).distinct()
    parts = F.filter(F.transform(F.split("cs", separator), lambda p: F.trim(p)), lambda p: p != "")
    has = terms.where(F.contains("cs", F.lit(separator))).select("cs", F.posexplode(parts).alias("at", "half"))
    has = has.withColumns({"n": norm(F.col("half")), "position": F.col("at") + 1})
    has = has.join(labels.select("n").distinct(), "n", "left_anti")
    mates = has.groupBy("n").agg(F.sort_array(F.collect_set("cs")).alias("all"))
    has = has.join(mates, "n").withColumn("shared_with", F.array_remove("all", F.col("cs")))
    # every beginning of a label that ends before a space or a separator, so that halves meet it by equality
    at = F.filter(F.sequence(F.lit(1), F.length("n")), lambda i: F.substring("n", i, F.lit(len(separator))).isin(separator) | (F.substring("n", i, F.lit(1)) == " "))
    heads = labels.withColumn("head", F.explode(F.transform(at, lambda i: F.substring("n", F.lit(1), i - 1)))).select("label", F.col("head").alias("n")).distinct()
    begun = has.select("cs", "half", "n").distinct().join(heads, "n").where("label <> cs")
    begun = begun.groupBy("cs", "half").agg(F.count(F.lit(1)).cast("int").alias("n_starts"))
    counted = has.join(begun, ["cs", "half"], "left").groupBy("cs", "half", "position", "shared_with").agg(F.coalesce(F.max("n_starts"), F.lit(0)).alias("n_starts"))
    letters = F.length(F.regexp_replace("half", r"[^\p{L}]", ""))
    verdict = (
        F.when(F.size("shared_with") > 0, "ambiguous")
        .when((letters < 3) | ~F.col("half").rlike(r"^\p{L}"), "fragment")
        .when(F.col("n_starts") > 0, "ambiguous")
        .otherwise("accept")
    )
    return counted.withColumn("verdict", verdict).withColumn("shared_with", F.array_join("shared_with", "; "))


def offered_halves(labels: DataFrame, halves: DataFrame) -> DataFrame:
    """(half, cs): accepted halves whose composite is offered and which are no labels; halves of several composites go."""
    unique = halves.groupBy("half").agg(F.min("cs").alias("cs"), F.count_distinct("cs").alias("n")).where("n = 1").drop("n")
    return unique.join(labels.select("cs"), "cs", "left_semi").join(labels.select(F.col("cs").alias("half")), "half", "left_anti").select("half", "cs")


def case_variants(labels: DataFrame) -> DataFrame:
    """(variant, cs): labels with the first letter's case swapped, where that is unique and no label."""
    first = F.substring("cs", 1, 1)
    swapped = F.when(first == F.upper(first), F.lower(first)).otherwise(F.upper(first))
    own = labels.select("cs").distinct().withColumn("variant", F.concat(swapped, F.expr("substring(cs, 2)")))
    own = own.where((F.col("variant") != F.col("cs")) & (F.length(swapped) == 1))
    own = own.join(labels.select(F.col("cs").alias("variant")).distinct(), "variant", "left_anti")
    return own.groupBy("variant").agg(F.min("cs").alias("cs"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")


def concept_index(records: DataFrame, precedence: Sequence[str], norm: Norm = F.lower) -> DataFrame:
    """(norm, source, uri, aat): the first record of each label by source, with its first exact match in the art thesaurus."""
    rank = F.array_position(F.array(*(F.lit(s) for s in precedence)), F.col("source"))
    df = records.withColumns({"norm": norm(F.col("cs")), "__r": rank}).where("norm <> ''")
    first = Window.partitionBy("norm").orderBy("__r", *record_order())
    aat = F.get(F.filter("exact_match", lambda u: F.contains(u, F.lit("vocab.getty.edu/aat/"))), F.lit(0))
    return df.withColumn("__k", F.row_number().over(first)).where("__k = 1").select("norm", "source", "uri", aat.alias("aat"))


def resolve_entities(entities: DataFrame, index: DataFrame, keys: Sequence[str], own_source: str, norm: Norm = F.lower) -> DataFrame:
    """(keys, own, aat): identifiers by lemma, else by surface; keys that match different identifiers are left out."""
    look = index.select("norm", F.when(F.col("source") == own_source, F.col("uri")).alias("own"), "aat").where("own is not null or aat is not null")
    a, b = look.toDF("la", "own_a", "aat_a"), look.toDF("lb", "own_b", "aat_b")
    df = entities.withColumns({"la": norm(F.col("lemma")), "lb": norm(F.col("surface"))}).join(a, "la", "left").join(b, "lb", "left")
    hit = F.col("own_a").isNotNull() | F.col("aat_a").isNotNull()
    df = df.select(*keys, F.when(hit, F.struct(F.col("own_a").alias("own"), F.col("aat_a").alias("aat"))).otherwise(F.struct(F.col("own_b").alias("own"), F.col("aat_b").alias("aat"))).alias("pid"))
    df = df.where("pid.own is not null or pid.aat is not null")
    return df.groupBy(*keys).agg(F.min("pid").alias("pid"), F.count_distinct(F.to_json("pid")).alias("n")).where("n = 1").select(*keys, "pid.own", "pid.aat")


def attach_ids(results: DataFrame, terms: DataFrame) -> DataFrame:
    """Adds ids by the result's category and puts the bare label in its place; looked up before it is rewritten.

    ``terms``: cs, ids, bare_cs (null unless the label is bracketed). Categories that are no term get no ids.
    """
    look = terms.select(F.col("cs").alias("category"), F.col("ids").alias("__i"), F.col("bare_cs").alias("__b"))
    both = results.join(look, "category", "left")
    none = F.array().cast(terms.schema["ids"].dataType)
    return both.withColumns({"ids": F.coalesce("__i", none), "category": F.coalesce("__b", "category")}).select(*results.columns, "ids")


def unknown_labels(observed: DataFrame, permitted: DataFrame) -> DataFrame:
    """(label, same_folded): distinct observed labels that are not permitted, with a permitted one that differs in case."""
    seen = observed.select("label").where("label is not null").distinct()
    wrong = seen.join(permitted.select("label"), "label", "left_anti")
    folded = permitted.groupBy(F.lower("label").alias("f")).agg(F.min("label").alias("same_folded"))
    return wrong.withColumn("f", F.lower("label")).join(folded, "f", "left").select("label", "same_folded")
