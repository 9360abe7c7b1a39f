"""Sinks: keyword tables, flat vocabularies, triples and their texts, reports, drift checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.operators.vocabulary import record_order

#: Predicates of the label columns and of the mapping columns.
LABELS = (("cs", "skos:prefLabel", "cs"), ("en", "skos:prefLabel", "en"), ("de", "skos:prefLabel", "de"), ("note_cs", "skos:scopeNote", "cs"), ("note_en", "skos:scopeNote", "en"))
LISTS = (("alt_cs", "skos:altLabel", "cs"), ("alt_en", "skos:altLabel", "en"))
MAPPINGS = (("exact_match", "skos:exactMatch"), ("close_match", "skos:closeMatch"), ("broad_match", "skos:broadMatch"), ("related_match", "skos:relatedMatch"))


def keyword_summary(ranked: DataFrame, num_keywords: int, doc: str = "doc_id") -> DataFrame:
    """Wide table: the id, then kw-1, score-1 ... padded to ``num_keywords``; ids sorted as text."""
    columns = []
    for k in range(1, num_keywords + 1):
        hit = F.col("rank") == k
        columns += [F.max(F.when(hit, F.col("keyword"))).alias(f"kw-{k}"), F.max(F.when(hit, F.col("score"))).alias(f"score-{k}")]
    return ranked.groupBy(F.col(doc).cast("string").alias("document_id")).agg(*columns).orderBy("document_id")


def write_keyword_files(ranked: DataFrame, path: str, doc: str = "doc_id") -> None:
    """One folder of CSV for each document, rows in rank order."""
    out = ranked.repartition(doc).sortWithinPartitions(doc, "rank").select(doc, "keyword", "score")
    out.write.mode("overwrite").partitionBy(doc).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """CSV with a fixed header in each file of a folder, as many as the frame has partitions; null is the empty text."""
    df.select(*columns).write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def markdown_table(df: DataFrame, columns: Sequence[str], limit: int = 200) -> str:
    """Markdown of a small report (at most ``limit`` rows)."""
    rows = df.select(*columns).limit(limit).collect()
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|")
    return "\n".join([f"| {' | '.join(columns)} |", f"|{'---|' * len(columns)}", *(f"| {' | '.join(cell(v) for v in r)} |" for r in rows)])


def ordered_vocabulary(records: DataFrame) -> DataFrame:
    """Records in canonical order."""
    return records.orderBy(*record_order())


def glossary(records: DataFrame) -> DataFrame:
    """(cs, en) of records that have an English label, in canonical order."""
    return ordered_vocabulary(records.where(F.coalesce("en", F.lit("")) != "")).select("cs", "en")


def triples(records: DataFrame, tree_source: str, base_uri: dict[str, str], schemes: dict[str, str]) -> DataFrame:
    """(s, p, kind, o, lang), distinct and in a total order.

    In ``tree_source`` the last broader id is the parent and those before are transitive; elsewhere broader ids are related.
    Records without a URI give none.
    """
    df = records.where(F.coalesce("uri", F.lit("")) != "")
    have = set(records.columns)

    def lit(p: str, value: Column, lang: str | None = None) -> DataFrame:
        return df.select(F.col("uri").alias("s"), F.lit(p).alias("p"), F.lit("lit").alias("kind"), value.cast("string").alias("o"), F.lit(lang).cast("string").alias("lang"))

    def uri(p: str, value: Column, frame: DataFrame | None = None) -> DataFrame:
        return (frame if frame is not None else df).select(F.col("uri").alias("s"), F.lit(p).alias("p"), F.lit("uri").alias("kind"), value.alias("o"), F.lit(None).cast("string").alias("lang"))

    lookup = lambda table: F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    parts = [uri("rdf:type", F.lit("skos:Concept")), uri("skos:inScheme", F.get(F.array(lookup(schemes)[F.col("source")]), F.lit(0))), lit("skos:notation", F.col("source_id"))]
    parts += [lit(p, F.col(c), lang) for c, p, lang in LABELS if c in have]
    parts += [lit(p, F.explode(F.col(c)), lang) for c, p, lang in LISTS if c in have]
    parts += [uri(p, F.explode(F.col(c))) for c, p in MAPPINGS if c in have]
    if "broader" in have:
        up = df.select("uri", "source", F.size("broader").alias("n"), F.posexplode("broader").alias("i", "b"))
        up = up.withColumn("target", F.concat(F.get(F.array(lookup(base_uri)[F.col("source")]), F.lit(0)), F.col("b")))
        tree = up.where(F.col("source") == tree_source)
        parts += [
            uri("skos:broader", F.col("target"), tree.where("i = n - 1")),
            uri("skos:broaderTransitive", F.col("target"), tree.where("i < n - 1")),
            uri("skos:related", F.col("target"), up.where(F.col("source") != tree_source)),
        ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.where(F.coalesce("o", F.lit("")) != "").distinct().orderBy("s", "p", "o", "lang")


def turtle(triples_: DataFrame) -> DataFrame:
    """(s, block): the Turtle text of each subject."""
    escaped = F.regexp_replace(F.regexp_replace("o", r"\\", r"\\\\\\\\"), '"', r'\\\\"')
    quoted = F.concat(F.lit('"'), escaped, F.lit('"'), F.when(F.col("lang").isNotNull(), F.concat(F.lit("@"), "lang")).otherwise(""))
    plain = F.when(F.col("o").rlike("^[a-z]+:[A-Za-z]+$"), F.col("o")).otherwise(F.concat(F.lit("<"), "o", F.lit(">")))
    text = F.concat(F.lit("  "), F.col("p"), F.lit(" "), F.when(F.col("kind") == "lit", quoted).otherwise(plain))
    lines = F.array_join(F.sort_array(F.collect_list(text)), " ;\n")
    return triples_.groupBy("s").agg(F.concat(F.lit("<"), F.col("s"), F.lit(">\n"), lines, F.lit(" .")).alias("block")).orderBy("s")


def drift(now: DataFrame, stored: DataFrame, stamps: Sequence[str] = ()) -> DataFrame:
    """Rows of either side alone, stamp columns aside; empty when nothing drifted."""
    columns = [c for c in now.columns if c not in stamps]
    a, b = now.select(*columns), stored.select(*columns)
    return a.exceptAll(b).withColumn("side", F.lit("now")).union(b.exceptAll(a).withColumn("side", F.lit("stored")))


def rendered_terms(terms: DataFrame, grouping: str = "facet") -> DataFrame:
    """(title, block): terms as "cs (en)" joined by "; " under each title, titles in order of first appearance.

    ``terms``: pos, theme, sub, cs, en. Grouping is flat, facet or facet_sub.
    """
    with_sub = F.when(F.coalesce("sub", F.lit("")) != "", F.concat("theme", F.lit(" / "), "sub")).otherwise(F.col("theme"))
    title = {"flat": F.lit(""), "facet": F.col("theme"), "facet_sub": with_sub}[grouping]
    shown = F.concat("cs", F.lit(" ("), F.coalesce("en", F.lit("")), F.lit(")"))
    ordered = F.sort_array(F.collect_list(F.struct("pos", shown.alias("t"))))
    by = terms.groupBy(title.alias("title")).agg(F.min("pos").alias("first"), F.array_join(F.transform(ordered, lambda x: x["t"]), "; ").alias("block"))
    return by.orderBy("first").select("title", "block")


#: Namespace of the label vocabulary.
SKOS = "http://www.w3.org/2004/02/skos/core#"


def registry_triples(schemes: DataFrame, concepts: DataFrame, collections: DataFrame, mappings: DataFrame, base: str) -> DataFrame:
    """(s, p, kind, o, lang) of a registry of labels, distinct and in a total order; every rendering is made from these alone.

    ``schemes``: scheme, title, description, authority, origin (a URI or null). ``concepts``: scheme, notation, labels and
    definitions (maps by language), originator. ``collections``: scheme, name, label, members. ``mappings``: s, p, o.
    """
    scheme = lambda: F.concat(F.lit(base), F.col("scheme"))
    uri = lambda c: F.concat(F.lit(base), F.col("scheme"), F.lit("/"), c)
    null = F.lit(None).cast("string")

    def part(df: DataFrame, s: Column, p: str, kind: str, o: Column, lang: Column = null) -> DataFrame:
        return df.select(s.alias("s"), F.lit(p).alias("p"), F.lit(kind).alias("kind"), o.cast("string").alias("o"), lang.alias("lang"))

    en = F.lit("en")
    concept = uri(F.col("notation"))
    named = concepts.select("scheme", "notation", F.explode("labels").alias("lang", "text"))
    defined = concepts.select("scheme", "notation", F.explode("definitions").alias("lang", "text"))
    own = F.concat(F.lit(base), F.col("scheme"), F.lit("/collection/"), F.col("name"))
    parts = [
        part(schemes, scheme(), "rdf:type", "uri", F.lit(SKOS + "ConceptScheme")),
        part(schemes, scheme(), "dct:title", "lit", F.col("title"), en),
        part(schemes, scheme(), "dct:description", "lit", F.col("description"), en),
        part(schemes, scheme(), "dct:source", "uri", F.col("origin")),
        part(schemes, scheme(), "rdfs:comment", "lit", F.concat(F.lit("authority: "), "authority"), en),
        part(concepts, concept, "rdf:type", "uri", F.lit(SKOS + "Concept")),
        part(concepts, concept, "skos:inScheme", "uri", scheme()),
        part(concepts, concept, "skos:notation", "lit", F.col("notation")),
        part(concepts, concept, "rdfs:comment", "lit", F.concat(F.lit("emitted by: "), "originator"), en),
        part(named, concept, "skos:prefLabel", "lit", F.col("text"), F.col("lang")),
        part(defined, concept, "skos:definition", "lit", F.col("text"), F.col("lang")),
        part(collections, own, "rdf:type", "uri", F.lit(SKOS + "Collection")),
        part(collections, own, "skos:prefLabel", "lit", F.col("label"), en),
        part(collections.select("scheme", "name", F.explode("members").alias("m")), own, "skos:member", "uri", uri(F.col("m"))),
        mappings.select("s", "p", F.lit("uri").alias("kind"), "o", null.alias("lang")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.where(F.coalesce("o", F.lit("")) != "").distinct().orderBy("s", "p", "o", "lang")


def template_blocks(blocks: DataFrame, flags: DataFrame, anchor: str) -> DataFrame:
    """(place, name, part, text): the blocks of a template that a configuration renders, before and after the vocabulary.

    ``blocks``: place, name, text, required, flag, value (the flag's value that shows the block; null for any true one).
    ``flags``: flag, value. A block that is neither required nor has a flag raises, and so does a template without its anchor.
    """
    given = flags.select("flag", F.lower(F.trim("value")).alias("__g"))
    lost = F.when(~F.col("required") & F.col("flag").isNull(), F.raise_error(F.concat(F.lit("no flag for block "), "name")).cast("boolean")).otherwise(F.lit(True))
    chosen = F.col("required") | F.when(F.col("value").isNotNull(), F.col("__g") == F.lower("value")).otherwise(F.col("__g").isin("1", "true", "yes", "on"))
    shown = blocks.join(given, "flag", "left").where(lost & F.coalesce(chosen, F.lit(False)))
    at = shown.where(F.col("name") == anchor).select("place").first()
    if at is None:
        raise ValueError(f"the template must render the block {anchor}")
    return shown.select("place", "name", F.when(F.col("place") <= at[0], "preamble").otherwise("footer").alias("part"), "text").orderBy("place")
