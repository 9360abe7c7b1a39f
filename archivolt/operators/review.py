"""Review reports: exclusion impact, reinstatement, ancestors, budgets, census, collisions and corpus evidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivolt.functions.scalars import gloss_similarity
from archivolt.operators.vocabulary import EXCLUDE, Norm, record_order

CHARS_PER_TOKEN = 3.35


def prompt_chars(cs: Column, en: Column) -> Column:
    """Characters that a term takes in a prompt: "cs (en)" and a separator of two."""
    return F.length(F.concat(cs, F.lit(" ("), F.coalesce(en, F.lit("")), F.lit(")"))) + 2


def samples(value: Column, n: int = 10) -> Column:
    """The ``n`` smallest distinct values, joined. The set is one rule's labels."""
    return F.array_join(F.slice(F.array_sort(F.collect_set(value)), 1, n), "; ")


def exclusion_impact(placed: DataFrame, notes: DataFrame) -> DataFrame:
    """(rule, kind, ident, term_count, status, reason, sample_terms) of every rule that excludes complete records."""
    out = placed.where((F.col("theme") == EXCLUDE) & F.col("placed_by").rlike("^(list|branch|override):") & F.col("cs").isNotNull() & F.col("en").isNotNull())
    by = out.groupBy(F.col("placed_by").alias("rule")).agg(F.count(F.lit(1)).alias("term_count"), samples(F.col("cs")).alias("sample_terms"))
    by = by.withColumns({"kind": F.split_part("rule", F.lit(":"), F.lit(1)), "ident": F.regexp_replace("rule", "^[^:]*:", "")})
    return by.join(notes, "rule", "left").select("rule", "kind", "ident", "term_count", F.coalesce("status", F.lit("undecided")).alias("status"), F.coalesce("reason", F.lit("")).alias("reason"), "sample_terms")


def reinstatement(placed: DataFrame, offered: DataFrame, norm: Norm = F.lower) -> DataFrame:
    """(rule, raw_count, usable_count, collides_with_offered, prompt_token_delta): what each excluding rule would bring back.

    ``offered`` has the column cs. Tokens count the first record of each new label in canonical order.
    """
    out = placed.where((F.col("theme") == EXCLUDE) & F.col("placed_by").rlike("^(list|branch|override):") & F.col("cs").isNotNull() & F.col("en").isNotNull())
    out = out.withColumns({"n": norm(F.col("cs")), "rule": F.col("placed_by")})
    have = offered.select(norm(F.col("cs")).alias("n")).distinct().withColumn("have", F.lit(True))
    out = out.join(have, "n", "left").withColumn("have", F.coalesce("have", F.lit(False)))
    first = Window.partitionBy("rule", "n").orderBy(*record_order())
    out = out.withColumn("k", F.row_number().over(first))
    cost = F.when((F.col("k") == 1) & ~F.col("have"), prompt_chars(F.col("cs"), F.col("en"))).otherwise(0)
    return out.groupBy("rule").agg(
        F.count(F.lit(1)).alias("raw_count"),
        F.count_distinct(F.when(~F.col("have"), F.col("n"))).alias("usable_count"),
        F.count_distinct(F.when(F.col("have"), F.col("n"))).alias("collides_with_offered"),
        F.round(F.sum(cost) / CHARS_PER_TOKEN).cast("long").alias("prompt_token_delta"),
    )


def offered_ancestors(terms: DataFrame) -> DataFrame:
    """(cs, theme, source_id, nearest_id, nearest_cs, outermost_cs, rungs_above, same_theme): ancestors that are offered.

    ``terms``: cs, theme, source_id, broader (ids from the root down).
    """
    up = terms.select("cs", "theme", "source_id", F.posexplode("broader").alias("depth", "a"))
    anc = terms.select(F.col("source_id").alias("a"), F.col("cs").alias("a_cs"), F.col("theme").alias("a_theme"))
    met = up.join(anc, "a").where("a_cs <> cs")
    return met.groupBy("cs", "theme", "source_id").agg(
        F.max_by("a", "depth").alias("nearest_id"),
        F.max_by("a_cs", "depth").alias("nearest_cs"),
        F.min_by("a_cs", "depth").alias("outermost_cs"),
        F.count(F.lit(1)).alias("rungs_above"),
        ((F.max_by("a_theme", "depth") == F.col("theme")) & (F.min_by("a_theme", "depth") == F.col("theme"))).alias("same_theme"),
    )


def broader_labels(records: DataFrame) -> DataFrame:
    """Adds ``broader_labels``: the ancestors' labels from the root down, ids where a label is missing."""
    names = records.select(F.col("source").alias("s"), F.col("source_id").alias("a"), F.col("cs").alias("label")).dropDuplicates(["s", "a"])
    up = records.select("source", "source_id", F.posexplode("broader").alias("i", "a"))
    met = up.join(names, (F.col("source") == F.col("s")) & up["a"] .eqNullSafe(names["a"]), "left").select("source", "source_id", "i", F.coalesce("label", up["a"]).alias("l"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "l"))), lambda x: x["l"]), " > ")
    return records.join(met.groupBy("source", "source_id").agg(text.alias("broader_labels")), ["source", "source_id"], "left").fillna("", ["broader_labels"])


#: Values of ``pos`` that one task sums at once.
SPAN = 4096


def running_total(df: DataFrame, pos: str, value: str, name: str) -> DataFrame:
    """Adds ``name``, the sum of ``value`` over all rows up to a row's ``pos`` (an integer, unique).

    Ranges of ``SPAN`` positions are summed apart; only one row for each of them meets in one task, to be summed up in turn.
    """
    ranged = df.withColumn("__r", F.floor(F.col(pos) / SPAN))
    sums = ranged.groupBy("__r").agg(F.sum(value).alias("__s"))
    before = F.sum("__s").over(Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("__r", F.coalesce(before, F.lit(0)).alias("__b"))
    within = F.sum(value).over(Window.partitionBy("__r").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0))
    return ranged.join(sums, "__r").withColumn(name, within + F.col("__b")).drop("__r", "__b")


def budget_prefix(terms: DataFrame, windows: Sequence[int], reserved: int = 2560, overhead: int = 0) -> DataFrame:
    """(window, theme, terms, surviving, dropped, status): how much of each theme fits before a window's budget is spent.

    ``terms``: theme, pos (render order), chars. The prefix ends at the first term that does not fit.
    """
    costed = running_total(terms, "pos", "chars", "used")
    budgets = [(w, max(0, w - reserved) * CHARS_PER_TOKEN - overhead) for w in windows]
    fits = [F.count_if(F.col("used") <= b).alias(f"__{w}") for w, b in budgets]
    by = costed.groupBy("theme").agg(F.count(F.lit(1)).alias("terms"), *fits)
    each = F.explode(F.array(*(F.struct(F.lit(w).alias("window"), F.col(f"__{w}").alias("surviving")) for w in windows)))
    out = by.select("theme", "terms", each.alias("x")).select("x.window", "theme", "terms", "x.surviving")
    status = F.when(F.col("surviving") == F.col("terms"), "full").when(F.col("surviving") > 0, "partial").otherwise("none")
    return out.withColumns({"dropped": F.col("terms") - F.col("surviving"), "status": status})


def largest_prefix(costs: DataFrame, budget: float) -> DataFrame:
    """(kept): terms of the largest prefix within the budget; over budget never all of them, and none of a single term."""
    seen = running_total(costs.select("pos", "chars"), "pos", "chars", "used")
    total = seen.agg(F.count(F.lit(1)).alias("n"), F.max("used").alias("all"), F.count_if(F.col("used") <= budget).alias("fit"))
    return total.select(F.when(F.col("all") <= budget, F.col("n")).otherwise(F.least("fit", F.greatest(F.col("n") - 1, F.lit(0)))).cast("int").alias("kept"))


def census(terms: DataFrame) -> DataFrame:
    """(theme, rank, terms, share, chars, cumulative_chars, sources, top_rules) in render order.

    ``terms``: theme, theme_rank, cs, en, source, placed_by.
    """
    by = terms.groupBy("theme").agg(
        F.min("theme_rank").alias("rank"), F.count(F.lit(1)).alias("terms"), F.sum(prompt_chars(F.col("cs"), F.col("en"))).alias("chars"), F.count_distinct("source").alias("sources")
    )
    rules = terms.groupBy("theme", "placed_by").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("theme").orderBy(F.desc("n"), F.asc("placed_by"))
    top = rules.withColumn("k", F.row_number().over(w)).where("k <= 4").groupBy("theme")
    top = top.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", F.format_string("%s (%d)", "placed_by", "n").alias("t")))), lambda x: x["t"]), "; ").alias("top_rules"))
    run = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)  # themes are few
    whole = Window.partitionBy(F.lit(1))
    out = by.withColumns({"cumulative_chars": F.sum("chars").over(run), "share": F.col("terms") / F.sum("terms").over(whole)})
    return out.join(top, "theme").select("theme", "rank", "terms", "share", "chars", "cumulative_chars", "sources", "top_rules")


def collisions(records: DataFrame, norm: Norm = F.lower) -> DataFrame:
    """(n, members, glosses, verdict): labels held with different glosses, and how their alignments agree.

    The verdict compares each non-empty set of exact matches with the first in canonical order: none, one_sided, agreeing or
    conflicting.
    """
    order = Window.partitionBy("n").orderBy(*record_order())
    df = records.withColumn("n", norm(F.col("cs"))).withColumn("k", F.row_number().over(order))
    sets = F.transform(F.sort_array(F.collect_list(F.when(F.size("exact_match") > 0, F.struct("k", "exact_match")))), lambda x: x["exact_match"])
    by = df.groupBy("n").agg(F.count(F.lit(1)).alias("members"), F.sort_array(F.collect_set(norm(F.col("en")))).alias("glosses"), sets.alias("sets"))
    first = F.get("sets", F.lit(0))
    verdict = (
        F.when(F.size("sets") == 0, "none")
        .when(F.size("sets") == 1, "one_sided")
        .when(F.forall("sets", lambda s: F.arrays_overlap(s, first)), "agreeing")
        .otherwise("conflicting")
    )
    return by.where(F.size("glosses") > 1).select("n", "members", "glosses", verdict.alias("verdict"))


def group_dissimilarity(groups: DataFrame) -> DataFrame:
    """(n, worst): the least similarity of two glosses of a group (n, glosses)."""
    a = groups.select("n", F.posexplode("glosses").alias("i", "x"))
    b = groups.select(F.col("n").alias("m"), F.posexplode("glosses").alias("j", "y"))
    pairs = a.join(b, (F.col("n") == F.col("m")) & (F.col("i") < F.col("j")))
    return pairs.groupBy("n").agg(F.min(gloss_similarity("x", "y")).alias("worst"))


def term_evidence(terms: DataFrame, tokens: DataFrame, examples: int = 3, norm: Norm = F.lower) -> DataFrame:
    """(cs, documents, occurrences, examples): where one-word terms occur as lemmas; terms without a hit have zeros.

    ``tokens``: doc_id, pos, lemma, line (text of the line).
    """
    single = terms.where(F.size(F.split(F.trim("cs"), r"\s+")) == 1).select("cs", norm(F.col("cs")).alias("lemma"))
    hits = tokens.withColumn("lemma", norm(F.col("lemma"))).join(single, "lemma")
    counted = hits.groupBy("cs").agg(F.count_distinct("doc_id").alias("documents"), F.count(F.lit(1)).alias("occurrences"))
    w = Window.partitionBy("cs").orderBy("doc_id", "pos")
    shown = hits.where("line is not null").dropDuplicates(["cs", "line"]).withColumn("k", F.row_number().over(w)).where(F.col("k") <= examples)
    shown = shown.groupBy("cs").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "line"))), lambda x: x["line"]).alias("examples"))
    return single.select("cs").join(counted, "cs", "left").join(shown, "cs", "left").fillna(0, ["documents", "occurrences"])


def branch_evidence(hits: DataFrame, offered: DataFrame) -> DataFrame:
    """(rule, terms, occurrences, unique_terms, unique_occurrences, documents, unique_samples, shared_samples): hits of excluded
    rules, those already offered apart. ``hits``: rule, lemma, doc_id, n."""
    have = offered.select("lemma", F.lit(True).alias("have")).distinct()
    df = hits.join(have, "lemma", "left").withColumn("own", F.col("have").isNull())
    return df.groupBy("rule").agg(
        F.count_distinct("lemma").alias("terms"),
        F.sum("n").alias("occurrences"),
        F.count_distinct(F.when(F.col("own"), F.col("lemma"))).alias("unique_terms"),
        F.sum(F.when(F.col("own"), F.col("n")).otherwise(0)).alias("unique_occurrences"),
        F.count_distinct("doc_id").alias("documents"),
        samples(F.when(F.col("own"), F.col("lemma"))).alias("unique_samples"),
        samples(F.when(~F.col("own"), F.col("lemma"))).alias("shared_samples"),
    )


def candidate_terms(lines: DataFrame, form_lemmas: DataFrame, terms: DataFrame, top: int = 5, norm: Norm = F.lower) -> DataFrame:
    """(doc_id, pos, candidates): terms whose lemma occurs in a line, first seen first, at most ``top``."""
    words = lines.select("doc_id", "pos", F.posexplode(F.regexp_extract_all("text", F.lit(r"(?U)(\w+)"), F.lit(1))).alias("at", "form")).withColumn("form", norm(F.col("form")))
    lemma = words.join(form_lemmas, ["doc_id", "form"], "left").withColumn("lemma", F.coalesce("lemma", "form"))
    met = lemma.join(terms.select("cs", norm(F.col("cs")).alias("lemma")), "lemma").groupBy("doc_id", "pos", "cs").agg(F.min("at").alias("at"))
    w = Window.partitionBy("doc_id", "pos").orderBy("at", "cs")
    kept = met.withColumn("k", F.row_number().over(w)).where(F.col("k") <= top).groupBy("doc_id", "pos")
    return kept.agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "cs"))), lambda x: x["cs"]).alias("candidates"))


def subbranch_impact(records: DataFrame, excluded_roots: DataFrame) -> DataFrame:
    """(root, child, term_count, usable_count, sample_terms): the branches right under excluded roots.

    ``records``: source_id, cs, en, broader (from the root down).
    """
    chain = F.concat("broader", F.array("source_id"))
    under = records.select("cs", "en", F.get(chain, F.lit(0)).alias("root"), F.get(chain, F.lit(1)).alias("child")).where("child is not null")
    under = under.join(excluded_roots.select("root"), "root", "left_semi")
    usable = F.count_distinct(F.when(F.col("en").isNotNull(), F.lower("cs")))
    return under.groupBy("root", "child").agg(F.count(F.lit(1)).alias("term_count"), usable.alias("usable_count"), samples(F.col("cs")).alias("sample_terms"))


def audit_links(audit: DataFrame, nested: DataFrame) -> DataFrame:
    """The audit's rows with ``same_as_count``, the links of the term that each describes (``nested``: theme, cs, same_as)."""
    counted = nested.groupBy("theme", "cs").agg(F.max(F.greatest(F.size("same_as"), F.lit(0))).alias("same_as_count"))
    return audit.join(counted, ["theme", "cs"], "left").select(*audit.columns, F.coalesce("same_as_count", F.lit(0)).alias("same_as_count"))


def covered_targets(covers: DataFrame, terms: DataFrame, schemes: DataFrame) -> DataFrame:
    """(kind, theme, name): groups and terms that a list of rules covers.

    ``covers``: rule. ``terms``: theme, sub, cs, ids (source, id). ``schemes``: id, scheme of the listed source's records. A
    rule "heslar:x" covers the groups with a term whose listed id has the scheme x; "teater:i" the terms with that id.
    """
    rules = covers.select(F.split_part("rule", F.lit(":"), F.lit(1)).alias("kind"), F.regexp_replace("rule", "^[^:]*:", "").alias("ident")).distinct()
    ids = terms.select("theme", "sub", "cs", F.explode("ids").alias("x")).select("theme", "sub", "cs", F.col("x.source").alias("source"), F.col("x.id").alias("id"))
    listed = ids.where("source = 'amcr'").join(schemes, "id").select("theme", "sub", F.col("scheme").alias("ident"))
    groups = listed.join(rules.where("kind = 'heslar'"), "ident", "left_semi").select(F.lit("group").alias("kind"), "theme", F.col("sub").alias("name"))
    single = ids.where("source = 'teater'").select("theme", "cs", F.col("id").alias("ident")).join(rules.where("kind = 'teater'"), "ident", "left_semi")
    return groups.union(single.select(F.lit("term"), "theme", "cs")).distinct()


def link_report(links: DataFrame, extra: DataFrame, suppress: DataFrame) -> DataFrame:
    """(a, b, status): every unordered pair of labels once: auto, suppressed, or manual where no rule found it."""
    pair = lambda df, x, y: df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).where("a <> b").distinct()
    auto = pair(links, "cs", "part_cs")
    status = F.when(F.col("__s"), "suppressed").otherwise("auto")
    found = auto.join(pair(suppress, "a", "b").withColumn("__s", F.lit(True)), ["a", "b"], "left").select("a", "b", status.alias("status"))
    return found.union(pair(extra, "a", "b").join(auto, ["a", "b"], "left_anti").select("a", "b", F.lit("manual")))
