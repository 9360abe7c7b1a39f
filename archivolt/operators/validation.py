"""Validation as data: every check is a column or an anti-join, and problems are rows.

Records, question sets, limits, themes, prompts and placement rules are tables here, so a whole corpus or a whole configuration
is checked in one job and all its problems are reported at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.functions.scalars import key_text
from archivolt.operators.vocabulary import EXCLUDE, Norm

#: The record's current major version, its type, and what a page may say of its content.
MAJOR, RECORD_TYPE, CONTENT_STATUS = "2", "document", ("text", "empty")
#: Kinds of questions, and how many questions and options a request takes.
QUESTION_TYPES, MOST_QUESTIONS, OPTIONS = ("noul", "choice", "score"), 64, (2, 64)
#: What a note on an exclusion may say, and the status that ties it to the prompt's guardrail.
EXCLUSION_STATUSES, GUARDED_STATUS = ("decided", "undecided", "geo-ethnic"), "geo-ethnic"
#: Effects that fail a run instead of being noted.
FAILING_EFFECTS = ("refused", "truncated", "dropped")


def _text(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c)), F.lit(""))


def record_rules(seed: bool = False) -> list[tuple[str, Column]]:
    """(problem, whether a record has it) in the order in which problems are reported.

    A record has schema_version, record_type, doc_id, source (sha512, filename, media_type, origin), pages (page, page_index,
    content_status, quality_score) and lines (page, line, quality_score). A seed is a record before its first tool: identity
    only, any version, no origin, no blocks.
    """
    digest = F.col("source.sha512").rlike("^[0-9a-f]{128}$")
    score = lambda x: x["quality_score"].isNull() | x["quality_score"].between(0, 1)
    none = F.array()
    pages, lines = F.coalesce("pages", none.cast("array<struct<page:string,page_index:int,content_status:string,quality_score:double>>")), F.coalesce("lines", none.cast("array<struct<page:string,line:int,quality_score:double>>"))
    common = [("doc_id", _text("doc_id") == ""), ("record_type", F.coalesce(F.col("record_type"), F.lit(RECORD_TYPE)) != RECORD_TYPE)]
    if seed:
        return [
            ("schema_version", F.col("schema_version").isNotNull() & ~F.col("schema_version").rlike(r"^[0-9]+\.[0-9]+$")),
            *common,
            ("source", F.col("source").isNull() | (F.coalesce("source.filename", F.lit("")) == "") | (F.coalesce("source.media_type", F.lit("")) == "")),
            ("source.sha512", ~F.coalesce(digest, F.lit(False))),
            ("source.origin", F.col("source.origin").isNotNull()),
            ("blocks", (F.size(pages) > 0) | (F.size(lines) > 0)),
        ]
    return [
        ("schema_version", ~F.coalesce(F.col("schema_version").rlike(rf"^{MAJOR}\.[0-9]+$"), F.lit(False))),
        *common,
        ("source.sha512", F.col("source.sha512").isNotNull() & ~digest),
        ("pages.page", F.exists(pages, lambda p: F.coalesce(p["page"], F.lit("")) == "")),
        ("pages.page_index", F.exists(pages, lambda p: F.coalesce(p["page_index"] < 1, F.lit(True)))),
        ("pages.content_status", F.exists(pages, lambda p: ~F.coalesce(p["content_status"].isin(*CONTENT_STATUS), F.lit(False)))),
        ("pages.quality_score", ~F.forall(pages, score)),
        ("pages.empty_with_score", F.exists(pages, lambda p: (p["content_status"] == "empty") & p["quality_score"].isNotNull())),
        ("lines.line", F.exists(lines, lambda x: F.coalesce(x["line"] < 1, F.lit(True)))),
        ("lines.quality_score", ~F.forall(lines, score)),
    ]


def record_problems(records: DataFrame, references: DataFrame | None = None, seed: bool = False) -> DataFrame:
    """(doc_id, problem, problems): the first problem of every record, null for a valid one, and how many rules it breaks.

    ``references``: doc_id, page, line of the rows that name a line. In a valid record with lines each must name one.
    """
    rules = record_rules(seed)
    broken = F.filter(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules)), lambda x: x.isNotNull())
    out = records.select("doc_id", broken.alias("broken"), "lines")
    if references is None or seed:
        return out.select("doc_id", F.get("broken", F.lit(0)).alias("problem"), F.size("broken").alias("problems"))
    kinds = dict(references.dtypes)
    key = lambda c: key_text(F.col(c), kinds[c])
    lines = records.select("doc_id", F.explode("lines").alias("l")).select("doc_id", F.col("l.page").alias("p"), F.col("l.line").cast("string").alias("n")).distinct()
    named = references.where("line is not null").select("doc_id", key("page").alias("p"), key("line").alias("n"))
    lost = named.join(records.where("size(lines) > 0").select("doc_id"), "doc_id", "left_semi").join(lines, ["doc_id", "p", "n"], "left_anti")
    out = out.join(lost.groupBy("doc_id").agg(F.count(F.lit(1)).alias("lost")), "doc_id", "left")
    problem = F.coalesce(F.get("broken", F.lit(0)), F.when(F.col("lost") > 0, "line references"))
    return out.select("doc_id", problem.alias("problem"), (F.size("broken") + (F.coalesce("lost", F.lit(0)) > 0).cast("int")).alias("problems"))


def gated(problems: DataFrame, baseline: DataFrame) -> DataFrame:
    """(doc_id, problem, gate): what becomes of a record that a tool has changed.

    A valid record is written. One whose problem its baseline had already is written as inherited; an own problem is refused,
    and the record goes to quarantine. Both frames: doc_id, problem.
    """
    before = baseline.select("doc_id", F.col("problem").alias("__b"))
    gate = F.when(F.col("problem").isNull(), "write").when(F.col("problem").eqNullSafe(F.col("__b")), "inherited").otherwise("refuse")
    return problems.join(before, "doc_id", "left").select("doc_id", "problem", gate.alias("gate"))


def question_problems(questions: DataFrame) -> DataFrame:
    """(set_id, qid, problem): the first problem of every question, and those of whole sets with a null qid.

    ``questions``: set_id, qid, type, criteria (option ids or level descriptions; null where none are given), keyed (whether
    criteria are named). A noul question takes true and false only.
    """
    n = F.size("criteria")
    problem = (
        F.when(F.coalesce("qid", F.lit("")) == "", "empty id")
        .when(~F.coalesce(F.col("type").isin(*QUESTION_TYPES), F.lit(False)), "type")
        .when((F.col("type") == "noul") & (F.size(F.array_except(F.coalesce("criteria", F.array().cast("array<string>")), F.array(F.lit("true"), F.lit("false")))) > 0), "criteria")
        .when((F.col("type") != "noul") & (F.col("criteria").isNull() | (F.col("keyed") != (F.col("type") == "choice"))), "criteria")
        .when((F.col("type") != "noul") & ~n.between(*OPTIONS), "options")
        .when((F.col("type") == "choice") & F.exists("criteria", lambda c: c == ""), "empty option")
    )
    own = questions.select("set_id", "qid", problem.alias("problem")).where("problem is not null")
    large = questions.groupBy("set_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MOST_QUESTIONS)
    return own.union(large.select("set_id", F.lit(None).cast("string"), F.lit("too many questions")))


def options_of(kind: Column, criteria: Column) -> Column:
    """The option ids that a question allows, in order: true and false, the named options, or the levels' numbers from 0."""
    levels = F.transform(criteria, lambda _, i: i.cast("string"))
    return F.when(kind == "noul", F.array(F.lit("true"), F.lit("false"))).when(kind == "choice", criteria).otherwise(levels)


def resolved_limits(specs: DataFrame) -> DataFrame:
    """(limit, value, origin, unlimited): the environment's value, else the legacy one converted, else the configured one, else
    the default; blank counts as unset, and what isn't a number or is below ``least`` raises.

    ``specs``: limit, env, legacy, divisor, config (text), fallback, least, zero_is_unlimited.
    """
    given = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    raw = F.coalesce(given("env"), given("legacy"), given("config"))
    number = raw.try_cast("double")
    value = F.when(raw.isNull(), F.col("fallback")).when(given("env").isNull() & given("legacy").isNotNull(), number / F.col("divisor")).otherwise(number)
    origin = F.when(given("env").isNotNull() | given("legacy").isNotNull(), "env").when(given("config").isNotNull(), "config").otherwise("default")
    bad = raw.isNotNull() & (number.isNull() | (number < F.col("least")))
    checked = F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.concat(F.lit("invalid limit "), "limit")).cast("double")).otherwise(value)
    return specs.select("limit", checked.alias("value"), origin.alias("origin"), (F.col("zero_is_unlimited") & (value == 0)).alias("unlimited"))


def exceeded(observed: DataFrame, limits: DataFrame) -> DataFrame:
    """(subject, limit, observed, value): observations over their limit; a limit without bound refuses nothing."""
    both = observed.join(limits.where("not unlimited"), "limit")
    return both.where(F.col("observed") > F.col("value")).select("subject", "limit", "observed", "value")


def refuse(over: DataFrame) -> None:
    """Raises if any observation is over its limit."""
    if (r := over.orderBy("limit", "subject").first()) is not None:
        raise ValueError(f"{r.subject}: {r.limit} is {r.observed}, over {r.value}")


def failing_notes(notes: DataFrame) -> None:
    """Raises if a limit note has an effect that fails a run; others are merged by ``records.merge_notes``."""
    if (r := notes.where(F.col("effect").isin(*FAILING_EFFECTS)).orderBy("limit", "effect").first()) is not None:
        raise ValueError(f"{r.limit}: {r.effect}")


def withheld_themes(themes: DataFrame) -> DataFrame:
    """(theme): lower-case names of the themes that a prompt leaves out. A theme without a flag is shown unless it is "other";
    "other" is withheld even if it isn't declared."""
    low = F.lower("theme")
    own = themes.where(~F.coalesce("in_prompt", low != "other")).select(low.alias("theme"))
    silent = themes.agg(F.coalesce(F.bool_or(low == "other"), F.lit(False)).alias("named")).where("not named").select(F.lit("other").alias("theme"))
    return own.union(silent).distinct()


def guardrail_problems(rules: DataFrame, covers: DataFrame, prompt: DataFrame, markers: Sequence[str], active: bool) -> DataFrame:
    """(check, subject): how a prompt's wording and the rules contradict each other.

    ``rules``: rule ("kind:ident"), theme. ``covers``: rule. ``prompt``: text, one row or more. The wording is there when all
    markers occur. A rule that an active guardrail covers must exclude.
    """
    low = F.lower(F.coalesce("text", F.lit("")))
    there = [F.coalesce(F.bool_or(F.contains(low, F.lit(m.lower()))), F.lit(False)) for m in markers]
    present = prompt.agg(reduce(lambda a, b: a & b, there, F.lit(True)).alias("present"))
    wording = present.where(F.col("present") != F.lit(active)).select(F.lit("wording missing" if active else "wording left").alias("check"), F.lit(None).cast("string").alias("subject"))
    if not active:
        return wording
    excluded = rules.where(F.col("theme") == EXCLUDE).select("rule")
    return wording.union(covers.select("rule").distinct().join(excluded, "rule", "left_anti").select(F.lit("covered rule offered"), "rule"))


def qualifier_problems(records: DataFrame, qualifiers: DataFrame, norm: Norm = F.lower) -> DataFrame:
    """(check, subject): labels of which two records have one qualifier, and labels whose records all have one.

    ``records``: source, source_id, cs. ``qualifiers``: source, source_id, qualifier.
    """
    named = records.where(F.coalesce("cs", F.lit("")) != "").join(qualifiers, ["source", "source_id"], "left").withColumn("n", norm(F.col("cs")))
    twice = named.where("qualifier is not null").groupBy("n", "qualifier").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    every = named.groupBy("n").agg(F.count(F.lit(1)).alias("c"), F.count("qualifier").alias("q")).where("c = q")
    return twice.select(F.lit("qualifier twice").alias("check"), F.concat("n", F.lit("|"), "qualifier").alias("subject")).union(every.select(F.lit("bare label gone"), "n"))


def config_problems(
    themes: DataFrame,
    maps: DataFrame,
    labels: DataFrame,
    notes: DataFrame,
    covers: DataFrame,
    overrides: DataFrame,
    links: DataFrame,
    tie_break: DataFrame,
    records: DataFrame | None = None,
) -> DataFrame:
    """(check, subject): every way in which a configuration won't do what it says, all at once.

    ``themes``: theme, priority. ``maps``: rule, theme. ``labels``: rule. ``notes``: rule, status. ``covers``: rule.
    ``overrides``: source, source_id, theme. ``links``: a, b, kind ("extra", "suppress"). ``tie_break``: theme. ``records``:
    source, source_id, cs, if the records are at hand.
    """
    known = themes.select("theme").union(themes.sparkSession.createDataFrame([(EXCLUDE,)], "theme string")).distinct()

    def found(df: DataFrame, check: str, subject: Column | str) -> DataFrame:
        return df.select(F.lit(check).alias("check"), (F.col(subject) if isinstance(subject, str) else subject).cast("string").alias("subject"))

    rules = maps.select("rule").distinct()
    excluded = maps.where(F.col("theme") == EXCLUDE).select("rule").distinct()
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    both = links.where("kind = 'extra'").select(*pair).distinct().join(links.where("kind = 'suppress'").select(*pair).distinct(), ["a", "b"], "left_semi")
    shared = themes.join(themes.groupBy("priority").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "priority", "left_semi")
    key = F.concat("source", F.lit(":"), "source_id")
    guarded = F.col("status") == GUARDED_STATUS
    parts = [
        found(maps.join(known, "theme", "left_anti"), "map to undeclared theme", F.concat("rule", F.lit("->"), "theme")),
        found(tie_break.join(themes, "theme", "left_anti"), "tie break of undeclared theme", "theme"),
        found(shared.join(tie_break, "theme", "left_anti"), "shared priority without tie break", "theme"),
        found(labels.join(rules, "rule", "left_anti"), "label of no rule", "rule"),
        found(notes.join(excluded, "rule", "left_anti"), "note of no exclusion", "rule"),
        found(notes.where(~F.coalesce(F.col("status").isin(*EXCLUSION_STATUSES), F.lit(False))), "unknown status", "rule"),
        found(covers.select("rule").distinct().join(rules, "rule", "left_anti"), "cover of no rule", "rule"),
        found(notes.where(guarded).join(covers, "rule", "left_anti"), "guarded but not covered", "rule"),
        found(notes.where(~guarded).join(covers, "rule", "left_semi").join(excluded, "rule", "left_semi"), "covered but not guarded", "rule"),
        found(overrides.where("theme is not null").join(known, "theme", "left_anti"), "override to undeclared theme", F.concat(key, F.lit("->"), "theme")),
        found(both, "link both added and suppressed", F.concat("a", F.lit("|"), "b")),
        found(links.where("coalesce(a, '') = '' or coalesce(b, '') = ''"), "link without an end", F.concat_ws("|", "a", "b")),
    ]
    if records is not None:
        parts.append(found(overrides.join(records, ["source", "source_id"], "left_anti"), "override of no record", key))
    return reduce(DataFrame.union, parts)
