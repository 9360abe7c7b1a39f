"""Placing records in themes by prioritised rules: overrides, lists, branches of the hierarchy, keywords.

Rules are tables of any size. Overrides, lists and branches are found by equi-joins: of a record's ancestors the nearest mapped
one is taken by exploding each distinct chain of ancestors once, so records don't move for it but by their chain. Keywords are
found anywhere in a label. Up to ``KEYWORD_BYTES`` of keywords, which are measured, are one Aho-Corasick automaton for each
language, built once and broadcast; it reads a label once, however many keywords there are. More keywords are joined with the
distinct labels by a rare piece of three characters, and checked.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivolt.operators.tasks import bounded_batches

OTHER = "Other"
#: Bytes of keywords up to which they are collected, and of the automata made of them up to which these are broadcast.
KEYWORD_BYTES, AUTOMATON_BYTES = 4 << 20, 256 << 20
#: Characters of the piece by which a keyword and a label are joined; shorter keywords are pieces themselves.
PIECE = 3

_FOUND = "struct<rank:int,lang:string,keyword:string,theme:string>"


def _automata(rows: list) -> dict[str, tuple[int | None, object]]:
    """For labels of either language: the first empty keyword, and the automaton of the others, with places in ``rows``."""
    import ahocorasick

    out = {}
    for side in ("cs", "en"):
        empty, found = None, ahocorasick.Automaton()
        for i, r in enumerate(rows):
            if (r["lang"] == "cs") != (side == "cs") or r["low"] is None:
                continue
            if not r["low"]:
                empty = i if empty is None else empty
            elif r["low"] not in found:
                found.add_word(r["low"], i)
        if len(found):
            found.make_automaton()
        out[side] = (empty, found if len(found) else None)
    return out


def _by_automaton(df: DataFrame, rows: list) -> DataFrame | None:
    """Adds ``__w``, the first keyword in the record's labels; None where the automata are too large to be broadcast."""
    automata = _automata(rows)
    if len(pickle.dumps(automata)) > AUTOMATON_BYTES:
        return None
    bounded_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((automata, [tuple(r)[:4] for r in rows]))

    @F.pandas_udf(_FOUND)
    def first(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        own, words = shared.value
        for pair in batches:
            best: list[int | None] = [None] * len(pair[0])
            for side, labels in zip(("cs", "en"), pair, strict=True):
                empty, automaton = own[side]
                for i, label in enumerate(labels):
                    found = [empty] if empty is not None else []
                    if automaton is not None and label:
                        found += (k for _, k in automaton.iter(label))
                    if found and (best[i] is None or min(found) < best[i]):
                        best[i] = min(found)
            yield pd.DataFrame([words[k] if k is not None else (None,) * 4 for k in best], columns=["rank", "lang", "keyword", "theme"])

    return df.withColumn("__w", first("__cs", "__en"))


def _pieces(text: Column, longest: int = PIECE) -> Column:
    """All distinct pieces of a text of up to ``longest`` characters, the empty one too."""


    def of_length(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(n)))

    return F.array_distinct(F.concat(F.array(F.lit("")), *(of_length(n) for n in range(1, longest + 1))))


def _by_join(df: DataFrame, keywords: DataFrame) -> DataFrame:
    """Adds ``__w``, the first keyword in the record's labels, for any number of keywords."""
    low = F.lower("keyword")
    side = F.when(F.col("lang") == "cs", "cs").otherwise("en")
    known = keywords.where("keyword is not null").select(side.alias("side"), low.alias("low"), F.struct("rank", "lang", "keyword", "theme").alias("w"))
    known = known.groupBy("side", "low").agg(F.min("w").alias("w"))
    every = F.transform(F.sequence(F.lit(1), F.greatest(F.length("low") - PIECE + 1, F.lit(1))), lambda i: F.substring("low", i, F.lit(PIECE)))
    cut = known.select("*", F.explode(F.array_distinct(every)).alias("piece"))
    rare = Window.partitionBy("side", "low").orderBy("n", "piece")  # the rarest piece of each keyword
    keyed = cut.join(cut.groupBy("side", "piece").agg(F.count(F.lit(1)).alias("n")), ["side", "piece"]).withColumn("k", F.row_number().over(rare)).where("k = 1")
    labels = df.select(F.lit("cs").alias("side"), F.col("__cs").alias("label")).union(df.select(F.lit("en"), F.col("__en"))).distinct()
    met = labels.select("side", "label", F.explode(_pieces(F.col("label"))).alias("piece")).join(keyed.select("side", "piece", "low", "w"), ["side", "piece"])
    found = met.where(F.contains("label", F.col("low"))).groupBy("side", "label").agg(F.min("w").alias("w"))
    for name in ("cs", "en"):
        own = found.where(F.col("side") == name).select(F.col("label").alias(f"__{name}"), F.col("w").alias(f"__w{name}"))
        df = df.join(own, f"__{name}", "left")
    return df.withColumn("__w", F.least("__wcs", "__wen")).drop("__wcs", "__wen")


def first_keyword(records: DataFrame, keywords: DataFrame) -> DataFrame:
    """Adds ``__w`` (rank, lang, keyword, theme): the first keyword, by rank, language and itself, that the label of its
    language contains in any case; null where none does."""
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    df = records.withColumns({"__cs": low("cs"), "__en": low("en")})
    words = keywords.select(F.col("rank").cast("int").alias("rank"), "lang", "keyword", "theme")
    size = words.agg(F.sum(F.octet_length("keyword") + F.coalesce(F.octet_length("theme"), F.lit(0)) + 16)).first()[0] or 0
    found = None
    if size <= KEYWORD_BYTES:
        found = _by_automaton(df, words.withColumn("low", F.lower("keyword")).orderBy("rank", "lang", "keyword", "theme").collect())
    return (_by_join(df, words) if found is None else found).drop("__cs", "__en")


def nearest_branch(records: DataFrame, branches: DataFrame) -> DataFrame:
    """Adds ``__node`` and ``__near``: the record itself or its nearest ancestor that ``branches`` (ident, theme) maps."""
    own = branches.select(F.col("ident").alias("source_id"), F.col("theme").alias("__own"))
    chains = records.where("size(broader) > 0").select("broader").distinct().select("broader", F.posexplode("broader").alias("pos", "ident"))
    nearest = chains.join(branches, "ident").groupBy("broader").agg(F.max(F.struct("pos", "ident", "theme")).alias("__up"))
    both = records.join(own, "source_id", "left").join(nearest, "broader", "left")
    node = F.when(F.col("__own").isNotNull(), F.col("source_id")).otherwise(F.col("__up.ident"))
    return both.withColumns({"__node": node, "__near": F.coalesce("__own", "__up.theme")}).drop("__own", "__up")


def place(records: DataFrame, overrides: DataFrame, maps: DataFrame, keywords: DataFrame) -> DataFrame:
    """Adds theme and placed_by: an override, else the list's map, else the nearest mapped ancestor, else a keyword, else Other.

    ``overrides``: source, source_id, theme. ``maps``: kind ("list" by scheme, "branch" by id), ident, theme. ``keywords``:
    lang ("cs", "en"), keyword, theme, rank (order of themes, languages and keywords). Of rules with one key the first theme
    counts; rules without a theme are none.
    """
    over = overrides.where("theme is not null").groupBy("source", "source_id").agg(F.min("theme").alias("__o"))
    themes = maps.where("theme is not null").groupBy("kind", "ident").agg(F.min("theme").alias("theme"))
    lists = themes.where("kind = 'list'").select(F.col("ident").alias("scheme"), F.col("theme").alias("__l"))
    df = records.join(over, ["source", "source_id"], "left").join(lists, "scheme", "left")
    df = first_keyword(nearest_branch(df, themes.where("kind = 'branch'").select("ident", "theme")), keywords)
    theme = F.coalesce("__o", "__l", "__near", "__w.theme", F.lit(OTHER))
    rule = (
        F.when(F.col("__o").isNotNull(), F.concat(F.lit("override:"), "source", F.lit(":"), "source_id"))
        .when(F.col("__l").isNotNull(), F.concat(F.lit("list:"), "scheme"))
        .when(F.col("__near").isNotNull(), F.concat(F.lit("branch:"), "__node"))
        .when(F.col("__w.theme").isNotNull(), F.concat(F.lit("keyword:"), F.col("__w.lang"), F.lit(":"), F.col("__w.keyword")))
        .otherwise("other")
    )
    return df.select(*(F.col(c) for c in records.columns), theme.alias("theme"), rule.alias("placed_by"))
