"""Source divergence audit: how the sources of a language differ from it and from each other in the terms that they use.

Terms are runs of ASCII letters and of everything beyond ASCII, A-Z in lower case. A language keeps the V terms that at least
``min_documents`` of its documents hold. A group, one source of a language, and the language itself give each kept term, with
count >= 0 occurrences there, p = 1 + floor(10^9 (count + 5) / (N + 5 V)), N the sum of the counts. All of it is exact: counts
are longs, products beyond them decimals.

1. Count (Arrow, one pass): a task adds up its documents' terms by group, vectorised, with the number of documents beside the
   number of occurrences, and sends them when ``HELD`` of them have gathered. One exchange by group and term adds these up.
2. Part ``pair``: sum of |p_g - p_o| over all kept terms. Terms that neither source holds all differ by the same, so the
   sum is made of what each source's own terms differ from the other's p at count 0, and of a correction for each term that
   stands in both postings. Cells (language, share of the terms, block of sources x block of sources) hold some
   ``CELL_POSTINGS`` postings each, and a cell leaves one number for each pair of its sources.
3. Part ``term``: the kept terms of which a group has more than its language (p > q), by p - q, up to rank ``k``. A group's
   terms fall into buckets by their count; in a bucket p is p of the largest count at most and q at least that of the smallest
   count in the language, which bounds f. The search is best-first in two waves over all groups at once: the buckets of
   highest bound that hold ``k`` terms together, then those whose bound isn't below the k-th value that the first wave found.
   What is left unseen lies strictly below it, so ties at rank ``k`` are all seen.

Scale: what is shuffled are counts, not words. A source with a third of all rows has its counts spread over its terms, and
is summed in the tasks first; a term that all sources hold is cut by blocks of sources. Pairs of sources are the result itself.
Tables of groups and of buckets (some hundred rows for a group) are broadcast up to ``BROADCAST_ROWS`` rows, joined beyond.

Defined results: null text, language or source count as empty strings. A group without terms has its pairs, and no term
rows. Without kept terms (V = 0) pair values are 0. A source that is alone in its language has no pairs. Repeated rows count
as documents each. A very long text is one vectorised step of its own. Other columns, whatever their names, are not read. No
documents give no rows. Words are told apart within a task by 64-bit hashes, and by themselves from then on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivolt.llm._common import byte_class, drop_written, find_words, ship, steps, text_bytes, trim_memory, written

#: Letters, and everything beyond ASCII.
LETTERS = byte_class(word_bytes=b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: Counts that a task holds before it sends them.
HELD = 400_000
UNIT = 1_000_000_000
#: Postings of a cell, about, and sources on each side of it.
CELL_POSTINGS = 100_000
CELL_SOURCES = 128
#: Buckets for each doubling of a count.
PER_DOUBLING = 4
BROADCAST_ROWS = 500_000


class _Counts:
    """Occurrences and documents of terms by group, as a task gathers them."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.names: dict[int, bytes] = {}
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def codes(self, langs: list[str], sources: list[str]) -> np.ndarray:
        return np.array([self.groups.setdefault(g, len(self.groups)) for g in zip(langs, sources, strict=True)], np.int64)

    def add(self, data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> None:
        """Counts some documents, of which each belongs to a group."""
        import pandas as pd

        words = find_words(data, offsets, LETTERS)
        if not len(words.hashes):
            return
        code, known = pd.factorize(words.hashes)
        doc = np.repeat(np.arange(len(group)), np.diff(words.bounds))
        pairs, times = np.unique(doc * len(known) + code, return_counts=True)
        both = group[pairs // len(known)] * len(known) + pairs % len(known)
        order = np.argsort(both, kind="stable")
        both = both[order]
        begin = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        n, docs = np.add.reduceat(times[order], begin), np.diff(np.append(begin, len(both)))
        first = np.empty(len(known), np.int64)
        first[code] = np.arange(len(code))  # any place of the word
        folded = words.folded.tobytes()
        at, to = words.starts[first].tolist(), words.ends[first].tolist()
        for h, a, b in zip(known.tolist(), at, to, strict=True):
            if h not in self.names:
                self.names[h] = folded[a:b]
        self.parts.append((both[begin] // len(known), known[both[begin] % len(known)], n.astype(np.int64), docs.astype(np.int64)))
        self.size += len(begin)
        if self.size > 2 * HELD:
            self.fold()

    def fold(self) -> None:
        """Adds equal counts up."""
        if len(self.parts) < 2:
            return
        of, h, n, docs = (np.concatenate(p) for p in zip(*self.parts, strict=True))
        order = np.lexsort((h, of))
        of, h = of[order], h[order]
        begin = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (h[1:] != h[:-1])))
        self.parts = [(of[begin], h[begin], np.add.reduceat(n[order], begin), np.add.reduceat(docs[order], begin))]
        self.size = len(begin)

    def sent(self) -> Iterator[pa.RecordBatch]:
        """All counts as rows, and a row without a term for each group; nothing stays."""
        self.fold()
        names = [*self.groups]
        lang, source = (pa.array([g[i] for g in names], pa.string()) for i in (0, 1))
        empty = pa.array([None] * len(names), pa.string())
        none = pa.array(np.zeros(len(names), np.int64))
        yield pa.RecordBatch.from_arrays([lang, source, empty, none, none], names=_NAMES)
        for of, h, n, docs in self.parts:
            for a in range(0, len(of), 50_000):
                b = a + 50_000
                terms = pa.array([self.names[x] for x in h[a:b].tolist()], pa.binary()).cast(pa.string())
                at = pa.array(of[a:b])
                yield pa.RecordBatch.from_arrays([lang.take(at), source.take(at), terms, pa.array(n[a:b]), pa.array(docs[a:b])], names=_NAMES)
        self.__init__()


_NAMES = ["lang", "source", "term", "n", "docs"]


def term_counts(docs: DataFrame) -> DataFrame:
    """(text, lang, source), none null, to (lang, source, term, n, docs): each group's terms with their occurrences and
    documents, and each group once with a null term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for a, b in steps(off):
                counts.add(data, off[a : b + 1], counts.codes(langs[a:b], sources[a:b]))
                if counts.size > HELD:
                    counts.fold()
                if counts.size > HELD or len(counts.names) > HELD:
                    yield from counts.sent()
        yield from counts.sent()
        trim_memory()

    parts = docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """p of a count in a group of ``total`` occurrences of ``terms`` kept terms; null without terms."""
    whole = F.nullif(total.cast("decimal(19,0)") + 5 * terms.cast("decimal(12,0)"), F.lit(0).cast("decimal(19,0)"))
    each = (count.cast("decimal(19,0)") + 5) * F.lit(UNIT).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", each, whole)


def _sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table, which is written, to be broadcast if it is small."""
    return F.broadcast(df) if df.count() <= rows else df


def _shares(n: np.ndarray, total: int, terms: int) -> np.ndarray:
    """``share`` of many counts; Python's integers where longs might not do."""
    whole = total + 5 * terms
    if len(n) and int(n.max()) >= (1 << 63) // UNIT - 5:
        return np.array([1 + UNIT * (int(x) + 5) // whole for x in n], np.int64)
    return 1 + UNIT * (n + 5) // whole


class _Postings:
    """The sources of one side of a cell, with their terms in it: p of each, and p at count 0."""

    def __init__(self, table: pa.Table, codes: dict[str, int]):
        lone = table["term"].is_null()
        heads = table.filter(lone).sort_by("source")
        self.names: list[str] = heads["source"].to_pylist()
        totals = list(zip(heads["total"].to_pylist(), heads["kept"].to_pylist(), strict=True))
        self.zero = np.array([int(_shares(np.zeros(1, np.int64), t, v)[0]) if t + 5 * v else 0 for t, v in totals], np.int64)
        own = table.filter(pa.compute.invert(lone)).sort_by("source")
        place = {s: i for i, s in enumerate(self.names)}
        source = np.array([place[s] for s in own["source"].to_pylist()], np.int64)
        self.bounds = np.searchsorted(source, np.arange(len(self.names) + 1))
        self.term = np.array([codes.setdefault(t, len(codes)) for t in own["term"].to_pylist()], np.int64)
        n = own["n"].to_numpy()
        self.p = np.concatenate([_shares(n[a:b], *totals[i]) for i, (a, b) in enumerate(zip(self.bounds[:-1], self.bounds[1:], strict=True)) if b > a] or [np.zeros(0, np.int64)])
        self.source = source


def _own_terms(x: _Postings, y: _Postings) -> np.ndarray:
    """For each source of x and each of y the sum of |p - z| over x's terms, z the other's p at count 0, less |z - z'|."""
    out = np.zeros((len(x.names), len(y.names)), np.int64)
    for i, (a, b) in enumerate(zip(x.bounds[:-1], x.bounds[1:], strict=True)):
        p = np.sort(x.p[a:b])
        upto = np.concatenate(([0], np.cumsum(p)))
        k = np.searchsorted(p, y.zero)
        out[i] = (upto[-1] - upto[k]) - (len(p) - k) * y.zero + k * y.zero - upto[k] - len(p) * np.abs(x.zero[i] - y.zero)
    return out


def pair_parts(x: _Postings, y: _Postings, n_terms: int) -> np.ndarray:
    """Of each source of x with each of y what the cell's terms add to the sum of |p_g - p_o|, less what they would add if
    neither held them."""
    out = _own_terms(x, y) + _own_terms(y, x).T
    buffer = np.zeros(n_terms, np.int64)
    filled = np.flatnonzero(np.diff(y.bounds))
    if not len(filled):
        return out
    zero = y.zero[y.source]
    for i, (a, b) in enumerate(zip(x.bounds[:-1], x.bounds[1:], strict=True)):
        buffer[x.term[a:b]] = x.p[a:b]
        other = buffer[y.term]
        z = x.zero[i]
        both = np.abs(other - y.p) - np.abs(other - zero) - np.abs(z - y.p) + np.abs(z - zero)
        out[i, filled] += np.add.reduceat(np.where(other > 0, both, 0), y.bounds[filled])
        buffer[x.term[a:b]] = 0
    return out


_CELL = ["lang", "part", "bx", "by"]


def _pairs(postings: DataFrame, groups: DataFrame, n_postings: int, most_sources: int) -> DataFrame:
    """(lang, source, item, value) of each two sources of a language, in both orders."""
    parts, blocks = max(1, -(-n_postings // CELL_POSTINGS)), max(1, -(-most_sources // CELL_SOURCES))
    block = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")
    heads = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), "total", "kept")
    heads = heads.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    of = groups.select("lang", "source", "total", "kept")
    dealt = postings.join(of, ["lang", "source"]).select("lang", "source", "term", "n", "total", "kept", F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int").alias("part"))
    dealt = dealt.unionByName(heads).withColumn("block", block)
    x = dealt.select("*", F.col("block").alias("bx"), F.explode(F.sequence(F.col("block"), F.lit(blocks - 1))).alias("by"), F.lit(True).alias("left"))
    y = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("block"))).alias("bx"), F.col("block").alias("by"), F.lit(False).alias("left")).where("bx < by")

    def compare(table: pa.Table) -> pa.Table:
        codes: dict[str, int] = {}
        left = _Postings(table.filter(table["left"]), codes)
        same = table["bx"][0].as_py() == table["by"][0].as_py()
        right = left if same else _Postings(table.filter(pa.compute.invert(table["left"])), codes)
        found = pair_parts(left, right, len(codes))
        i, j = np.nonzero(np.triu(np.ones(found.shape, bool), 1) if same else np.ones(found.shape, bool))
        a, b = pa.array(left.names, pa.string()), pa.array(right.names, pa.string())
        lang = pa.array([table["lang"][0].as_py()] * len(i), pa.string())
        return pa.table({"lang": lang, "a": a.take(pa.array(i)), "b": b.take(pa.array(j)), "value": pa.array(found[i, j])})

    added = x.unionByName(y).groupBy(*_CELL).applyInArrow(compare, "lang string, a string, b string, value long")
    sums = added.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    zero = groups.select("lang", "source", "kept", share(F.lit(0), F.col("total"), F.col("kept")).alias("zero"))
    za, zb = zero.select("lang", F.col("source").alias("a"), F.col("zero").alias("za"), "kept"), zero.select("lang", F.col("source").alias("b"), F.col("zero").alias("zb"))
    rest = F.coalesce(F.col("kept") * F.abs(F.col("za") - F.col("zb")), F.lit(0))
    both = sums.join(za, ["lang", "a"]).join(zb, ["lang", "b"]).select("lang", "a", "b", (F.col("value") + rest).alias("value"))
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return both.select("lang", sides.alias("s"), "value").select("lang", "s.source", "s.item", "value")


def _with_shares(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """Postings with p, q and f."""
    both = postings.join(groups.select("lang", "source", "total", "kept", "lang_total"), ["lang", "source"])
    p, q = share(F.col("n"), F.col("total"), F.col("kept")), share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    return both.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q").select("lang", "source", "item", (F.col("p") - F.col("q")).alias("value"))


def _terms(postings: DataFrame, groups: DataFrame, k: int) -> DataFrame:
    """(lang, source, item, value, rank) of the ``k`` kept terms of which a group has most beyond its language."""
    group = ["lang", "source"]
    bucket = F.floor(F.log2(F.col("n").cast("double")) * PER_DOUBLING).cast("int").alias("bucket")
    placed = postings.withColumn("bucket", bucket)
    buckets = placed.groupBy(*group, "bucket").agg(F.max("n").alias("most"), F.min("lang_n").alias("least"), F.count(F.lit(1)).alias("terms"))
    buckets = buckets.join(groups.select(*group, "total", "kept", "lang_total"), group)
    bound = share(F.col("most"), F.col("total"), F.col("kept")) - share(F.col("least"), F.col("lang_total"), F.col("kept"))
    best = Window.partitionBy(*group).orderBy(F.desc("bound"), F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(*group, "bucket", "terms", bound.alias("bound")).where("bound > 0")
    buckets = written(buckets.select(*group, "bucket", "bound", F.coalesce(F.sum("terms").over(best), F.lit(0)).alias("before")), "buckets")

    first = _sized(buckets).where(F.col("before") < k).select(*group, "bucket")
    seen = written(_with_shares(placed.join(first, [*group, "bucket"], "left_semi"), groups), "first_wave")
    order = Window.partitionBy(*group).orderBy(F.desc("value"), "item")
    kth = seen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select(*group, F.col("value").alias("kth"))
    later = buckets.where(F.col("before") >= k).join(kth, group, "left").where(F.col("kth").isNull() | (F.col("bound") >= F.col("kth"))).select(*group, "bucket")
    later = written(later, "second_wave_buckets")
    more = _with_shares(placed.join(_sized(later), [*group, "bucket"], "left_semi"), groups)
    return seen.unionByName(more).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def audit(
    docs: DataFrame, *, min_documents: int = 30, k: int = 50, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has each other source of the language by divergence, all ranks;
    part ``term`` the kept terms of which the group has most beyond its language, up to rank ``k``."""
    ship(docs.sparkSession)
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    counts = written(term_counts(named), "term_counts")
    of_lang = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = of_lang.where(F.col("docs") >= min_documents).select("lang", "term", "lang_n")
    postings = written(counts.where("term is not null").select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "postings")

    langs = postings.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = counts.where("term is null").select("lang", "source")
    none = F.lit(0).cast("long")
    groups = every.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = written(groups.select("lang", "source", *(F.coalesce(c, none).alias(c) for c in ("total", "kept", "lang_total"))), "groups")
    drop_written(counts)
    most = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    sized = _sized(groups)

    pair = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(postings, sized, postings.count(), most).withColumn("rank", F.row_number().over(pair))
    columns = ["lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")]
    terms = _terms(postings, sized, k)
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(terms.withColumn("part", F.lit("term")).select(*columns))
