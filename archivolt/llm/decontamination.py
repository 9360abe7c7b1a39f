"""Benchmark decontamination by winnowing.

Every window of 13 consecutive item words (an item of fewer words is one window of its own length) leaves one
fingerprint: the least hash among the k-word grams that the window holds. Documents are fingerprinted alike, so a
document that contains a window has that window's fingerprint, whatever stands around it: with k = 5 and 9 grams to a
window, no shared span of 13 words can be missed. Fingerprints are joined, and each match is extended over the windows
that carry it, which are compared word for word.

Scale: a benchmark of at most ``block_bytes``, ids and a fixed number of bytes for each item included, which is measured, is
indexed once and broadcast; documents are read in one pass without a shuffle, and windows are compared word for word. A larger
one is joined: a filter, a bit in ``BITS_A_WINDOW`` for each of the benchmark's windows, tells a task which of its documents'
fingerprints can occur there, and only these leave it, each with the place and 128 bits of hash of its window. Beyond
``FILTER_WORDS`` words of 64 bits there is no filter, and all windows of the lengths that the benchmark has leave it. They are
joined with the benchmark's windows by fingerprint and hash, and hits are merged for each distinct text, and joined back to
the documents. Hit spans are merged ranges in order on either path. A passage that many
documents share is a skewed join key, which adaptive execution splits. Nothing of the benchmark is on the driver but the
filter, and no text moves. A lost executor only repeats its own part of the scan.

Defined results: a null or empty text has no words and is clean. Items without words never match. A null ``item_id``
contributes hits but no item. Repeated rows each get their own result row; repeated items count once. A very long text is
one vectorised step of its own. Other columns may have any name; carried ones that clash with results are left out. No
documents give no rows; without a benchmark every document is clean.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivolt.llm._common import ALNUM_WORDS, find_words, mix, ship, signed, steps, text_bytes, written

WINDOW = 13
GRAM = 5


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def _grams(words: np.ndarray, k: int, salt: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of the ``k`` words from every position, or from the positions ``at``."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    take = (lambda j: words[j : j + n]) if at is None else (lambda j: words[at + j])
    out = np.full(n if at is None else len(at), salt, np.uint64)
    for j in range(k):
        out *= np.uint64(0x2545F4914F6CDD1D)
        out += take(j)
    return mix(out)


def _fingerprints(words: np.ndarray, m: int) -> np.ndarray:
    """Winnowed fingerprint of every window of ``m`` words: the least of its grams' hashes."""
    k = min(GRAM, m)
    grams = _grams(words, k, 1)
    return _sliding_min(grams, m - k + 1) if len(words) >= m else np.zeros(0, np.uint64)


@dataclass
class _Length:
    """Windows of one length: their fingerprints, hashes, places in the index's text, and items."""

    m: int
    salt: int
    maybe: np.ndarray
    prints: np.ndarray
    hashes: np.ndarray
    spans: np.ndarray
    item_from: np.ndarray
    items: np.ndarray


@dataclass
class Index:
    """What one block of the benchmark contains."""

    text: bytes
    item_ids: list
    lengths: list[_Length]


def build_index(item_ids: list, texts: list, window: int = WINDOW) -> Index:
    """Index of one block of items, built from their whole texts."""
    data, off = text_bytes(pa.array(texts, pa.large_string()))
    words = find_words(data, off, ALNUM_WORDS)
    text, at, _ = words.canonical()
    counts = np.diff(words.bounds)
    classes = []
    for m in sorted({min(int(c), window) for c in counts if c}):
        own = np.flatnonzero((counts >= window) if m == window else (counts == m))
        start = np.concatenate([np.arange(words.bounds[i], words.bounds[i + 1] - m + 1) for i in own])
        item = np.repeat(own, counts[own] - m + 1)
        salt = 3
        while True:  # until no two different windows share a hash
            hashes = _grams(words.hashes, m, salt, start)
            order = np.lexsort((item, hashes))
            unique, first = np.unique(hashes[order], return_index=True)
            last = np.append(first[1:], len(order))
            spans = np.stack([at[start[order]], at[start[order] + m]], 1)
            if all(len({text[a:b] for a, b in spans[f:e]}) == 1 for f, e in zip(first, last, strict=True) if e - f > 1):
                break
            salt += 2
        pairs = np.unique(np.stack([np.repeat(np.arange(len(unique)), last - first), item[order]], 1), axis=0)
        prints = np.unique(_fingerprints(words.hashes, m)[start])
        maybe = np.zeros(1 << 16, bool)
        maybe[prints >> np.uint64(48)] = True
        item_from = np.searchsorted(pairs[:, 0], np.arange(len(unique) + 1))
        classes.append(_Length(m, salt, maybe, prints, unique, spans[first], item_from, pairs[:, 1]))
    return Index(text, list(item_ids), classes)


def find_hits(data: np.ndarray, offsets: np.ndarray, index: Index) -> tuple[np.ndarray, list, list]:
    """Of some documents: word counts, merged hit spans [from, to) in words, and the items whose windows occur."""
    words = find_words(data, offsets, ALNUM_WORDS)
    counts, n = np.diff(words.bounds), len(words.hashes)
    spans: list = [[] for _ in counts]
    items: list = [[] for _ in counts]
    ends = np.repeat(words.bounds[1:], counts)
    text, delta, found = b"", np.zeros(n + 1, np.int32), []
    at = None
    for c in index.lengths:
        if n < c.m:
            continue
        prints = _fingerprints(words.hashes, c.m)
        likely = np.flatnonzero(c.maybe[prints >> np.uint64(48)])
        likely = likely[likely + c.m <= ends[likely]]
        place = np.minimum(np.searchsorted(c.prints, prints[likely]), len(c.prints) - 1)
        likely = likely[c.prints[place] == prints[likely]]
        if not len(likely):
            continue
        hashes = _grams(words.hashes, c.m, c.salt, likely)
        place = np.minimum(np.searchsorted(c.hashes, hashes), len(c.hashes) - 1)
        same = c.hashes[place] == hashes
        for i, w in zip(likely[same].tolist(), place[same].tolist(), strict=True):
            if at is None:
                text, at, _ = words.canonical()
            a, b = c.spans[w]
            if text[at[i] : at[i + c.m]] == index.text[a:b]:
                delta[i] += 1
                delta[i + c.m] -= 1
                found.append((i, c, w))
    if found:
        inside = np.cumsum(delta[:-1]) > 0
        edge = inside.copy()
        edge[1:] &= ~inside[:-1]
        firsts = words.bounds[:-1][counts > 0]
        edge[firsts] = inside[firsts]
        begin = np.flatnonzero(edge)
        stop = np.minimum(ends[begin], np.append(begin[1:], n))
        total = np.concatenate(([0], np.cumsum(inside)))
        of = np.searchsorted(words.bounds, begin, "right") - 1
        for d, a, b in zip(of.tolist(), begin.tolist(), stop.tolist(), strict=True):
            base = int(words.bounds[d])
            spans[d].append((a - base, a - base + int(total[b] - total[a])))
        seen = {}
        for i, c, w in found:
            seen.setdefault((int(np.searchsorted(words.bounds, i, "right")) - 1, c.m, w), c)
        for (d, _, w), c in seen.items():
            items[d].extend(c.items[c.item_from[w] : c.item_from[w + 1]].tolist())
    names = [sorted({index.item_ids[j] for j in own} - {None}) for own in items]
    return counts, spans, names


_SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
_RESULT = "__av_words long, __av_spans array<struct<a:long,b:long>>, __av_items array<string>"


def _scan(docs: DataFrame, text_col: str, carry: list[str], index) -> DataFrame:
    """The carried columns of every document, with its words, hit spans and items."""
    fields = [f for f in docs.schema.fields if f.name in carry]
    schema = T.StructType([*fields, *T._parse_datatype_string(_RESULT).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            data, off = text_bytes(batch.column(text_col))
            for a, b in steps(off):
                counts, spans, items = find_hits(data, off[a : b + 1], own)
                kept = [batch.column(f.name)[a:b] for f in fields]
                got = [
                    pa.array(counts, pa.int64()),
                    pa.array([[{"a": x, "b": y} for x, y in s] for s in spans], _SPANS),
                    pa.array(items, pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays([*kept, *got], names=schema.names)

    return docs.mapInArrow(run, schema)


#: 64-bit words of the largest filter of fingerprints, a power of two: 16 MB.
FILTER_WORDS = 1 << 21
BITS_A_WINDOW = 8
#: Bytes that an item counts beside its id and text.
ITEM_BYTES = 64


def _window_rows(data: np.ndarray, offsets: np.ndarray, lengths: list[int] | None = None, filter_: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Of some texts: the word counts, and for each window of the ``lengths`` (None: windows of items, which have their own)
    that the filter, if there is one, lets pass its text, place, length, fingerprint and two hashes."""
    words = find_words(data, offsets, ALNUM_WORDS)
    counts, n = np.diff(words.bounds), len(words.hashes)
    ends = np.repeat(words.bounds[1:], counts)
    text = np.repeat(np.arange(len(counts)), counts)
    found = []
    for m in range(1, WINDOW + 1) if lengths is None else lengths:
        if n < m:
            continue
        at = np.arange(n - m + 1)
        at = at[at + m <= ends[at]]
        if lengths is None and m < WINDOW:  # an item's own length
            at = at[counts[text[at]] == m]
        prints = _fingerprints(words.hashes, m)[at] ^ mix(np.full(1, m, np.uint64))
        if filter_ is not None:
            bits = filter_[(prints >> np.uint64(6)).astype(np.int64) & (len(filter_) - 1)]
            keep = ((bits >> (prints & np.uint64(63))) & np.uint64(1)).astype(bool)
            at, prints = at[keep], prints[keep]
        hashes = [signed(_grams(words.hashes, m, salt, at)) if len(at) else np.zeros(0, np.int64) for salt in (3, 5)]
        found.append((text[at], at - words.bounds[text[at]], np.full(len(at), m), signed(prints), *hashes))
    return (counts, *(map(np.concatenate, zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 6))


_WINDOW = "m int, fp long, h1 long, h2 long"


def merged_spans(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, those that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _joined_hits(texts: DataFrame, items: DataFrame) -> DataFrame:
    """(th, t) and (i, t) to (th, spans, items): the hits of each distinct text that has any, with the benchmark of any size."""
    spark = texts.sparkSession

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column("t"))
            for a, b in steps(off):
                _, text, _, m, fp, h1, h2 = _window_rows(data, off[a : b + 1])
                own = batch.column("i").take(pa.array(text + a))
                yield pa.RecordBatch.from_arrays([own, pa.array(m, pa.int32()), *map(pa.array, (fp, h1, h2))], names=["i", "m", "fp", "h1", "h2"])

    known = written(items.mapInArrow(windows, f"i string, {_WINDOW}").distinct(), "benchmark_windows")
    n, lengths = known.agg(F.count(F.lit(1)), F.sort_array(F.collect_set("m"))).first()  # at most WINDOW lengths
    filter_ = None
    if n * BITS_A_WINDOW <= FILTER_WORDS * 64:
        size = 1 << max(0, (n * BITS_A_WINDOW // 64).bit_length())
        word = F.shiftright("fp", 6).bitwiseAND(F.lit(min(size, FILTER_WORDS) - 1)).alias("word")
        bits = known.select(word, F.expr("shiftleft(1L, cast(fp & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        filter_ = np.zeros(min(size, FILTER_WORDS), np.uint64)
        filter_[bits["word"].to_numpy()] = bits["bits"].to_numpy().view(np.uint64)
    wanted = spark.sparkContext.broadcast((lengths, filter_))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column("t"))
            for a, b in steps(off):
                _, text, at, m, fp, h1, h2 = _window_rows(data, off[a : b + 1], *wanted.value)
                own = batch.column("th").take(pa.array(text + a))
                yield pa.RecordBatch.from_arrays([own, pa.array(at), pa.array(m, pa.int32()), *map(pa.array, (fp, h1, h2))], names=["th", "at", "m", "fp", "h1", "h2"])

    met = texts.mapInArrow(candidates, f"th string, at long, {_WINDOW}").distinct().join(known, ["m", "fp", "h1", "h2"])
    span = F.struct(F.col("at").alias("a"), (F.col("at") + F.col("m")).alias("b"))
    hits = met.groupBy("th").agg(F.collect_set(span).alias("spans"), F.collect_set("i").alias("items"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"a": a, "b": b} for a, b in merged_spans((x["a"], x["b"]) for x in own)] for own in batch.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("th"), pa.array(spans, _SPANS), batch.column("items")], names=["th", "spans", "items"])

    return hits.mapInArrow(merge, "th string, spans array<struct<a:long,b:long>>, items array<string>")


def _scan_joined(docs: DataFrame, items: DataFrame, text_col: str, carry: list[str]) -> DataFrame:
    """As ``_scan``, for a benchmark of any size."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumn("__av_th", F.sha2(text, 256))
    hits = written(_joined_hits(keyed.select(F.col("__av_th").alias("th"), text.alias("t")), items), "hits")
    counted = _scan(keyed, text_col, [*carry, "__av_th"], docs.sparkSession.sparkContext.broadcast(Index(b"", [], [])))
    both = counted.alias("d").join(hits.alias("h"), F.col("__av_th") == F.col("h.th"), "left")
    spans = F.coalesce("h.spans", F.array().cast("array<struct<a:bigint,b:bigint>>")).alias("__av_spans")
    return both.select(*(F.col(f"d.`{c}`") for c in carry), "__av_words", spans, F.coalesce("h.items", F.array().cast("array<string>")).alias("__av_items"))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    carry: list[str] | None = None,
    block_bytes: int = 8 << 20,
    min_share: tuple[int, int] = (1, 20),
) -> DataFrame:
    """One row per document: the carried columns, then n_words, n_hit, n_items, items (sorted), hit_spans, contaminated.

    A document is contaminated when it has a hit and at least ``min_share`` of its words are hit. Carried columns whose
    names clash with results are left out.
    """
    results = {"n_words", "n_hit", "n_items", "items", "hit_spans", "contaminated"}
    carry = [c for c in (docs.columns if carry is None else carry) if c not in results]
    ship(docs.sparkSession)
    items = benchmark.select(F.col(item_col).cast("string").alias("i"), F.coalesce(F.col(item_text_col), F.lit("")).alias("t"))
    source = docs.select(*dict.fromkeys([*carry, text_col]))
    size = F.octet_length("t") + F.coalesce(F.octet_length("i"), F.lit(0)) + ITEM_BYTES
    if (items.agg(F.sum(size)).first()[0] or 0) <= block_bytes:
        rows = items.toArrow().to_pydict()
        found = _scan(source, text_col, carry, docs.sparkSession.sparkContext.broadcast(build_index(rows["i"], rows["t"])))
    else:
        found = _scan_joined(source, items, text_col, carry)
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    merged = F.aggregate(
        F.sort_array("__av_spans"),
        start,
        lambda acc, x: F.struct(
            (acc.n + F.greatest(F.lit(0), x.b - F.greatest(acc.upto, x.a))).alias("n"), F.greatest(acc.upto, x.b).alias("upto")
        ),
        lambda acc: acc.n,
    )
    num, den = min_share
    out = found.select(
        *carry,
        F.col("__av_words").alias("n_words"),
        merged.alias("n_hit"),
        F.array_sort(F.array_distinct("__av_items")).alias("items"),
        F.col("__av_spans").alias("hit_spans"),
    )
    return out.withColumn("n_items", F.size("items").cast("long")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * den >= F.col("n_words") * num)
    )
