"""PII by information-theoretic sanitisation.

Base patterns (e-mail, IP, card and phone numbers) give the protected entities. How strongly a term reveals one is
estimated from the corpus: term t and entity e meet in a document when t stands within ``window`` lines of e. With p(e|t)
the share of the documents holding t in which the two meet, and p(e) the share of all documents that hold e, the disclosure
of e by t is PMI(e; t) / IC(e) = log(p(e|t) / p(e)) / -log p(e). It is 1 when the term gives the entity away and 0 when they
are independent. No pair is too rare to count: p(e|t) is drawn towards p(e) by the weight of one document against the s
documents in which the two meet (copies of the line that holds t add none), so that it is about half of its observed share
for s = 1. A term is sensitive to an entity when its disclosure reaches ``generalise_at``; from ``remove_at`` on it is
removed, below it is generalised to its shape. So a word of one document, beside an entity of that document alone, is
generalised in a corpus of some thousand documents or more, and removed on firmer evidence. Every occurrence of a sensitive
term is treated in all documents that hold the entity. Terms have no minimum length.

Scale: the first pass (Arrow, no exchange) finds base spans, and for documents with an entity its entities, its places (the
sets of lines near one entity or more) with the terms in each, and all its terms; they travel as 64-bit hashes, and one
document's rows leave in batches of bounded size. Entities that have the same places in all documents, as many addresses in
one line do, meet the same terms as often and are one class, so no pair is made of each entity and each term. Counts are
combined by (class, term) and are over all documents. Document counts are needed only for terms
that meet an entity: tasks send the counts of terms whose hash is in a broadcast filter of at most ``FILTER_WORDS`` words of
64 bits, and a join drops what else passes it. Documents' terms are joined with sensitive ones by term, then with their
document's entities; a sensitive term is seldom found apart from its entity, so the join has about as many rows as pairs
have meetings. A hot entity spreads over its terms; nothing is gathered by entity. The last pass gets each document's
sensitive terms and finds their places, in one Python step. Those lists are broadcast up to ``BROADCAST_TERMS`` terms.

Defined results: a null text is empty (and stays null when sanitised). Rows that agree in id and text share their spans;
each is returned, and count as documents each. Entities are compared in lower case, numbers by their digits. Base spans are
found in time linear in the text, so that a very long token or number does no harm; a line of m entities and n terms has n
pairs for each class of its entities. Ids must be numbers that fit a long. Other columns may have any name; carried ones that clash with results
are left out. No documents give no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivolt.llm._common import drop_written, ship, trim_memory, written

KINDS = ("email", "ip", "card", "phone")
#: The base patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: The same patterns for a search in linear time: no run of characters is tried again from within. The first of each pair is
#: tried where the last match ended, the second is searched for from there.
_FIND = {
    "email": (
        re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
        re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    ),
    "ip": (re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"), re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")),
    "card": (re.compile(r"[0-9](?:[\x20-]?[0-9])++"), re.compile(r"[0-9](?:[\x20-]?[0-9])++")),
    "phone": (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
}
_DIGIT = re.compile("[0-9]")
#: 64-bit words of the filter of terms, a power of two; 16 MB at most.
FILTER_WORDS = 1 << 21
#: Up to this many term spans are broadcast.
BROADCAST_TERMS = 200_000
WINDOW = 2
_WORD = re.compile("[^\x20\x09-\x0D]+")
_EDGES = b"".join(bytes([c]) for c in range(33, 127) if not chr(c).isalnum())


def luhn(digits: str) -> bool:
    """Whether a digit string passes the Luhn check."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _passes(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(int(part) <= 255 if len(part) < 19 else int(part.lstrip("0")[:4] or 0) <= 255 for part in found.split("."))
    if kind == "email":
        return True
    digits = "".join(_DIGIT.findall(found))
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def _matches(kind: str, text: str) -> Iterator[re.Match]:
    """Leftmost non-overlapping matches of a base pattern."""
    here, later = _FIND[kind]
    at = 0
    while found := (at and here.match(text, at)) or later.search(text, at):
        yield found
        at = found.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, rank of the kind) of a text's personal data, by start, then by kind."""
    out = []
    for rank, kind in enumerate(KINDS):
        if kind == "email" and "@" not in text or kind == "phone" and "+" not in text or kind != "email" and not _DIGIT.search(text):
            continue
        out += [(m.start(), m.end(), rank) for m in _matches(kind, text) if _passes(kind, m[0])]
    return sorted(out, key=lambda x: (x[0], x[2]))


def entity_of(kind: str, found: str) -> str:
    """The form in which an entity is compared."""
    return f"{kind}:{found.lower() if kind in ('email', 'ip') else ''.join(_DIGIT.findall(found))}"


def context_terms(text: str, spans: list[tuple[int, int, int]], window: int = WINDOW) -> tuple[list[str], list[list[tuple[str, int, int]]], dict[str, list[int]]]:
    """The lines; of each line the terms with their places, but those that overlap personal data; and of each entity the
    lines within ``window`` lines of it."""
    lines = text.split("\n")
    starts = [0]
    for line in lines[:-1]:
        starts.append(starts[-1] + len(line) + 1)
    own: dict[int, list[tuple[int, int]]] = {}
    near: dict[str, set[int]] = {}
    for a, b, k in spans:
        at = bisect_right(starts, a) - 1  # no pattern goes beyond a line
        own.setdefault(at, []).append((a, b))
        near.setdefault(entity_of(KINDS[k], text[a:b]), set()).update(range(max(0, at - window), min(len(lines), at + window + 1)))
    edges, terms = _EDGES.decode(), []
    for i, line in enumerate(lines):
        taken, ends = [], []
        for a, b in own.get(i, ()):  # by start: runs of overlapping spans as one
            if taken and a < ends[-1]:
                ends[-1] = max(ends[-1], b)
            else:
                taken.append(a)
                ends.append(b)
        found = []
        for m in _WORD.finditer(line):
            bare = m[0].strip(edges)
            if bare:
                a = starts[i] + m.start() + m[0].find(bare)
                after = bisect_right(ends, a)  # the first run that ends behind the term's start
                if after == len(ends) or taken[after] >= a + len(bare):
                    found.append((bare.lower(), a, a + len(bare)))
        terms.append(found)
    return lines, terms, {e: sorted(x) for e, x in sorted(near.items())}


_SPANS = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("s", "e", "k")]))
_ARROW_SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("k", pa.int32())]))


def hash_of(value: str) -> int:
    """The 64-bit hash under which an entity, a term or a line travels; 0 stands for none."""
    import xxhash

    return xxhash.xxh64_intdigest(value.encode(), 42) - (1 << 63)


_ROW = [(n, pa.int64()) for n in ("id", "th", "entity", "place", "term", "lh")]
_ROWS = 100_000


def _entity_terms(docs: DataFrame, window: int) -> DataFrame:
    """(id, th, t) to three kinds of rows for each document with an entity: each entity with its place; each place with each
    term in it, once, and the hash of the first line of the place that holds the term; and each term of the document, once."""

    def found(th: int, text: str) -> Iterator[tuple]:
        spans = base_spans(text)
        if not spans:
            return
        lines, terms, near = context_terms(text, spans, window)
        names: dict[str, int] = {}
        for t in terms:
            for term, _, _ in t:
                if term not in names:
                    names[term] = hash_of(term)
        own = [list(dict.fromkeys(names[term] for term, _, _ in t)) for t in terms]
        hashes: dict[int, int] = {}
        places: dict[tuple[int, ...], int] = {}
        for entity, at in near.items():
            key = tuple(at)
            if key not in places:
                places[key] = hash_of(f"{th} {' '.join(map(str, key))}")
            yield hash_of(entity), places[key], None, None
        for key, place in places.items():
            first: dict[int, int] = {}
            for i in key:
                if i not in hashes:
                    hashes[i] = hash_of(lines[i])
                for term in own[i]:
                    first.setdefault(term, hashes[i])
            for term, line in first.items():
                yield None, place, term, line
        for term in dict.fromkeys(t for x in own for t in x):
            yield None, None, term, None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in _ROW]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _ROW, strict=True)], names=[n for n, _ in _ROW])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for doc, th, text in zip(*(batch.column(c).to_pylist() for c in ("id", "th", "t")), strict=True):
                for row in found(th, text):
                    rows.append((doc, th, *row))
                    if len(rows) >= _ROWS:
                        yield batch_of(rows)
                        rows = []
            trim_memory()
        yield batch_of(rows)

    return docs.mapInArrow(run, ", ".join(f"{n} long" for n, _ in _ROW))


def _classes(held: DataFrame) -> DataFrame:
    """(entity, place) of every document to (entity, class, documents): entities that have the same places, repeats included,
    are of one class, which its smallest hash names. Equal are the number of places and three sums of 32 bits of them."""
    bits = [F.xxhash64("place", F.lit(salt)).bitwiseAND(F.lit((1 << 32) - 1)) for salt in (1, 2, 3)]
    marks = held.groupBy("entity").agg(F.count(F.lit(1)).alias("documents"), *(F.sum(b).alias(f"m{i}") for i, b in enumerate(bits)))
    marks = written(marks, "entity_places")
    key = ["documents", "m0", "m1", "m2"]
    named = marks.groupBy(*key).agg(F.min("entity").alias("class"))
    return written(marks.join(named, key).select("entity", "class", "documents"), "entity_classes")


def _filter_of(terms: DataFrame) -> np.ndarray:
    """A bit for each term, in ``FILTER_WORDS`` words."""
    word = F.shiftright("term", 6).bitwiseAND(F.lit(FILTER_WORDS - 1)).alias("word")
    bit = F.expr("shiftleft(1L, cast(term & 63 as int))").alias("bit")
    found = terms.select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(FILTER_WORDS, np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def _passing(hashes: np.ndarray, filter_: np.ndarray) -> np.ndarray:
    """Places of the terms whose bit is set."""
    h = hashes.view(np.uint64)
    bits = filter_[((h >> np.uint64(6)) & np.uint64(FILTER_WORDS - 1)).astype(np.int64)]
    return np.flatnonzero((bits >> (h & np.uint64(63))) & np.uint64(1))


#: Distinct terms that a task holds before it sends their counts.
_HELD = 200_000


def _term_documents(docs: DataFrame, wanted) -> DataFrame:
    """(t) to (term, documents): in how many documents of a task, or of a part of it, a term occurs; the term 0 stands for all
    of them. Only terms that pass the broadcast filter ``wanted`` are sent."""
    edges = _EDGES.decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        rows = 0

        def sent() -> pa.RecordBatch:
            counts.pop("", None)
            hashes = np.fromiter(map(hash_of, counts), np.int64, len(counts))
            at = _passing(hashes, wanted.value)
            own = np.fromiter(counts.values(), np.int64, len(counts))[at]
            return pa.RecordBatch.from_pydict({"term": np.append(hashes[at], 0), "documents": np.append(own, rows)})

        for batch in batches:
            for text in batch.column("t").to_pylist():
                counts.update({w.strip(edges).lower() for w in set(_WORD.findall(text))})
                rows += 1
                if len(counts) >= _HELD:
                    yield sent()
                    counts.clear()
                    rows = 0
        yield sent()
        counts.clear()
        trim_memory()

    return docs.mapInArrow(run, "term long, documents long")


def disclosures(texts: DataFrame, terms: DataFrame, classes: DataFrame, *, generalise_at: float) -> DataFrame | None:
    """(class, term, disclosure) of sensitive terms, from counts over all documents; None when no term meets an entity.

    ``texts`` has all texts as ``t``; ``terms`` is what ``_entity_terms`` found in them, with ``classes`` of its entities.
    """
    spark = texts.sparkSession
    held = terms.where("entity is not null").select("entity", "place").join(classes.select("entity", "class"), "entity").select("class", "place").distinct()
    inside = terms.where("place is not null and term is not null").groupBy("place", "term", "lh").agg(F.count(F.lit(1)).alias("joint"))
    lines = inside.join(held, "place").groupBy("class", "term", "lh").agg(F.sum("joint").alias("joint"))
    pairs = written(lines.groupBy("class", "term").agg(F.count(F.lit(1)).alias("support"), F.sum("joint").alias("joint")), "class_terms")
    if pairs.isEmpty():
        return None
    wanted = spark.sparkContext.broadcast(_filter_of(pairs))
    counted = written(_term_documents(texts, wanted).groupBy("term").agg(F.sum("documents").alias("documents")), "term_documents")
    total = float(counted.where("term = 0").first()["documents"])
    entities = classes.where("entity = class").select("class", F.col("documents").alias("entity_documents"))
    both = pairs.join(counted, "term").join(entities, "class")
    prior = F.col("entity_documents") / F.lit(total)
    s = F.col("support")
    drawn = (F.col("joint") / F.col("documents") * s + prior) / (s + 1)
    gained = F.log(drawn / prior) / -F.log(prior)
    found = both.where(F.col("entity_documents") < total).withColumn("disclosure", gained)
    return found.where(F.col("disclosure") >= generalise_at).select("class", "term", "disclosure")


def _sensitive_terms(docs: DataFrame, id_col: str, text_col: str, window: int, generalise_at: float, remove_at: float) -> DataFrame:
    """The documents with ``__av_terms``, each one's sensitive terms (h, k): k is 1 to remove and 0 to generalise."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumn("__av_th", F.xxhash64(text))
    texts = keyed.select(F.col(id_col).cast("long").alias("id"), F.col("__av_th").alias("th"), text.alias("t"))
    terms = written(_entity_terms(texts, window), "entity_contexts")
    classes = _classes(terms.where("entity is not null").select("entity", "place"))
    sensitive = disclosures(texts.select("t"), terms, classes, generalise_at=generalise_at)
    none = F.array().cast("array<struct<h:bigint,k:int>>")
    if sensitive is None:
        return keyed.withColumn("__av_terms", none).drop("__av_th")
    action = F.when(F.col("disclosure") >= remove_at, 1).otherwise(0)
    strongest = sensitive.groupBy("class", "term").agg(F.max(action).alias("k"))
    held = terms.where("entity is not null").select("id", "th", "entity").join(classes, "entity").select("id", "th", "class").distinct()
    hits = terms.where("entity is null and place is null").select("id", "th", "term").join(strongest, "term")  # repeated rows meet below
    same = F.col("o.id").eqNullSafe(F.col("h.id")) & (F.col("o.th") == F.col("h.th")) & (F.col("o.class") == F.col("h.class"))
    hits = hits.alias("o").join(held.alias("h"), same, "left_semi").groupBy("id", "th", "term").agg(F.max("k").alias("k"))
    lists = hits.groupBy("id", "th").agg(F.collect_list(F.struct(F.col("term").alias("h"), "k")).alias("terms"))
    lists = written(lists, "document_terms")
    drop_written(terms, classes)
    if (lists.agg(F.sum(F.size("terms"))).first()[0] or 0) <= BROADCAST_TERMS:
        lists = F.broadcast(lists)
    both = keyed.alias("d").join(lists.alias("p"), F.col(f"d.`{id_col}`").eqNullSafe(F.col("p.id")) & (F.col("__av_th") == F.col("p.th")), "left")
    return both.select(*(F.col(f"d.`{c}`") for c in docs.columns), F.coalesce("p.terms", none).alias("__av_terms"))


def term_places(text: str, spans: list[tuple[int, int, int]], wanted: dict[int, int]) -> list[tuple[int, int, int]]:
    """(start, end, k) of every place of the wanted terms (by hash, with k) that overlaps no base span."""
    known: dict[str, int | None] = {}
    out = []
    for line in context_terms(text, spans)[1]:
        for term, a, b in line:
            if term not in known:
                known[term] = wanted.get(hash_of(term))
            if known[term] is not None:
                out.append((a, b, known[term]))
    return out


def _treated(text: str | None, wanted: list[dict] | None) -> tuple[list, list]:
    """Base spans and term spans of a text."""
    spans = base_spans(text) if text else []
    return spans, term_places(text, spans, {x["h"]: x["k"] for x in wanted}) if wanted and spans else []


_SPANS = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("s", "e", "k")]))
_ARROW_SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("k", pa.int32())]))


def _span_rows(spans: list[tuple[int, int, int]]) -> list[dict]:
    return [{"s": a, "e": b, "k": k} for a, b, k in spans]


def find_personal_data(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
    window: int = WINDOW,
    generalise_at: float = 0.9,
    remove_at: float = 0.97,
) -> DataFrame:
    """One row per document: the carried columns, ``base`` (spans s, e, k with k the rank of the kind in KINDS) and ``terms``
    (spans s, e, k of sensitive terms; k is 1 to remove and 0 to generalise), both in order of start. Carried columns whose
    names clash with results are left out."""
    ship(docs.sparkSession)
    carry = [c for c in (docs.columns if carry is None else carry) if c not in ("base", "terms")]
    found = _sensitive_terms(docs.select(*dict.fromkeys([*carry, id_col, text_col])), id_col, text_col, window, generalise_at, remove_at)
    fields = [f for f in found.schema.fields if f.name in carry]
    schema = T.StructType([*fields, T.StructField("base", _SPANS), T.StructField("terms", _SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [_treated(t, w) for t, w in zip(batch.column(text_col).to_pylist(), batch.column("__av_terms").to_pylist(), strict=True)]
            own = [pa.array([_span_rows(p[i]) for p in pairs], _ARROW_SPANS) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), *own], names=schema.names)
            trim_memory()

    return found.mapInArrow(run, schema)


def shape(term: str) -> str:
    """A term's general form: letters as x or X, digits as #."""
    return "".join("#" if c.isdigit() else ("X" if c.isupper() else "x") if c.isalpha() else c for c in term)


def cleaned(text: str, base: list[tuple[int, int, int]], terms: list[tuple[int, int, int]]) -> str:
    """The text with personal data replaced by its kind, and sensitive terms removed or generalised."""
    spans = [(a, b, f"[{KINDS[k].upper()}]") for a, b, k in base]
    spans += [(a, b, "[TERM]" if k else shape(text[a:b])) for a, b, k in terms]
    out, at = [], 0
    for a, b, new in sorted(spans):
        if a >= at:
            out += [text[at:a], new]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitise(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, generalise_at: float = 0.9, remove_at: float = 0.97
) -> DataFrame:
    """The documents with their texts cleaned; other columns stay."""
    ship(docs.sparkSession)
    found = _sensitive_terms(docs, id_col, text_col, window, generalise_at, remove_at)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [cleaned(t, *_treated(t, w)) if t else t for t, w in zip(batch.column(text_col).to_pylist(), batch.column("__av_terms").to_pylist(), strict=True)]
            own = [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in schema.names]
            yield pa.RecordBatch.from_arrays(own, names=schema.names)
            del texts, own
            trim_memory()

    return found.mapInArrow(run, schema)


def span_text(kinds: tuple[str, ...] = KINDS, terms: str | None = None) -> Column:
    """kind:start:end of the column ``base``, and of ``terms`` if given, by start, then by kind, joined by commas."""

    def named(rank: Column, kind: Column, x: Column) -> Column:
        return F.struct(x["s"].alias("s"), rank.cast("int").alias("k"), x["e"].alias("e"), F.concat_ws(":", kind, x["s"], x["e"]).alias("t"))

    names = F.array(*(F.lit(k) for k in kinds))
    every = F.transform("base", lambda x: named(x["k"], names[x["k"]], x))
    if terms is not None:
        every = F.concat(every, F.transform(terms, lambda x: named(F.lit(len(kinds)), F.lit("term"), x)))
    return F.array_join(F.transform(F.sort_array(every), lambda x: x["t"]), ",")
