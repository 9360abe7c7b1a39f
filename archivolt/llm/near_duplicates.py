"""MinHash near-duplicate detection with odd sketches.

Words are lower-cased (A-Z) runs between ASCII white space; a document's set is its distinct five-word shingles, as
64-bit hashes. Documents with equal word sequences form a class; the smallest id stands for it from then on.

1. Signatures (Arrow, one pass): 144 MinHash samples in 36 bands of 4 rows. A pair at similarity 0.75 shares no band
   with probability (1 - 0.75^4)^36, about 1e-6.
2. Buckets of one member are dropped. In every other bucket one hub is chosen, the member whose buckets are largest over
   all bands, and every member is compared with the hub alone, so a bucket of n members gives n - 1 pairs.
3. Candidates are pruned by odd sketches: 1,024 samples each flip one bit of a 4,096-bit map. At similarity 0.75 the XOR of
   two maps has 453 set bits on average with a deviation under 30; a pair is dropped above 610, which loses a link with
   probability below 1e-6 and drops nearly all pairs under 0.65. What is left is confirmed on the full sets.
4. Links are closed to components: up to ``ONE_TASK_LINKS`` by union-find in one task, more by alternating star contraction.
   Buckets whose members still lie in different components are completed: the members outside the bucket's largest
   component meet every member of another component. A bucket is cut into a grid, blocks of some ``BLOCK`` outsiders by blocks
   of as many members, each cell a group of bounded size; few outsiders give few columns, and few copies of the members. First only ids, sizes and sketches are moved, and members that have any
   close sketch of fitting size among the others are named. Then these alone are moved with their full sets, in cells
   bounded by their sizes too, and sets are compared there: a member against all others of its cell at once, and of the links
   found only those that connect components still apart become rows, so their number is linear in the members.

What moves: for each document its class key and 36 band hashes; sketches, sets and texts move only for documents in
buckets of two or more. Nothing is collected to the driver but counts. Intermediate tables are written in the shared
checkpoint folder, so a lost executor repeats only its own tasks.

The cost of step 4 grows with (members outside the largest component) x (members of fitting size) of a bucket: for a bucket
of many documents that share four samples but are no near copies, that is quadratic in comparisons (about 0.1 microseconds
each, spread over the grid's cells), not in rows or in memory.

Classes of equal word sequences have numbers of their own, so that rows which share an id but not a text are linked each by
its own text; an edge between the classes of one id then joins their components. With ``rows`` the texts' own components, without
these edges, choose the survivors, so that no text goes because its id has another one.

Defined results: null or empty texts have an empty set, link with nothing and are kept. Rows that share an id count as
one document for ``component_id`` and ``kept``, and each is returned. Rows with a null id link with nothing: component_id null,
kept true.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.llm._common import SPACE_WORDS, drop_written, find_words, gram_hashes, mix, ship, signed, steps, text_bytes, written

SHINGLE = 5
BANDS, ROWS = 36, 4
SKETCH_SAMPLES, SKETCH_BITS, MOST_BITS = 1024, 4096, 610
#: Up to this many links (16 bytes each) are closed in one task, more by star contraction over the cluster.
ONE_TASK_LINKS = 250_000
#: Members of a bucket on each side of a cell of its grid, about.
BLOCK = 1024
#: Shingles of a bucket for each block of its grid, where that gives more blocks.
CELL_GRAMS = 1 << 20
#: Sketches of one side that are compared at once.
ROWS_AT_ONCE = 32
#: Ids up to this many (8 bytes each) are broadcast to select documents; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def _constants(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) | np.uint64(1)


_TIMES, _PLUS = _constants(SKETCH_SAMPLES, 11), _constants(SKETCH_SAMPLES, 13)


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Shingle hashes with repeats, each document's bounds in them, and a digest of each document's words."""
    words = find_words(data, offsets, SPACE_WORDS)
    counts = np.diff(words.bounds)
    sizes = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(int(bounds[-1]), np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    whole = np.ones(len(out), bool)
    whole[bounds[short]] = False
    grams = gram_hashes(words.hashes, k)
    ends = np.repeat(words.bounds[1:], counts)
    out[whole] = grams[np.arange(len(grams)) + k <= ends[: len(grams)]]
    for d in short.tolist():
        a, b = words.bounds[d], words.bounds[d + 1]
        out[bounds[d]] = gram_hashes(words.hashes[a:b], int(b - a))[0]
    text, _, at = words.canonical()
    keys = [hashlib.blake2b(text[a:b], digest_size=16).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return out, bounds, keys


def samples(grams: np.ndarray, bounds: np.ndarray, k: int = BANDS * ROWS) -> tuple[np.ndarray, np.ndarray]:
    """``k`` MinHash samples of the documents that have shingles (one row for each sample), and which those are."""
    full = np.flatnonzero(np.diff(bounds))
    starts = bounds[full]
    out = np.empty((k, len(full)), np.uint64)
    if len(full):
        buffer = np.empty_like(grams)
        for j in range(k):
            np.multiply(grams, _TIMES[j], out=buffer)
            np.add(buffer, _PLUS[j], out=buffer)
            np.minimum.reduceat(buffer, starts, out=out[j])
    return out, full


def band_hashes(minima: np.ndarray) -> np.ndarray:
    """One hash for each document and band."""
    out = np.empty((minima.shape[1], BANDS), np.uint64)
    for b in range(BANDS):
        own = np.full(minima.shape[1], b + 1, np.uint64)
        for r in range(ROWS):
            own = mix(own * np.uint64(0x2545F4914F6CDD1D) + minima[b * ROWS + r])
        out[:, b] = own
    return out


def odd_sketches(minima: np.ndarray) -> np.ndarray:
    """Parity bitmaps: sample j with minimum v flips the bit that hash(j, v) names."""
    docs = minima.shape[1]
    bits = mix(minima + _PLUS[: len(minima), None] * np.uint64(3)) >> np.uint64(65 - SKETCH_BITS.bit_length())
    flat = bits.astype(np.int64) + np.arange(docs) * SKETCH_BITS
    parity = np.bincount(flat.ravel(), minlength=docs * SKETCH_BITS).astype(np.uint8) & 1
    return np.packbits(parity.reshape(docs, SKETCH_BITS), axis=1, bitorder="little").view(np.int64)


def _signatures(docs: DataFrame) -> DataFrame:
    """(id, th, text) to (id, th, n_shingles, key, bands); no bands without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            for a, b in steps(off):
                grams, bounds, keys = shingles(data, off[a : b + 1])
                minima, full = samples(grams, bounds)
                n = [len(np.unique(grams[x:y])) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
                ends = np.zeros(b - a + 1, np.int32)
                ends[full + 1] = BANDS
                bands = pa.ListArray.from_arrays(pa.array(np.cumsum(ends, dtype=np.int32)), pa.array(signed(band_hashes(minima)).ravel()))
                columns = [batch.column("id")[a:b], batch.column("th")[a:b], pa.array(n, pa.int64()), pa.array(keys, pa.binary()), bands]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "th", "n_shingles", "key", "bands"])

    return docs.mapInArrow(run, "id long, th long, n_shingles long, key binary, bands array<long>")


def _members(docs: DataFrame) -> DataFrame:
    """(id, text) to (id, n, sketch, grams): the full set, sorted, and its odd sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            for a, b in steps(off):
                grams, bounds, _ = shingles(data, off[a : b + 1])
                minima, full = samples(grams, bounds, SKETCH_SAMPLES)
                sets = [np.unique(grams[bounds[d] : bounds[d + 1]]) for d in full]
                sizes = np.array([len(s) for s in sets], np.int32)
                ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int32))).astype(np.int32)
                flat = signed(np.concatenate(sets)) if sets else np.zeros(0, np.int64)
                sketch = odd_sketches(minima)
                width = sketch.shape[1] if sketch.size else SKETCH_BITS // 64
                columns = [
                    batch.column("id")[a:b].take(pa.array(full)),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1, dtype=np.int32) * width), pa.array(sketch.ravel())),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "sketch", "grams"])

    return docs.mapInArrow(run, "id long, n long, sketch array<long>, grams array<long>")


def _bits_apart(x: Column, y: Column) -> Column:
    """Population count of the XOR of two sketches."""
    return reduce(lambda p, q: p + q, [F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(SKETCH_BITS // 64)])


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components of the links of one task, which are bounded in number."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.get(top, top)) != top:
            top = up
        while (up := root.get(x, x)) != top:
            root[x], x = top, up
        return top

    for batch in batches:
        for a, b in zip(batch.column("hi").to_pylist(), batch.column("lo").to_pylist(), strict=True):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    ids = [i for i in root if find(i) != i]
    yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "label": pa.array([find(i) for i in ids], pa.int64())})


def components(edges: DataFrame, one_task: int = ONE_TASK_LINKS) -> DataFrame:
    """(a, b) links to (id, label): every linked id, but a component's smallest, with the smallest id that it reaches.

    Up to ``one_task`` links are closed in one task; more by star contraction. Both give the same labels.
    """

    def signature(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())

    now = written(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct(), "edges")
    seen = signature(now)
    if seen[0] <= one_task:
        labels = written(now.repartition(1).mapInArrow(_union_find, "id long, label long"), "labels")
        drop_written(now)
        return labels
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select(F.col("lo"), F.col("hi")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(root, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo")
        after = written(small.union(root.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
        last, seen = seen, signature(after)
        drop_written(now)
        now = after
        if seen == last:
            return now.select(F.col("hi").alias("id"), F.col("lo").alias("label"))


def _linked(na: Column, nb: Column, xa: Column, xb: Column, threshold: tuple[int, int]) -> Column:
    """Whether two full sets reach the threshold."""
    num, den = threshold
    shared = F.size(F.array_intersect(xa, xb)).cast("long")
    return shared * den >= (na + nb - shared) * num


def _side(members: DataFrame, letter: str, column: str) -> DataFrame:
    return members.select(F.col("id").alias(letter), F.col("n").alias(f"n{letter}"), F.col(column).alias(f"x{letter}"))


def _with_sets(pairs: DataFrame, members: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""
    full = pairs.join(_side(members, "a", "grams"), "a").join(_side(members, "b", "grams"), "b")
    return full.where(_linked(F.col("na"), F.col("nb"), F.col("xa"), F.col("xb"), threshold)).select("a", "b")


def _confirmed(pairs: DataFrame, members: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of fitting sizes whose sketches are close and whose full sets reach the threshold."""
    num, den = threshold
    sized = (F.col("na") * den >= F.col("nb") * num) & (F.col("nb") * den >= F.col("na") * num)
    near = pairs.join(_side(members, "a", "sketch"), "a").join(_side(members, "b", "sketch"), "b")
    near = near.where(sized & (_bits_apart(F.col("xa"), F.col("xb")) <= MOST_BITS)).select("a", "b")
    return _with_sets(near, members, threshold)


class _Side:
    """One side of a cell: ids, labels, sizes and sketches in order of size, and the full sets if they came along."""

    def __init__(self, table: pa.Table, mask: np.ndarray):
        at = np.flatnonzero(mask)
        at = at[np.argsort(table["n"].to_numpy()[at], kind="stable")]
        own = table.take(pa.array(at))
        self.ids, self.labels, self.n = (own[c].to_numpy() for c in ("id", "label", "n"))
        self.sketches = own["sketch"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(at), SKETCH_BITS // 64)
        if "grams" in table.column_names:
            self.sets = own["grams"].combine_chunks().flatten().to_numpy()
            self.bounds = np.concatenate(([0], np.cumsum(self.n)))


def _close(x: _Side, y: _Side, threshold: tuple[int, int]) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """Some rows of ``x``, the first row of a range of ``y``, and which pairs of the two have other labels, fitting sizes and
    close sketches."""
    num, den = threshold
    lo, hi = np.searchsorted(y.n, -(-x.n * num // den), "left"), np.searchsorted(y.n, x.n * den // num, "right")
    for k in range(0, len(x.ids), ROWS_AT_ONCE):
        own = np.arange(k, min(k + ROWS_AT_ONCE, len(x.ids)))
        a, b = int(lo[own].min()), int(hi[own].max())
        if a >= b:
            continue
        apart = np.zeros((len(own), b - a), np.uint16)
        for w in range(x.sketches.shape[1]):
            apart += np.bitwise_count(x.sketches[own, w, None] ^ y.sketches[None, a:b, w])
        place = np.arange(a, b)
        fit = (apart <= MOST_BITS) & (x.labels[own, None] != y.labels[None, a:b])
        yield own, a, fit & (place >= lo[own, None]) & (place < hi[own, None])


def _sides(table: pa.Table) -> tuple[_Side, _Side]:
    table = table.combine_chunks()
    outside = table["outside"].to_numpy()
    return _Side(table, outside), _Side(table, ~outside)


def _near_some(table: pa.Table, threshold: tuple[int, int]) -> np.ndarray:
    """Ids of a cell's members that have a close one on the other side."""
    x, y = _sides(table)
    hit_x, hit_y = np.zeros(len(x.ids), bool), np.zeros(len(y.ids), bool)
    for own, a, fit in _close(x, y, threshold) if len(x.ids) and len(y.ids) else ():
        hit_x[own] |= fit.any(1)
        hit_y[a : a + fit.shape[1]] |= fit.any(0)
    return np.unique(np.concatenate((x.ids[hit_x], y.ids[hit_y])))


def _cell_links(table: pa.Table, threshold: tuple[int, int]) -> list[tuple[int, int]]:
    """Links of a cell that connect components still apart, full sets compared."""
    num, den = threshold
    x, y = _sides(table)
    root: dict[int, int] = {}

    def find(v: int) -> int:
        while (up := root.get(v, v)) != v:
            root[v] = root.get(up, up)
            v = up
        return v

    out: list[tuple[int, int]] = []
    if not len(x.ids) or not len(y.ids):
        return out
    known, codes = np.unique(np.concatenate((x.sets, y.sets)), return_inverse=True)
    mark = np.zeros(len(known), bool)
    codes_x, codes_y = codes[: len(x.sets)], codes[len(x.sets) :]
    for own, a, fit in _close(x, y, threshold):
        for i, row in zip(own.tolist(), fit, strict=True):
            near = a + np.flatnonzero(row)
            near = near[[find(int(v)) != find(int(x.labels[i])) for v in y.labels[near]]] if len(near) else near
            if not len(near):
                continue
            mine = codes_x[x.bounds[i] : x.bounds[i + 1]]
            mark[mine] = True
            first, last = int(near[0]), int(near[-1]) + 1
            begin = y.bounds[first:last]
            shared = np.add.reduceat(mark[codes_y[begin[0] : y.bounds[last]]].astype(np.int64), begin - begin[0])[near - first]
            mark[mine] = False
            for j in near[shared * den >= (x.n[i] + y.n[near] - shared) * num].tolist():
                p, q = find(int(x.labels[i])), find(int(y.labels[j]))
                if p != q:
                    root[max(p, q)] = min(p, q)
                    out.append((int(x.ids[i]), int(y.ids[j])))
    return out


_CELL = ["bucket", "bx", "by"]


def _grid(outside: Column, members: Column, grams: Column | None, block: int) -> list[Column]:
    """How many blocks of outsiders and of members a bucket's grid has: aggregates by bucket."""

    def blocks(mask: Column, name: str) -> Column:
        n = F.count_if(mask) / block
        size = n if grams is None else F.greatest(n, F.sum(F.when(mask, grams)) / CELL_GRAMS)
        return F.greatest(F.ceil(size), F.lit(1)).cast("int").alias(name)

    return [blocks(outside, "across"), blocks(members, "down")]


def _cells(inside: DataFrame, columns: list[str]) -> DataFrame:
    """Members with bucket, label, major, across and down, once for each cell of their bucket's grid and side on which they
    stand: outsiders in a column of cells, all members in a row of them."""
    place = F.xxhash64("id")
    x = inside.where("label <> major").select("*", F.pmod(place, F.col("across")).cast("int").alias("bx"))
    x = x.select("*", F.explode(F.sequence(F.lit(0), F.col("down") - 1)).alias("by"), F.lit(True).alias("outside"))
    y = inside.select("*", F.pmod(place, F.col("down")).cast("int").alias("by"))
    y = y.select("*", F.explode(F.sequence(F.lit(0), F.col("across") - 1)).alias("bx"), F.lit(False).alias("outside"))
    columns = [*_CELL, "outside", "id", "label", *columns]
    return x.select(*columns).union(y.select(*columns))


def _completing_links(placed: DataFrame, open_: DataFrame, members: DataFrame, threshold: tuple[int, int], block: int) -> DataFrame:
    """(a, b): links between members that share an open bucket and lie in different components.

    ``placed``: bucket, id, label; ``open_``: bucket, major, hub, across, down.
    """
    members = members.dropDuplicates(["id"])
    inside = written(placed.join(open_, "bucket").where("id <> hub").drop("hub"), "inside")

    def near(table: pa.Table) -> pa.Table:
        ids = _near_some(table, threshold)
        return pa.table({"bucket": pa.array([table["bucket"][0].as_py()] * len(ids), pa.int64()), "id": pa.array(ids, pa.int64())})

    sketches = inside.join(members.select("id", "n", "sketch"), "id")
    close = _cells(sketches, ["n", "sketch"]).groupBy(*_CELL).applyInArrow(near, "bucket long, id long").distinct()
    close = written(inside.drop("across", "down").join(close, ["bucket", "id"]).join(members.select("id", "n"), "id"), "close_members")
    grid = _grid(F.col("label") != F.col("major"), F.lit(True), F.col("n"), block)
    full = close.join(close.groupBy("bucket").agg(*grid), "bucket").join(members.select("id", "sketch", "grams"), "id")

    def compare(table: pa.Table) -> pa.Table:
        links = _cell_links(table, threshold)
        return pa.table({"a": pa.array([min(e) for e in links], pa.int64()), "b": pa.array([max(e) for e in links], pa.int64())})

    return _cells(full, ["n", "sketch", "grams"]).groupBy(*_CELL).applyInArrow(compare, "a long, b long").distinct()


def _id_edges(classes: DataFrame) -> DataFrame | None:
    """(a, b): edges between the classes of rows that share an id; None where no id has two."""
    ends = classes.groupBy("id").agg(F.min("cid").alias("b"), F.max("cid").alias("last")).where("b < last").select("id", "b")
    shared = written(ends, "shared_ids")
    if shared.isEmpty():
        return None
    return classes.join(shared, "id").select(F.col("cid").alias("a"), "b").where("a <> b").distinct()


def _with_smallest(labels: DataFrame, firsts: DataFrame) -> DataFrame:
    """(cid, rep, top) of every class in a component of two or more: the smallest id of the component, and its class."""
    ends = labels.select(F.col("id").alias("cid"), "label").union(labels.select("label", "label")).distinct()
    named = written(ends.join(firsts.select("cid", "rep"), "cid"), "labelled")
    least = named.groupBy("label").agg(F.min(F.struct("rep", "cid")).alias("least"))
    return named.select("cid", "label").join(least, "label").select("cid", F.col("least.rep").alias("component"), F.col("least.cid").alias("top"))


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: tuple[int, int] = (75, 100), block: int = BLOCK, rows: bool = False
) -> DataFrame:
    """One row per document: id, n_shingles (set size), component_id (smallest id reachable over links), kept.

    With ``rows`` also text_hash (xxhash64 of the text) and survives: true for the rows of one id and one text in each component of
    texts, and for all that link with nothing. Other columns of ``docs``, whatever their names, are not read. Ids must be
    numbers that fit a long. A very long text is one vectorised step of its own (some 40 bytes of memory for each of its bytes).
    """
    ship(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    signed_docs = written(_signatures(source), "signatures")
    some = signed_docs.where("id is not null and n_shingles > 0")
    first = some.groupBy("key").agg(F.min(F.struct("id", "th")).alias("m"))
    firsts = written(first.select("key", F.col("m.id").alias("rep"), F.col("m.th").alias("rep_th"), F.monotonically_increasing_id().alias("cid")), "classes")
    classes = written(some.select("id", "th", "n_shingles", "key").join(firsts, "key").drop("key"), "documents_of_classes")

    # buckets of two classes or more
    one = (F.col("id") == F.col("rep")) & (F.col("th") == F.col("rep_th"))
    banded = some.select("id", "th", "key", "bands").join(firsts, "key").where(one).select(F.col("cid").alias("id"), F.explode("bands").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = written(banded.join(sizes, "bucket").select("bucket", "id", "n").distinct(), "buckets")
    degrees = buckets.groupBy("id").agg(F.sum("n").alias("degree"))
    central = buckets.join(degrees, "id").groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("id")).alias("neg"))).alias("top"))
    hubs = written(central.select("bucket", (-F.col("top.neg")).alias("hub")), "hubs")

    ids = written(buckets.select(F.col("id").alias("cid")).distinct().join(firsts, "cid").select("cid", F.col("rep").alias("id"), F.col("rep_th").alias("th")), "chosen")
    chosen = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    members = written(_members(source.join(chosen, ["id", "th"]).select(F.col("cid").alias("id"), "text")), "members")

    ordered = [F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")]
    pairs = buckets.join(hubs, "bucket").where("id <> hub").select(*ordered).distinct()
    labels = components(_confirmed(pairs, members, threshold))

    # buckets that still span components
    label = F.coalesce("label", "id").alias("label")
    placed = buckets.join(labels, "id", "left").select("bucket", "id", label)
    tally = placed.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    major = F.max(F.struct("n", "label")).getField("label").alias("major")
    open_ = tally.groupBy("bucket").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.count(F.lit(1)).alias("labels"), major).where("labels > 1 and n > 2")
    across, down = F.ceil((F.col("n") - F.col("most")) / block).cast("int").alias("across"), F.ceil(F.col("n") / block).cast("int").alias("down")
    open_ = written(open_.join(hubs, "bucket").select("bucket", "major", "hub", across, down), "open")
    if not open_.isEmpty():
        more = written(_completing_links(placed, open_, members, threshold, block), "more_links")
        if not more.isEmpty():
            labels = components(more.union(labels.select(F.col("id").alias("a"), F.col("label").alias("b"))))
        drop_written(more)
    drop_written(buckets, hubs, open_, members, ids)

    edges = _id_edges(classes)
    whole = labels if edges is None else components(edges.union(labels.select(F.col("id").alias("a"), F.col("label").alias("b"))))
    linked = classes.join(_with_smallest(whole, firsts).drop("top"), "cid", "left").withColumn("component_id", F.coalesce("component", "rep")).drop("component")
    if rows:
        linked = linked.join(_with_smallest(labels, firsts).select("cid", "top"), "cid", "left")
        linked = linked.withColumn("survives", one & (F.coalesce("top", "cid") == F.col("cid")))
    else:
        linked = linked.withColumn("survives", F.lit(True))
    columns = ["id", "th", "n_shingles", "component_id", "survives"]
    alone = signed_docs.where("id is null or n_shingles = 0").select("id", "th", "n_shingles", F.col("id").alias("component_id"), F.lit(True).alias("survives"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    more = [F.col("th").alias("text_hash"), "survives"] if rows else []
    return linked.select(*columns).union(alone.select(*columns)).select(F.col("id").alias(id_col), "n_shingles", "component_id", kept, *more)
