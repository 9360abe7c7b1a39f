"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text, and perplexity quantiles by language.

The model is over bytes of UTF-8 (order 5, one for each language), so its tables are bounded by the alphabet rather than by
the vocabulary, grams are exact 40-bit integers, and no text is out of vocabulary. White space is folded to single spaces
and digits to 0; a text is preceded by four line ends.

1. Training counts are over all trusted documents but the held-out ones: each task counts its grams, one exchange adds them.
   Lower orders are continuation counts of the order above. Discounts D1, D2, D3+ follow from each language's and order's counts of counts.
2. Probabilities are made by joins on (language, context) and (language, suffix), sharded like the counts, and stored with
   back-off weights, so that a gram that was never seen is scored exactly too.
3. The model is written in shards by the last two context bytes, which every gram of a position shares, each of at most some
   ``SHARD_ROWS`` rows (orders 1 and 2, of bounded size, are apart and go with all). Scoring is one pass over the documents:
   a task joins the distinct grams of a batch with one shard after another, read from the shared folder. Nothing of the
   model is on the driver or broadcast, and nothing is shuffled.
4. A language's threshold is a quantile of the perplexity of its held-out trusted documents, a share of ``1 / HELD_OUT`` of
   the texts by hash, so that it isn't measured on what the model has seen; exact counts in steps of 0.001 of the logarithm.
   A language without held-out documents takes the quantile over all languages; without any, over all trusted documents.

Defined results: null and empty texts have no perplexity and are not kept. A null language is a language of its own. Without
any trusted document every document with text is kept. Rows that agree in id, language and text have equal results; each is
returned. Repeated labels count once. A language without trusted text has no model and every byte of it the same
probability. A very long text is one vectorised step of its own. Other columns, whatever their names, are not read; ids must
be numbers that fit a long. No documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.llm._common import check_store, drop_written, open_store, scratch_path, ship, steps, text_bytes, trim_memory, written

ORDER = 5
SHARD_ROWS = 3_000_000
BROADCAST_IDS = 2_000_000
STEP = 1000  # steps of the natural logarithm
#: One in so many trusted texts is held out of training.
HELD_OUT = 10
#: Languages with trusted text, at most; their names are on the driver.
MOST_LANGUAGES = 10_000

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[9, 10, 11, 12, 13]] = 32
_FOLD[48:58] = 48
_MASK = (1 << 40) - 1


def byte_grams(data: np.ndarray, offsets: np.ndarray, langs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order-5 gram that ends at each folded byte, with the language above its 40 bits, and documents' bounds in them."""
    off = offsets - offsets[0]
    folded = _FOLD[data[offsets[0] : offsets[-1]]]
    space = folded == 32
    keep = np.ones(len(folded), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[off[:-1][np.diff(off) > 0]] = True
    total = np.concatenate(([0], np.cumsum(keep)))
    bounds = total[off]
    sizes = np.diff(bounds)
    pad = ORDER - 1
    out = np.full(int(bounds[-1]) + pad * len(sizes), 10, np.uint64)
    place = np.arange(bounds[-1]) + np.repeat(pad * np.arange(1, len(sizes) + 1), sizes)
    out[place] = folded[keep]
    gram = out.copy()
    for j in range(1, ORDER):
        gram[j:] |= out[: len(out) - j] << np.uint64(8 * j)
    return gram[place] | np.repeat(langs.astype(np.uint64) << np.uint64(40), sizes), bounds


def _gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, text) to (lang, gram, c)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            langs = batch.column("lang").to_numpy()
            for a, b in steps(off, 8_000_000):
                grams, _ = byte_grams(data, off[a : b + 1], langs[a:b])
                keys, c = np.unique(grams, return_counts=True)
                lang, gram = (keys >> np.uint64(40)).astype(np.int64), (keys & np.uint64(_MASK)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"lang": pa.array(lang), "gram": pa.array(gram), "c": pa.array(c.astype(np.int64))})

    return docs.mapInArrow(run, "lang long, gram long, c long")


def _discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3): the discounts of each language from its counts of counts; fixed values where it has too few."""
    n = counts.groupBy("lang").agg(*(F.sum((F.col("c") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)))
    some = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0)
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    found = []
    for k, fixed in ((1, 0.5), (2, 1.0), (3, 1.5)):
        d = k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")
        found.append(F.when(some, F.least(F.greatest(d, F.lit(0.05 * k)), F.lit(0.95 * k))).otherwise(fixed).alias(f"d{k}"))
    return n.select("lang", *found)


def train(trusted: DataFrame) -> DataFrame:
    """(lang, text) to the model: (kind, order, lang, gram, value). Kind p has the logarithm of a seen gram's interpolated
    probability; kind b that of a context's back-off weight, with the order of the grams that it begins."""
    orders = {ORDER: written(_gram_counts(trusted).groupBy("lang", "gram").agg(F.sum("c").alias("c")), "grams")}
    for m in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << (8 * m)) - 1)).alias("gram")
        above = orders[m + 1].select("lang", suffix)
        orders[m] = written(above.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("c")), f"grams{m}")
    parts, lower = [], None
    for m in range(1, ORDER + 1):
        c = F.col("c")
        cut = F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))
        ctx = F.shiftright("gram", 8).alias("ctx")
        limits = _discounts(orders[m])  # a row for each language, MOST_LANGUAGES at most
        own = orders[m].join(F.broadcast(limits), "lang").select("lang", "gram", ctx, c.cast("double").alias("c"), cut.alias("d"))
        stats = own.groupBy("lang", "ctx").agg(F.sum("c").alias("s"), (F.sum("d") / F.sum("c")).alias("g"))
        joined = own.join(stats, ["lang", "ctx"])
        if lower is None:
            below = joined.withColumn("q", F.lit(1 / 256))
        else:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << (8 * (m - 1))) - 1))
            below = joined.withColumn("suffix", suffix).join(lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("q")), ["lang", "suffix"])
        p = (F.col("c") - F.col("d")) / F.col("s") + F.col("g") * F.col("q")
        lower = written(below.select("lang", "gram", p.alias("p")), f"p{m}")
        parts.append(lower.select(F.lit("p").alias("kind"), F.lit(m).alias("order"), "lang", "gram", F.log("p").alias("value")))
        parts.append(stats.select(F.lit("b").alias("kind"), F.lit(m).alias("order"), "lang", F.col("ctx").alias("gram"), F.log("g").alias("value")))
    model = parts[0]
    for p in parts[1:]:
        model = model.union(p)
    out = written(model, "model")
    drop_written(model, *orders.values())
    return out


class Shard:
    """Lookup tables of one shard of the model, sorted by language and gram."""

    def __init__(self, rows: pa.Table):
        kind = rows["kind"].to_numpy() == "p"
        order = rows["order"].to_numpy()
        key = (rows["lang"].to_numpy().astype(np.uint64) << np.uint64(40)) | rows["gram"].to_numpy().astype(np.uint64)
        value = rows["value"].to_numpy().astype(np.float32)
        self.p, self.b = {}, {}
        for m in range(1, ORDER + 1):
            for own, pick in ((self.p, kind), (self.b, ~kind)):
                at = np.flatnonzero(pick & (order == m))
                at = at[np.argsort(key[at])]
                own[m] = (key[at], value[at])

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        have, values = table
        if not len(have):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.float32)
        at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
        hit = have[at] == keys
        return hit, np.where(hit, values[at], np.float32(0))

    def log_probabilities(self, keys: np.ndarray) -> np.ndarray:
        """Of each gram of order 5 with its language, by backing off to the longest seen one."""
        lang = keys & ~np.uint64(_MASK)
        out, open_ = np.zeros(len(keys), np.float64), np.arange(len(keys))
        for m in range(ORDER, 0, -1):
            own = keys[open_] & np.uint64((1 << (8 * m)) - 1)
            hit, value = self._find(self.p[m], lang[open_] | own)
            out[open_[hit]] += value[hit]
            open_, own = open_[~hit], own[~hit]
            weight = self._find(self.b[m], lang[open_] | (own >> np.uint64(8)))[1]
            out[open_] += weight
        out[open_] += np.log(1 / 256)
        return out


def _shard_of(lang: Column, pair: Column, n: int) -> Column:
    return F.pmod(lang * 31 + pair * 40503, F.lit(n))


def write_shards(model: DataFrame, shard_rows: int, path: str) -> int:
    """Writes the model in shards of some ``shard_rows`` rows, and shard -1 with the orders that go with all; returns their number."""
    small = F.col("order") <= 2
    n = max(1, -(-model.where(~small).count() // shard_rows))
    pair = F.when(F.col("kind") == "p", F.shiftright("gram", 8)).otherwise(F.col("gram")).bitwiseAND(F.lit(0xFFFF))
    shard = F.when(small, -1).otherwise(_shard_of(F.col("lang"), pair, n)).cast("int")
    model.withColumn("shard", shard).repartition(n + 1, "shard").write.partitionBy("shard").parquet(path)
    return n


def read_shard(path: str, k: int) -> Shard:
    """A shard with the orders that go with all."""
    import pyarrow.parquet as pq

    fs, inner = open_store(path)
    tables = []
    for own in (-1, k):
        for f in fs.get_file_info(pafs.FileSelector(f"{inner}/shard={own}", allow_not_found=True)):
            if f.path.endswith(".parquet"):
                with fs.open_input_file(f.path) as stream:
                    tables.append(pq.ParquetFile(stream).read(["kind", "order", "lang", "gram", "value"]))
    empty = pa.table({"kind": pa.array([], pa.string()), "order": pa.array([], pa.int32()), "lang": pa.array([], pa.int64()), "gram": pa.array([], pa.int64()), "value": pa.array([], pa.float64())})
    return Shard(pa.concat_tables(tables) if tables else empty)


def _score(docs: DataFrame, path: str, n: int) -> DataFrame:
    """(id, th, lang, name, text) to the number of bytes and the sum of their log-probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pandas as pd

        only = read_shard(path, 0) if n == 1 else None
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            langs = batch.column("lang").to_numpy()
            for a, b in steps(off, 4_000_000):
                grams, bounds = byte_grams(data, off[a : b + 1], langs[a:b])
                codes, keys = pd.factorize(grams)
                logs = np.zeros(len(keys))
                if only is not None:
                    logs = only.log_probabilities(keys)
                elif len(keys):
                    pair = (keys >> np.uint64(8)) & np.uint64(0xFFFF)
                    of = ((keys >> np.uint64(40)) * np.uint64(31) + pair * np.uint64(40503)) % np.uint64(n)
                    for k in np.unique(of).tolist():  # one shard in memory at a time
                        at = np.flatnonzero(of == k)
                        logs[at] = read_shard(path, k).log_probabilities(keys[at])
                total = np.concatenate(([0.0], np.cumsum(logs[codes])))
                columns = [batch.column(c)[a:b] for c in ("id", "th", "name")]
                columns += [pa.array(np.diff(bounds).astype(np.int64)), pa.array(np.diff(total[bounds]))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "th", "name", "n_bytes", "log_p"])
        trim_memory()

    return docs.mapInArrow(run, "id long, th long, name string, n_bytes long, log_p double")


def thresholds(scored: DataFrame, quantile: float) -> DataFrame:
    """(name, threshold): each language's quantile of held-out log-perplexities, by steps; the null language too.

    The row with ``every`` true has the quantile over all languages.
    """
    usable = scored.where("trusted and n_bytes > 0")
    held = usable.where("held")
    binned = (usable if held.isEmpty() else held).groupBy("name", F.ceil(F.col("log_ppl") * STEP).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    binned = written(binned, "perplexity_steps")
    both = binned.select("name", F.lit(False).alias("every"), "bin", "n").union(binned.groupBy("bin").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string"), F.lit(True), "bin", "n"))
    total = both.groupBy("name", "every").agg(F.sum("n").alias("all"), F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"))
    # at most some thousand steps for each language
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("bin"))
    found = F.aggregate(
        "bins",
        start,
        lambda acc, x: F.struct(
            (acc["seen"] + x["n"]).alias("seen"),
            F.when(acc["bin"].isNotNull(), acc["bin"]).when(acc["seen"] + x["n"] >= F.col("all") * quantile, x["bin"]).alias("bin"),
        ),
        lambda acc: acc["bin"],
    )
    return total.select("name", "every", (found / STEP).alias("threshold"))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    quantile: float = 0.995,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per document: id, lang, n_bytes (scored bytes), perplexity, threshold, trusted, kept (perplexity at the
    threshold or below).

    ``labels`` has the ids of trusted documents in the column ``id_col``.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"), F.col(lang_col).cast("string").alias("name"), text.alias("text"))
    ids = written(labels.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct(), "trusted")
    known = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    names = [r[0] for r in source.join(known, "id", "left_semi").select("name").distinct().limit(MOST_LANGUAGES + 1).collect()]
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages have trusted text")
    code = F.lit(0)  # no model
    for i, name in enumerate(sorted(names, key=lambda x: (x is not None, x)), 1):
        code = F.when(F.col("name").eqNullSafe(F.lit(name)), i).otherwise(code)
    source = source.withColumn("lang", code.cast("long"))
    held = F.pmod(F.xxhash64("th", F.lit(17)), F.lit(HELD_OUT)) == 0
    model = train(source.join(known, "id", "left_semi").where(~held).select("lang", "text"))
    path = scratch_path(spark, "shards")
    check_store(path)
    n = write_shards(model, shard_rows, path)
    drop_written(model)
    log_ppl = F.when(F.col("n_bytes") > 0, -F.col("log_p") / F.col("n_bytes"))
    scored = _score(source, path, n).withColumn("log_ppl", log_ppl).join(known.withColumn("trusted", F.lit(True)), "id", "left")
    scored = written(scored.withColumns({"trusted": F.coalesce("trusted", F.lit(False)), "held": held}), "scored")
    limits = written(thresholds(scored, quantile), "thresholds")
    default = limits.where("every").select("threshold").first()
    own = limits.where("not every").select(F.col("name").alias("l"), "threshold")
    out = scored.join(F.broadcast(own) if own.count() <= 10_000 else own, F.col("name").eqNullSafe(F.col("l")), "left")
    limit = F.coalesce("threshold", F.lit(default[0] if default else None).cast("double"))
    kept = F.coalesce((F.col("log_ppl") <= limit) | (limit.isNull() & (F.col("n_bytes") > 0)), F.lit(False))
    return out.select(
        F.col("id").alias(id_col), F.col("name").alias(lang_col), "n_bytes", F.exp("log_ppl").alias("perplexity"), F.exp(limit).alias("threshold"), "trusted", kept.alias("kept")
    )
