"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

How many rows of each source partition go to each shard is drawn first, without looking at a row: the counts of a uniform
random assignment with fixed shard sizes follow the multivariate hypergeometric law. Each partition then permutes its own
labels, rows are exchanged, and each shard is permuted again, which together is a uniform permutation of all rows.

Scale: shards are cut into blocks of about ``block_rows`` rows, which take the shards' place in the matrix, so no task
holds a whole shard; a slot is the block's place in its shard plus the place within the block. The matrix is never built: it
is drawn by halving. At a node of a binary tree over the partitions, the node's counts for all blocks are split between its
two halves by exact hypergeometric draws, themselves made by halving the blocks; a task draws only the nodes on the path to
its partition, each from a seed of its own, so all tasks agree. What the driver holds and sends is one count for each
partition. Whole rows are frozen with their places (partition, position) in a Parquet table in the shared folder first, and
every draw depends on the seed and these places alone, so a repeated task repeats its result. Rows are exchanged once, with
all their columns; a block that exceeds memory is sorted on disk.

Defined results: null texts have size 1 and checksum 0; a very long text is a row like any other. Repeated rows are rows of
their own. Other columns are carried, whatever their names; ``shard`` and ``slot`` are replaced. No rows give no shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivolt.llm._common import ship, text_bytes, written

BLOCK_ROWS = 1 << 16


def block_sizes(rows: int, shards: int, block_rows: int = BLOCK_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Of each block its rows and its shard: shard sizes differ by one at most, and so do a shard's blocks."""
    sizes, of = [], []
    for s in range(shards):
        own = rows // shards + (s < rows % shards)
        n = max(1, -(-own // block_rows))
        sizes += [own // n + (i < own % n) for i in range(n)]
        of += [s] * n
    return np.array(sizes, np.int64), np.array(of, np.int64)


def _hypergeometric(rng: np.random.Generator, good: np.ndarray, bad: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Exact draws. Beyond numpy's range of 10^9 rows: two binomial counts, taken when they sum to the number of draws."""
    large = np.maximum(good, bad) >= 10**9
    out = rng.hypergeometric(np.where(large, 0, good), np.where(large, 0, bad), np.where(large, 0, draws))
    for i in np.flatnonzero(large).tolist():
        g, b, n = int(good[i]), int(bad[i]), int(draws[i])
        while True:
            x = rng.binomial(g, n / (g + b), 1 << 16)
            hit = np.flatnonzero(x + rng.binomial(b, n / (g + b), 1 << 16) == n)
            if len(hit):
                out[i] = x[hit[0]]
                break
    return out


def draw_counts(rng: np.random.Generator, left: np.ndarray, rows: int) -> np.ndarray:
    """How many of ``rows`` rows go to each block of which ``left`` places are open, by halving the blocks."""
    some = np.flatnonzero(left)
    out = np.zeros(len(left), np.int64)
    if not len(some):
        return out
    levels = [left[some]]
    while len(levels[-1]) > 1:
        last = levels[-1] if len(levels[-1]) % 2 == 0 else np.append(levels[-1], 0)
        levels.append(last[::2] + last[1::2])
    own = np.array([rows], np.int64)
    for level in levels[-2::-1]:
        good, bad = level[::2], level[1::2]
        if len(bad) < len(good):
            bad = np.append(bad, 0)
        first = _hypergeometric(rng, good, bad, own)
        own = np.stack([first, own - first], 1).ravel()[: len(level)]
    out[some] = own
    return out


def partition_counts(part: int, before: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """A partition's row of the matrix; ``before`` has the number of rows before each partition, and all of them."""
    lo, hi, own = 0, len(before) - 1, sizes
    while hi - lo > 1:
        mid = (lo + hi) // 2
        first = draw_counts(np.random.default_rng([seed, lo, hi]), own, int(before[mid] - before[lo]))
        lo, hi, own = (lo, mid, first) if part < mid else (mid, hi, own - first)
    return own


def partition_labels(part: int, before: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """The block of every row of a partition: its row of the matrix, permuted."""
    own = partition_counts(part, before, sizes, seed)
    labels = np.repeat(np.arange(len(own), dtype=np.int32), own)
    return np.random.default_rng([seed, part]).permutation(labels)


def shuffle_into_shards(df: DataFrame, shards: int, *, seed: int = 20240607, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows with their columns, and ``shard`` and ``slot`` (gapless from 0 in each shard); columns of these names are
    replaced."""
    spark = df.sparkSession
    ship(spark)
    df = df.drop("shard", "slot")
    place = F.monotonically_increasing_id()
    frozen = df.withColumns({"__av_part": F.shiftright(place, 33).cast("int"), "__av_at": place.bitwiseAND(F.lit((1 << 33) - 1))})
    frozen = written(frozen, "placed_rows")
    counted = {r[0]: r[1] for r in frozen.groupBy("__av_part").count().collect()}
    parts = np.array([counted.get(p, 0) for p in range(max(counted, default=-1) + 1)], np.int64)
    sizes, of = block_sizes(int(parts.sum()), shards, block_rows)
    base = np.concatenate([np.cumsum(sizes[of == s]) - sizes[of == s] for s in range(shards)])
    plan = spark.sparkContext.broadcast(np.concatenate(([0], np.cumsum(parts))))
    rows = int(parts.sum())
    schema = T.StructType([*frozen.schema.fields, T.StructField("__av_block", T.IntegerType())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_part, labels = -1, None
        own_sizes, _ = block_sizes(rows, shards, block_rows)
        for batch in batches:
            part = batch.column("__av_part").to_numpy()
            at = batch.column("__av_at").to_numpy()
            block = np.empty(len(at), np.int32)
            for p in np.unique(part).tolist():
                if p != own_part:
                    own_part, labels = p, partition_labels(p, plan.value, own_sizes, seed)
                block[part == p] = labels[at[part == p]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block)], names=schema.names)

    labelled = frozen.mapInArrow(label, schema)
    key = F.xxhash64(F.lit(seed), "__av_part", "__av_at")
    order = Window.partitionBy("__av_block").orderBy(key, "__av_part", "__av_at")
    ranked = labelled.withColumn("__av_rank", F.row_number().over(order).cast("long") - 1)
    shard_of = F.array(*(F.lit(int(s)) for s in of)) if len(of) <= 4096 else None
    if shard_of is not None:
        first = F.array(*(F.lit(int(b)) for b in base))
        out = ranked.withColumns({"shard": shard_of[F.col("__av_block")], "slot": first[F.col("__av_block")] + F.col("__av_rank")})
    else:
        blocks = spark.createDataFrame([(i, int(s), int(b)) for i, (s, b) in enumerate(zip(of, base, strict=True))], "__av_block int, shard int, __av_base long")
        out = ranked.join(blocks, "__av_block").withColumn("slot", F.col("__av_base") + F.col("__av_rank"))
    return out.select(*df.columns, "shard", "slot")


def text_digests(shuffled: DataFrame, *, text_col: str = "text", carry: list[str]) -> DataFrame:
    """The carried columns with ``size`` (bytes of text, and one) and ``text_crc32`` of the texts that arrived in the shards.

    Arrow takes whole rows, so no column is pruned before the exchange.
    """
    fields = [f for f in shuffled.schema.fields if f.name in carry]
    schema = T.StructType([*fields, T.StructField("size", T.LongType()), T.StructField("text_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column(text_col))
            crc = [zlib.crc32(data[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            own = [*(batch.column(f.name) for f in fields), pa.array(np.diff(off) + 1), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(own, names=schema.names)

    return shuffled.mapInArrow(run, schema)
