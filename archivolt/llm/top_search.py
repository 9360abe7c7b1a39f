"""Exact top-k search by inner product with multi-resolution segment statistics.

Components x become integers floor(scale * x). A vector is cut into 1, 4 and 16 segments, and into segments of two; of each
segment its mean and deviation are known. For two vectors the squared distance is at least the sum over the segments of their lengths times
(difference of means)^2 + (difference of deviations)^2, by the inequality of Cauchy and Schwarz on what is left of the means.
Squared distance and inner product add up to known norms, so each lower bound of the distance is an upper bound of the score:
the sum of lengths times (product of means + product of deviations). Coarse to fine, pairs whose bound is below a query's k-th
score so far are dropped, and those that survive all levels are scored exactly, as integers.

Scale: a stated set of queries meets all rows, in blocks. Equal vectors differ in id alone, so of each distinct vector the
k + 1 rows of smallest id stand for all: a vector that a third of all rows hold doesn't make a hot block. Candidates and
queries are dealt into blocks by a hash of their row, and each cell (block of queries x block of candidates) is a group of
bounded size, compared by one task: in steps of ``STEP_QUERIES`` x ``STEP_CANDIDATES``, so that a query's k-th score rises
while it goes on. A cell leaves k rows for each query, of which a window keeps the best. Nothing but counts is on the driver.
Work and cells grow with the number of queries times that of candidates, as the task does; rows that are shuffled grow with
candidates x query blocks. Bounds are doubles with a margin far above their rounding; scores are exact longs.

Defined results: vectors that are null or hold a null or non-finite component take no part. Vectors of different lengths have
no inner product and are no candidates of each other. A query's own row is no candidate, but a repeated row is, as is one with
the same id. Ties go to the smaller id, then to equal rows in any order; a null id comes last and is never a query. Queries
with fewer than k candidates have all of them, without any none. Vectors whose squared norm is beyond ``MOST_NORM``, so that a
score might not fit a long, are refused with an error. An empty vector scores 0. Other columns, whatever their names, are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivolt.llm._common import ship, written
from archivolt.llm.centroids import integer_vector, usable

#: Numbers of segments, coarse to fine; the finest level has segments of two components.
LEVELS = (1, 4, 16)
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 4096
STEP_QUERIES, STEP_CANDIDATES = 128, 1024
MOST_NORM = 1 << 62
#: Below this share of surviving pairs, the next level looks at these pairs alone.
SPARSE = 0.125


def levels(dims: int) -> list[int]:
    """Numbers of segments for vectors of that many components."""
    return sorted({1, *(s for s in LEVELS if s <= dims // 2), max(1, dims // 2)})


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Of each row the segments' means and deviations, each times the root of the segment's length, so that the inner product
    of two rows' features bounds that of the rows from above."""
    n, dims = x.shape
    cuts = np.linspace(0, dims, min(segments, dims) + 1).astype(np.int64)[:-1] if dims else np.zeros(0, np.int64)
    if not dims:
        return np.zeros((n, 0))
    size = np.diff(np.append(cuts, dims)).astype(np.float64)
    y = x.astype(np.float64)
    mean = np.add.reduceat(y, cuts, axis=1) / size
    left = y - np.repeat(mean, size.astype(np.int64), axis=1)
    deviation = np.sqrt(np.add.reduceat(left * left, cuts, axis=1) / size)
    return np.concatenate((mean, deviation), axis=1) * np.sqrt(np.tile(size, 2))


class _Side:
    """Rows of one side of a cell: vectors, ids, rows, norms and the features of each level."""

    def __init__(self, table: pa.Table, dims: int):
        self.row, self.id = table["row"].to_numpy(), table["id"].combine_chunks()
        self.known = ~self.id.is_null().to_numpy(zero_copy_only=False)
        self.order = self.id.fill_null(0).to_numpy()
        self.v = table["v"].combine_chunks().flatten().to_numpy().reshape(len(table), dims)
        self.norm = np.sqrt((self.v.astype(np.float64) ** 2).sum(1))
        self.features = [segment_features(self.v, s) for s in levels(dims)]


def _best(x: _Side, y: _Side, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in x, place in y, score) of the k best rows of y for each row of x but itself."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a in range(0, len(x.row), STEP_QUERIES):
        own = np.arange(a, min(a + STEP_QUERIES, len(x.row)))
        limit = np.full(len(own), -np.inf)
        held = (np.zeros(0, np.int64),) * 3
        first = x.features[0][own] @ y.features[0].T
        for b in _steps(first):
            near = first[:, b]
            # a margin far above the rounding of the bounds
            margin = 1 + 1e-9 * x.norm[own, None] * y.norm[None, b]
            alive = near + margin >= limit[:, None]
            alive &= x.row[own, None] != y.row[None, b]
            for level in range(1, len(x.features)):
                q, c = x.features[level], y.features[level]
                if alive.sum() > SPARSE * alive.size:
                    alive &= q[own] @ c[b].T + margin >= limit[:, None]
                else:
                    i, j = np.nonzero(alive)
                    bound = np.einsum("ij,ij->i", q[own[i]], c[b[j]])
                    alive[i, j] = bound + margin[i, j] >= limit[i]
            i, j = np.nonzero(alive)
            score = np.concatenate([np.einsum("ij,ij->i", x.v[own[i[s : s + 65536]]], y.v[b[j[s : s + 65536]]]) for s in range(0, len(i), 65536)] or [np.zeros(0, np.int64)])
            i, j, score = (np.concatenate(p) for p in zip(held, (i, b[j], score), strict=True))
            order = np.lexsort((y.row[j], y.order[j], ~y.known[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            begin = np.searchsorted(i, np.arange(len(own)))
            place = np.arange(len(i)) - begin[i] if len(i) else np.zeros(0, np.int64)
            keep = place < k
            full = i[place == k - 1]
            limit[full] = score[place == k - 1]
            held = (i[keep], j[keep], score[keep])
        out.append((own[held[0]], held[1], held[2]))
    return tuple(np.concatenate(p) for p in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def _steps(bounds: np.ndarray) -> list[np.ndarray]:
    """Candidates in steps, those of the largest coarse bounds first."""
    order = np.argsort(-bounds.max(0), kind="stable") if bounds.size else np.zeros(0, np.int64)
    return [order[s : s + STEP_CANDIDATES] for s in range(0, len(order), STEP_CANDIDATES)]


def exact_top_k(vectors: DataFrame, queries: Column, *, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the ``k`` highest inner products of every row for which ``queries`` holds, a condition on
    the id column."""
    ship(vectors.sparkSession)
    source = vectors.where(usable(F.col(vector_col)))
    norm = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    fits = F.when(norm <= float(MOST_NORM), F.col("v")).otherwise(F.raise_error(F.lit(f"squared norms beyond {MOST_NORM} are refused")).cast("array<bigint>"))
    prepared = source.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(queries, F.lit(False)).alias("asks"), integer_vector(F.col(vector_col), scale, 1 << 31).alias("v")
    )
    prepared = written(prepared.select("id", "asks", fits.alias("v"), F.size("v").alias("dims"), F.monotonically_increasing_id().alias("row")), "integer_vectors")

    # of equal vectors the k + 1 of smallest id can be among a query's k best
    alike = Window.partitionBy("v").orderBy(F.asc_nulls_last("id"), "row")
    candidates = written(prepared.withColumn("place", F.row_number().over(alike)).where(F.col("place") <= k + 1).select("id", "row", "v", "dims"), "distinct_vectors")
    asked = prepared.where("asks").select("id", "row", "v", "dims")
    across, down = (max(1, -(-df.count() // size)) for df, size in ((asked, QUERY_BLOCK), (candidates, CANDIDATE_BLOCK)))

    def cells(df: DataFrame, own: str, n: int, every: str, m: int, asks: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias(own)
        return df.select("*", block, F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(every), F.lit(asks).alias("asks"))

    both = cells(asked, "qx", across, "cy", down, True).unionByName(cells(candidates, "cy", down, "qx", across, False))

    def search(table: pa.Table) -> pa.Table:
        dims = table["dims"][0].as_py()
        x, y = (_Side(table.filter(m), dims) for m in (table["asks"], pa.compute.invert(table["asks"])))
        i, j, score = _best(x, y, k)
        return pa.table({"query": pa.array(x.row[i]), "query_id": x.id.take(pa.array(i)), "id": y.id.take(pa.array(j)), "row": pa.array(y.row[j]), "score": pa.array(score)})

    found = both.groupBy("dims", "qx", "cy").applyInArrow(search, "query long, query_id long, id long, row long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
