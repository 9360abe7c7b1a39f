"""Centroid clustering: plain Lloyd over integer vectors, exact in every step.

A vector is kept when it has ``dims`` components, none null and all finite; each component x becomes floor(scale * x) as an
integer. The starting centroids are the ``k`` kept vectors whose ids, behind a prefix, have the smallest SHA-256. In each
round the centroids are broadcast, a task computes the squared differences of a batch to one centroid after another in NumPy
and takes the first least one, and adds its vectors up by cluster; these sums, ``k`` vectors of integers for each task, merge
through ``groupBy``. A centroid becomes the floor of sum over count, an empty one stays. Then vectors are assigned once more.

Scale: the kept vectors are written once in the shared folder, as integers, and read once in each round; what is shuffled in
a round is ``k`` sums for each task, so a cluster that holds a third of all vectors is no heavier than another. The driver
holds ``k`` centroids of ``dims`` integers, whose number doesn't depend on the input; a task holds one batch and its
differences to one centroid. A lost executor repeats its own tasks.

Defined results: null vectors, vectors of another length and vectors with a null or non-finite component are left out. Fewer
than ``k`` kept vectors give as many centroids; none give no rows. Repeated rows are vectors each, and can be two centroids
at one place, of which the first gets all. A null id comes last in the order of the start; equal hashes are ordered by the
vector. Integers beyond ``LIMIT`` in size, whose distances might not fit a long, are refused with an error, as Spark refuses
an overflow. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.llm._common import drop_written, ship, written

#: Differences of integers up to this size have squares whose sum over 64 components fits a long.
LIMIT = 1 << 27


def integer_vector(vector: Column, scale: int, limit: int) -> Column:
    """floor(scale * x) of every component, x as double; an error names a component beyond ``limit``."""

    def one(x: Column) -> Column:
        scaled = F.floor(F.lit(float(scale)) * x.cast("double"))
        return F.when(F.abs(F.lit(float(scale)) * x.cast("double")) <= float(limit), scaled).otherwise(
            F.raise_error(F.concat(F.lit(f"scaled components beyond {limit} are refused: "), x.cast("string"))).cast("long")
        )

    return F.transform(vector, one)


def usable(vector: Column) -> Column:
    """Whether a vector is not null and has no null and no non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest centroid of each row, and its squared distance."""
    best = np.full(len(x), np.iinfo(np.int64).max)
    cluster = np.zeros(len(x), np.int32)
    for k, c in enumerate(centroids):
        d = x - c
        own = np.einsum("ij,ij->i", d, d)
        closer = own < best  # an equal distance stays with the smaller number
        best[closer] = own[closer]
        cluster[closer] = k
    return cluster, best


def _rows(batch: pd.DataFrame, dims: int) -> np.ndarray:
    return np.stack(batch["v"].to_numpy()).astype(np.int64) if len(batch) else np.zeros((0, dims), np.int64)


def _sums(kept: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Of each cluster that isn't empty: how many vectors it has, and their sum."""
    shared = kept.sparkSession.sparkContext.broadcast(centroids)
    k, dims = centroids.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            x = _rows(batch, dims)
            cluster, _ = nearest(x, shared.value)
            for c in np.unique(cluster):
                own = x[cluster == c]
                n[c] += len(own)
                total[c] += own.sum(0)
        some = np.flatnonzero(n)
        yield pd.DataFrame({"cluster": np.repeat(some, dims), "dim": np.tile(np.arange(dims), len(some)), "n": np.repeat(n[some], dims), "total": total[some].ravel()})

    parts = kept.select("v").mapInPandas(run, "cluster int, dim int, n long, total long")
    merged = parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found: dict[int, tuple[int, list[int]]] = {}
    for r in merged.orderBy("cluster", "dim").collect():  # k x dims rows
        found.setdefault(r["cluster"], (r["n"], []))[1].append(int(r["total"]))
    shared.unpersist()
    return found


def cluster(
    vectors: DataFrame, *, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2:", id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per kept vector: the id, cluster, distance (squared), cluster_inertia and inertia (distances summed over the
    cluster and over all) and centroid_sha256 (of its final centroid's components, as decimal integers joined by commas)."""
    spark = vectors.sparkSession
    ship(spark)
    vector = F.col(vector_col)
    source = vectors.select(F.col(id_col).alias("id"), F.when(F.size(vector) == dims, vector).alias("x")).where(usable(F.col("x")))
    kept = written(source.select("id", integer_vector(F.col("x"), scale, LIMIT).cast("array<int>").alias("v")), "vectors")
    digest = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    start = kept.select("v", digest.alias("h")).orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()  # k rows
    centroids = np.array([r["v"] for r in start], np.int64).reshape(len(start), dims)
    for _ in range(rounds if len(start) else 0):
        for c, (n, total) in _sums(kept, centroids).items():
            centroids[c] = [x // n for x in total]

    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own, distance = nearest(_rows(batch, dims), shared.value)
            yield pd.DataFrame({"id": batch["id"], "cluster": own, "distance": distance})

    id_type = kept.schema["id"].dataType.simpleString()
    assigned = written(kept.mapInPandas(assign, f"id {id_type}, cluster int, distance long"), "assigned")
    drop_written(kept)
    sums = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(c, s, sum(sums.values(), Decimal(0)), names[c]) for c, s in sorted(sums.items())]
    finals = spark.createDataFrame(rows, "cluster int, cluster_inertia decimal(38,0), inertia decimal(38,0), centroid_sha256 string")
    out = assigned.join(F.broadcast(finals), "cluster")  # k rows
    return out.select(
        F.col("id").alias(id_col), "cluster", "distance", F.col("cluster_inertia").cast("long").alias("cluster_inertia"), F.col("inertia").cast("long").alias("inertia"), "centroid_sha256"
    )
