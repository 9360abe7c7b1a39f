"""Helpers shared by the training-data operators: shared scratch tables and vectorised word hashing.

Everything that must outlive a lost executor is written under the folder that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one vectorised step takes at once; a longer document is a step of its own.
STEP_BYTES = 1_500_000
#: Bytes of an Arrow batch on its way to a Python worker, unless the session has set its own; a row may exceed it.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_LIBC = ctypes.CDLL(None)


#: Spark's own default of that setting.
_DEFAULT_BATCH = "67108864b"
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for each application, so that it need not be installed there.

    Arrow batches of a session that has not set their size are bounded, since two copies of each are in memory at once.
    """
    sc = spark.sparkContext
    if spark.conf.get(_BATCH) == _DEFAULT_BATCH:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="archivolt-ship-")) / "archivolt.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, by any path that Spark can read. Texts that come in fewer splits than there are cores (one
    small file) are dealt out to all of them."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in ("documents", "pages") and df.rdd.getNumPartitions() < cores // 2:
        return df.repartition(cores)
    return df


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one is set only in local mode where the session names none, as in tests."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="archivolt-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/archivolt-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: the frame is written as Parquet in the shared folder and read again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(*frames: DataFrame) -> None:
    """Deletes tables that ``written`` made, once nothing lazy reads them any more."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/archivolt-" in parent:
                path = sc._jvm.org.apache.hadoop.fs.Path(parent)
                path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path.getParent(), True)


#: Schemes of the stores that tasks can open themselves, and the name under which Arrow knows each.
STORES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def check_store(uri: str) -> str:
    """The URI as Arrow takes it. A scheme that tasks can't open is refused, by name, before a job begins."""
    scheme, gap, rest = uri.partition(":")
    if not gap or "/" in scheme:
        return f"file://{uri}"
    if scheme not in STORES:
        raise ValueError(f"tasks read and write files under {', '.join(STORES)}, not {scheme}: let spark.checkpoint.dir name such a folder")
    return f"{STORES[scheme]}:{rest}" if rest.startswith("//") else f"{STORES[scheme]}://{rest}"


def open_store(uri: str) -> tuple:
    """The file system of a URI, and the path in it. Stores beyond the local one take their settings from the environment."""
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(check_store(uri))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return np.ascontiguousarray(x, dtype=np.uint64).view(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), off


def trim_memory() -> None:
    """Gives memory that a worker has freed back to the system, which reused workers otherwise keep."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text; freed memory is given back before and after, so that a worker that waits
    for its next task holds little."""
    trim_memory()
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b
        a = b
    _POWERS.clear()
    trim_memory()


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mixer of SplitMix64, in place on a copy."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, STEP_BYTES + STEP_BYTES // 4)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps_ = np.full(size, base, np.uint64)
            steps_[0] = 1
            _POWERS[name] = np.cumprod(steps_, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def byte_class(separators: bytes | None = None, word_bytes: bytes | None = None) -> np.ndarray:
    """Table from a byte to its lower-case form (A-Z only), or 0 where the byte separates words.

    Bytes from 0x80 belong to words, so whole code points stay together.
    """
    lut = np.arange(256, dtype=np.uint8)
    lut[ord("A") : ord("Z") + 1] += 32
    if separators is not None:
        lut[list(separators)] = 0
    if word_bytes is not None:
        keep = np.zeros(256, bool)
        keep[list(word_bytes)] = True
        keep[128:] = True
        lut[~keep] = 0
    return lut


#: Words between ASCII white space. A NUL byte is a word byte there, so it stands as 0xFF, which UTF-8 never has.
SPACE_WORDS = byte_class(separators=b" \t\n\x0b\x0c\r")
SPACE_WORDS[0] = 255
#: Words of ASCII letters and digits and of everything beyond ASCII.
ALNUM_WORDS = byte_class(word_bytes=b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


@dataclass
class Words:
    """The words of some documents: 64-bit hashes, and where each stands in the folded bytes."""

    folded: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray  # document d has words bounds[d] to bounds[d + 1]

    def canonical(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words, each followed by one space; each word's offsets in them, and each document's."""
        if not len(self.starts):
            return b"", np.zeros(1, np.int64), np.zeros(len(self.bounds), np.int64)
        lengths = self.ends - self.starts
        at = np.concatenate(([0], np.cumsum(lengths + 1)))
        out = np.full(int(at[-1]), 32, np.uint8)
        body = np.flatnonzero(self.folded)
        out[body - np.repeat(self.starts - at[:-1], lengths)] = self.folded[body]
        return out.tobytes(), at, at[self.bounds]


def find_words(data: np.ndarray, offsets: np.ndarray, lut: np.ndarray) -> Words:
    """Words of the documents that ``offsets`` delimits in ``data``; no word crosses a document's end."""
    off = offsets - offsets[0]
    folded = lut[data[offsets[0] : offsets[-1]]]
    n = len(folded)
    inside = folded != 0
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    cuts = off[(off > 0) & (off < n)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[cuts - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    if len(starts):
        up, down = _powers(n)
        sums = np.add.reduceat(folded * up[:n], starts)
        hashes = mix(sums * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    else:
        hashes = np.zeros(0, np.uint64)
    return Words(folded, starts, ends, hashes, np.searchsorted(starts, off))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words, document ends aside: entry i covers words i to i + k - 1."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, k):
        out *= np.uint64(0x2545F4914F6CDD1D)
        out += words[j : j + n]
    return mix(out + np.uint64(k))
