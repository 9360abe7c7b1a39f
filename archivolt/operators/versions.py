"""Tables with versions: readers always find a whole one, writers never lose each other's work.

A table is a folder. ``data`` has each version's Parquet files under a name of their own; ``versions`` has one small file for
each version, ``<number>.json``, which names its data. A commit writes the data first and then puts the next version's file,
which must not exist: the first of two writers wins, the other makes its rows again from what the first has written, and
retries. A reader takes the newest version file; what a writer left that died before its put is in no version and is cleared
away by ``vacuum``. So there is no moment at which a table is missing or half written, and no lock.

The put is a hard link on local file systems and a rename that refuses an existing target elsewhere (atomic on HDFS; a store
whose rename isn't atomic must serialise its writers). The driver holds one version file; data never passes through it.

Defined results: a table without versions is an error to readers and ``None`` to the first writer. A version's columns are its
own. A commit that gives up after ``retries`` conflicts raises ``Conflict`` and leaves no data.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Other writers were first, each time."""


def _fs(spark: SparkSession, path: str):
    """The path's file system, and the path."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _listed(spark: SparkSession, folder: str) -> list:
    fs, at = _fs(spark, folder)
    return list(fs.listStatus(at)) if fs.exists(at) else []


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The table's versions, in order."""
    names = (s.getPath().getName() for s in _listed(spark, f"{path}/versions"))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _file(path: str, number: int) -> str:
    return f"{path}/versions/{number:020d}.json"


def entry(spark: SparkSession, path: str, number: int) -> dict:
    """What a version's file says: data (a name), rows, note."""
    fs, at = _fs(spark, _file(path, number))
    stream = fs.open(at)
    try:
        return json.loads(bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()


def _put(spark: SparkSession, path: str, number: int, content: dict) -> bool:
    """Puts a version's file unless there is one; false if there is."""
    target, own = _file(path, number), f"{path}/versions/.{uuid.uuid4().hex}"
    fs, at = _fs(spark, own)
    fs.mkdirs(at.getParent())
    stream = fs.create(at, False)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    try:
        if fs.getScheme() == "file":
            os.link(*(urlparse(p).path if "://" in p or p.startswith("file:") else p for p in (own, target)))
            return True
        context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        options = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(at, _fs(spark, target)[1], options)
        return True
    except FileExistsError:
        return False
    except Exception as problem:
        if "FileAlreadyExists" in str(problem):
            return False
        raise
    finally:
        if fs.exists(at):
            fs.delete(at, False)


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """A version of the table, the newest if none is named."""
    known = numbers(spark, path)
    if not known or (number is not None and number not in known):
        raise FileNotFoundError(f"{path}: no version {'' if number is None else number}".rstrip())
    return spark.read.parquet(f"{path}/data/{entry(spark, path, known[-1] if number is None else number)['data']}")


def commit(spark: SparkSession, path: str, make: Callable[[DataFrame | None], DataFrame], *, note: str = "", retries: int = 5) -> int:
    """Writes ``make`` of the newest version (None if there is none) as the next one; returns its number."""
    for _ in range(retries + 1):
        known = numbers(spark, path)
        name = uuid.uuid4().hex
        make(read(spark, path, known[-1]) if known else None).write.parquet(f"{path}/data/{name}")
        number = (known[-1] if known else 0) + 1
        if _put(spark, path, number, {"data": name, "note": note}):
            return number
        fs, at = _fs(spark, f"{path}/data/{name}")
        fs.delete(at, True)
    raise Conflict(f"{path}: {retries + 1} attempts met other writers")


def replace_table(df: DataFrame, path: str) -> int:
    """The frame as the table's next version, whatever it held."""
    return commit(df.sparkSession, path, lambda _: df)


def history(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, note) of every version."""
    return [(n, entry(spark, path, n)["note"]) for n in numbers(spark, path)]


def vacuum(spark: SparkSession, path: str, *, keep: int = 2, older_than: float = 24 * 3600) -> list[str]:
    """Deletes versions but the ``keep`` newest, and data that no version names and that is ``older_than`` seconds old, so that
    a writer at work is left alone; returns the data's names."""
    known, gone = numbers(spark, path), []
    for n in known[:-keep] if keep else []:
        fs, at = _fs(spark, _file(path, n))
        fs.delete(at, False)
    named = {entry(spark, path, n)["data"] for n in numbers(spark, path)}
    for s in _listed(spark, f"{path}/data"):
        name = s.getPath().getName()
        if name not in named and s.getModificationTime() <= 1000 * (time.time() - older_than):
            _fs(spark, path)[0].delete(s.getPath(), True)
            gone.append(name)
    return sorted(gone)


def differences(old: DataFrame | None, new: DataFrame, key: str, *, whole: bool = True) -> DataFrame:
    """(key, change): added, changed or gone, by comparing all columns of two versions. A new version that isn't ``whole``, as
    after a harvest that broke off, has no gone rows. Repeated keys count by their first row in order of all columns."""
    from pyspark.sql import functions as F

    def first(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(key).agg(F.min(F.struct(*sorted(df.columns))).alias(name))

    if old is None:
        return new.select(key, F.lit("added").alias("change")).distinct()
    both = first(old.select(*new.columns), "o").join(first(new, "n"), key, "full_outer")
    change = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), F.lit("gone") if whole else F.lit(None)).when(~F.col("o").eqNullSafe(F.col("n")), "changed")
    return both.select(key, change.alias("change")).where("change is not null")
