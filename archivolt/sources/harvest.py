"""A paged harvest as a Spark data source, ``label_harvest``: each page names the next by its resumption token.

``spark.readStream.format("label_harvest")`` has the token as its offset: a stream that stops goes on with the page that it
hasn't committed. ``spark.read`` follows the chain from its first page to its end in one task, since a token is only known once
the page before is read. Options: ``pages``, a folder of saved pages (``request=<token>`` folders, as Spark's text writer with
``partitionBy("request")`` leaves them; the first page's token is ``first``) or an http address that takes ``resumptionToken``;
``retry``, true to ask again for a page that failed when the stream starts anew.

A page that can't be read or isn't well formed gives one row with its problem, and the harvest ends there: what came before is
a partial result, and is kept. A token that comes again ends the harvest with a problem too, so that no server can keep it in a
circle. Pages pass one at a time; within a page records are read in order.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from urllib.parse import quote

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, SimpleDataSourceStreamReader

from archivolt.operators import versions
from archivolt.sources.trees import harvested, parse_xml

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package

SCHEMA = "page long, request string, pos long, id string, cs string, en string, problem string"
FIRST = "first"
TIMEOUT = 60
_ESCAPED = re.compile("[\x00-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")


def fetched(pages: str, token: str) -> str:
    """The text of the page that a token asks for."""
    if pages.startswith(("http://", "https://")):
        import urllib.request

        tail = "" if token == FIRST else f"{'&' if '?' in pages else '?'}resumptionToken={quote(token, safe='')}"
        with urllib.request.urlopen(pages + tail, timeout=TIMEOUT) as answer:  # noqa: S310
            return answer.read().decode("utf-8", "replace")
    import pyarrow.fs as pafs

    fs, folder = pafs.FileSystem.from_uri(pages.replace("file:/", "file:///", 1) if re.match("file:/[^/]", pages) else pages)
    at = f"{folder.rstrip('/')}/request={_ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', token)}"
    files = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(at)) if f.is_file and not f.base_name.startswith((".", "_")))
    parts = []
    for f in files:
        with fs.open_input_stream(f) as stream:
            parts.append(stream.read().decode("utf-8", "replace"))
    return "".join(parts)


def page_rows(pages: str, page: int, token: str) -> tuple[list[tuple], str, bool]:
    """A page's rows, the next token (empty on the last page), and whether the page failed."""
    try:
        root = parse_xml(fetched(pages, token))
        rows = [(page, token, i, ident, cs, en, None) for i, (ident, cs, en, _) in enumerate(harvested(root))]
        tokens = [(e.text or "").strip() for e in root.iter() if str(e.tag).rpartition("}")[2] == "resumptionToken"]
        return rows, tokens[0] if tokens else "", False
    except Exception as problem:  # any: a page is a page of somebody else
        return [(page, token, 0, None, None, None, f"{type(problem).__name__}: {problem}"[:500])], "", True


class _Reader(DataSourceReader):
    def __init__(self, pages: str):
        self.pages = pages

    def read(self, partition) -> Iterator[tuple]:
        page, token, seen = 0, FIRST, set()
        while token:
            if token in seen:
                yield page, token, 0, None, None, None, "the token came again"
                return
            seen.add(token)
            rows, token, failed = page_rows(self.pages, page, token)
            yield from rows
            if failed:
                return
            page += 1


class _StreamReader(SimpleDataSourceStreamReader):
    """Offset: the page to come, its token (empty when the harvest is over), the page at which tokens were last marked, that
    mark, and whether the page failed. The mark moves at powers of two, so that a circle is found without a list of tokens."""

    def __init__(self, pages: str, retry: bool):
        self.pages, self.retry, self.fresh = pages, retry, True

    def initialOffset(self) -> dict:  # noqa: N802
        return {"page": 0, "token": FIRST, "mark": "", "failed": False}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        again = self.retry and self.fresh
        self.fresh = False
        if not start["token"] or start["failed"] and not again:
            return iter([]), start
        page, token = start["page"], start["token"]
        if page and token == start["mark"]:
            return iter([(page, token, 0, None, None, None, "the token came again")]), start | {"token": ""}
        rows, following, failed = page_rows(self.pages, page, token)
        if failed:
            return iter(rows), start | {"failed": True, "attempt": start.get("attempt", 0) + 1}
        mark = token if page & (page - 1) == 0 else start["mark"]
        return iter(rows), {"page": page + 1, "token": following, "mark": mark, "failed": False}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        if start == end:
            return iter([])
        if start["page"] and start["token"] == start["mark"]:
            return iter([(start["page"], start["token"], 0, None, None, None, "the token came again")])
        return iter(page_rows(self.pages, start["page"], start["token"])[0])

    def commit(self, end: dict) -> None:
        pass


class LabelHarvest(DataSource):
    """See the module."""

    @classmethod
    def name(cls) -> str:
        return "label_harvest"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["pages"])

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: N802
        return _StreamReader(self.options["pages"], self.options.get("retry", "false").lower() == "true")


def kept_first(rows: DataFrame) -> DataFrame:
    """(id, cs, en): the first record of each id, by page and place; rows with a problem and records without an id go."""
    first = Window.partitionBy("id").orderBy("page", "pos")
    good = rows.where("problem is null and id <> ''")
    return good.withColumn("__k", F.row_number().over(first)).where("__k = 1").select("id", "cs", "en")


def harvest_stream(spark: SparkSession, pages: str, folder: str, *, retry: bool = False) -> DataFrame:
    """Harvests into ``folder`` as a stream until no page is left; returns all rows so far. A run that stops goes on from its
    last page; a batch that is written again replaces itself."""
    spark.dataSource.register(LabelHarvest)
    source = spark.readStream.format("label_harvest").option("pages", pages).option("retry", str(retry).lower()).load()

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    query = source.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.option("basePath", f"{folder}/rows").parquet(f"{folder}/rows").drop("batch")


def load_or_sync(spark: SparkSession, path: str, pages: str, folder: str, *, sync: bool) -> tuple[DataFrame, DataFrame]:
    """(table, changes): the versioned table of labels at ``path``; with ``sync`` harvested anew and committed as its next
    version. Changes are (id, change). A harvest that broke off adds and changes labels, and takes none away."""
    before = versions.read(spark, path) if versions.numbers(spark, path) else None
    if not sync:
        if before is None:
            raise FileNotFoundError(f"{path}: harvest the labels first")
        return before, versions.differences(before, before, "id")
    rows = harvest_stream(spark, pages, folder)
    new, whole = kept_first(rows), rows.where("problem is not null").isEmpty()
    changes = versions.differences(before, new, "id", whole=whole)

    def merged(old: DataFrame | None) -> DataFrame:
        return new if whole or old is None else new.unionByName(old.select("id", "cs", "en").join(new.select("id"), "id", "left_anti"))

    number = versions.commit(spark, path, merged, note="whole" if whole else "broken off")
    return versions.read(spark, path, number), changes
