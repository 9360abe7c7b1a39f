"""What a task holds doesn't grow with the table."""

from __future__ import annotations

import time

import oracle
import pytest
from pyspark.sql import functions as F

from archivolt import catalog


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["best_score_merge", "form_lemmas", "ker_topk"])
def test_documents_move_once_as_texts(spark, sf_dir, name):
    plan = plan_of(catalog.queries()[name](spark, sf_dir))
    assert plan.count("Exchange ") == plan.count("REPARTITION_BY_NUM") == 1  # of texts, to a number of tasks by their bytes


def test_tasks_by_bytes(spark):
    from archivolt.operators.tasks import dealt

    rows = spark.range(100).select("id", F.repeat(F.lit("x"), 100).alias("t"))
    assert dealt(rows, "t", "id", task_bytes=1000).rdd.getNumPartitions() == 11
    assert dealt(rows.where("id < 0"), "t", "id").rdd.getNumPartitions() == 1


def test_ids_of_a_label_are_made_unique_by_hashing(spark):
    from archivolt.sources import records as R

    ids = lambda *x: [{"source": a, "id": b} for a, b in x]
    schema = "theme_rank int, term_rank int, theme string, cs string, source string, source_id string, discarded array<struct<source:string,id:string>>"
    many = [("s", str(i % 30_000)) for i in range(60_000)]
    rows = [(1, 1, "T", "a", "s", "1", ids(("s", "1"), ('q"', "ř,"), (None, "1"), ("s", None), ('q"', "ř,"))), (1, 2, "T", "b", None, None, None), (1, 3, "T", "c", "s", "0", ids(*many))]
    out = R.ordered_terms(spark.createDataFrame(rows, schema), spark.createDataFrame([], "theme string"), "none")
    assert out.schema["ids"].dataType.simpleString() == "array<struct<source:string,id:string>>"
    got = {r.cs: [tuple(x) for x in r.ids] for r in out.collect()}
    assert got["a"] == [("s", "1"), ('q"', "ř,"), (None, "1"), ("s", None)] and got["b"] == [] == got["none"]
    assert got["c"] == [("s", str(i)) for i in range(30_000)]
    plan = plan_of(out.select("ids"))
    assert "array_distinct(concat(" not in plan  # structs are compared pair by pair


def test_files_and_pages_are_bounded(spark, tmp_path, sf_dir, monkeypatch):
    from archivolt.plans import structure_plans as P

    records = spark.range(5000).select(F.col("id").alias("pos"), F.col("id").cast("string").alias("id"), F.lit("a").alias("cs"), F.lit("b").alias("en"))
    monkeypatch.setattr(P, "PAGE_RECORDS", 200)
    folder = P._saved_pages(records, f"file://{tmp_path}/pages")
    pages = spark.read.text(folder)
    assert pages.count() > 20 and pages.agg(F.max(F.length("value"))).first()[0] < 5000 * 100 / 8  # eight before
    spark.dataSource.register(P.harvest.LabelHarvest)
    rows = spark.read.format("label_harvest").option("pages", str(tmp_path / "pages")).load().orderBy("page", "pos").collect()
    assert [r.id for r in rows] == [str(i) for i in range(5000)]  # in their order over all pages
    monkeypatch.setattr(P, "FILE_LINES", 20)
    picks, bad = P._scanned(spark, sf_dir)
    assert picks.select("run", "file").distinct().count() > 3 * picks.select("run").distinct().count()  # one of each run before
    assert [r.run for r in bad.collect()] == ["role=assistant"]


def test_small_rows_that_take_long_are_dealt(spark, sf_dir, monkeypatch):
    from archivolt.operators import schema

    monkeypatch.setattr(schema, "TASK_RECORDS", 50)
    assert catalog.queries()["schema_check"](spark, sf_dir).rdd.getNumPartitions() > 3  # splits of a file before


def test_workers_hand_on_pieces(spark, monkeypatch):
    from archivolt.sources import trees

    files = spark.range(400, numPartitions=1).select(F.concat(F.lit("/in/"), "id", F.lit(".xml")).alias("path"), F.concat(F.lit("<a>"), F.repeat(F.lit("<tok>w</tok>"), 60), F.when(F.col("id") == 7, "<b>").otherwise(""), F.lit("</a>")).alias("text"))
    run = {}
    monkeypatch.setattr(type(files), "mapInPandas", lambda self, f, schema: run.update(f=f) or self)
    trees.read_xml_tokens(files)
    sizes = [len(p) for p in run["f"](iter([files.toPandas()]))]
    assert sum(sizes) == 399 * 60 + 1 and max(sizes) < trees.PIECE_ROWS + 60  # one frame for a batch before
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 4 << 20


def test_lines_move_as_texts(spark, sf_dir):
    plan = plan_of(catalog.queries()["text_lines"](spark, sf_dir))
    assert plan.count("Exchange ") == plan.count("REPARTITION_BY_NUM") == 1


def test_long_lines_are_searched_once(spark, tmp_path):
    line = "word " * 40_000
    texts = ["", None, "a", "\n", "a\nb\nc\nd", "a\nb\nc\nd\n", "\n\n\n\n\n\n\n\n\n", "a\r\nb\rc\r\nd\n\re\nf\n\n\n\n\n g \n", "a\fb\n\n\n\n\f\nc", "\n".join(map(str, range(23))), line, f"a\nb\nc\n{line}", f"{line}\nb\n\nd\n{line}\nf"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/rows")
    next((tmp_path / "rows").glob("*.parquet")).rename(tmp_path / "documents.parquet")
    began = time.monotonic()
    got = catalog.queries()["text_lines"](spark, str(tmp_path))
    oracle.compare(got, catalog.oracle_sql()["text_lines"], str(tmp_path))
    assert time.monotonic() - began < 30  # minutes before: a line of n letters without three more was searched from each of them


def test_keywords_are_compared_by_bounds_first():
    from archivolt.operators import ranking

    for a, b in [("abcd", "abcd"), ("abcdefghij", "abcdefghi"), ("abcdefghij", "jihgfedcba"), ("a", "abcdefgh"), ("", ""), ("", "a")]:
        assert all(ranking._alike(a, b, x) == (ranking.SequenceMatcher(None, a, b).ratio() >= x) for x in (0.1, 0.5, 0.9, 1.0))
    assert ranking.statistical_keywords("Old Mill. Old Mill stands. The old mill.", 3) and ranking.statistical_keywords("", 3) == []
