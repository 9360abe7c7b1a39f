"""Consecutive errors as keyed state of a stream: the rows of a batch, stop and start, retries by timers."""

from __future__ import annotations

import time

import pytest

from archivolt.operators import enrich
from archivolt.streaming import enrichment

SCHEMA = "doc_id string, pos long, prompt string"


@pytest.fixture(autouse=True)
def provider(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, enrichment.PROVIDER)
    yield
    spark.conf.set(name, before)


def caller():
    def call(prompt):
        if "bad" in prompt:
            raise ValueError("no answer")
        return prompt.upper()

    return call


def run(spark, tmp_path, n, **how):
    """One start of the query over what lies in the folder, one file a batch, until ``n`` rows are there; returns all rows so far."""
    (tmp_path / "out").mkdir(exist_ok=True)
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    made = enrichment.enrich_stream(source, caller(), **how).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state")
    query = made.trigger(processingTime="500 milliseconds").start(f"{tmp_path}/out")
    try:
        return so_far(spark, tmp_path, n, query)
    finally:
        query.stop()


def so_far(spark, tmp_path, n, query):
    end, rows = time.time() + 60, []
    while time.time() < end and len(rows) < n and query.isActive:
        time.sleep(0.5)
        rows = spark.read.schema("doc_id string, pos long, status string, reply string").parquet(f"{tmp_path}/out").collect()
    return sorted(map(tuple, rows), key=str)


def lay(spark, tmp_path, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.json(f"{tmp_path}/{name}")
    (tmp_path / "in").mkdir(exist_ok=True)
    (file,) = (tmp_path / name).glob("part-*.json")
    file.rename(tmp_path / "in" / f"{name}.json")
    time.sleep(1.1)  # files are taken in order of their times


LINES = [("a", i, t) for i, t in enumerate(["x", "bad", "y", "bad", "bad", "z", "w"])] + [("b", i, t) for i, t in enumerate(["bad", "bad 2", "q"])] + [("c", 0, "fine"), ("c", 1, None)]


def test_stop_and_start_gives_the_rows_of_one_run(spark, tmp_path):
    numbered = spark.createDataFrame([(ord(d), p, t or "") for d, p, t in LINES], "doc_id long, pos long, prompt string")
    want = {(chr(r.doc_id), r.pos): r.status for r in enrich.enrich_in_order(numbered, caller(), max_consecutive_errors=2).collect()}
    lay(spark, tmp_path, [x for x in LINES if x[1] < 4], "one")
    first = run(spark, tmp_path, 9, most_errors=2)
    assert {r[:2] for r in first} == {x[:2] for x in LINES if x[1] < 4}
    lay(spark, tmp_path, [x for x in LINES if x[1] >= 4], "two")  # the error at 3 is remembered
    got = run(spark, tmp_path, len(LINES), most_errors=2)
    assert {r[:2]: r[2] for r in got} == want and len(got) == len(LINES)
    assert {r[:2]: r[3] for r in got}["a", 0] == "X" and {r[:2]: r[3] for r in got}["c", 1] == ""


def test_failed_calls_are_tried_again_later_and_in_order(spark, tmp_path):
    lay(spark, tmp_path, [("a", 0, "bad"), ("a", 1, "x"), ("b", 0, "y")], "one")

    assert [r[:3] for r in run(spark, tmp_path, 1, most_errors=2, retries=1, backoff=10_000)] == [("b", 0, "processed")]  # a waits
    lay(spark, tmp_path, [("a", 2, "z")], "two")
    got = run(spark, tmp_path, 4, most_errors=2, retries=1, backoff=10_000)
    assert [r[:3] for r in got] == [("a", 0, "error"), ("a", 1, "processed"), ("a", 2, "processed"), ("b", 0, "processed")]
