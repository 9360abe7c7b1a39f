"""Versioned tables, harvests and walks: crashes, two writers, pages that fail, trees of odd shape."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from archivolt.operators import versions, walk
from archivolt.sources import harvest


def test_a_crash_at_any_step_leaves_the_last_version(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    assert versions.replace_table(spark.range(3), path) == 1

    def crash(*_):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):  # before the data are made
        versions.commit(spark, path, crash)
    monkeypatch.setattr(versions, "_put", crash)  # between data and version
    with pytest.raises(KeyboardInterrupt):
        versions.replace_table(spark.range(9), path)
    monkeypatch.undo()
    monkeypatch.setattr(versions.os, "link", crash)  # at the put itself
    with pytest.raises(KeyboardInterrupt):
        versions.replace_table(spark.range(9), path)
    monkeypatch.undo()
    assert versions.numbers(spark, path) == [1] and versions.read(spark, path).count() == 3
    assert versions.replace_table(spark.range(4), path) == 2
    assert len(versions.vacuum(spark, path, older_than=-60)) == 2  # of the two crashes that had written
    assert [versions.read(spark, path, n).count() for n in (1, 2)] == [3, 4] and versions.read(spark, path).count() == 4
    versions.replace_table(spark.range(5), path)
    assert len(versions.vacuum(spark, path, keep=1, older_than=-60)) == 2 and versions.numbers(spark, path) == [3]
    assert versions.vacuum(spark, path) == [] and versions.read(spark, path).count() == 5
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path, 1)


def test_two_writers_lose_nothing(spark, tmp_path):
    path, both, errors = f"file://{tmp_path}/t", threading.Barrier(2), []
    versions.replace_table(spark.range(0), path)

    def write(lot):
        try:
            met = []

            def more(t):
                if not met:
                    met.append(both.wait(60))  # both have read the same version
                return t.union(spark.range(lot, lot + 5))

            versions.commit(spark, path, more, note=str(lot))
        except Exception as problem:
            errors.append(problem)

    writers = [threading.Thread(target=write, args=(lot,)) for lot in (100, 200)]
    for w in writers:
        w.start()
    for w in writers:
        w.join(120)
    assert not errors and versions.numbers(spark, path) == [1, 2, 3]
    assert sorted(r.id for r in versions.read(spark, path).collect()) == [*range(100, 105), *range(200, 205)]
    assert {n for _, n in versions.history(spark, path)} == {"", "100", "200"} and len(list((tmp_path / "t/data").iterdir())) == 3
    assert not [p for p in (tmp_path / "t/versions").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]

    def always_late(t):
        versions.replace_table(spark.range(1), path)
        return spark.range(2)

    with pytest.raises(versions.Conflict):
        versions.commit(spark, path, always_late, retries=1)


def test_differences_of_versions(spark):
    rows = lambda *x: spark.createDataFrame(list(x), "id string, a int, b string")
    old, new = rows(("1", 1, "x"), ("2", None, "x"), ("3", 3, None), ("3", 3, None), ("4", 4, "y")), rows(("1", 1, "x"), ("2", 2, "x"), ("3", 3, None), ("5", 5, "z"))
    got = lambda **how: sorted(map(tuple, versions.differences(old, new, "id", **how).collect()))
    assert got() == [("2", "changed"), ("4", "gone"), ("5", "added")] and got(whole=False) == [("2", "changed"), ("5", "added")]
    assert sorted(map(tuple, versions.differences(None, new, "id").collect())) == [(i, "added") for i in "1235"]


def save(folder, token, records, following=""):
    at = folder / f"request={harvest._ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', token)}"
    at.mkdir(parents=True)
    body = "".join(f"<record><identifier>{i}</identifier><heslo>{cs}</heslo></record>" for i, cs in records)
    (at / "part-0.txt").write_text(f"<OAI>{body}<resumptionToken>{following}</resumptionToken></OAI>")


def test_a_harvest_goes_on_where_it_stopped(spark, tmp_path):
    pages = tmp_path / "pages"
    save(pages, "first", [("a", "one"), ("b", "two")], "t/2")
    save(pages, "t/2", [("b", "late"), ("", "none"), ("c", "three")], "t3")
    rows = harvest.harvest_stream(spark, str(pages), f"file://{tmp_path}/h")  # the third page is missing
    assert {(r.id, r.cs) for r in harvest.kept_first(rows).collect()} == {("a", "one"), ("b", "two"), ("c", "three")}
    assert [(r.page, r.request) for r in rows.where("problem is not null").collect()] == [(2, "t3")]
    save(pages, "t3", [("d", "four")])
    again = harvest.harvest_stream(spark, str(pages), f"file://{tmp_path}/h")
    assert again.count() == rows.count()  # a failed page isn't asked for again by itself
    whole = harvest.harvest_stream(spark, str(pages), f"file://{tmp_path}/h", retry=True)
    assert {r.id for r in harvest.kept_first(whole).collect()} == set("abcd") and whole.where("problem is null").count() == 6
    batch = spark.read.format("label_harvest").option("pages", str(pages)).load()
    assert sorted((r.page, r.pos, r.id) for r in batch.collect()) == sorted((r.page, r.pos, r.id) for r in whole.where("problem is null").collect())
    assert batch.where("problem is not null").count() == 0


def test_a_harvest_in_a_circle_ends(spark, tmp_path):
    for i in range(5):
        save(tmp_path / "pages", "first" if i == 0 else f"t{i}", [(f"r{i}", "x")], f"t{i + 1}" if i < 4 else "t2")
    for rows in (harvest.harvest_stream(spark, str(tmp_path / "pages"), f"file://{tmp_path}/h"), spark.read.format("label_harvest").option("pages", str(tmp_path / "pages")).load()):
        assert {r.id for r in harvest.kept_first(rows).collect()} == {f"r{i}" for i in range(5)}
        assert [r.problem for r in rows.where("problem is not null").collect()] == ["the token came again"]


def test_a_harvest_that_broke_off_takes_nothing_away(spark, tmp_path):
    path = f"file://{tmp_path}/labels"
    save(tmp_path / "one", "first", [("a", "one"), ("b", "two")])
    save(tmp_path / "two", "first", [("b", "new")], "lost")
    with pytest.raises(FileNotFoundError):
        harvest.load_or_sync(spark, path, str(tmp_path / "one"), f"file://{tmp_path}/h0", sync=False)
    harvest.load_or_sync(spark, path, str(tmp_path / "one"), f"file://{tmp_path}/h1", sync=True)
    table, changes = harvest.load_or_sync(spark, path, str(tmp_path / "two"), f"file://{tmp_path}/h2", sync=True)
    assert {(r.id, r.cs) for r in table.collect()} == {("a", "one"), ("b", "new")} and [tuple(r) for r in changes.collect()] == [("b", "changed")]
    assert versions.history(spark, path) == [(1, "whole"), (2, "broken off")]
    same, none = harvest.load_or_sync(spark, path, "", "", sync=False)
    assert same.count() == 2 and none.count() == 0


def walked(spark, terms, edges, **how):
    terms = spark.createDataFrame(terms, "id long, w long")
    children = spark.createDataFrame(edges, "parent string, child string, rank int, num long")
    found = walk.walk(terms, children, F.lit("all"), F.col("w") * F.col("num") % 10, least=F.lit(4), accept=F.lit(7), **how)
    return {r.id: (r.node, r.questions) for r in found.collect()}


def test_a_walk_keeps_no_answers_that_it_never_needs(spark, monkeypatch):
    cut, kept = walk.cut, []

    def measured(df):
        out = cut(df)
        if "path" in out.columns:
            kept.append(out.select(F.max(F.coalesce(F.size(F.flatten(F.transform("path", lambda x: F.coalesce(x["offers"], F.slice(x["offers"], 1, 0))))), F.lit(0)))).first()[0] or 0)
        return out

    monkeypatch.setattr(walk, "cut", measured)
    edges = [("all", "a", 1, 5), ("all", "b", 2, 6)] + [(p, f"{p}{i}", i, i % 10) for p in "ab" for i in range(1, 301)]
    # b (6) is better than a (5); of b's leaves at 9 the first is b9; those at 4 to 6 fit, but none of them is entered
    assert walked(spark, [(i, 1) for i in range(5)], edges) == {i: ("b9", 302) for i in range(5)}
    assert max(kept) <= 4  # terms times options before
    low = [(p, c, r, min(n, 6)) for p, c, r, n in edges]
    assert walked(spark, [(1, 1)], low, most_steps=8) == {1: (None, 602)}  # a step for each leaf before


def test_walks_stop_go_back_and_end(spark):
    edges = [("all", "a", 1, 6), ("all", "b", 2, 5), ("all", "c", 3, 6), ("a", "a1", 1, 2), ("a", "a2", 2, 4), ("b", "b1", 1, 8), ("c", "c1", 1, 9), ("c1", "c2", 1, None)]
    # 1: a (6, as c, but first) has only a2 at 4, too low to stop; then c, c1 at 9, which stops as c2 has no answer
    got = walked(spark, [(1, 1), (2, 0), (None, 1), (3, None)], edges)
    assert got == {1: ("c1", 3 + 2 + 1 + 1), 2: (None, 3), None: (None, None), 3: (None, 3)}
    assert walked(spark, [(1, 1)], edges, most_options=1) == {1: ("c1", 7)}
    assert walked(spark, [], edges) == {} and walked(spark, [(1, 1)], []) == {1: (None, 0)}
    with pytest.raises(ValueError, match="still walk"):
        walked(spark, [(1, 1)], edges, most_steps=2)
