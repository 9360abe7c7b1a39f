"""Semantics of single operators on small literals."""

from __future__ import annotations

import fractions
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from archivolt.functions import scalars as S
from archivolt.operators import enrich, graph, lines, ranking, records, review, scoring, sinks, versions
from archivolt.operators import keywords as K
from archivolt.operators import vocabulary as V
from archivolt.sources import records as R
from archivolt.sources import text_files as X
from archivolt.sources import trees


def one(df):
    return df.collect()[0]


def test_top_lemmas_are_chosen_before_the_penalty(spark):
    rows = [(1, i, w) for i, w in enumerate(["rok"] * 5 + ["dům"] * 3 + ["les"] * 2 + ["pes"])]
    df = spark.createDataFrame(rows, "doc_id int, pos int, word string")
    got = [(r.rank, r.keyword, r.score) for r in K.weighted_top_lemmas(df, 1).orderBy("rank").collect()]
    assert got == [(1, "dům", 3.0)]
    got = [r.keyword for r in K.weighted_top_lemmas(df, 2, penalty=1.0).orderBy("rank").collect()]
    assert got == ["rok", "dům"]


@pytest.mark.parametrize(("n", "sizes"), [(0, []), (1, [1]), (400, [400]), (401, [400, 51]), (720, [400, 370, 20])])
def test_word_chunks(spark, n, sizes):
    df = spark.createDataFrame([(" ".join(["w"] * n),)], "t string")
    got = one(df.select(F.transform(K.word_chunks(S.words_of(F.col("t"))), lambda c: F.size(c)).alias("c"))).c
    assert got == sizes


@pytest.mark.parametrize(
    ("text", "categ", "quality", "keep", "reason"),
    [
        ("", "Clear", 0.9, False, "empty"),
        ("some text", "Empty", 0.5, True, ""),  # the band overrides the category
        ("some text", "Clear", 0.1, False, "categ:Trash"),
        ("some text", "Trash", 0.5, False, "categ:Trash"),
        ("12345678 9", "Non-text", None, False, "non_text_letters"),
        ("abcd", "Non-text", None, False, "non_text_short"),
        ("ab", "", None, False, "short"),
        ("ab c", None, None, True, ""),
    ],
)
def test_line_decision(spark, text, categ, quality, keep, reason):
    df = spark.createDataFrame([(text, categ, quality)], "t string, c string, q double")
    got = one(df.select(lines.line_decision(F.col("t"), F.col("c"), F.col("q")).alias("d"))).d
    assert (got.keep, got.reason) == (keep, reason)


def test_norm_label_folds_beyond_lower(spark):
    df = spark.createDataFrame([("Straße\xa0 X",), ("éA",), (None,)], "t string")
    assert [r[0] for r in df.select(S.norm_label("t")).collect()] == ["strasse x", "éa", ""]


def test_czech_order(spark):
    words = ["chata", "cihla", "Čáp", "č", "hrad", "ibis", "dům", "duma"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r.w for r in df.withColumn("k", S.czech_order("w")).orderBy("k").collect()]
    assert got == ["cihla", "č", "Čáp", "dům", "duma", "hrad", "chata", "ibis"]


def test_similarity_is_symmetric_and_exact_test_is_bounded(spark):
    assert S.similarity("old church", "church old") == S.similarity("church old", "old church") == 1.0
    df = spark.createDataFrame([(0, 0), (5, 0), (1, 9)], "b int, c int")
    got = [r[0] for r in df.select(S.mcnemar_exact("b", "c")).collect()]
    assert got[0] == 1.0 and math.isclose(got[1], 2 / 32) and math.isclose(got[2], 2 * 11 / 1024)


def test_binomial_tails_are_exact_at_any_size(spark):
    r = random.Random(2)
    pairs = [(b, c) for b in range(0, 26) for c in range(0, 26, 3)] + [(r.randrange(0, 2000), r.randrange(0, 2000)) for _ in range(60)]
    pairs += [(k, n - k) for n in (1000, 5001) for k in (0, 1, n // 2 - 40, n // 2 - 1, n // 2)]
    got = spark.createDataFrame([*pairs, (None, 3)], "b long, c long").select("b", "c", S.mcnemar_exact("b", "c").alias("p")).collect()
    for x in got[:-1]:
        n, k = x.b + x.c, min(x.b, x.c)
        want = min(1.0, float(fractions.Fraction(2 * sum(math.comb(n, i) for i in range(k + 1)), 2**n))) if n else 1.0
        assert math.isclose(x.p, want, rel_tol=1e-10), (x.b, x.c, x.p, want)
    assert got[-1].p is None
    large = spark.range(20_000).selectExpr("1000000000L + id as b", "1000060000L as c").select(S.mcnemar_exact("b", "c").alias("p"))
    begin = time.perf_counter()
    p = [x.p for x in large.collect()]
    assert time.perf_counter() - begin < 30 and all(0 < a < b < 1 for a, b in zip(p, p[1:], strict=False))
    z = 59999.0 / math.sqrt(2_000_060_000)  # continuity corrected
    assert math.isclose(p[0], math.erfc(z / math.sqrt(2)), rel_tol=1e-4)


def test_contexts_of_split_documents(spark):
    """One document of all lines over many ranges, parts shorter than a frame, repeated headings, noise at the edges."""
    r = random.Random(7)
    rows = [("long", i, r.choice(["1", "2", None]), i % 9, r.choice(["text", "", None, " x "]) and f"t{i}", r.choice(["Clear", "Trash", "Header", None, "Empty"])) for i in range(150)]
    rows += [(d, i, "1", i, f"{d}{i}", r.choice(["Clear", "Trash", "Heading"])) for d in ("a", "b", "z") for i in range(r.randrange(1, 5))]
    rows += [(None, 1, "1", 1, "null document", "Clear")]
    df = spark.createDataFrame(rows, "doc_id string, pos long, page string, line int, text string, categ string")
    for window in (1, 2, 4):
        want = sorted(map(str, lines.context_windows(df.where("doc_id is not null"), window).collect()))
        for n in (1, 7, 60):
            assert sorted(map(str, lines.context_windows_split(df.where("doc_id is not null"), window, n).collect())) == want
    assert lines.context_windows_split(df.where("false")).count() == 0
    spread = lines.context_windows_split(df.where("doc_id = 'long'"), 2, 10)
    assert spread.count() == 150


def test_document_ids_and_keys(spark):
    df = spark.createDataFrame([("a/CTX1.alto.xml",), ("b.c.conllu",), ("x.odd.thing",)], "p string")
    assert [r[0] for r in df.select(S.doc_id_of(F.col("p"))).collect()] == ["CTX1", "b.c", "x"]
    df = spark.createDataFrame([(1.0,), (1.5,), (None,)], "v double")
    assert [r[0] for r in df.select(S.key_text(F.col("v"), "double")).collect()] == ["1", "1.5", "null"]


def test_upsert_patches_the_last_of_equal_keys_and_nulls_overwrite(spark):
    base = spark.createDataFrame([(1, "a", "x", 1), (1, "a", "y", 2), (2, "b", "z", 3)], "page int, line string, v string, pos int")
    patch = spark.createDataFrame([("1", "a", None, 1), ("3", "c", "new", 2)], "page string, line string, v string, pos int")
    patch = patch.withColumn("page", F.col("page").cast("double"))
    got = {(r.page, r.line, r.v) for r in records.upsert(base.withColumn("page", F.col("page").cast("double")), patch, ["page", "line"], ["v"]).collect()}
    assert got == {(1.0, "a", "x"), (1.0, "a", None), (2.0, "b", "z"), (3.0, "c", "new")}
    assert records.refused_fields(patch, ["v"], ["page", "line"]) == ["pos"]


def test_calibration(spark):
    df = spark.createDataFrame([(0.0, False), (0.05, True), (1.0, True)], "confidence double, correct boolean")
    assert math.isclose(one(scoring.expected_calibration_error(df)).ece, (abs(1 - 0.05) + 0) / 3)
    curve = [tuple(r) for r in scoring.coverage_curve(df).orderBy(F.desc("threshold")).collect()]
    assert curve == [(1.0, 1 / 3, 0.0), (0.05, 2 / 3, 0.0), (0.0, 1.0, 1 / 3)]
    assert one(scoring.pick_threshold(scoring.coverage_curve(df), 0.0)).threshold == 0.05
    assert scoring.pick_threshold(scoring.coverage_curve(df.where("not correct")), 0.0).count() == 0
    with pytest.raises(ValueError, match="exceed"):
        S.lane(F.lit(0.5), 0.2, 0.4)


def test_cycles_are_broken_and_levels_found(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 3), (6, 5)], "child int, parent int")
    nodes = spark.createDataFrame([(i,) for i in range(1, 7)], "id int")
    cut = graph.break_cycles(edges)
    assert {tuple(r) for r in cut.collect()} == {(2, 3), (3, 1), (4, 3), (6, 5)}
    levels = {r.id: (r.root, r.level) for r in graph.roots_of(nodes, cut).collect()}
    assert levels == {1: (1, 0), 3: (1, 1), 2: (1, 2), 4: (1, 2), 5: (5, 0), 6: (5, 1)}
    assert {r.id for r in graph.withheld(nodes, cut, nodes.where("id = 3")).collect()} == {2, 3, 4}
    stats = one(graph.tree_stats(nodes, cut))
    assert (stats.nodes, stats.roots, stats.deepest, stats.inner_nodes, stats.widest) == (6, 2, 2, 3, 2)


@pytest.mark.parametrize("rising", [True, False])
def test_long_chains_and_cycles(spark, rising):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) if rising else (i + 1, i) for i in range(n)], "child long, parent long")
    assert graph.break_cycles(edges).count() == n
    nodes = spark.range(n + 1)
    levels = {r.id: (r.root, r.level) for r in graph.roots_of(nodes, edges).collect()}
    assert levels == {i: ((n, n - i) if rising else (0, i)) for i in range(n + 1)}
    below = graph.withheld(nodes, edges, nodes.where("id = 100"))
    assert {r.id for r in below.collect()} == (set(range(101)) if rising else set(range(100, n + 1)))
    step = 1 if rising else n - 1
    ring = spark.createDataFrame([(i, (i + step) % n) for i in range(n)] + [(n + 5, 7)], "child long, parent long")
    cut = graph.break_cycles(ring)
    assert cut.count() == n and cut.where("child = 0").count() == 0
    assert graph.roots_of(spark.range(n), cut.where(f"child < {n}")).where("level >= 0 and root = 0").count() == n
    with pytest.raises(ValueError, match="cycle"):
        graph.roots_of(spark.range(n), ring.where(f"child < {n}"))


def test_limits_and_notes_refuse(spark):
    from archivolt.operators import validation

    specs = "`limit` string, env string, legacy string, divisor double, config string, fallback double, least double, zero_is_unlimited boolean"
    assert one(validation.resolved_limits(spark.createDataFrame([("a", "", "", 1.0, "7", 3.0, 0.0, False)], specs))).value == 7.0
    for bad in ("x", "-1"):
        with pytest.raises(Exception, match="invalid limit a"):
            validation.resolved_limits(spark.createDataFrame([("a", bad, None, 1.0, None, 3.0, 0.0, False)], specs)).collect()
    over = spark.createDataFrame([("doc", "a", 9.0, 7.0)], "subject string, `limit` string, observed double, value double")
    with pytest.raises(ValueError, match="over 7"):
        validation.refuse(over)
    validation.refuse(over.where("false"))
    notes = spark.createDataFrame([("a", "sampled"), ("b", "truncated")], "`limit` string, effect string")
    with pytest.raises(ValueError, match="b: truncated"):
        validation.failing_notes(notes)
    validation.failing_notes(notes.where("effect = 'sampled'"))
    assert one(spark.createDataFrame([("score", ["x", "y"])], "k string, c array<string>").select(validation.options_of(F.col("k"), F.col("c"))))[0] == ["0", "1"]


def test_tables_are_replaced_as_a_whole(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    for n in (3, 5):
        versions.replace_table(spark.range(n), path)
        assert versions.read(spark, path).count() == n
    assert R.load_vocabulary(spark, path).count() == 5
    with pytest.raises(FileNotFoundError, match="build"):
        R.load_vocabulary(spark, f"file://{tmp_path}/none")
    (tmp_path / "v.meta.json").write_text('{"terms": 3, "built": "today"}')
    assert {tuple(r) for r in R.vocabulary_metadata(spark, f"file://{tmp_path}/v").collect()} == {("terms", "3"), ("built", "today")}


def test_newer_logs_and_odd_templates_raise(spark):
    logs = "schema_version string, statistics struct<processed:long,skipped:long>, processed long, skipped long, license string, components array<string>, limits_applied array<string>, limits array<string>, action_status string"
    with pytest.raises(Exception, match="newer version 4.0"):
        records.migrated_logs(spark.createDataFrame([("4.0", None, 1, 1, None, None, None, None, None)], logs)).collect()
    blocks = spark.createDataFrame([(1, "role", "r", True, None, None), (2, "odd", "o", False, None, None)], "place int, name string, text string, required boolean, flag string, value string")
    flags = spark.createDataFrame([("F", "1")], "flag string, value string")
    with pytest.raises(Exception, match="no flag for block odd"):
        sinks.template_blocks(blocks, flags, "role").collect()
    with pytest.raises(ValueError, match="must render"):
        sinks.template_blocks(blocks.where("place = 1"), flags, "terms")


def test_deep_trees_and_page_breaks():
    deep = trees.parse_xml("<a>" * 3000 + "<p>x</p>" + "</a>" * 3000)
    assert [r[2] for r in trees.xml_rows(deep)] == ["x"]
    root = trees.parse_xml('<TEI><text><s><tok>A</tok> <tok>b</tok></s><lb/><s><tok>c</tok><pb n="iv"/><tok>d</tok></s><pb n="9"/><lb/><s text="E e"/></text></TEI>')
    assert list(trees.xml_rows(root)) == [("1", 1, "A b", 1), ("1", 2, "c", 1), ("1", 1, "d", 2), ("9", 1, "E e", 3)]
    blocks = trees.parse_xml("<TEI><teiHeader><p>no</p></teiHeader><text><p>one <l>two</l></p><head>three</head></text></TEI>")
    assert [r[2] for r in trees.xml_rows(blocks)] == ["two", "three"]


def test_taxonomy_and_empty_records(spark, tmp_path):
    text = """{"_settings": {"heslar_map": {"a": "Sites", "b": "__exclude__"}, "teater_branch_map": {"7": "Finds"}, "heslar_labels": {"a": "A"},
      "tie_break": ["Sites", "Finds"], "geo_guardrail": {"active": true, "covers": ["heslar:b"]}},
      "_exclusions": {"teater 7": {"status": "decided", "reason": "r"}, "_note": {}}, "Sites": {"priority": 3, "in_prompt": false}, "Finds": {}}"""
    (tmp_path / "c.json").write_text(text)
    got = R.taxonomy(spark, f"file://{tmp_path}/c.json")
    rows = {k: sorted(tuple(r) for r in df.collect()) for k, df in got.items()}
    assert rows == {
        "themes": [("Finds", 0, None), ("Sites", 3, False)], "maps": [("heslar:a", "Sites"), ("heslar:b", "__exclude__"), ("teater:7", "Finds")],
        "labels": [("heslar:a", "A")], "notes": [("teater:7", "decided", "r")], "covers": [("heslar:b",)], "tie_break": [(0, "Sites"), (1, "Finds")],
    }
    frame = spark.createDataFrame([("x", [], (" ",)), ("y", [("1",)], None), ("z", None, ("t",)), ("w", None, None)], "doc_id string, lines array<struct<text:string>>, content struct<text:string>")
    assert sorted(r.doc_id for r in R.empty_records(frame).collect()) == ["w", "x"]


def test_folded_runs_have_all_components(spark):
    logs = "run string, processed long, skipped long, start int, `end` int, stage string, failed boolean, components array<string>"
    got = one(records.fold_runs(spark.createDataFrame([("r", 1, 0, 1, 2, "a", False, ["x", "y"]), ("r", 2, 1, 2, 5, "b", True, ["y", "z"])], logs), "run"))
    assert (got.processed, got.first_stage, got.last_stage, got.any_failed, list(got.components)) == (3, "a", "b", True, ["x", "y", "z"])


def test_parents(spark):
    terms = spark.createDataFrame([(1, "f", [("t", "10")]), (2, "f", [("t", "20"), ("a", "7")]), (3, "f", [("a", "8")])], "pos int, theme string, ids array<struct<source:string,id:string>>")
    near = spark.createDataFrame([("f", "20", "10")], "theme string, id string, ancestor string")
    broader = spark.createDataFrame([("7", 0, "8"), ("8", 0, "8"), ("8", 1, "20")], "id string, at int, ancestor string")
    got = {(r.child, r.parent, r.via, r.conflict) for r in graph.choose_parents(terms, near, broader).collect()}
    assert got == {(2, 1, "nearest", True), (3, 2, "broader", False)}


def test_qualified_records_and_rescue(spark):
    rows = [("a", "A", "s", "1"), ("b", "B", "s", "2")]
    r = spark.createDataFrame(rows, "cs string, en string, source string, source_id string")
    q = spark.createDataFrame([("s", "2", "old")], "source string, id string, qualifier string")
    flagged, plain = V.split_qualified(r, q)
    assert one(flagged).cs == "b (old)" and one(flagged).bare_cs == "b" and one(plain).cs == "a"
    placed = r.withColumns({"theme": F.lit("Other"), "placed_by": F.lit("other")})
    look = spark.createDataFrame([("a", "T")], "norm string, theme string")
    assert {(x.cs, x.theme) for x in V.rescue(placed, look).collect()} == {("a", "T"), ("b", "Other")}


def test_enrichment_gives_up_and_repairs(spark):
    df = spark.createDataFrame([(1, i, "bad" if i in (1, 2) else "ok") for i in range(5)], "doc_id long, pos long, prompt string")

    def reply(p):
        if p == "bad":
            raise ValueError("x")
        return p

    got = [r.status for r in enrich.enrich_in_order(df, reply, max_consecutive_errors=2).orderBy("pos").collect()]
    assert got == ["processed", "error", "error", "unprocessed", "unprocessed"]
    text = '[{"category": " Hrad (x)", "page": 2.0, "keywords": "a; b", "confidence_score": "1.5"}, {"category": "none"}, 3]'
    rows = enrich.repair_replies(spark.createDataFrame([(1, text), (2, "{"), (3, '{"items": [{}]}')], "doc_id long, reply string"), ["hrad"]).orderBy("doc_id", "at").collect()
    assert (rows[0].page, rows[0].category, rows[0].keywords, rows[0].confidence, rows[0].problem) == ("2", "hrad", ["a", "b"], 1.0, None)
    assert [r.problem for r in rows] == [None, "unknown category", "not an object", "no JSON", "none survived", "unknown category"]


def test_readers(spark, tmp_path):
    (tmp_path / "a.conllu").write_text("# c\n1\tHrady\thrad\tNOUN\t_\t_\t_\t_\t_\tSpaceAfter=No\n1-2\tx\tx\tX\t_\t_\t_\t_\t_\t_\n2\t.\t.\tPUNCT\t_\t_\t_\t_\t_\t_\n\n1\tDva\tdva\tNUM\t_\t_\t_\t_\t_\t_\n")
    files = X.whole_files(spark, f"{tmp_path}/a.conllu")
    tokens = X.conllu_tokens(files)
    assert [r.form for r in tokens.orderBy("pos").collect()] == ["Hrady", ".", "Dva"]
    assert [r.text for r in X.surface_sentences(tokens).orderBy("sent").collect()] == ["Hrady.", "Dva"]
    assert [r.word for r in X.keyword_lemmas(tokens).collect()] == ["hrad"]
    assert one(files.select(X.input_kind(F.col("path"), F.col("text")))) [0] == "conllu"
    (tmp_path / "b.txt").write_text(" one\n\ntwo\n\fthree")
    got = [(r.page, r.line, r.text) for r in X.text_lines(X.whole_files(spark, f"{tmp_path}/b.txt")).orderBy("pos").collect()]
    assert got == [("1", 1, "one"), ("1", 2, "two"), ("2", 1, "three")]
    (tmp_path / "c.csv").write_text("text,page_num,quality_score\nhi,,0.5\nyo,3,x\n")
    got = [(r.page, r.text, r.quality_score) for r in X.line_table(spark, f"{tmp_path}/c.csv").orderBy("pos").collect()]
    assert got == [("1", "hi", 0.5), ("3", "yo", None)]
    (tmp_path / "d.json").write_text('{"doc_id": "d", "lines": [{"text": "t", "line": 1}, {"text": "u", "categ": "Trash"}], "content": {"text": "z"}}')
    (tmp_path / "e.json").write_text('{"doc_id": "e", "content": {"text": "only\\nthis"}}')
    got = {(r.doc_id, r.page, r.text) for r in R.record_lines(R.records(spark, f"{tmp_path}/[de].json")).collect()}
    assert got == {("d", "1", "t"), ("e", "1", "only"), ("e", "1", "this")}


def test_trees():
    root = trees.parse_xml('<TEI><text><pb n="5"/><s>Old <tok>church</tok> <tok>here</tok></s><pb/><s>New</s></text></TEI>')
    assert [(p, t) for p, _, t, _ in trees.xml_rows(root)] == [("5", "Old church here"), ("6", "New")]
    with pytest.raises(ValueError, match="refused"):
        trees.parse_xml('<!DOCTYPE a [<!ENTITY x "y">]><a>&x;</a>')
    flat = list(trees.flatten_tree({"id": 1, "cz": "a", "children": [{"id": 2, "cs": "b", "children": [{"id": 3, "cs": "c"}, {"id": 2, "cs": "again"}]}]}))
    assert [(i, c, a, s) for i, c, _, a, s in flat] == [("1", "a", [], ""), ("2", "b", ["1"], "b"), ("3", "c", ["1", "2"], "b")]


def test_statistical_keywords_prefer_repeated_terms():
    text = "The stone church stood in Praha. The stone church was old. People saw the stone church often, but a dog ran away."
    found = [k.lower() for k, _ in ranking.statistical_keywords(text, 5)]
    assert any("stone church" in k for k in found) and ranking.statistical_keywords("", 5) == []


def test_drift_and_markdown(spark):
    a = spark.createDataFrame([(1, "x", "t1"), (2, "y", "t1")], "i int, v string, stamp string")
    b = spark.createDataFrame([(1, "x", "t2"), (2, "z", "t2")], "i int, v string, stamp string")
    assert {(r.v, r.side) for r in sinks.drift(a, b, ["stamp"]).collect()} == {("y", "now"), ("z", "stored")}
    assert sinks.drift(a, a.withColumn("stamp", F.lit("q")), ["stamp"]).isEmpty()
    assert sinks.markdown_table(a.where("i = 1"), ["i", "v"]).splitlines()[-1] == "| 1 | x |"


def test_order_of_rows_does_not_matter(spark):
    rows = [(f"l{i % 7}", "E", f"s{i % 3}", str(i)) for i in range(60)]
    want = None
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "cs string, en string, source string, source_id string").repartition(3 + seed)
        got = sorted((r.cs, r.source_id, tuple(d.id for d in r.discarded)) for r in V.label_winners(df).collect())
        assert want is None or got == want
        want = got


def test_collision_verdict_compares_with_the_first_set(spark):
    rows = [("a", "x", "s", "1", ["u"]), ("a", "y", "s", "2", ["u", "v"]), ("a", "z", "s", "3", ["v"])]
    df = spark.createDataFrame(rows, "cs string, en string, source string, source_id string, exact_match array<string>")
    assert one(review.collisions(df)).verdict == "conflicting"


def test_stream(spark, tmp_path):
    from archivolt.streaming.files import stream_files

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"doc_id": 1, "pos": 0, "word": "hrad"}\n')
    q = stream_files(spark, f"{tmp_path}/in", "doc_id int, pos int, word string", K.weighted_top_lemmas, f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination(60)
    assert one(spark.read.parquet(f"{tmp_path}/out")).keyword == "hrad"


def test_placement_takes_the_first_rule_however_many(spark, monkeypatch):
    """An automaton and a join by pieces give the same keywords; both equal a plain search."""
    from archivolt.operators import placement

    r = random.Random(3)
    stems = ["kostel", "hrad", "mince", "Óš", "a", "", "ringy", "ring", "hra", "rád", "ěž"]
    words = [(lang, w, f"T{i % 5}", i // 2) for i, (lang, w) in enumerate((lang, w) for w in r.sample(stems, len(stems)) for lang in ("cs", "en") if w or lang == "en")]
    words = [w for w in words if w[1]] + [("en", "zz", None, -1), ("cs", None, "X", -2)]
    maps = [("branch", "b1", "B1"), ("branch", "b2", "B2"), ("branch", "r7", "Own"), ("list", "s1", "L1"), ("branch", "b2", "A2"), ("list", "s2", None)]
    over = [("x", "r3", "O3"), ("x", "r3", "N3"), ("y", "r3", "no")]
    rows = []
    for i in range(60):
        broader = r.choice([None, [], ["b1"], ["b1", "b2"], ["b2", "b1"], ["q", "b1", "q2"], ["q"]])
        rows.append((r.choice(["", None, "Hradní KOSTEL", "string", "ÓŠ", "nic"]), r.choice([None, "", "Ring of zz", "coin", "MINCE"]), "x", f"r{i}", r.choice(["s1", "s2", None, "s3"]), broader))
    rows.append(rows[3])

    def want(cs, en, source, sid, scheme, broader):
        themes = sorted(t for s, i, t in over if (s, i) == (source, sid))
        if themes:
            return themes[0], f"override:{source}:{sid}"
        by = lambda kind, ident: min((t for k, i, t in maps if k == kind and i == ident and t), default=None)
        if by("list", scheme):
            return by("list", scheme), f"list:{scheme}"
        for node in [sid, *reversed(broader or [])]:
            if by("branch", node):
                return by("branch", node), f"branch:{node}"
        for rank, lang, w, t in sorted((rank, lang, w, t) for lang, w, t, rank in words if w is not None and t):
            if w.lower() in ((cs if lang == "cs" else en) or "").lower():
                return t, f"keyword:{lang}:{w}"
        return "Other", "other"

    words = [w for w in words if w[2]]
    frames = (
        spark.createDataFrame(rows, "cs string, en string, source string, source_id string, scheme string, broader array<string>"),
        spark.createDataFrame(over, "source string, source_id string, theme string"),
        spark.createDataFrame(maps, "kind string, ident string, theme string"),
    )
    for most in (placement.KEYWORD_BYTES, 0):
        monkeypatch.setattr(placement, "KEYWORD_BYTES", most)
        got = placement.place(*frames, spark.createDataFrame(words, "lang string, keyword string, theme string, rank int")).collect()
        assert sorted((tuple(x) for x in got), key=str) == sorted(((*x, *want(*x)) for x in rows), key=str)
    monkeypatch.undo()
    seconds = []
    for n in (100, 100, 50_000):
        many = spark.createDataFrame([("en", f"kw{i:06d}q", "T", i) for i in range(n)], "lang string, keyword string, theme string, rank int")
        maps_ = spark.createDataFrame([("branch", f"n{i}", f"T{i % 9}") for i in range(n)], "kind string, ident string, theme string")
        terms = spark.range(20_000).selectExpr("'a' as cs", "concat('some kw', lpad(cast(id % 90 as string), 6, '0'), 'q here') as en", "'x' as source", "cast(id as string) as source_id", "'s' as scheme", "array('n1', 'm2') as broader")
        begin = time.perf_counter()
        assert placement.place(terms, frames[1], maps_, many).where("theme = 'Other'").count() == 0
        seconds.append(time.perf_counter() - begin)
    assert seconds[2] < 5 * seconds[1] + 5
