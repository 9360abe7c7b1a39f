"""Queries of validation, projection, migration, registry and hierarchy operators over the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.functions import scalars as S
from archivolt.operators import graph, records, review, scoring, sinks, validation
from archivolt.plans import scoring_plans, vocabulary_plans
from archivolt.sources import records as R


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- records


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records, with every kind of fault at some of them."""
    d, n = _t(spark, sf_dir, "documents"), F.col("n_chars")
    digest = F.when(n % 13 == 0, "bad").when(n % 17 > 0, F.sha2(F.coalesce("text", F.lit("")), 512))
    empty = n % 11 == 0
    page = F.struct(
        F.lit("1").alias("page"), (n % 23).cast("int").alias("page_index"), F.when(empty, "empty").otherwise("text").alias("content_status"),
        F.when(~empty | (n % 2 == 0), (n % 103) / 100.0).alias("quality_score"),
    )
    line = F.struct(F.lit("1").alias("page"), F.lit(1).alias("line"), F.lit(0.5).cast("double").alias("quality_score"))
    source = F.struct(digest.alias("sha512"), F.lit("a.txt").alias("filename"), F.lit("text/plain").alias("media_type"), F.lit(None).cast("string").alias("origin"))
    return d.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.when(n % 7 == 0, "1.0").otherwise("2.1").alias("schema_version"), F.when(n % 19 == 0, "page").alias("record_type"),
        source.alias("source"), F.array(page).alias("pages"), F.array(line).alias("lines"), n.alias("n_chars"),
    )


def record_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first problem of every record, and what becomes of it beside a baseline with problems of its own."""
    r = _records(spark, sf_dir)
    references = r.select("doc_id", F.lit("1").alias("page"), F.when(F.col("n_chars") % 5 == 0, (F.col("n_chars") % 2 + 1).cast("int")).alias("line"))
    found = validation.record_problems(r, references)
    baseline = r.select("doc_id", F.when(F.col("n_chars") % 7 == 0, "schema_version").alias("problem"))
    return validation.gated(found, baseline).join(found.select("doc_id", "problems"), "doc_id")


def seed_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as seeds, which may have no blocks."""
    bare = _records(spark, sf_dir).withColumns({"pages": F.when(F.col("n_chars") % 3 == 0, F.col("pages")), "lines": F.lit(None).cast("array<struct<page:string,line:int,quality_score:double>>")})
    return validation.record_problems(bare, seed=True)


def projected_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as results of their orders: lines that no order has are unknown, pages are cited."""
    results = _t(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % 500).alias("doc_id"), (F.col("l_suppkey") % 7).alias("page"), (F.col("l_linenumber") - 2).alias("line")).agg(F.count(F.lit(1)).alias("n"))
    results = results.withColumn("page", F.when(F.col("page") > 0, F.col("page")))
    lines = _t(spark, sf_dir, "orders").select((F.col("o_orderkey") % 500).alias("doc_id"), (F.col("o_custkey") % 7).cast("double").alias("page"), (F.col("o_orderkey") % 4 + 1).alias("line"))
    out = records.project_results(results, lines)
    return out.groupBy("doc_id", "page", "line", "citation").agg(F.sum("n").alias("n"))


def migrated_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as run logs of three versions."""
    e, v = _t(spark, sf_dir, "events"), F.col("user_id") % 3
    counts = F.struct(F.lit(1).cast("long").alias("processed"), (F.col("event_id") % 5).alias("skipped"))
    listed = lambda at: F.when(v == at, F.array("event_type"))
    logs = e.select(
        "event_id", F.when(v == 1, "2.4").when(v == 2, "3.0").alias("schema_version"), F.when(v == 0, counts).alias("statistics"),
        F.when(v > 0, F.col("event_id") % 7).alias("processed"), F.when(v > 0, F.lit(0).cast("long")).alias("skipped"), F.lit("CC").alias("license"),
        listed(2).alias("components"), listed(1).alias("limits_applied"), listed(2).alias("limits"), F.when(v == 2, "failed").alias("action_status"),
    )
    out = records.migrated_logs(logs)
    return out.withColumns({c: F.array_join(c, ",") for c in ("components", "limits")})


def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as inputs of each user's run."""
    bad = F.col("event_type") == "error"
    e = _t(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"), F.when(bad, "skipped").otherwise("processed").alias("status"), F.col("event_type").alias("output_type"),
        F.when(bad, F.concat(F.lit("code "), (F.col("event_id") % 3).cast("string"))).alias("reason"), (F.col("value") > 90).alias("limited"), F.col("ts").alias("started"), F.col("ts").alias("ended"),
    )
    return records.run_counters(e)


def lost_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that orders set and a merge has lost."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    merged = o.where("o_orderkey % 4 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus")))
    return records.lost_fields(merged, o, ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])


def first_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' nations by two writers: the first wins, differences are named."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 > 0, F.col("c_name")).alias("name"), "c_mktsegment")
    other = _t(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 == 0, "x").otherwise(F.col("c_name")).alias("name"), F.when(F.col("c_custkey") % 7 > 0, F.col("c_mktsegment")).otherwise("NEW").alias("c_mktsegment"))
    out = records.first_writer(c, other, "c_custkey", ["name"], ["c_mktsegment"])
    return out.withColumns({k: F.array_join(k, ",") for k in ("conflicts", "notes")})


# ---- checks


def question_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as questions of a set for each brand."""
    p, k = _t(spark, sf_dir, "part"), F.col("p_partkey")
    kind = F.element_at(F.array(*map(F.lit, ("noul", "choice", "score", "essay"))), (k % 4 + 1).cast("int"))
    criteria = F.when(k % 9 > 0, F.when(k % 11 == 0, F.array("p_type")).when(k % 4 == 0, F.array(F.lit("true"), F.when(k % 8 == 0, "false").otherwise("maybe"))).otherwise(F.array("p_name", F.when(k % 13 == 0, "").otherwise("b"))))
    q = p.select(F.col("p_brand").alias("set_id"), F.when(k % 50 == 0, "").otherwise(k.cast("string")).alias("qid"), kind.alias("type"), criteria.alias("criteria"), ((k % 4 == 1) & (k % 6 != 1)).alias("keyed"))
    return validation.question_problems(q)


def limit_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' balances over limits that come from several places."""
    specs = spark.createDataFrame(
        [("BUILDING", " 9000 ", None, 1.0, "1", 5.0, 0.0, True), ("MACHINERY", "", "9500000", 1000.0, None, 5.0, 0.0, True), ("FURNITURE", None, None, 1.0, "8000", 5.0, 0.0, True), ("HOUSEHOLD", None, " ", 1.0, "", 9900.0, 0.0, True), ("AUTOMOBILE", "0", None, 1.0, None, 1.0, 0.0, True)],
        "`limit` string, env string, legacy string, divisor double, config string, fallback double, least double, zero_is_unlimited boolean",
    )
    limits = validation.resolved_limits(specs)
    seen = _t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("subject"), F.col("c_mktsegment").alias("limit"), F.col("c_acctbal").alias("observed"))
    return validation.exceeded(seen, limits).join(limits.select("limit", "origin"), "limit")


def withheld_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as themes, some of them flagged."""
    n = _t(spark, sf_dir, "nation").select(F.col("n_name").alias("theme"), F.when(F.col("n_nationkey") % 3 == 0, F.lit(False)).when(F.col("n_nationkey") % 3 == 1, F.lit(True)).alias("in_prompt"))
    return validation.withheld_themes(n)


def guardrail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands that the prompt still forbids although a rule offers them."""
    rules = spark.createDataFrame([(f"{k}:{i}", t) for k, i, t in vocabulary_plans.MAPS], "rule string, theme string")
    covers = _t(spark, sf_dir, "part").select(F.concat(F.lit("list:"), "p_brand").alias("rule"))
    prompt = _t(spark, sf_dir, "documents").select("text")
    return validation.guardrail_problems(rules, covers, prompt, ("the", "license"), True)


def config_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fault of a configuration made of parts, brands and nations."""
    part = _t(spark, sf_dir, "part")
    brand = part.select("p_brand").distinct()
    n = F.regexp_extract("p_brand", "[0-9]+", 0).cast("int")
    themes = brand.select(F.concat(F.lit("T"), "p_brand").alias("theme"), (n % 5).alias("priority"))
    maps = brand.select(F.col("p_brand").alias("rule"), F.when(n % 4 == 0, "__exclude__").when(n % 7 == 0, "nowhere").otherwise(F.concat(F.lit("T"), "p_brand")).alias("theme"))
    labels = brand.where(n % 2 == 0).select(F.concat("p_brand", F.when(n % 6 == 0, "x").otherwise("")).alias("rule"))
    notes = brand.where(n % 8 < 5).select(F.col("p_brand").alias("rule"), F.when(n % 3 == 0, "geo-ethnic").when(n % 3 == 1, "decided").otherwise("perhaps").alias("status"))
    covers = brand.where(n % 3 != 1).select(F.concat("p_brand", F.when(n % 10 == 0, "y").otherwise("")).alias("rule"))
    overrides = part.select(F.col("p_brand").alias("source"), F.col("p_partkey").cast("string").alias("source_id"), F.when(F.col("p_size") == 1, "lost").when(F.col("p_size") == 2, "TBrand#1").alias("theme"))
    links = part.select(F.col("p_name").alias("a"), F.col("p_type").alias("b"), F.when(F.col("p_size") % 2 == 0, "extra").otherwise("suppress").alias("kind"))
    tie = brand.where(n % 5 != 0).select(F.concat(F.lit("T"), "p_brand", F.when(n == 7, "z").otherwise("")).alias("theme"))
    kept = vocabulary_plans._records(spark, sf_dir).where(F.col("sort") != 3)
    return validation.config_problems(themes, maps, labels, notes, covers, overrides, links, tie, kept)


def qualifier_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of one name that have the same qualifier, and names of which every part has one."""
    r = vocabulary_plans._records(spark, sf_dir)
    q = r.where(F.col("sort") % 3 > 0).select("source", "source_id", F.col("en").alias("qualifier"))
    return validation.qualifier_problems(r, q)


# ---- vocabulary and registry


def audit_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name and type with the number of its links."""
    labels = vocabulary_plans._labels(spark, sf_dir)
    from archivolt.operators import vocabulary as V

    linked = labels.join(V.same_as(V.composite_links(labels, " ")), "cs")
    return review.audit_links(labels.withColumn("size", F.length("cs")), linked)


def link_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links with their status."""
    from archivolt.operators import vocabulary as V

    links = V.composite_links(vocabulary_plans._labels(spark, sf_dir), " ")
    pairs = _t(spark, sf_dir, "part").where("p_size < 5").select(F.col("p_name").alias("a"), F.split_part("p_type", F.lit(" "), F.lit(1)).alias("b"))
    return review.link_report(links, pairs, pairs.where("length(a) % 2 = 0"))


def covered_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and terms that rules cover: orders' customers as listed ids, their nations as schemes."""
    o = _t(spark, sf_dir, "orders")
    ids = F.array(
        F.struct(F.lit("amcr").alias("source"), F.col("o_custkey").cast("string").alias("id")), F.struct(F.lit("teater").alias("source"), (F.col("o_orderkey") % 1000).cast("string").alias("id"))
    )
    terms = o.select(F.col("o_orderpriority").alias("theme"), F.col("o_orderstatus").alias("sub"), F.col("o_orderkey").cast("string").alias("cs"), ids.alias("ids"))
    schemes = _t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_nationkey").cast("string").alias("scheme"))
    covers = spark.createDataFrame([("heslar:3",), ("heslar:4",), ("teater:17",), ("teater:18",), ("heslar:3",)], "rule string")
    return review.covered_targets(covers, terms, schemes)


def registry_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as schemes, nations as concepts, even nations as a collection of each region."""
    r, n = _t(spark, sf_dir, "region"), _t(spark, sf_dir, "nation").withColumn("scheme", F.concat(F.lit("r"), "n_regionkey"))
    schemes = r.select(F.concat(F.lit("r"), "r_regionkey").alias("scheme"), F.col("r_name").alias("title"), F.lower("r_name").alias("description"), F.lit("atlas").alias("authority"), F.when(F.col("r_regionkey") > 2, F.lit("urn:atlas")).alias("origin"))
    labels = F.create_map(F.lit("en"), F.col("n_name"), F.lit("cs"), F.lower("n_name"))
    concepts = n.select("scheme", F.col("n_nationkey").cast("string").alias("notation"), labels.alias("labels"), F.map_from_arrays(F.array(F.lit("en")), F.array(F.initcap("n_name"))).alias("definitions"), F.when(F.col("n_nationkey") % 2 == 0, "survey").alias("originator"))
    groups = n.where("n_nationkey % 2 = 0").groupBy("scheme").agg(F.collect_set(F.col("n_nationkey").cast("string")).alias("members"))
    collections = groups.select("scheme", F.lit("even").alias("name"), F.lit("Even").alias("label"), "members")
    mappings = n.select(F.concat(F.lit("urn:x:"), "n_nationkey").alias("s"), F.lit("skos:exactMatch").alias("p"), F.concat(F.lit("urn:y:"), "n_name").alias("o"))
    return sinks.registry_triples(schemes, concepts, collections, mappings, "urn:v:")


def template_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as blocks of a template, chosen by flags."""
    n, k = _t(spark, sf_dir, "nation"), F.col("n_nationkey")
    blocks = n.select(k.alias("place"), F.col("n_name").alias("name"), F.lower("n_name").alias("text"), (k % 5 == 0).alias("required"), F.concat(F.lit("F"), (k % 4).cast("string")).alias("flag"), F.when(k % 4 == 3, "strict").alias("value"))
    flags = spark.createDataFrame([("F0", "yes"), ("F1", "0"), ("F2", " TRUE "), ("F3", "Strict")], "flag string, value string")
    anchor = n.where("n_nationkey = 10").select("n_name").first()[0]
    return sinks.template_blocks(blocks, flags, anchor)


def ordered_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms on offer, the sentinel first, with all the ids behind each."""
    from archivolt.operators import vocabulary as V

    won = V.label_winners(V.drop_excluded(vocabulary_plans._placed(spark, sf_dir)))
    ranks = won.select("theme").distinct().withColumn("theme_rank", F.ascii(F.col("theme")))
    nested = V.nested_order(won, [], ranks)
    out = R.ordered_terms(nested, spark.createDataFrame([("other",)], "theme string"), "none of these")
    return out.select("pos", "theme", "cs", F.array_join(F.transform("ids", lambda x: F.concat_ws(":", x["source"], x["id"])), ",").alias("ids"))


def content_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of texts, and of canonical JSON of their columns."""
    d = _t(spark, sf_dir, "documents")
    fields = F.create_map(F.lit("source"), "source", F.lit("lang"), "lang")
    return d.select("doc_id", S.content_digest(F.coalesce("text", F.lit(""))).alias("sha256"), S.content_digest(S.canonical_json(fields)).alias("fields"))


def score_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table of a whole scoring run."""
    picks, expected = scoring_plans._picks(spark, sf_dir), scoring_plans._expected(spark, sf_dir)
    lost = _t(spark, sf_dir, "events").where("event_type = 'error'").select((F.col("user_id") % 4).cast("string").alias("run"), (F.col("event_id") % 9).cast("string").alias("file"))
    out = None
    for name, df in scoring.score_runs(picks, expected, "N", lost, watch=("R/x",)).items():
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = part if out is None else out.union(part)
    return out


# ---- hierarchies


def nested_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from records to the nested vocabulary, each term with its place in the audit."""
    from archivolt.operators import vocabulary as V

    overrides = spark.createDataFrame(vocabulary_plans.OVERRIDES, "source string, source_id string, theme string")
    maps = spark.createDataFrame(vocabulary_plans.MAPS, "kind string, ident string, theme string")
    words = spark.createDataFrame(vocabulary_plans.KEYWORDS, "lang string, keyword string, theme string, rank int")
    labels = _t(spark, sf_dir, "part").where("p_size % 5 = 0").groupBy(F.lower("p_name").alias("norm")).agg(F.min("p_brand").alias("theme"))
    ranks = spark.createDataFrame([("Big", 1), ("Cheap", 2)], "theme string, theme_rank int")
    nested, audit = V.build_nested(vocabulary_plans._records(spark, sf_dir), overrides, maps, words, labels, ["gizmo"], ranks)
    audited = audit.groupBy("theme").agg(F.count(F.lit(1)).alias("audited"))
    return nested.join(audited, "theme").select("theme", "theme_rank", "term_rank", "cs", "placed_by", "audited")


def replaced_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their priority replaced, or emptied, by another table's."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    new = o.where("o_orderkey % 3 = 0").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.lower("o_orderpriority")).alias("o_orderpriority"))
    return records.set_block(o, new, "o_orderpriority", "o_orderkey")


def harvest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as pages of harvests of 40, which break off at pages with a problem."""
    k = F.col("c_custkey")
    pages = _t(spark, sf_dir, "customer").select(
        F.col("c_name").alias("path"), F.when(k % 40 > 0, F.concat(F.lit("t"), k)).alias("request"), F.when(k % 40 < 39, F.concat(F.lit("t"), k + 1)).otherwise(" ").alias("token"), F.when(k % 57 == 0, "broken").alias("problem")
    )
    return graph.chained_pages(pages)


def cycle_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map of customers onto customers, with the cycles of its graph broken."""
    k = F.col("c_custkey")
    return graph.break_cycles(_t(spark, sf_dir, "customer").select(k.alias("child"), ((k * k + 1) % 149 + 1).alias("parent")))


def deep_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root and level in chains of 500 parts."""
    p = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    return graph.roots_of(p, p.where("id % 500 <> 0").select(F.col("id").alias("child"), (F.col("id") - 1).alias("parent")))


def withheld_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that lies below a region and a nation."""
    region, nation, cust = (_t(spark, sf_dir, n) for n in ("region", "nation", "customer"))
    nodes = region.select(F.concat(F.lit("r"), "r_regionkey").alias("id")).union(nation.select(F.concat(F.lit("n"), "n_nationkey"))).union(cust.select(F.concat(F.lit("c"), "c_custkey")))
    edges = nation.select(F.concat(F.lit("n"), "n_nationkey").alias("child"), F.concat(F.lit("r"), "n_regionkey").alias("parent"))
    edges = edges.union(cust.select(F.concat(F.lit("c"), "c_custkey"), F.concat(F.lit("n"), "c_nationkey")))
    return graph.withheld(nodes, edges, spark.createDataFrame([("r1",), ("n7",)], "id string"))


def tree_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, depth and width of the chains of parts."""
    p = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    return graph.tree_stats(p, p.where("id % 500 <> 0").select(F.col("id").alias("child"), (F.col("id") - 1).alias("parent")))


_REC = """r AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, n_chars AS n,
  CASE WHEN n_chars % 7 = 0 THEN 'schema_version' END AS p1, CASE WHEN n_chars % 19 = 0 THEN 'record_type' END AS p2, CASE WHEN n_chars % 13 = 0 THEN 'source.sha512' END AS p3,
  CASE WHEN n_chars % 23 = 0 THEN 'pages.page_index' END AS p4,
  CASE WHEN NOT (n_chars % 11 = 0 AND n_chars % 2 = 1) AND n_chars % 103 > 100 THEN 'pages.quality_score' END AS p5,
  CASE WHEN n_chars % 11 = 0 AND n_chars % 2 = 0 THEN 'pages.empty_with_score' END AS p6,
  CASE WHEN n_chars % 5 = 0 AND n_chars % 2 = 1 THEN 'line references' END AS p7 FROM documents)"""
_V = vocabulary_plans

ORACLES = {
    "record_problems": f"""
WITH {_REC}, f AS (SELECT *, coalesce(p1, p2, p3, p4, p5, p6, p7) AS problem FROM r)
SELECT doc_id, problem, CASE WHEN problem IS NULL THEN 'write' WHEN problem = 'schema_version' THEN 'inherited' ELSE 'refuse' END AS gate,
  CAST((p1 IS NOT NULL)::INT + (p2 IS NOT NULL)::INT + (p3 IS NOT NULL)::INT + (p4 IS NOT NULL)::INT + (p5 IS NOT NULL)::INT + (p6 IS NOT NULL)::INT + (p7 IS NOT NULL)::INT AS INTEGER) AS problems FROM f""",
    "seed_problems": """
WITH r AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN n_chars % 19 = 0 THEN 'record_type' END AS a, CASE WHEN n_chars % 13 = 0 OR n_chars % 17 = 0 THEN 'source.sha512' END AS b,
  CASE WHEN n_chars % 3 = 0 THEN 'blocks' END AS c FROM documents)
SELECT doc_id, coalesce(a, b, c) AS problem, CAST((a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT AS INTEGER) AS problems FROM r""",
    "projected_results": """
WITH s AS (SELECT l_orderkey % 500 AS doc_id, CASE WHEN l_suppkey % 7 > 0 THEN CAST(l_suppkey % 7 AS VARCHAR) END AS page, l_linenumber - 2 AS line, count(*) AS n FROM lineitem GROUP BY ALL),
k AS (SELECT DISTINCT o_orderkey % 500 AS doc_id, CAST(o_custkey % 7 AS VARCHAR) AS page, o_orderkey % 4 + 1 AS line FROM orders),
j AS (SELECT s.doc_id, s.page, CASE WHEN k.line IS NOT NULL AND s.line >= 1 THEN s.line END AS line, n FROM s LEFT JOIN k ON s.doc_id = k.doc_id AND s.page = k.page AND s.line = k.line)
SELECT doc_id, page, CAST(line AS INTEGER) AS line, CASE WHEN page IS NOT NULL THEN '[Source: ' || doc_id || ', Page ' || page || ']' END AS citation, CAST(sum(n) AS BIGINT) AS n FROM j GROUP BY ALL""",
    "migrated_logs": """
SELECT event_id, '3.0' AS schema_version, CASE WHEN user_id % 3 = 0 THEN 1 ELSE event_id % 7 END AS processed, CASE WHEN user_id % 3 = 0 THEN event_id % 5 ELSE 0 END AS skipped,
  CASE WHEN user_id % 3 = 2 THEN event_type ELSE '' END AS components, CASE WHEN user_id % 3 = 0 THEN '' ELSE event_type END AS limits,
  CASE WHEN user_id % 3 = 2 THEN 'failed' ELSE 'completed' END AS action_status FROM events""",
    "run_counters": """
WITH o AS (SELECT user_id, event_type AS v, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY ALL),
s AS (SELECT user_id, 'code ' || (event_id % 3) AS v, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL),
b AS (SELECT user_id AS run, count(*) AS inputs, count(*) FILTER (event_type <> 'error') AS processed, count(*) FILTER (event_type = 'error') AS skipped, count(*) FILTER (value > 90) AS limited,
  CAST(floor(epoch(max(ts))) - floor(epoch(min(ts))) AS BIGINT) AS seconds FROM events GROUP BY user_id)
SELECT b.*, coalesce((SELECT string_agg(v || ' ' || n, '; ' ORDER BY n DESC, v) FROM o WHERE user_id = run), '') AS outputs,
  coalesce((SELECT string_agg(v || ' ' || n, '; ' ORDER BY n DESC, v) FROM s WHERE user_id = run), '') AS reasons FROM b""",
    "lost_fields": """
SELECT o_orderkey, unnest(list_filter([CASE WHEN o_orderkey % 4 = 0 OR o_orderkey % 3 = 0 THEN 'o_orderstatus' END, CASE WHEN o_orderkey % 4 = 0 THEN 'o_orderpriority' END], lambda x: x IS NOT NULL)) AS field FROM orders""",
    "first_writer": """
SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_name WHEN c_custkey % 5 = 0 THEN 'x' ELSE c_name END AS name, c_mktsegment,
  CASE WHEN c_custkey % 3 > 0 AND c_custkey % 5 = 0 THEN 'name' ELSE '' END AS conflicts, CASE WHEN c_custkey % 7 = 0 THEN 'c_mktsegment' ELSE '' END AS notes FROM customer""",
    "question_problems": """
WITH q AS (SELECT p_brand AS set_id, CASE WHEN p_partkey % 50 = 0 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS qid, p_partkey AS k,
  CASE p_partkey % 4 WHEN 0 THEN 'noul' WHEN 1 THEN 'choice' WHEN 2 THEN 'score' ELSE 'essay' END AS kind, (p_partkey % 4 = 1 AND p_partkey % 6 <> 1) AS keyed FROM part),
f AS (SELECT set_id, qid, CASE WHEN qid = '' THEN 'empty id' WHEN kind = 'essay' THEN 'type'
  WHEN kind = 'noul' THEN CASE WHEN k % 9 > 0 AND (k % 11 = 0 OR k % 8 <> 0) THEN 'criteria' END
  WHEN k % 9 = 0 OR keyed <> (kind = 'choice') THEN 'criteria' WHEN k % 11 = 0 THEN 'options' WHEN kind = 'choice' AND k % 13 = 0 THEN 'empty option' END AS problem FROM q)
SELECT * FROM f WHERE problem IS NOT NULL UNION ALL SELECT set_id, NULL, 'too many questions' FROM q GROUP BY set_id HAVING count(*) > 64""",
    "limit_checks": """
WITH l(name, value, origin) AS (VALUES ('BUILDING', 9000.0::DOUBLE, 'env'), ('MACHINERY', 9500.0::DOUBLE, 'env'), ('FURNITURE', 8000.0::DOUBLE, 'config'), ('HOUSEHOLD', 9900.0::DOUBLE, 'default'))
SELECT CAST(c_custkey AS VARCHAR) AS subject, name AS "limit", c_acctbal AS observed, value, origin FROM customer JOIN l ON c_mktsegment = name WHERE c_acctbal > value""",
    "withheld_themes": """
SELECT lower(n_name) AS theme FROM nation WHERE n_nationkey % 3 = 0 OR (n_nationkey % 3 = 2 AND lower(n_name) = 'other')
UNION SELECT 'other' WHERE NOT EXISTS (SELECT 1 FROM nation WHERE lower(n_name) = 'other')""",
    "guardrail": """
SELECT 'covered rule offered' AS "check", 'list:' || p_brand AS subject FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand NOT IN ('Brand#1', 'Brand#3'))
UNION ALL SELECT 'wording missing', NULL WHERE NOT (SELECT bool_or(contains(lower(text), 'the')) AND bool_or(contains(lower(text), 'license')) FROM documents)""",
    "config_problems": """
WITH b AS (SELECT DISTINCT p_brand, CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS n FROM part),
th AS (SELECT 'T' || p_brand AS theme, n % 5 AS priority FROM b),
mp AS (SELECT p_brand AS rule, CASE WHEN n % 4 = 0 THEN '__exclude__' WHEN n % 7 = 0 THEN 'nowhere' ELSE 'T' || p_brand END AS theme FROM b),
nt AS (SELECT p_brand AS rule, CASE n % 3 WHEN 0 THEN 'geo-ethnic' WHEN 1 THEN 'decided' ELSE 'perhaps' END AS status FROM b WHERE n % 8 < 5),
cv AS (SELECT p_brand || CASE WHEN n % 10 = 0 THEN 'y' ELSE '' END AS rule FROM b WHERE n % 3 <> 1),
tb AS (SELECT 'T' || p_brand || CASE WHEN n = 7 THEN 'z' ELSE '' END AS theme FROM b WHERE n % 5 <> 0),
ov AS (SELECT p_brand AS source, CAST(p_partkey AS VARCHAR) AS id, CASE p_size WHEN 1 THEN 'lost' WHEN 2 THEN 'TBrand#1' END AS theme, p_size FROM part),
ex AS (SELECT rule FROM mp WHERE theme = '__exclude__'),
pr AS (SELECT DISTINCT least(p_name, p_type) AS a, greatest(p_name, p_type) AS b, p_size % 2 AS odd FROM part)
SELECT 'map to undeclared theme' AS "check", rule || '->' || theme AS subject FROM mp WHERE theme = 'nowhere'
UNION ALL SELECT 'tie break of undeclared theme', theme FROM tb WHERE theme NOT IN (SELECT theme FROM th)
UNION ALL SELECT 'shared priority without tie break', theme FROM th WHERE theme NOT IN (SELECT theme FROM tb) AND priority IN (SELECT priority FROM th GROUP BY priority HAVING count(*) > 1)
UNION ALL SELECT 'label of no rule', p_brand || 'x' FROM b WHERE n % 6 = 0
UNION ALL SELECT 'note of no exclusion', rule FROM nt WHERE rule NOT IN (SELECT rule FROM ex)
UNION ALL SELECT 'unknown status', rule FROM nt WHERE status = 'perhaps'
UNION ALL SELECT 'cover of no rule', rule FROM cv WHERE rule LIKE '%y'
UNION ALL SELECT 'guarded but not covered', rule FROM nt WHERE status = 'geo-ethnic' AND rule NOT IN (SELECT rule FROM cv)
UNION ALL SELECT 'covered but not guarded', rule FROM nt WHERE status <> 'geo-ethnic' AND rule IN (SELECT rule FROM cv) AND rule IN (SELECT rule FROM ex)
UNION ALL SELECT 'override to undeclared theme', source || ':' || id || '->' || theme FROM ov WHERE theme = 'lost'
UNION ALL SELECT 'link both added and suppressed', x.a || '|' || x.b FROM pr x JOIN pr y USING (a, b) WHERE x.odd = 0 AND y.odd = 1
UNION ALL SELECT 'override of no record', source || ':' || id FROM ov WHERE p_size = 3""",
    "qualifier_problems": """
WITH q AS (SELECT lower(p_name) AS n, CASE WHEN p_size % 3 > 0 THEN p_type END AS q FROM part)
SELECT 'qualifier twice' AS "check", n || '|' || q AS subject FROM q WHERE q IS NOT NULL GROUP BY n, q HAVING count(*) > 1
UNION ALL SELECT 'bare label gone', n FROM q GROUP BY n HAVING count(*) = count(q)""",
    "audit_links": f"""
WITH {_V._LINKS}, pairs AS (SELECT DISTINCT least(cs, part_cs) AS a, greatest(cs, part_cs) AS b FROM links WHERE cs <> part_cs),
n AS (SELECT cs, count(*) AS c FROM (SELECT a AS cs FROM pairs UNION ALL SELECT b FROM pairs) GROUP BY cs)
SELECT theme, cs, CAST(length(cs) AS INTEGER) AS size, CAST(coalesce(c, 0) AS INTEGER) AS same_as_count FROM l LEFT JOIN n USING (cs)""",
    "link_report": f"""
WITH {_V._LINKS}, auto AS (SELECT DISTINCT least(cs, part_cs) AS a, greatest(cs, part_cs) AS b FROM links WHERE cs <> part_cs),
x AS (SELECT DISTINCT least(p_name, split_part(p_type, ' ', 1)) AS a, greatest(p_name, split_part(p_type, ' ', 1)) AS b, length(p_name) % 2 = 0 AS s FROM part WHERE p_size < 5 AND p_name <> split_part(p_type, ' ', 1))
SELECT a, b, CASE WHEN (a, b) IN (SELECT a, b FROM x WHERE s) THEN 'suppressed' ELSE 'auto' END AS status FROM auto
UNION ALL SELECT DISTINCT a, b, 'manual' FROM x WHERE (a, b) NOT IN (SELECT a, b FROM auto)""",
    "ordered_terms": f"""
WITH {_V._PLACED}, e AS (SELECT *, row_number() OVER (PARTITION BY lower(cs) ORDER BY {_V._ORDER}) AS k FROM placed WHERE theme <> '__exclude__'),
g AS (SELECT lower(cs) AS n, string_agg(source || ':' || source_id, ',' ORDER BY k) AS ids FROM e GROUP BY lower(cs)),
t AS (SELECT theme, cs, lower(cs) AS n, row_number() OVER (PARTITION BY theme ORDER BY sort, cs) AS tr FROM e WHERE k = 1)
SELECT CAST(row_number() OVER (ORDER BY ascii(theme), tr, cs) AS INTEGER) AS pos, theme, cs, ids FROM t JOIN g USING (n) WHERE theme <> 'Other' UNION ALL SELECT 0, NULL, 'none of these', ''""",
    "covered_targets": """
SELECT DISTINCT 'group' AS kind, o_orderpriority AS theme, o_orderstatus AS name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey IN (3, 4)
UNION SELECT DISTINCT 'term', o_orderpriority, CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 1000 IN (17, 18)""",
    "registry_triples": """
WITH n AS (SELECT *, 'urn:v:r' || n_regionkey AS su, 'urn:v:r' || n_regionkey || '/' || n_nationkey AS u FROM nation), r AS (SELECT *, 'urn:v:r' || r_regionkey AS u FROM region),
t(s, p, kind, o, lang) AS (
  SELECT u, 'rdf:type', 'uri', 'http://www.w3.org/2004/02/skos/core#ConceptScheme', NULL FROM r
  UNION ALL SELECT u, 'dct:title', 'lit', r_name, 'en' FROM r UNION ALL SELECT u, 'dct:description', 'lit', lower(r_name), 'en' FROM r
  UNION ALL SELECT u, 'dct:source', 'uri', 'urn:atlas', NULL FROM r WHERE r_regionkey > 2 UNION ALL SELECT u, 'rdfs:comment', 'lit', 'authority: atlas', 'en' FROM r
  UNION ALL SELECT u, 'rdf:type', 'uri', 'http://www.w3.org/2004/02/skos/core#Concept', NULL FROM n UNION ALL SELECT u, 'skos:inScheme', 'uri', su, NULL FROM n
  UNION ALL SELECT u, 'skos:notation', 'lit', CAST(n_nationkey AS VARCHAR), NULL FROM n UNION ALL SELECT u, 'rdfs:comment', 'lit', 'emitted by: survey', 'en' FROM n WHERE n_nationkey % 2 = 0
  UNION ALL SELECT u, 'skos:prefLabel', 'lit', n_name, 'en' FROM n UNION ALL SELECT u, 'skos:prefLabel', 'lit', lower(n_name), 'cs' FROM n
  UNION ALL SELECT u, 'skos:definition', 'lit', list_aggregate(list_transform(string_split(n_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' '), 'en' FROM n
  UNION ALL SELECT DISTINCT su || '/collection/even', 'rdf:type', 'uri', 'http://www.w3.org/2004/02/skos/core#Collection', NULL FROM n WHERE n_nationkey % 2 = 0
  UNION ALL SELECT DISTINCT su || '/collection/even', 'skos:prefLabel', 'lit', 'Even', 'en' FROM n WHERE n_nationkey % 2 = 0
  UNION ALL SELECT su || '/collection/even', 'skos:member', 'uri', u, NULL FROM n WHERE n_nationkey % 2 = 0
  UNION ALL SELECT 'urn:x:' || n_nationkey, 'skos:exactMatch', 'uri', 'urn:y:' || n_name, NULL FROM n)
SELECT DISTINCT * FROM t""",
    "template_blocks": """
SELECT n_nationkey AS place, n_name AS name, CASE WHEN n_nationkey <= 10 THEN 'preamble' ELSE 'footer' END AS part, lower(n_name) AS text
FROM nation WHERE n_nationkey % 5 = 0 OR n_nationkey % 4 <> 1""",
    "content_digests": """
SELECT doc_id, sha256(coalesce(text, '')) AS sha256, sha256('{"lang":"' || lang || '","source":"' || source || '"}') AS fields FROM documents""",
    "score_report": f"""
WITH {scoring_plans._PICKS}, {scoring_plans._AGREE}
SELECT 'runs' AS name, count(DISTINCT run) AS rows FROM p UNION ALL SELECT 'agreement', count(*) FROM ag
UNION ALL SELECT 'before_after', count(DISTINCT a.run) FROM p a JOIN p b ON b.run = regexp_replace(a.run, '_R\\d+_', '_') AND a.run <> b.run
UNION ALL SELECT 'forced', count(*) FROM p WHERE category <> 'N' AND NOT supported
UNION ALL SELECT 'unreadable', count(*) FROM (SELECT DISTINCT user_id % 4, event_id % 9 FROM events WHERE event_type = 'error')""",
    "nested_build": f"""
WITH {_V._PLACED}, k AS (SELECT lower(p_name) AS n, min(p_brand) AS t FROM part WHERE p_size % 5 = 0 GROUP BY ALL),
a AS (SELECT cs, source, num, source_id, sort, CASE WHEN theme = 'Other' AND t IS NOT NULL THEN t ELSE theme END AS theme, CASE WHEN theme = 'Other' AND t IS NOT NULL THEN 'rescue' ELSE placed_by END AS placed_by
  FROM placed LEFT JOIN k ON lower(cs) = n),
w AS (SELECT * FROM a WHERE theme <> '__exclude__' QUALIFY row_number() OVER (PARTITION BY lower(cs) ORDER BY {_V._ORDER}) = 1)
SELECT w.theme, CAST(CASE w.theme WHEN 'Big' THEN 1 WHEN 'Cheap' THEN 2 END AS INTEGER) AS theme_rank,
  CAST(row_number() OVER (PARTITION BY w.theme ORDER BY CAST(contains(lower(cs), 'gizmo') AS INTEGER), sort, cs) AS INTEGER) AS term_rank, cs, placed_by,
  (SELECT count(*) FROM a WHERE a.theme = w.theme) AS audited FROM w""",
    "replaced_blocks": """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN lower(o_orderpriority) END ELSE o_orderpriority END AS o_orderpriority, o_orderstatus FROM orders""",
    "harvest_order": """
WITH b AS (SELECT c_custkey // 40 AS h, min(CASE WHEN c_custkey % 57 = 0 THEN c_custkey END) AS bad, min(c_custkey) AS low FROM customer GROUP BY ALL)
SELECT c_name AS path, CAST(c_custkey % 40 AS INTEGER) AS at FROM customer JOIN b ON c_custkey // 40 = h WHERE low % 40 = 0 AND c_custkey < coalesce(bad, c_custkey + 1)""",
    "cycle_breaks": """
WITH RECURSIVE e AS (SELECT c_custkey AS child, (c_custkey * c_custkey + 1) % 149 + 1 AS parent FROM customer),
r(s, n) AS (SELECT child, parent FROM e UNION SELECT r.s, e.parent FROM r JOIN e ON e.child = r.n),
c AS (SELECT s, min(n) AS m FROM r WHERE s IN (SELECT s FROM r WHERE s = n) GROUP BY s)
SELECT child, parent FROM e WHERE child NOT IN (SELECT m FROM c)""",
    "deep_roots": """
WITH p AS (SELECT p_partkey AS id, min(p_partkey) OVER (PARTITION BY p_partkey // 500) AS root FROM part) SELECT id, root, CAST(id - root AS INTEGER) AS level FROM p""",
    "withheld_nodes": """
SELECT 'r1' AS id UNION SELECT 'n7' UNION SELECT 'n' || n_nationkey FROM nation WHERE n_regionkey = 1
UNION SELECT 'c' || c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1 OR n_nationkey = 7""",
    "tree_summary": """
WITH p AS (SELECT p_partkey AS id, min(p_partkey) OVER (PARTITION BY p_partkey // 500) AS root FROM part)
SELECT count(*) AS nodes, count(*) FILTER (id = root) AS roots, CAST(max(id - root) AS INTEGER) AS deepest, (SELECT count(DISTINCT p_partkey - 1) FROM part WHERE p_partkey % 500 <> 0) AS inner_nodes,
  CAST(1 AS BIGINT) AS widest FROM p""",
}

QUERIES = {
    f.__name__: f
    for f in (
        record_problems, seed_problems, projected_results, migrated_logs, run_counters, lost_fields, first_writer, question_problems, limit_checks, withheld_themes,
        guardrail, config_problems, qualifier_problems, audit_links, link_report, covered_targets, registry_triples, template_blocks, ordered_terms, content_digests,
        score_report, nested_build, replaced_blocks, harvest_order, cycle_breaks, deep_roots, withheld_nodes, tree_summary,
    )
}
