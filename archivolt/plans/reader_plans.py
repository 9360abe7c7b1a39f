"""Queries of the readers and scalar operators: tables are written out as the texts that the readers take, and read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from archivolt.functions import scalars as S
from archivolt.operators import keywords, lines, review, sinks
from archivolt.operators import vocabulary as V
from archivolt.plans import check_plans, vocabulary_plans
from archivolt.sources import records as R
from archivolt.sources import text_files as X
from archivolt.sources import trees


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _upos(word: Column) -> Column:
    n = F.length(word)
    return F.when(n % 3 == 0, "NOUN").when(n % 3 == 1, "ADJ").otherwise("VERB")


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, turn, words): turns of conversations that have ASCII words."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("([A-Za-z]+)"), F.lit(1))
    return _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), "turn", words.alias("words")).where("size(words) > 0")


def _joined(rows: DataFrame, ending: str, between: str, head: str = "", tail: str = "") -> DataFrame:
    """(doc, turn, part) to files, the parts of a document in order of turns."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct("turn", "part"))), lambda x: x["part"])
    text = F.concat(F.lit(head), F.array_join(parts, between), F.lit(tail))
    return rows.groupBy("doc").agg(text.alias("text")).select(F.concat(F.lit("/in/"), F.col("doc"), F.lit(ending)).alias("path"), "text")


def _conllu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as annotated files: the lemma is the folded word, words of five letters join the next."""
    line = lambda w, i: F.concat_ws("\t", (i + 1).cast("string"), w, F.lower(w), _upos(w), *map(F.lit, "_____"), F.when(F.length(w) == 5, "SpaceAfter=No").otherwise("_"))
    rows = _sentences(spark, sf_dir).select("doc", "turn", F.concat(F.lit("# sent\n"), F.array_join(F.transform("words", line), "\n")).alias("part"))
    return _joined(rows, ".conllu", "\n\n")


def conllu_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of annotated files."""
    return X.conllu_tokens(_conllu(spark, sf_dir)).select("doc_id", "sent", "id", "form", "lemma", "upos", "misc")


def conllu_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surface text of annotated sentences."""
    return X.surface_sentences(X.conllu_tokens(_conllu(spark, sf_dir)))


def conllu_lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword lemmas of annotated files, counted."""
    return X.keyword_lemmas(X.conllu_tokens(_conllu(spark, sf_dir))).groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of plain texts, a form feed before every fourth line."""
    four = r"\G((?:[^\n]*\n){4})"  # \G, the end of the last match: what follows the last four is not searched again from each of its letters
    text = F.regexp_replace(F.coalesce("text", F.lit("")), four, "$1\f")
    files = _t(spark, sf_dir, "documents").select(F.concat(F.lit("/in/"), F.col("doc_id"), F.lit(".txt")).alias("path"), text.alias("text"))
    return X.text_lines(files).select("doc_id", "pos", "page", "line", F.md5("text").alias("digest"))


def _xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as annotated trees: a page for three turns, a line and a sentence for each."""
    tok = lambda w: F.concat(F.lit('<tok lemma="'), F.lower(w), F.lit('" upos="'), _upos(w), F.lit('">'), w, F.lit("</tok>"))
    rows = _sentences(spark, sf_dir)
    k = F.row_number().over(Window.partitionBy("doc").orderBy("turn")) - 1
    page = F.when(F.col("k") % 3 == 0, "<pb/>").otherwise("")
    part = F.concat(page, F.lit("<lb/><s>"), F.array_join(F.transform("words", tok), " "), F.lit("</s>"))
    return _joined(rows.withColumn("k", k).select("doc", "turn", part.alias("part")), ".teitok.xml", "", "<TEI><text>", "</text></TEI>")


def xml_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of annotated trees with their pages and lines."""
    rows = trees.read_xml_rows(_xml(spark, sf_dir))
    return rows.select(S.doc_id_of(F.col("path")).alias("doc_id"), "pos", "page", F.col("line").cast("int").alias("line"), F.col("page_index").cast("int").alias("page_index"), "text", "problem")


def xml_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of annotated trees, counted by lemma."""
    rows = trees.read_xml_tokens(_xml(spark, sf_dir))
    return rows.groupBy(S.doc_id_of(F.col("path")).alias("doc_id"), "lemma", "upos").agg(F.count(F.lit(1)).alias("n"))


def any_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences and lemmas of files of both kinds, and of broken ones, which have none."""
    broken = spark.createDataFrame([("/in/x.xml", "<a><b></a>"), ("/in/y.xml", "<!DOCTYPE a><a/>")], "path string, text string")
    sentences, words = trees.read_any(_xml(spark, sf_dir).union(_conllu(spark, sf_dir)).union(broken))
    a = sentences.groupBy("path").agg(F.count(F.lit(1)).alias("sentences"))
    return a.join(words.groupBy("path").agg(F.count(F.lit(1)).alias("tokens")), "path")


def broken_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as XML: those that aren't well formed have a problem instead of rows."""
    files = _t(spark, sf_dir, "nation").select(
        F.concat(F.lit("/in/"), F.col("n_name"), F.lit(".xml")).alias("path"),
        F.when(F.col("n_nationkey") % 4 == 0, F.concat(F.lit("<a><p>"), "n_name")).when(F.col("n_nationkey") % 4 == 1, F.concat(F.lit("<a><p>"), "n_name", F.lit("</p><head>two  words</head></a>"))).otherwise(F.concat(F.lit("<!DOCTYPE a><a><p>"), "n_name", F.lit("</p></a>"))).alias("text"),
    )
    return trees.read_xml_rows(files).select(S.doc_id_of(F.col("path")).alias("doc_id"), "pos", "text", F.col("problem").isNotNull().alias("broken"))


def label_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, nations and customers as one tree of labels, flattened."""
    region, nation, cust = (_t(spark, sf_dir, n) for n in ("region", "nation", "customer"))
    kids = lambda c: F.sort_array(F.collect_list(c))
    c = cust.groupBy("c_nationkey").agg(kids(F.struct(F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_name").alias("cs"))).alias("children"))
    n = nation.join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    n = n.groupBy("n_regionkey").agg(kids(F.struct(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.col("n_name").alias("cs"), "children")).alias("children"))
    r = region.join(n, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    r = r.select(F.concat(F.lit("/in/"), "r_name", F.lit(".json")).alias("path"), F.to_json(F.struct(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.col("r_name").alias("cz"), "children")).alias("text"))
    return trees.read_label_tree(r).select("id", "cs", F.array_join("broader", ",").alias("broader"), "sub")


def harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as saved pages of a harvest; the first page with an id counts."""
    p, k = _t(spark, sf_dir, "part"), F.col("p_partkey")
    record = F.concat(F.lit("<record><ident_cely>"), (k % 150).cast("string"), F.lit('</ident_cely><heslo xml:lang="cs">'), "p_name", F.lit("</heslo><heslo_en>"), "p_type", F.lit("</heslo_en></record>"))
    pages = p.select(F.lpad(F.floor(k / 100).cast("string"), 6, "0").alias("doc"), k.alias("turn"), record.alias("part"))
    files = _joined(pages, ".xml", "", "<OAI>", "<resumptionToken>more</resumptionToken></OAI>")
    return trees.read_harvest(files).select("id", "cs", "en", "token")


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of records: turns of conversations, or a plain text where a record has no lines."""
    c = _t(spark, sf_dir, "conversations")
    null = F.lit(None).cast("string")
    line = F.struct(
        F.when(F.col("turn") % 2 == 0, "7").alias("page"), F.col("turn").cast("string").alias("line"), F.col("text"), F.when(F.col("turn") % 5 == 0, "Trash").otherwise("Clear").alias("categ"),
        F.lit(0.5).cast("double").alias("quality_score"), null.alias("lemma"), null.alias("upos"), null.alias("unit"),
    )
    by = c.groupBy(F.col("conv_id").cast("string").alias("doc_id")).agg(F.sort_array(F.collect_list(F.struct("turn", line.alias("l")))).alias("all"))
    plain = F.array_join(F.transform("all", lambda x: F.coalesce(x["l"]["text"], F.lit(""))), "\n")
    odd = F.col("doc_id").cast("int") % 2 == 1
    frame = by.select("doc_id", F.when(~odd, F.transform("all", lambda x: x["l"])).alias("lines"), F.struct(F.when(odd, plain).alias("text")).alias("content"))
    return R.record_lines(frame).select("doc_id", "pos", "page", "line", F.md5("text").alias("digest"), "categ")


# ---- scalars


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document ids and kinds of files by their names."""
    endings = F.element_at(F.array(*map(F.lit, (".alto.xml", ".v2.md", ".conllu", ".document.json", ".x.y", ".csv", ".TXT"))), (F.col("p_partkey") % 7 + 1).cast("int"))
    path = F.concat(F.lit("/a/b."), F.col("p_partkey").cast("string"), endings)
    return _t(spark, sf_dir, "part").select("p_partkey", S.doc_id_of(path).alias("doc_id"), X.input_kind(path, F.lit("x")).alias("kind"))


def clean_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels without markup at their edges, and alternatives without repeats."""
    p = _t(spark, sf_dir, "part")
    raw = F.concat(F.when(F.col("p_partkey") % 3 == 0, "**").otherwise(" "), "p_name", F.when(F.col("p_partkey") % 2 == 0, " __").otherwise(""))
    others = F.array(F.col("p_type"), F.concat(F.lit("*"), "p_type"), F.col("p_name"), F.lit(" * "))
    return p.select("p_partkey", R.clean_label(raw).alias("label"), F.array_join(R.clean_alternatives(others, F.col("p_name")), "|").alias("others"))


def exclusion_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical keys of exclusions written in several ways."""
    k = F.col("n_nationkey")
    key = F.when(k % 4 == 0, F.concat(F.lit(" TEATER: "), k)).when(k % 4 == 1, F.concat(F.lit("teater  "), k)).when(k % 4 == 2, k.cast("string")).otherwise(F.col("n_name"))
    return _t(spark, sf_dir, "nation").select("n_nationkey", R.exclusion_key(key).alias("key"))


def keyword_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names of each brand as keyword entries, the most frequent first."""
    c = _t(spark, sf_dir, "part").groupBy("p_brand", "p_name").agg(F.count(F.lit(1)).cast("double").alias("score"))
    pairs = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("o"), F.col("p_name").alias("phrase"), "score"))), lambda x: F.struct(x["phrase"].alias("phrase"), x["score"].alias("score")))
    out = c.groupBy("p_brand").agg(pairs.alias("pairs")).select("p_brand", F.explode(S.keyword_entries(F.col("pairs"), "count")).alias("e"))
    return out.select("p_brand", "e.keyword", "e.score", "e.method", "e.rank")


def scaled_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes scaled and moved, halves to even."""
    box = F.array(F.col("l_quantity"), F.col("l_quantity") + 1, F.col("l_quantity") + 2, F.col("l_linenumber") * 1.0)
    boxes = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", S.scale_box(box, 0.5, 1.5, 2.0).alias("b"))
    inch = S.units_per_inch(F.when(F.col("l_linenumber") == 1, "MM10").when(F.col("l_linenumber") == 2, "inch1200").otherwise("pixel"))
    return boxes.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(F.col("b").cast("array<string>"), ",").alias("box"), inch.alias("per_inch"))


def licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical names by folded spelling."""
    return _t(spark, sf_dir, "events").groupBy(S.normalise_licence(F.concat(F.lit(" "), F.upper("event_type")), {"click": "CLICK-1.0", "view": "VIEW-2.0"}).alias("name")).agg(F.count(F.lit(1)).alias("n"))


def expected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the lines that are worth sending on."""
    c = _t(spark, sf_dir, "conversations")
    df = c.select(
        F.col("conv_id").cast("string").alias("file_id"), F.when(F.col("turn") % 4 == 3, "iv").otherwise(F.col("turn").cast("string")).alias("page"), F.col("turn").cast("string").alias("line"),
        "text", F.when(F.col("role") == "system", "Trash").otherwise("Clear").alias("categ"), (F.col("turn") % 10 / 10.0).alias("quality_score"),
    )
    return lines.expected_keys(df)


def turtle_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry's triples as text."""
    return sinks.turtle(check_plans.registry_triples(spark, sf_dir))


def drift_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that differ from a stored copy, apart from their stamps."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    stored = o.where("o_orderkey % 100 <> 7").withColumns({"o_orderstatus": F.when(F.col("o_orderkey") % 50 == 0, "X").otherwise(F.col("o_orderstatus")), "o_orderdate": F.lit(None).cast("timestamp")})
    return sinks.drift(o, stored, ["o_orderdate"])


# ---- vocabulary


def rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that no rule placed, by their labels."""
    labels = _t(spark, sf_dir, "part").where("p_size % 5 = 0").groupBy(F.lower("p_name").alias("norm")).agg(F.min("p_brand").alias("theme"))
    return V.rescue(vocabulary_plans._placed(spark, sf_dir), labels).select("source_id", "theme", "placed_by")


def qualified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a qualifier get it in brackets."""
    r = vocabulary_plans._records(spark, sf_dir)
    flagged, plain = V.split_qualified(r, r.where("sort = 7").select("source", F.col("source_id").alias("id"), F.col("en").alias("qualifier")))
    return flagged.select("source_id", "cs", "bare_cs").union(plain.select("source_id", "cs", "bare_cs"))


def ancestor_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of ancestors from the root down."""
    region, nation, cust = (_t(spark, sf_dir, n) for n in ("region", "nation", "customer"))
    rid, nid = F.concat(F.lit("r"), "r_regionkey"), F.concat(F.lit("n"), "n_nationkey")
    s = F.lit("s").alias("source")
    r = region.select(s, rid.alias("source_id"), F.col("r_name").alias("cs"), F.array().cast("array<string>").alias("broader"))
    n = nation.where("n_nationkey % 3 <> 0").select(s, nid.alias("source_id"), F.col("n_name").alias("cs"), F.array(F.concat(F.lit("r"), "n_regionkey")).alias("broader"))
    c = cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(s, F.concat(F.lit("c"), "c_custkey").alias("source_id"), F.col("c_name").alias("cs"), F.array(F.concat(F.lit("r"), "n_regionkey"), nid).alias("broader"))
    return review.broader_labels(r.union(n).union(c)).select("source_id", "broader_labels")


def candidate_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms that occur in turns by the lemma of a form."""
    c = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("pos"), F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z ]", " ").alias("text"))
    words = keywords.surface_words(c.select(F.col("doc_id"), "text")).select("doc_id", F.col("word").alias("form")).distinct()
    forms = words.select("doc_id", "form", F.substring("form", 1, 3).alias("lemma"))
    terms = spark.createDataFrame([("the",), ("con",), ("Ans",), ("que",), ("pro",)], "cs string")
    return review.candidate_terms(c, forms, terms, 3).select("doc_id", "pos", F.array_join("candidates", ",").alias("candidates"))


def halves_on_offer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of names that stand for one composite alone."""
    labels = vocabulary_plans._labels(spark, sf_dir)
    halves = _t(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("half"), F.col("p_name").alias("cs")).union(_t(spark, sf_dir, "nation").select(F.lower("n_name"), F.lit("SMALL"))).distinct()
    return V.offered_halves(labels.select("cs").distinct(), halves)


_SENT = """w AS (SELECT conv_id, turn, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+') AS w FROM conversations),
s AS (SELECT conv_id, turn, w, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k FROM w WHERE len(w) > 0)"""
_TOK = _SENT + """,
t AS (SELECT CAST(conv_id AS VARCHAR) AS doc_id, k, unnest(w) AS form, generate_subscripts(w, 1) AS i FROM s),
u AS (SELECT *, lower(form) AS lemma, CASE length(form) % 3 WHEN 0 THEN 'NOUN' WHEN 1 THEN 'ADJ' ELSE 'VERB' END AS upos FROM t)"""

ORACLES = {
    "conllu_tokens": f"WITH {_TOK} SELECT doc_id, k AS sent, CAST(i AS VARCHAR) AS id, form, lemma, upos, CASE WHEN length(form) = 5 THEN 'SpaceAfter=No' ELSE '_' END AS misc FROM u",
    "conllu_sentences": f"WITH {_TOK} SELECT doc_id, k AS sent, trim(string_agg(form || CASE WHEN length(form) = 5 THEN '' ELSE ' ' END, '' ORDER BY i)) AS text FROM u GROUP BY doc_id, k",
    "conllu_lemmas": f"WITH {_TOK} SELECT doc_id, lemma AS word, count(*) AS n FROM u WHERE upos IN ('NOUN', 'ADJ') AND length(form) > 1 GROUP BY ALL",
    "text_lines": """
WITH p AS (SELECT doc_id, unnest(b) AS body, generate_subscripts(b, 1) AS p FROM (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '((?:[^\\n]*\\n){4})', '\\1' || chr(12), 'g'), chr(12)) AS b FROM documents)),
l AS (SELECT doc_id, p, trim(unnest(r)) AS t, generate_subscripts(r, 1) AS i FROM (SELECT doc_id, p, string_split_regex(body, '\\r\\n|\\r|\\n') AS r FROM p))
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY p, i) AS INTEGER) AS pos, CAST(p AS VARCHAR) AS page,
  CAST(row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS INTEGER) AS line, md5(t) AS digest FROM l WHERE t <> ''""",
    "xml_rows": f"""
WITH {_SENT} SELECT CAST(conv_id AS VARCHAR) AS doc_id, k AS pos, CAST(k // 3 + 1 AS VARCHAR) AS page, CAST(k % 3 + 1 AS INTEGER) AS line, CAST(k // 3 + 1 AS INTEGER) AS page_index,
  array_to_string(w, ' ') AS text, CAST(NULL AS VARCHAR) AS problem FROM s""",
    "xml_tokens": f"WITH {_TOK} SELECT doc_id, lemma, upos, count(*) AS n FROM u GROUP BY ALL",
    "any_reader": f"""
WITH {_TOK}, c AS (SELECT doc_id, count(DISTINCT k) AS sentences, count(*) AS tokens FROM u GROUP BY doc_id)
SELECT '/in/' || doc_id || unnest(['.teitok.xml', '.conllu']) AS path, sentences, tokens FROM c""",
    "broken_trees": """
SELECT n_name AS doc_id, CAST(-1 AS BIGINT) AS pos, CAST(NULL AS VARCHAR) AS text, true AS broken FROM nation WHERE n_nationkey % 4 <> 1
UNION ALL SELECT n_name, 0, n_name, false FROM nation WHERE n_nationkey % 4 = 1 UNION ALL SELECT n_name, 1, 'two words', false FROM nation WHERE n_nationkey % 4 = 1""",
    "label_tree": """
SELECT 'r' || r_regionkey AS id, r_name AS cs, '' AS broader, '' AS sub FROM region
UNION ALL SELECT 'n' || n_nationkey, n_name, 'r' || n_regionkey, n_name FROM nation
UNION ALL SELECT 'c' || c_custkey, c_name, 'r' || n_regionkey || ',n' || n_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "harvest": """
SELECT CAST(p_partkey % 150 AS VARCHAR) AS id, p_name AS cs, p_type AS en, 'more' AS token FROM part QUALIFY row_number() OVER (PARTITION BY p_partkey % 150 ORDER BY p_partkey // 100, p_partkey) = 1""",
    "record_lines": """
WITH c AS (SELECT conv_id, turn, coalesce(text, '') AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k FROM conversations),
b AS (SELECT conv_id, unnest(a) AS t, generate_subscripts(a, 1) - 1 AS k FROM (SELECT conv_id, string_split_regex(string_agg(t, chr(10) ORDER BY turn), '\\r?\\n') AS a FROM c WHERE conv_id % 2 = 1 GROUP BY conv_id))
SELECT CAST(conv_id AS VARCHAR) AS doc_id, CAST(k AS INTEGER) AS pos, CASE WHEN turn % 2 = 0 THEN '7' ELSE '1' END AS page, CAST(turn AS VARCHAR) AS line, md5(trim(t)) AS digest, 'Clear' AS categ
FROM c WHERE conv_id % 2 = 0 AND trim(t) <> '' AND turn % 5 <> 0
UNION ALL SELECT CAST(conv_id AS VARCHAR), CAST(k AS INTEGER), '1', CAST(k + 1 AS VARCHAR), md5(trim(t)), NULL FROM b WHERE trim(t) <> ''""",
    "file_names": """
SELECT p_partkey, CASE p_partkey % 7 WHEN 1 THEN 'b.' || p_partkey || '.v2' WHEN 4 THEN 'b' ELSE 'b.' || p_partkey END AS doc_id,
  CASE p_partkey % 7 WHEN 0 THEN 'xml' WHEN 2 THEN 'conllu' WHEN 3 THEN 'record' WHEN 5 THEN 'csv' WHEN 6 THEN 'text' END AS kind FROM part""",
    "clean_labels": "SELECT p_partkey, p_name AS label, CASE WHEN lower(p_type) = lower(p_name) THEN '' ELSE p_type END AS others FROM part",
    "exclusion_keys": """
SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 3 THEN 'heslar:' || n_name ELSE 'teater:' || n_nationkey END AS key FROM nation""",
    "keyword_entries": """
SELECT p_brand, p_name AS keyword, CAST(count(*) AS DOUBLE) AS score, 'count' AS method, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_name) AS INTEGER) AS rank FROM part GROUP BY p_brand, p_name""",
    "scaled_boxes": """
WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, [l_quantity * 0.5 + 2, (l_quantity + 1) * 1.5, (l_quantity + 2) * 0.5 + 2, l_linenumber * 1.5] AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(list_transform(b, lambda v: CAST(CAST(round_even(CAST(v AS DOUBLE), 0) AS INTEGER) AS VARCHAR)), ',') AS box,
  CASE l_linenumber WHEN 1 THEN 254.0::DOUBLE WHEN 2 THEN 1200.0::DOUBLE END AS per_inch FROM b""",
    "licences": """
SELECT CASE event_type WHEN 'click' THEN 'CLICK-1.0' WHEN 'view' THEN 'VIEW-2.0' ELSE ' ' || upper(event_type) END AS name, count(*) AS n FROM events GROUP BY ALL""",
    "expected_lines": """
SELECT DISTINCT CAST(conv_id AS VARCHAR) AS file_id, CAST(turn AS INTEGER) AS page, CAST(turn AS INTEGER) AS line FROM conversations
WHERE turn % 4 <> 3 AND role <> 'system' AND turn % 10 >= 4 AND length(coalesce(text, '')) >= 3""",
    "turtle_blocks": f"""
WITH x AS ({check_plans.ORACLES["registry_triples"]}),
l AS (SELECT s, '  ' || p || ' ' || CASE WHEN kind = 'lit' THEN '"' || o || '"' || CASE WHEN lang IS NULL THEN '' ELSE '@' || lang END
  WHEN regexp_full_match(o, '[a-z]+:[A-Za-z]+') THEN o ELSE '<' || o || '>' END AS line FROM x)
SELECT s, '<' || s || '>' || chr(10) || string_agg(line, ' ;' || chr(10) ORDER BY line) || ' .' AS block FROM l GROUP BY s""",
    "drift_rows": """
WITH n AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders),
o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 100 <> 7)
SELECT *, 'now' AS side FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM o) UNION ALL SELECT *, 'stored' FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM n)""",
    "rescued": f"""
WITH {vocabulary_plans._PLACED}, k AS (SELECT lower(p_name) AS n, min(p_brand) AS t FROM part WHERE p_size % 5 = 0 GROUP BY ALL)
SELECT source_id, CASE WHEN theme = 'Other' AND t IS NOT NULL THEN t ELSE theme END AS theme, CASE WHEN theme = 'Other' AND t IS NOT NULL THEN 'rescue' ELSE placed_by END AS placed_by
FROM placed LEFT JOIN k ON lower(cs) = n""",
    "qualified": "SELECT CAST(p_partkey AS VARCHAR) AS source_id, CASE WHEN p_size = 7 THEN p_name || ' (' || p_type || ')' ELSE p_name END AS cs, CASE WHEN p_size = 7 THEN p_name END AS bare_cs FROM part",
    "ancestor_labels": """
SELECT 'r' || r_regionkey AS source_id, '' AS broader_labels FROM region
UNION ALL SELECT 'n' || n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 3 <> 0
UNION ALL SELECT 'c' || c_custkey, r_name || ' > ' || CASE WHEN n_nationkey % 3 <> 0 THEN n_name ELSE 'n' || n_nationkey END FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "candidate_terms": """
WITH c AS (SELECT conv_id AS doc_id, turn AS pos, regexp_extract_all(regexp_replace(coalesce(text, ''), '[^A-Za-z ]', ' ', 'g'), '[A-Za-z]+') AS w FROM conversations),
f AS (SELECT doc_id, pos, lower(unnest(w)) AS form, generate_subscripts(w, 1) AS "at" FROM c),
t AS (SELECT unnest(['the', 'con', 'Ans', 'que', 'pro']) AS cs),
g AS (SELECT doc_id, pos, cs, min(f."at") AS "at" FROM f JOIN t ON lower(cs) = CASE WHEN length(form) > 1 THEN substr(form, 1, 3) ELSE form END GROUP BY doc_id, pos, cs),
m AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY doc_id, pos ORDER BY g."at", cs) <= 3)
SELECT doc_id, pos, string_agg(cs, ',' ORDER BY "at", cs) AS candidates FROM m GROUP BY doc_id, pos""",
    "halves_on_offer": f"""
WITH {vocabulary_plans._LABELS}, h AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS half, p_name AS cs FROM part UNION SELECT lower(n_name), 'SMALL' FROM nation),
u AS (SELECT half, min(cs) AS cs FROM h GROUP BY half HAVING count(DISTINCT cs) = 1)
SELECT half, cs FROM u WHERE cs IN (SELECT cs FROM l) AND half NOT IN (SELECT cs FROM l)""",
}

QUERIES = {
    f.__name__: f
    for f in (
        conllu_tokens, conllu_sentences, conllu_lemmas, text_lines, xml_rows, xml_tokens, any_reader, broken_trees, label_tree, harvest, record_lines, file_names, clean_labels,
        exclusion_keys, keyword_entries, scaled_boxes, licences, expected_lines, turtle_blocks, drift_rows, rescued, qualified, ancestor_labels, candidate_terms, halves_on_offer,
    )
}
