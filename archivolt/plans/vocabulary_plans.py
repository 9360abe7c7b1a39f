"""Queries of the vocabulary and review operators: parts stand for records, their names for labels, brands for sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from archivolt.operators import graph, review, sinks
from archivolt.operators import vocabulary as V

#: The stand-in's rules: brands that a map places or excludes, keywords in order, single overrides.
MAPS = (("list", "Brand#1", "__exclude__"), ("list", "Brand#2", "Tools"), ("list", "Brand#3", "__exclude__"), ("branch", "ECONOMY", "Cheap"), ("branch", "red", "Red"))
KEYWORDS = (("en", "LARGE", "Big", 1), ("cs", "bolt", "Bolts", 2), ("cs", "ring", "Rings", 3))
OVERRIDES = (("Brand#5", "70", "Special"), ("Brand#6", "71", "__exclude__"))
PRECEDENCE = tuple(f"Brand#{i}" for i in range(25, 0, -1))


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records: cs the name, en the type, source the brand; the chain of broader ids is the type, then the colour."""
    part = _t(spark, sf_dir, "part")
    return part.select(
        F.col("p_name").alias("cs"),
        F.col("p_type").alias("en"),
        F.col("p_brand").alias("source"),
        F.col("p_partkey").cast("string").alias("source_id"),
        F.col("p_brand").alias("scheme"),
        F.array("p_type", F.split_part("p_name", F.lit(" "), F.lit(1))).alias("broader"),
        F.col("p_size").alias("sort"),
        F.concat(F.lit("urn:part:"), F.col("p_partkey").cast("string")).alias("uri"),
    )


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    overrides = spark.createDataFrame(OVERRIDES, "source string, source_id string, theme string")
    maps = spark.createDataFrame(MAPS, "kind string, ident string, theme string")
    keywords = spark.createDataFrame(KEYWORDS, "lang string, keyword string, theme string, rank int")
    return V.place(_records(spark, sf_dir), overrides, maps, keywords)


def vocab_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record for each label, with the ids that it displaced."""
    won = V.label_winners(_records(spark, sf_dir))
    return won.select("cs", "source", "source_id", F.size("discarded").alias("n_discarded"), F.array_join(F.transform("discarded", lambda d: d["id"]), ",").alias("discarded_ids"))


def vocab_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record for each label, by an order of sources."""
    return V.merge_labels(_records(spark, sf_dir), PRECEDENCE).select("cs", "source", "source_id")


def rule_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The theme of every record and the rule that gave it."""
    return _placed(spark, sf_dir).select("source_id", "theme", "placed_by")


def exclude_then_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exclusion before labels are made unique."""
    return V.label_winners(V.drop_excluded(_placed(spark, sf_dir))).select("cs", "source", "source_id", "theme")


def nested_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winners in their order within themes, boilerplate last."""
    won = V.label_winners(V.drop_excluded(_placed(spark, sf_dir)))
    ranks = spark.createDataFrame([("Big", 1), ("Cheap", 2), ("Tools", 3)], "theme string, theme_rank int")
    return V.nested_order(won, ["gizmo"], ranks).select("theme", "theme_rank", "term_rank", "cs")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _t(spark, sf_dir, "part").select(F.lit("name").alias("theme"), F.col("p_name").alias("cs")).distinct()
    types = _t(spark, sf_dir, "part").select(F.lit("type").alias("theme"), F.col("p_type").alias("cs")).distinct()
    return names.union(types)


def composite_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names whose words are labels themselves."""
    return V.composite_links(_labels(spark, sf_dir), " ")


def composite_same_as(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symmetric links, with one suppressed and one added."""
    extra = spark.createDataFrame([("blue bolt", "red bolt")], "a string, b string")
    suppress = spark.createDataFrame([("small ring", "SMALL")], "a string, b string")
    found = V.same_as(V.composite_links(_labels(spark, sf_dir), " "), extra, suppress)
    return found.select("cs", F.array_join("same_as", ",").alias("same_as"))


def composite_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of names that are no labels, and whether they would do."""
    return V.composite_halves(_labels(spark, sf_dir), " ").select("cs", "half", "position", "shared_with", "n_starts", "verdict")


def case_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with the first letter's case swapped, where that is unique and free."""
    names = _labels(spark, sf_dir).select("cs").union(_t(spark, sf_dir, "nation").select("n_name"))
    return V.case_variants(names)


def label_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types that are not permitted, with one that differs in case only."""
    permitted = spark.createDataFrame([("VIEW",), ("click",), ("signup",)], "label string")
    return V.unknown_labels(_t(spark, sf_dir, "events").select(F.col("event_type").alias("label")), permitted)


def entity_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' priorities and customers' segments resolved through an index of concepts."""
    rows = [("HOUSEHOLD", "own", "1", "urn:h", []), ("MACHINERY", "own", "2", None, ["http://vocab.getty.edu/aat/3"]), ("BUILDING", "other", "3", "urn:b", [])]
    records = spark.createDataFrame(rows, "cs string, source string, source_id string, uri string, exact_match array<string>")
    index = V.concept_index(records, ["own", "other"])
    people = _t(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("lemma"), F.col("c_mktsegment").alias("surface"))
    return V.resolve_entities(people, index, ["c_custkey"], "own")


def category_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids attached by category; bracketed labels give way to bare ones."""
    terms = spark.createDataFrame([("view", ["1", "2"], None), ("click", ["3"], "CLICK")], "cs string, ids array<string>, bare_cs string")
    out = V.attach_ids(_t(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("category")), terms)
    return out.select("event_id", "category", F.array_join("ids", ",").alias("ids"))


def nearest_ancestor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest and outermost offered ancestors: customers under nations under regions; some nations are not offered."""
    region, nation, cust = (_t(spark, sf_dir, n) for n in ("region", "nation", "customer"))
    rid, nid = F.concat(F.lit("r"), "r_regionkey"), F.concat(F.lit("n"), "n_nationkey")
    r = region.select(F.col("r_name").alias("cs"), F.lit("place").alias("theme"), rid.alias("source_id"), F.array().cast("array<string>").alias("broader"))
    n = nation.where("n_nationkey % 3 <> 0").select(F.col("n_name").alias("cs"), F.lit("place").alias("theme"), nid.alias("source_id"), F.array(F.concat(F.lit("r"), "n_regionkey")).alias("broader"))
    c = cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.select(F.col("c_name").alias("cs"), F.col("c_mktsegment").alias("theme"), F.concat(F.lit("c"), "c_custkey").alias("source_id"), F.array(F.concat(F.lit("r"), "n_regionkey"), nid).alias("broader"))
    return review.offered_ancestors(r.union(n).union(c))


def exclusion_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every excluding rule removes."""
    notes = spark.createDataFrame([("list:Brand#1", "decided", "old brand")], "rule string, status string, reason string")
    return review.exclusion_impact(_placed(spark, sf_dir), notes)


def reinstatement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every excluding rule would bring back beside the labels on offer."""
    placed = _placed(spark, sf_dir)
    return review.reinstatement(placed, V.drop_excluded(placed).where("theme <> 'Other'").select("cs"))


def budget_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each brand fits in prompts of several sizes."""
    order = Window.orderBy("p_brand", "p_partkey")
    terms = _t(spark, sf_dir, "part").select(F.col("p_brand").alias("theme"), F.row_number().over(order).alias("pos"), review.prompt_chars(F.col("p_name"), F.col("p_type")).alias("chars"))
    return review.budget_prefix(terms, (4096, 8192, 32768)).select("window", "theme", "terms", "surviving", "dropped", "status")


def largest_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of the largest prefix within a budget."""
    terms = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("pos"), F.length("p_name").alias("chars"))
    return review.largest_prefix(terms, 9000)


def theme_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Themes in order with sizes, running totals and the rules that feed them."""
    placed = V.drop_excluded(_placed(spark, sf_dir))
    ranked = placed.withColumn("theme_rank", F.dense_rank().over(Window.orderBy("theme")))
    out = review.census(ranked)
    return out.withColumn("share", F.round("share", 9))


def branch_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of excluded rules among line items, those already on offer apart."""
    placed = _placed(spark, sf_dir)
    items = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").cast("string").alias("source_id"), F.col("l_suppkey").alias("doc_id")).agg(F.count(F.lit(1)).alias("n"))
    hits = placed.where("theme = '__exclude__'").select("source_id", F.col("placed_by").alias("rule"), F.col("cs").alias("lemma")).join(items, "source_id")
    return review.branch_evidence(hits, placed.where("theme = 'Cheap'").select(F.col("cs").alias("lemma")))


def term_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and occurrences of one-word terms among documents' words."""
    from archivolt.operators.keywords import surface_words

    terms = spark.createDataFrame([("the",), ("une",), ("nowhere",), ("two words",), ("DER",)], "cs string")
    tokens = surface_words(_t(spark, sf_dir, "documents")).select("doc_id", "pos", F.col("word").alias("lemma"), F.lit(None).cast("string").alias("line"))
    return review.term_evidence(terms, tokens).select("cs", "documents", "occurrences")


def subbranches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches right under excluded types."""
    roots = spark.createDataFrame([("ECONOMY",), ("PROMO",)], "root string")
    return review.subbranch_impact(_records(spark, sf_dir), roots)


def collision_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels held with different glosses and how alike the glosses are."""
    r = _records(spark, sf_dir).withColumn("exact_match", F.when(F.col("sort") % 5 == 0, F.array("en")).otherwise(F.array().cast("array<string>")))
    found = review.collisions(r)
    return found.join(review.group_dissimilarity(found), "n").select("n", "members", F.array_join("glosses", ",").alias("glosses"), "verdict", F.round("worst", 6).alias("worst"))


def collision_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the alignment sets of labels with different glosses agree."""
    r = _records(spark, sf_dir).withColumn("exact_match", F.when(F.col("sort") % 25 == 0, F.array("en")).otherwise(F.array().cast("array<string>")))
    return review.collisions(r).select("n", "members", F.array_join("glosses", ",").alias("glosses"), "verdict")


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as subject, predicate and object."""
    bases = {f"Brand#{i}": "urn:id:" for i in range(1, 26)}
    schemes = {f"Brand#{i}": f"urn:scheme:{i}" for i in range(1, 26)}
    return sinks.triples(_records(spark, sf_dir), "Brand#1", bases, schemes)


def glossary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-column glossary in canonical order."""
    return sinks.glossary(_records(spark, sf_dir))


def rendered_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms joined under their titles."""
    t = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("pos"), F.col("p_brand").alias("theme"), F.col("p_type").alias("sub"), F.col("p_name").alias("cs"), F.lit(None).cast("string").alias("en"))
    return sinks.rendered_terms(t, "facet_sub")


def keyword_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide table of the three most frequent part names of each brand."""
    c = _t(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("doc_id"), F.col("p_name").alias("keyword")).agg(F.count(F.lit(1)).cast("double").alias("score"))
    w = Window.partitionBy("doc_id").orderBy(F.desc("score"), "keyword")
    return sinks.keyword_summary(c.withColumn("rank", F.row_number().over(w)).where("rank <= 3"), 3)


def tree_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root and level of every region, nation and customer."""
    region, nation, cust = (_t(spark, sf_dir, n) for n in ("region", "nation", "customer"))
    nodes = region.select(F.concat(F.lit("r"), "r_regionkey").alias("id")).union(nation.select(F.concat(F.lit("n"), "n_nationkey"))).union(cust.select(F.concat(F.lit("c"), "c_custkey")))
    edges = nation.select(F.concat(F.lit("n"), "n_nationkey").alias("child"), F.concat(F.lit("r"), "n_regionkey").alias("parent"))
    edges = edges.union(cust.select(F.concat(F.lit("c"), "c_custkey"), F.concat(F.lit("n"), "c_nationkey")))
    return graph.roots_of(nodes, edges)


def child_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of each nation split evenly into chunks of at most nine."""
    c = _t(spark, sf_dir, "customer")
    rank = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey"))
    return graph.chunked(c.select(F.col("c_nationkey").alias("parent"), F.col("c_custkey").alias("child"), rank.alias("rank")), 9)


def node_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of each brand as options with unique labels."""
    p = _t(spark, sf_dir, "part")
    rank = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    children = p.select(F.col("p_brand").alias("parent"), F.col("p_partkey").alias("child"), rank.alias("rank"))
    return graph.node_options(children, p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("label"), F.col("p_type").alias("en")))


_RECORDS = """r AS (SELECT p_name AS cs, p_type AS en, p_brand AS source, CAST(p_partkey AS VARCHAR) AS source_id, p_partkey AS num, p_size AS sort,
  split_part(p_name, ' ', 1) AS colour FROM part)"""
_PLACED = (
    _RECORDS
    + """,
placed AS (SELECT *, CASE
    WHEN source = 'Brand#5' AND source_id = '70' THEN 'Special' WHEN source = 'Brand#6' AND source_id = '71' THEN '__exclude__'
    WHEN source IN ('Brand#1', 'Brand#3') THEN '__exclude__' WHEN source = 'Brand#2' THEN 'Tools'
    WHEN colour = 'red' THEN 'Red' WHEN en = 'ECONOMY' THEN 'Cheap'
    WHEN contains(lower(en), 'large') THEN 'Big' WHEN contains(lower(cs), 'bolt') THEN 'Bolts' WHEN contains(lower(cs), 'ring') THEN 'Rings' ELSE 'Other' END AS theme,
  CASE WHEN (source = 'Brand#5' AND source_id = '70') OR (source = 'Brand#6' AND source_id = '71') THEN 'override:' || source || ':' || source_id
    WHEN source IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'list:' || source
    WHEN colour = 'red' THEN 'branch:red' WHEN en = 'ECONOMY' THEN 'branch:ECONOMY'
    WHEN contains(lower(en), 'large') THEN 'keyword:en:LARGE' WHEN contains(lower(cs), 'bolt') THEN 'keyword:cs:bolt' WHEN contains(lower(cs), 'ring') THEN 'keyword:cs:ring'
    ELSE 'other' END AS placed_by FROM r)"""
)
_ORDER = "source, num, source_id, cs"
_LABELS = "l AS (SELECT DISTINCT 'name' AS theme, p_name AS cs FROM part UNION SELECT DISTINCT 'type', p_type FROM part)"
_LINKS = (
    _LABELS
    + """,
parts AS (SELECT theme, cs, unnest(string_split(cs, ' ')) AS part FROM l WHERE contains(cs, ' ')),
links AS (SELECT DISTINCT p.theme, p.cs, q.theme AS part_theme, q.cs AS part_cs FROM parts p JOIN l q ON lower(p.part) = lower(q.cs) WHERE lower(p.part) <> lower(p.cs))"""
)

ORACLES = {
    "vocab_winner": f"""
WITH {_RECORDS}, k AS (SELECT *, row_number() OVER (PARTITION BY lower(cs) ORDER BY {_ORDER}) AS k FROM r)
SELECT max(CASE WHEN k = 1 THEN cs END) AS cs, max(CASE WHEN k = 1 THEN source END) AS source, max(CASE WHEN k = 1 THEN source_id END) AS source_id,
  CAST(count(*) - 1 AS INTEGER) AS n_discarded, coalesce(string_agg(CASE WHEN k > 1 THEN source_id END, ',' ORDER BY k), '') AS discarded_ids FROM k GROUP BY lower(cs)""",
    "vocab_merge": f"""
WITH {_RECORDS} SELECT cs, source, source_id FROM r
QUALIFY row_number() OVER (PARTITION BY lower(cs) ORDER BY -CAST(substr(source, 7) AS INTEGER), {_ORDER}) = 1""",
    "rule_placement": f"WITH {_PLACED} SELECT source_id, theme, placed_by FROM placed",
    "exclude_then_dedup": f"""
WITH {_PLACED} SELECT cs, source, source_id, theme FROM placed WHERE theme <> '__exclude__'
QUALIFY row_number() OVER (PARTITION BY lower(cs) ORDER BY {_ORDER}) = 1""",
    "nested_vocabulary": f"""
WITH {_PLACED}, won AS (SELECT * FROM placed WHERE theme <> '__exclude__' QUALIFY row_number() OVER (PARTITION BY lower(cs) ORDER BY {_ORDER}) = 1)
SELECT theme, CAST(CASE theme WHEN 'Big' THEN 1 WHEN 'Cheap' THEN 2 WHEN 'Tools' THEN 3 END AS INTEGER) AS theme_rank,
  CAST(row_number() OVER (PARTITION BY theme ORDER BY CAST(contains(lower(cs), 'gizmo') AS INTEGER), sort, cs) AS INTEGER) AS term_rank, cs FROM won""",
    "composite_links": f"WITH {_LINKS} SELECT * FROM links",
    "composite_same_as": f"""
WITH {_LINKS}, pairs AS (SELECT least(cs, part_cs) AS a, greatest(cs, part_cs) AS b FROM links UNION SELECT 'blue bolt', 'red bolt'),
kept AS (SELECT DISTINCT a, b FROM pairs WHERE NOT (a = 'SMALL' AND b = 'small ring') AND a <> b),
two AS (SELECT a AS cs, b AS o FROM kept UNION ALL SELECT b, a FROM kept)
SELECT cs, string_agg(o, ',' ORDER BY o) AS same_as FROM two GROUP BY cs""",
    "composite_halves": f"""
WITH {_LABELS},
h AS (SELECT cs, s[i] AS half, CAST(i AS INTEGER) AS position FROM (SELECT cs, string_split(cs, ' ') AS s, unnest(range(1, len(string_split(cs, ' ')) + 1)) AS i FROM l WHERE contains(cs, ' '))),
f AS (SELECT * FROM h WHERE lower(half) NOT IN (SELECT lower(cs) FROM l)),
m AS (SELECT lower(half) AS n, list_sort(list(DISTINCT cs)) AS every FROM f GROUP BY ALL),
s AS (SELECT f.*, list_filter(m.every, lambda x: x <> f.cs) AS shared FROM f JOIN m ON lower(f.half) = m.n),
c AS (SELECT s.cs, s.half, s.position, s.shared, CAST(count(l.cs) AS INTEGER) AS n_starts FROM s LEFT JOIN (SELECT DISTINCT cs FROM l) l
  ON l.cs <> s.cs AND starts_with(lower(l.cs), lower(s.half) || ' ') GROUP BY ALL)
SELECT cs, half, position, array_to_string(shared, '; ') AS shared_with, n_starts,
  CASE WHEN len(shared) > 0 THEN 'ambiguous' WHEN length(regexp_replace(half, '[^\\p{{L}}]', '', 'g')) < 3 THEN 'fragment' WHEN n_starts > 0 THEN 'ambiguous' ELSE 'accept' END AS verdict FROM c""",
    "case_variants": f"""
WITH {_LABELS}, n AS (SELECT DISTINCT cs FROM l UNION SELECT n_name FROM nation),
v AS (SELECT cs, CASE WHEN substr(cs, 1, 1) = upper(substr(cs, 1, 1)) THEN lower(substr(cs, 1, 1)) ELSE upper(substr(cs, 1, 1)) END || substr(cs, 2) AS variant FROM n)
SELECT variant, min(cs) AS cs FROM v WHERE variant <> cs AND variant NOT IN (SELECT cs FROM n) GROUP BY variant HAVING count(*) = 1""",
    "label_check": """
SELECT DISTINCT event_type AS label, CASE WHEN event_type = 'view' THEN 'VIEW' END AS same_folded FROM events WHERE event_type NOT IN ('VIEW', 'click', 'signup')""",
    "entity_ids": """
SELECT c_custkey, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'urn:h' END AS own, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'http://vocab.getty.edu/aat/3' END AS aat
FROM customer WHERE c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')""",
    "category_ids": """
SELECT event_id, CASE event_type WHEN 'click' THEN 'CLICK' ELSE event_type END AS category, CASE event_type WHEN 'view' THEN '1,2' WHEN 'click' THEN '3' ELSE '' END AS ids FROM events""",
    "nearest_ancestor": """
WITH t AS (
  SELECT r_name AS cs, 'place' AS theme, 'r' || r_regionkey AS source_id, [] :: VARCHAR[] AS broader FROM region
  UNION ALL SELECT n_name, 'place', 'n' || n_nationkey, ['r' || n_regionkey] FROM nation WHERE n_nationkey % 3 <> 0
  UNION ALL SELECT c_name, c_mktsegment, 'c' || c_custkey, ['r' || n_regionkey, 'n' || n_nationkey] FROM customer JOIN nation ON c_nationkey = n_nationkey),
u AS (SELECT cs, theme, source_id, unnest(broader) AS a, generate_subscripts(broader, 1) AS depth FROM t),
m AS (SELECT u.*, x.cs AS a_cs, x.theme AS a_theme FROM u JOIN t x ON u.a = x.source_id WHERE x.cs <> u.cs)
SELECT cs, theme, source_id, arg_max(a, depth) AS nearest_id, arg_max(a_cs, depth) AS nearest_cs, arg_min(a_cs, depth) AS outermost_cs, count(*) AS rungs_above,
  arg_max(a_theme, depth) = theme AND arg_min(a_theme, depth) = theme AS same_theme FROM m GROUP BY cs, theme, source_id""",
    "exclusion_impact": f"""
WITH {_PLACED}, e AS (SELECT placed_by AS rule, count(*) AS term_count, array_to_string(list_slice(list_sort(list(DISTINCT cs)), 1, 10), '; ') AS sample_terms
  FROM placed WHERE theme = '__exclude__' GROUP BY placed_by)
SELECT rule, split_part(rule, ':', 1) AS kind, regexp_replace(rule, '^[^:]*:', '') AS ident, term_count,
  CASE WHEN rule = 'list:Brand#1' THEN 'decided' ELSE 'undecided' END AS status, CASE WHEN rule = 'list:Brand#1' THEN 'old brand' ELSE '' END AS reason, sample_terms FROM e""",
    "reinstatement": f"""
WITH {_PLACED}, o AS (SELECT DISTINCT lower(cs) AS n FROM placed WHERE theme NOT IN ('__exclude__', 'Other')),
e AS (SELECT placed_by AS rule, cs, en, lower(cs) AS n, lower(cs) IN (SELECT n FROM o) AS have, row_number() OVER (PARTITION BY placed_by, lower(cs) ORDER BY {_ORDER}) AS k
  FROM placed WHERE theme = '__exclude__')
SELECT rule, count(*) AS raw_count, count(DISTINCT CASE WHEN NOT have THEN n END) AS usable_count, count(DISTINCT CASE WHEN have THEN n END) AS collides_with_offered,
  CAST(round(sum(CASE WHEN k = 1 AND NOT have THEN length(cs || ' (' || en || ')') + 2 ELSE 0 END) / 3.35::DOUBLE) AS BIGINT) AS prompt_token_delta FROM e GROUP BY rule""",
    "budget_prefix": """
WITH t AS (SELECT p_brand AS theme, sum(length(p_name || ' (' || p_type || ')') + 2) OVER (ORDER BY p_brand, p_partkey ROWS UNBOUNDED PRECEDING) AS used FROM part),
w AS (SELECT CAST(unnest([4096, 8192, 32768]) AS INTEGER) AS "window"),
c AS (SELECT "window", theme, count(*) AS terms, count(*) FILTER (used <= ("window" - 2560) * 3.35::DOUBLE) AS surviving FROM w, t GROUP BY ALL)
SELECT "window", theme, terms, surviving, terms - surviving AS dropped, CASE WHEN surviving = terms THEN 'full' WHEN surviving > 0 THEN 'partial' ELSE 'none' END AS status FROM c""",
    "largest_prefix": """
WITH t AS (SELECT row_number() OVER (ORDER BY p_partkey) AS k, sum(length(p_name)) OVER (ORDER BY p_partkey ROWS UNBOUNDED PRECEDING) AS used FROM part)
SELECT CAST(CASE WHEN max(used) <= 9000 THEN max(k) ELSE least(coalesce(max(CASE WHEN used <= 9000 THEN k END), 0), greatest(max(k) - 1, 0)) END AS INTEGER) AS kept FROM t""",
    "theme_census": f"""
WITH {_PLACED}, p AS (SELECT *, dense_rank() OVER (ORDER BY theme) AS rank FROM placed WHERE theme <> '__exclude__'),
b AS (SELECT theme, CAST(min(rank) AS INTEGER) AS rank, count(*) AS terms, CAST(sum(length(cs || ' (' || en || ')') + 2) AS BIGINT) AS chars, count(DISTINCT source) AS sources FROM p GROUP BY theme),
q AS (SELECT theme, placed_by, count(*) AS n FROM p GROUP BY theme, placed_by QUALIFY row_number() OVER (PARTITION BY theme ORDER BY count(*) DESC, placed_by) <= 4),
t AS (SELECT theme, string_agg(placed_by || ' (' || n || ')', '; ' ORDER BY n DESC, placed_by) AS top_rules FROM q GROUP BY theme)
SELECT theme, rank, terms, round(terms / (sum(terms) OVER ())::DOUBLE, 9) AS share, chars, CAST(sum(chars) OVER (ORDER BY rank ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_chars, sources, top_rules
FROM b JOIN t USING (theme)""",
    "branch_evidence": f"""
WITH {_PLACED}, i AS (SELECT CAST(l_partkey AS VARCHAR) AS source_id, l_suppkey AS doc_id, count(*) AS n FROM lineitem GROUP BY ALL),
h AS (SELECT placed_by AS rule, cs AS lemma, doc_id, n FROM placed JOIN i USING (source_id) WHERE theme = '__exclude__'),
o AS (SELECT DISTINCT cs AS lemma FROM placed WHERE theme = 'Cheap'),
d AS (SELECT h.*, lemma NOT IN (SELECT lemma FROM o) AS own FROM h)
SELECT rule, count(DISTINCT lemma) AS terms, CAST(sum(n) AS BIGINT) AS occurrences, count(DISTINCT CASE WHEN own THEN lemma END) AS unique_terms,
  CAST(sum(CASE WHEN own THEN n ELSE 0 END) AS BIGINT) AS unique_occurrences, count(DISTINCT doc_id) AS documents,
  array_to_string(list_slice(list_sort(coalesce(list(DISTINCT lemma) FILTER (own), [])), 1, 10), '; ') AS unique_samples,
  array_to_string(list_slice(list_sort(coalesce(list(DISTINCT lemma) FILTER (NOT own), [])), 1, 10), '; ') AS shared_samples FROM d GROUP BY rule""",
    "term_evidence": """
WITH words AS (SELECT doc_id, unnest(string_split_regex(lower(trim(text)), '[ \\t\\n\\x0B\\f\\r]+')) AS word FROM documents),
t AS (SELECT unnest(['the', 'une', 'nowhere', 'DER']) AS cs),
h AS (SELECT cs, doc_id FROM t LEFT JOIN words ON lower(cs) = word)
SELECT cs, count(DISTINCT doc_id) AS documents, count(doc_id) AS occurrences FROM h GROUP BY cs""",
    "subbranches": f"""
WITH {_RECORDS} SELECT en AS root, colour AS child, count(*) AS term_count, count(DISTINCT lower(cs)) AS usable_count,
  array_to_string(list_slice(list_sort(list(DISTINCT cs)), 1, 10), '; ') AS sample_terms FROM r WHERE en IN ('ECONOMY', 'PROMO') GROUP BY ALL""",
    "collision_verdicts": f"""
WITH {_RECORDS}, o AS (SELECT lower(cs) AS n, lower(en) AS g, CASE WHEN sort % 25 = 0 THEN en END AS x, row_number() OVER (PARTITION BY lower(cs) ORDER BY {_ORDER}) AS k FROM r),
c AS (SELECT n, count(*) AS members, list_sort(list(DISTINCT g)) AS glosses, list(x ORDER BY k) FILTER (x IS NOT NULL) AS sets FROM o GROUP BY n)
SELECT n, members, array_to_string(glosses, ',') AS glosses, CASE WHEN coalesce(len(sets), 0) = 0 THEN 'none' WHEN len(sets) = 1 THEN 'one_sided'
  WHEN len(list_distinct(sets)) = 1 THEN 'agreeing' ELSE 'conflicting' END AS verdict FROM c WHERE len(glosses) > 1""",
    "triples": f"""
WITH {_RECORDS}, u AS (SELECT *, 'urn:part:' || source_id AS s FROM r)
SELECT DISTINCT * FROM (
  SELECT s, 'rdf:type' AS p, 'uri' AS kind, 'skos:Concept' AS o, NULL :: VARCHAR AS lang FROM u
  UNION ALL SELECT s, 'skos:inScheme', 'uri', 'urn:scheme:' || substr(source, 7), NULL FROM u
  UNION ALL SELECT s, 'skos:notation', 'lit', source_id, NULL FROM u
  UNION ALL SELECT s, 'skos:prefLabel', 'lit', cs, 'cs' FROM u
  UNION ALL SELECT s, 'skos:prefLabel', 'lit', en, 'en' FROM u
  UNION ALL SELECT s, 'skos:broader', 'uri', 'urn:id:' || colour, NULL FROM u WHERE source = 'Brand#1'
  UNION ALL SELECT s, 'skos:broaderTransitive', 'uri', 'urn:id:' || en, NULL FROM u WHERE source = 'Brand#1'
  UNION ALL SELECT s, 'skos:related', 'uri', 'urn:id:' || en, NULL FROM u WHERE source <> 'Brand#1'
  UNION ALL SELECT s, 'skos:related', 'uri', 'urn:id:' || colour, NULL FROM u WHERE source <> 'Brand#1')""",
    "glossary": "SELECT p_name AS cs, p_type AS en FROM part",
    "rendered_terms": """
SELECT p_brand || ' / ' || p_type AS title, string_agg(p_name || ' ()', '; ' ORDER BY p_partkey) AS block FROM part GROUP BY ALL""",
    "keyword_summary": """
WITH g AS (SELECT p_brand, p_name, CAST(count(*) AS DOUBLE) AS score FROM part GROUP BY p_brand, p_name),
c AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, p_name) AS k FROM g)
SELECT p_brand AS document_id, max(CASE WHEN k = 1 THEN p_name END) AS "kw-1", max(CASE WHEN k = 1 THEN score END) AS "score-1",
  max(CASE WHEN k = 2 THEN p_name END) AS "kw-2", max(CASE WHEN k = 2 THEN score END) AS "score-2", max(CASE WHEN k = 3 THEN p_name END) AS "kw-3", max(CASE WHEN k = 3 THEN score END) AS "score-3"
FROM c GROUP BY p_brand""",
    "tree_depth": """
WITH RECURSIVE e AS (SELECT 'n' || n_nationkey AS child, 'r' || n_regionkey AS parent FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer),
up AS (SELECT 'r' || r_regionkey AS id, 'r' || r_regionkey AS root, CAST(0 AS INTEGER) AS level FROM region
  UNION ALL SELECT e.child, u.root, u.level + 1 FROM up u JOIN e ON u.id = e.parent)
SELECT id, root, level FROM up""",
    "child_chunks": """
WITH c AS (SELECT c_nationkey AS parent, c_custkey AS child, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS INTEGER) AS rank, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer)
SELECT parent, child, rank, CAST(floor((rank - 1) / ceil(n / ceil(n / 9))) AS INTEGER) AS chunk FROM c""",
    "node_options": """
WITH c AS (SELECT p_brand AS parent, p_partkey AS child, p_name, p_type, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS INTEGER) AS rank FROM part),
a AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY parent, p_name ORDER BY rank) > 1 THEN p_name || ' [' || p_type || ']' ELSE p_name END AS l1 FROM c)
SELECT parent, rank, CASE WHEN row_number() OVER (PARTITION BY parent, l1 ORDER BY rank) > 1 THEN l1 || ' <' || child || '>' ELSE l1 END AS label, child FROM a""",
}

QUERIES = {
    f.__name__: f
    for f in (
        vocab_winner, vocab_merge, rule_placement, exclude_then_dedup, nested_vocabulary, composite_links, composite_same_as, composite_halves,
        case_variants, label_check, entity_ids, category_ids, nearest_ancestor, exclusion_impact, reinstatement, budget_prefix, largest_prefix,
        theme_census, branch_evidence, term_evidence, subbranches, collision_review, collision_verdicts, triples, glossary, rendered_terms,
        keyword_summary, tree_depth, child_chunks, node_options,
    )
}
