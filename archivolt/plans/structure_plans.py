"""Queries of schema checks, decision walks, harvests and versioned tables over the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from archivolt.operators import enrich, schema, sinks, versions, walk
from archivolt.operators import records as records_
from archivolt.operators.graph import cut, shared_folder
from archivolt.sources import harvest
from archivolt.sources import records as R


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- schema

BRANDS = [f"Brand#{i}" for i in range(1, 19)]
PART_SCHEMA = {
    "type": "object",
    "required": ["id", "name"],
    "dependentRequired": {"owner": ["name"]},
    "additionalProperties": False,
    "properties": {
        "id": {"type": "integer", "minimum": 0},
        "name": {"type": "string", "minLength": 9, "maxLength": 11, "pattern": "^(red|blue|hot) "},
        "size": {"type": "integer", "minimum": 3, "exclusiveMaximum": 45, "multipleOf": 1},
        "brand": {"enum": BRANDS},
        "price": {"type": ["number", "null"], "anyOf": [{"maximum": 930}, {"exclusiveMinimum": 950.5}]},
        "words": {"type": "array", "minItems": 2, "maxItems": 2, "uniqueItems": True, "items": {"$ref": "#/$defs/word"}},
        "owner": {"oneOf": [{"required": ["code"]}, {"properties": {"kind": {"const": "STANDARD"}}, "required": ["kind"]}]},
    },
    "not": {"required": ["extra", "owner"]},
    "if": {"properties": {"size": {"minimum": 40}}, "required": ["size"]},
    "then": {"properties": {"brand": {"not": {"const": "Brand#9"}}}},
    "$defs": {"word": {"type": "string", "minLength": 4, "pattern": "[aeiou].*[aeiou]|[gr]"}},
}


def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records in JSON, with faults at some of them, against a schema."""
    size, key, words = F.col("p_size"), F.col("p_partkey"), F.split("p_name", " ")
    record = F.struct(
        key.alias("id"),
        F.when(size % 9 > 0, F.col("p_name")).alias("name"),
        size.alias("size"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
        F.when(size % 5 == 0, F.concat(words, F.slice(words, 1, 1))).otherwise(words).alias("words"),
        F.when(key % 11 == 0, F.lit("x")).alias("extra"),
        F.when(size % 7 == 0, F.struct(F.col("p_type").alias("kind"), F.when(key % 2 == 0, F.lit("c")).alias("code"))).alias("owner"),
    )
    records = _t(spark, sf_dir, "part").select(key.alias("id"), F.to_json(record).alias("record"))
    records = records.repartition(1 + records.count() // schema.TASK_RECORDS, "id")  # rows that are small to read and long to check
    return schema.schema_problems(records, PART_SCHEMA, json_col="record", key="id")


_BRANDS = ", ".join(f"'{b}'" for b in BRANDS)
_WORD = "regexp_matches({w}, '[aeiou].*[aeiou]|[gr]')"
#: In the order of the problems: path, keyword, and when a part has it.
_FAULTS = [
    ("/name", "required", "p_size % 9 = 0"),
    ("/name", "dependentRequired", "p_size % 7 = 0 AND p_size % 9 = 0"),
    ("/extra", "additionalProperties", "p_partkey % 11 = 0"),
    ("/name", "minLength", "p_size % 9 > 0 AND length(p_name) < 9"),
    ("/name", "maxLength", "p_size % 9 > 0 AND length(p_name) > 11"),
    ("/name", "pattern", "p_size % 9 > 0 AND NOT regexp_matches(p_name, '^(red|blue|hot) ')"),
    ("/size", "minimum", "p_size < 3"),
    ("/size", "exclusiveMaximum", "p_size >= 45"),
    ("/brand", "enum", f"p_brand NOT IN ({_BRANDS})"),
    ("/price", "anyOf", "p_retailprice > 930 AND p_retailprice <= 950.5"),
    ("/words", "maxItems", "p_size % 5 = 0"),
    ("/words", "uniqueItems", "p_size % 5 = 0"),
    ("/words/0", "minLength", "length(w[1]) < 4"),
    ("/words/0", "pattern", f"NOT {_WORD.format(w='w[1]')}"),
    ("/words/1", "minLength", "length(w[2]) < 4"),
    ("/words/1", "pattern", f"NOT {_WORD.format(w='w[2]')}"),
    ("/words/2", "minLength", "p_size % 5 = 0 AND length(w[1]) < 4"),
    ("/words/2", "pattern", f"p_size % 5 = 0 AND NOT {_WORD.format(w='w[1]')}"),
    ("/owner", "oneOf", "p_size % 7 = 0 AND (p_partkey % 2 = 0) = (p_type = 'STANDARD')"),
    ("", "not", "p_partkey % 11 = 0 AND p_size % 7 = 0"),
    ("/brand", "not", "p_size >= 40 AND p_brand = 'Brand#9'"),
]
_FOUND = " UNION ALL ".join(f"SELECT p_partkey AS id, {i} AS k, '{path}' AS path, '{word}' AS keyword FROM p WHERE {bad}" for i, (path, word, bad) in enumerate(_FAULTS))

# ---- walks


def _tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, their nations, their suppliers: parent, child, rank and a number for answers."""
    region, nation, supplier = (_t(spark, sf_dir, n) for n in ("region", "nation", "supplier"))
    name = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    edges = region.select(F.lit("all").alias("parent"), name("r", "r_regionkey").alias("child"), (F.col("r_regionkey") * 7 + 1).cast("long").alias("num"))
    edges = edges.union(nation.select(name("r", "n_regionkey"), name("n", "n_nationkey"), (F.col("n_nationkey") * 13 + 5).cast("long")))
    edges = edges.union(supplier.select(name("n", "s_nationkey"), name("s", "s_suppkey"), F.col("s_suppkey").cast("long")))
    return edges.withColumn("rank", F.row_number().over(Window.partitionBy("parent").orderBy("num")))


def decision_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer placed in the tree of regions, nations and suppliers, by answers in whole numbers."""
    terms = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    answer = F.pmod(F.col("id") * 31 + F.col("num") * 17, F.lit(101))
    found = walk.walk(terms, _tree(spark, sf_dir), F.lit("all"), answer, least=F.lit(60), accept=F.lit(85), most_options=3)
    return found.select("id", "node", "questions")


# ---- harvests and versions


def _saved_pages(records: DataFrame, folder: str) -> str:
    """Records (pos, id, cs, en) as saved pages of a harvest, eight or more of some ``PAGE_RECORDS``, written by Spark; each names
    the next. Ranges of positions are pages, numbered without those that got no record."""
    ranges = max(8, -(-records.count() // PAGE_RECORDS))
    dealt = cut(records.repartitionByRange(ranges, "pos").withColumn("range", F.spark_partition_id()))
    numbers = dealt.select("range").distinct().select("range", (F.row_number().over(Window.orderBy("range")) - 1).alias("page"))  # a row for each page
    last = numbers.count() - 1
    records, place = dealt.join(F.broadcast(numbers), "range"), F.col("page")
    record = F.concat(F.lit("<record><identifier>"), "id", F.lit('</identifier><heslo xml:lang="cs">'), "cs", F.lit("</heslo><heslo_en>"), "en", F.lit("</heslo_en></record>"))
    page = records.select("pos", place.alias("page"), record.alias("x")).groupBy("page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda r: r["x"]), "").alias("body"))
    token = F.when(F.col("page") < last, F.concat(F.lit("next/"), F.col("page") + 1)).otherwise("")
    request = F.when(F.col("page") == 0, harvest.FIRST).otherwise(F.concat(F.lit("next/"), "page"))
    text = F.concat(F.lit("<OAI>"), "body", F.lit("<resumptionToken>"), token, F.lit("</resumptionToken></OAI>"))
    page.select(text.alias("value"), request.alias("request")).write.partitionBy("request").text(folder)
    return folder


def _harvested(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The table and the changes of two harvests of parts, of which some appear, change or vanish between the two."""
    key, size = F.col("p_partkey"), F.col("p_size")
    parts = _t(spark, sf_dir, "part").select(key.alias("pos"), key.cast("string").alias("id"), F.col("p_name").alias("cs"), F.col("p_type").alias("en"), size.alias("size"))
    folder = shared_folder(spark)
    one = _saved_pages(parts.where("size > 5").drop("size"), f"{folder}/one")
    again = parts.select("pos", "id", F.lit("late").alias("cs"), "en", (F.col("size") + 0).alias("size")).withColumn("pos", F.col("pos") + 10**9)  # ids that come twice
    later = parts.withColumn("en", F.when(F.col("size") % 7 == 0, F.upper("cs")).otherwise(F.col("en"))).union(again).where("size < 45")
    two = _saved_pages(later.drop("size"), f"{folder}/two")
    harvest.load_or_sync(spark, f"{folder}/labels", one, f"{folder}/first", sync=True)
    return harvest.load_or_sync(spark, f"{folder}/labels", two, f"{folder}/second", sync=True)


def harvest_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels after two harvests through the data source, page by page as a stream; the first record of each id counts."""
    return _harvested(spark, sf_dir)[0]


def harvest_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second harvest added, changed and took away."""
    return _harvested(spark, sf_dir)[1]


def versioned_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three commits to a table of parts, and in which of its versions each part stands at what price."""
    parts = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"), F.col("p_size").alias("size"))
    path = f"{shared_folder(spark)}/prices"
    versions.replace_table(parts, path)
    versions.commit(spark, path, lambda t: t.withColumn("price", F.when(F.col("size") % 3 == 0, F.col("price") * 2).otherwise(F.col("price"))))
    versions.commit(spark, path, lambda t: t.where("size % 4 > 0"))
    found = [versions.read(spark, path, n).select("id", "price", F.lit(n).alias("version")) for n in versions.numbers(spark, path)]
    return found[0].union(found[1]).union(found[2])


# ---- files that are written and read again


def flat_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as flat vocabulary archives, one of each brand, with markup at the edges of labels."""
    marked = F.concat(F.lit("**"), "p_name", F.lit(" _"))
    term = F.struct(F.when(F.col("p_size") % 3 == 0, marked).otherwise(F.col("p_name")).alias("cs"), F.when(F.col("p_size") % 4 == 0, "* _").otherwise(F.col("p_type")).alias("en"), F.col("p_partkey").cast("string").alias("source_id"), F.array("p_brand").alias("broader"), F.col("p_size").alias("sort"))
    path = f"{shared_folder(spark)}/flat"
    _t(spark, sf_dir, "part").groupBy("p_brand").agg(F.collect_list(term).alias("terms")).select(F.to_json(F.struct("terms")).alias("value"), "p_brand").write.partitionBy("p_brand").text(path)
    return R.flat_vocabulary(spark, f"{path}/*").select("source_id", "cs", "en", F.array_join("broader", ",").alias("broader"), "sort")


#: Lines in a file of a run, and records in a page of a harvest, about.
FILE_LINES, PAGE_RECORDS = 20_000, 100_000


def _scanned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Conversations as a run of each role, in files of some ``FILE_LINES`` lines; the run of one role has a file that breaks off."""
    text = F.coalesce("text", F.lit(""))
    first = F.regexp_extract(F.lower(text), "[a-z]{3,}", 0)
    enriched = F.struct(F.array(first).alias("extracted_keywords_cs"), F.when(F.col("turn") % 2 == 0, first).otherwise("zzzzz").alias("teater_category"), (F.col("turn") / 10).alias("confidence_score"))
    line = F.struct(F.col("conv_id").cast("string").alias("file_id"), F.when(F.col("turn") % 5 == 4, "x").otherwise("1").alias("page"), F.col("turn").cast("string").alias("line"), text.alias("original_text"), enriched.alias("enrichment"))
    turns = _t(spark, sf_dir, "conversations")
    file = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(1 + turns.count() // FILE_LINES))
    runs = turns.groupBy("role", file.alias("file")).agg(F.to_json(F.collect_list(line)).alias("value"))
    first = runs.where("role = 'assistant'").agg(F.min("file").alias("file"))
    broken = runs.where("role = 'assistant'").join(first, "file", "left_semi").select(F.expr("left(value, length(value) div 2)").alias("value"), "role")
    path = f"{shared_folder(spark)}/runs"
    # a file of Spark's JSON reader is a task: no more than a group of lines in each
    runs.select("value", "role").write.option("maxRecordsPerFile", 1).partitionBy("role").text(path)
    broken.write.mode("append").partitionBy("role").text(path)
    return R.run_picks(spark, path, "*/part-*")


def run_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Picks of all runs and their support, and how many of a run's files can't be read."""
    picks, bad = _scanned(spark, sf_dir)
    found = picks.groupBy("run").agg(F.count(F.lit(1)).alias("picks"), F.count_if("supported").alias("supported"), F.count_distinct("file_id").alias("files"))
    return found.join(bad.groupBy("run").agg(F.count(F.lit(1)).alias("unreadable")), "run", "left").select(F.split_part("run", F.lit("="), F.lit(2)).alias("run"), "picks", "supported", "files", F.coalesce("unreadable", F.lit(0)).alias("unreadable"))


def reviewed_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Halves of part names by a review sheet, without those that are accepted for two names."""
    part, even = _t(spark, sf_dir, "part"), F.col("p_size") % 2 == 0
    halves = part.select(F.explode(F.split("p_name", " ")).alias("word"), "p_name", "p_brand", "p_size", "p_partkey")
    rows = halves.select(
        F.concat_ws("-", "word", "p_brand", F.col("p_partkey") % 40).alias("half"), F.concat(F.lit(" "), "p_name").alias("composite"),
        F.when(F.col("p_size") % 7 == 0, "reject").otherwise(" ").alias("verdict"), F.when(even, "accept").otherwise("ambiguous").alias("auto_verdict"),
    )
    path = f"{shared_folder(spark)}/sheet"
    sinks.write_csv(rows, path, ["half", "composite", "verdict", "auto_verdict"])
    return R.accepted_halves(R.review_sheet(spark, path))


def keyword_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts' keywords by brand, written as a folder of CSV for each brand and read again."""
    ranked = _t(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("doc_id"), F.col("p_name").alias("keyword")).agg(F.sum("p_size").cast("double").alias("score"))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("score"), "keyword")))
    path = f"{shared_folder(spark)}/keywords"
    sinks.write_keyword_files(ranked, path)
    return spark.read.option("header", True).schema("keyword string, score double, doc_id string").csv(path).select("doc_id", "keyword", "score")


def migrated_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations' turns as pages of an older schema: indexes, states and scores filled or emptied on reading."""
    turns = _t(spark, sf_dir, "conversations")
    label = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("p"), F.col("turn").cast("string"))).otherwise((F.col("turn") - 1).cast("string"))
    pages = turns.select(
        F.col("conv_id").alias("doc_id"), label.alias("page"), (F.col("turn") + 1).alias("pos"), F.when(F.col("turn") % 5 == 0, F.lit(99)).alias("page_index"),
        F.when(F.col("turn") % 4 == 1, "empty").alias("content_status"), F.lit(0.5).alias("quality_score"),
    )
    lines = turns.where("length(text) > 40").select(F.col("conv_id").alias("doc_id"), label.alias("page"))
    return records_.migrated_pages(pages, lines).select("doc_id", "pos", "page_index", "content_status", "quality_score")


def checked_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies made of parts: variants to labels, confidence clamped, a sentinel without keywords, and what is wrong."""
    size = F.col("p_size")
    confidence = F.when(size % 9 == 0, F.lit("none")).otherwise((size / 20 - 0.5).cast("string"))
    good = F.to_json(F.struct(F.when(size % 8 > 0, F.col("p_type")).alias("category"), F.split("p_name", " ").alias("keywords_cs"), confidence.alias("confidence_score")))
    reply = F.when(size % 11 == 0, F.lit("[1]")).when(size % 13 == 0, F.concat(F.lit("{"), "p_name")).otherwise(good)
    variants = spark.createDataFrame([("ECONOMY", "Economy"), ("STANDARD", "Standard"), ("STANDARD", "Usual")], "variant string, label string")
    found = enrich.checked_replies(_t(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), reply.alias("reply")), variants, sentinel="Standard")
    return found.select("id", "category", F.array_join("keywords_cs", ",").alias("keywords"), "confidence", "problem")


_TREE = """
k AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY num) AS rank FROM (
  SELECT 'all' AS parent, 'r' || r_regionkey AS child, CAST(r_regionkey * 7 + 1 AS BIGINT) AS num FROM region
  UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey, n_nationkey * 13 + 5 FROM nation UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey, s_suppkey FROM supplier))"""

ORACLES = {
    "flat_archive": """
SELECT CAST(p_partkey AS VARCHAR) AS source_id, p_name AS cs, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_type END AS en, p_brand AS broader, p_size AS sort FROM part""",
    "run_scan": """
WITH c AS (SELECT *, coalesce(text, '') AS t, regexp_extract(lower(coalesce(text, '')), '[a-z]{3,}', 0) AS w FROM conversations)
SELECT role AS run, count(*) AS picks, count(*) FILTER (turn % 2 = 0 AND w <> '') AS supported, count(DISTINCT conv_id) AS files, CAST(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS BIGINT) AS unreadable
FROM c WHERE turn % 5 <> 4 GROUP BY role""",
    "reviewed_halves": """
WITH h AS (SELECT unnest(string_split(p_name, ' ')) || '-' || p_brand || '-' || (p_partkey % 40) AS half, p_name AS composite FROM part WHERE p_size % 7 <> 0 AND p_size % 2 = 0)
SELECT half, min(composite) AS composite FROM h GROUP BY half HAVING count(DISTINCT composite) = 1""",
    "keyword_files": "SELECT p_brand AS doc_id, p_name AS keyword, CAST(sum(p_size) AS DOUBLE) AS score FROM part GROUP BY ALL",
    "migrated_page_rows": """
WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'p' || turn ELSE CAST(turn - 1 AS VARCHAR) END AS page, text FROM conversations),
l AS (SELECT DISTINCT conv_id, page FROM c WHERE length(text) > 40),
p AS (SELECT c.*, coalesce(CASE WHEN turn % 4 = 1 THEN 'empty' END, CASE WHEN l.page IS NOT NULL THEN 'text' ELSE 'empty' END) AS status FROM c LEFT JOIN l USING (conv_id, page))
SELECT conv_id AS doc_id, turn + 1 AS pos, CAST(CASE WHEN turn % 5 = 0 THEN 99 WHEN turn % 3 > 0 AND turn > 1 THEN turn - 1 ELSE turn + 1 END AS INTEGER) AS page_index, status AS content_status,
  CASE WHEN status <> 'empty' THEN CAST(0.5 AS DOUBLE) END AS quality_score FROM p""",
    "checked_replies": """
WITH p AS (SELECT *, CASE WHEN p_size % 11 = 0 OR p_size % 13 = 0 THEN 'no object' WHEN p_size % 9 = 0 THEN 'no confidence' WHEN p_size % 8 = 0 THEN 'no category' END AS problem,
  CASE p_type WHEN 'ECONOMY' THEN 'Economy' WHEN 'STANDARD' THEN 'Standard' ELSE p_type END AS label FROM part)
SELECT p_partkey AS id, CASE WHEN problem IS NULL THEN label END AS category, CASE WHEN problem IS NULL THEN CASE WHEN label = 'Standard' THEN '' ELSE replace(p_name, ' ', ',') END END AS keywords,
  CASE WHEN problem IS NULL THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, p_size / 20::DOUBLE - 0.5::DOUBLE)) END AS confidence, problem FROM p""",
    "harvest_sync": """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS cs, CASE WHEN p_size % 7 = 0 THEN upper(p_name) ELSE p_type END AS en FROM part WHERE p_size < 45""",
    "harvest_changes": """
SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_size <= 5 THEN 'added' WHEN p_size >= 45 THEN 'gone' ELSE 'changed' END AS change FROM part WHERE p_size <= 5 OR p_size >= 45 OR p_size % 7 = 0""",
    "versioned_prices": """
WITH p AS (SELECT p_partkey AS id, p_size, p_retailprice AS one, CASE WHEN p_size % 3 = 0 THEN 2 * p_retailprice ELSE p_retailprice END AS two FROM part)
SELECT id, one AS price, 1 AS version FROM p UNION ALL SELECT id, two, 2 FROM p UNION ALL SELECT id, two, 3 FROM p WHERE p_size % 4 > 0""",
    "decision_walk": f"""
WITH RECURSIVE {_TREE},
w(id, node, score, path) AS (SELECT c_custkey, 'all', CAST(NULL AS BIGINT), CAST([] AS BIGINT[]) FROM customer
  UNION ALL SELECT w.id, k.child, (w.id * 31 + k.num * 17) % 101, list_concat(w.path, [-((w.id * 31 + k.num * 17) % 101), k.rank]) FROM w JOIN k ON k.parent = w.node
  WHERE (w.id * 31 + k.num * 17) % 101 >= 60),
e AS (SELECT id, arg_min(node, list_concat(path, [1000000])) AS node, min(list_concat(path, [1000000])) AS last FROM w WHERE score >= 85 GROUP BY id),
n AS (SELECT parent, count(*) AS n FROM k GROUP BY parent),
q AS (SELECT w.id, any_value(e.node) AS node, CAST(coalesce(sum(n.n), 0) AS BIGINT) AS questions FROM w LEFT JOIN e USING (id) LEFT JOIN n ON n.parent = w.node WHERE e.last IS NULL OR w.path < e.last GROUP BY w.id)
SELECT id, node, questions FROM q""",
    "schema_check": f"""
WITH p AS (SELECT *, string_split(p_name, ' ') AS w FROM part), f AS ({_FOUND}),
g AS (SELECT id, arg_min(path, k) AS path, arg_min(keyword, k) AS keyword, count(*) AS n FROM f GROUP BY id)
SELECT p_partkey AS id, path, keyword, CAST(coalesce(n, 0) AS INTEGER) AS problems FROM p LEFT JOIN g ON g.id = p_partkey""",
}

QUERIES = {
    f.__name__: f
    for f in (
        schema_check, decision_walk, harvest_sync, harvest_changes, versioned_prices, flat_archive, run_scan, reviewed_halves, keyword_files, migrated_page_rows,
        checked_replies,
    )
}
