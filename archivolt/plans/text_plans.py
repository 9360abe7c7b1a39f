"""Queries of the line and text operators over ``conversations`` and ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.functions import scalars as S
from archivolt.operators import enrich, lines, ranking
from archivolt.operators import keywords as K
from archivolt.operators.tasks import dealt


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as lines: a page is three turns, system turns are headings, every fourth turn is noise."""
    categ = F.when(F.col("role") == "system", "Header").when(F.col("turn") % 4 == 3, "Trash").otherwise("Clear")
    page = F.floor(F.col("turn") / 3).cast("string")
    return _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("pos"), page.alias("page"), F.col("turn").alias("line"), "text", categ.alias("categ"), "role")


def page_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns joined by role, roles in order of first appearance."""
    df = _turns(spark, sf_dir).withColumn("page", F.col("role"))
    return lines.pages_of(df).select("doc_id", "page_pos", "page", "text", "n_lines")


def document_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as their regrouped pages joined."""
    return lines.documents_of(lines.pages_of(_turns(spark, sf_dir).withColumn("page", F.col("role"))))


def line_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality decision on every document as a line."""
    labels = _t(spark, sf_dir, "labels").select("doc_id", "toxic")
    quality = F.when(F.col("n_chars") % 5 == 0, " ").when(F.col("n_chars") % 7 == 0, "n/a").otherwise(F.concat(F.lit("0."), F.lpad((F.col("n_chars") % 1000).cast("string"), 3, "0")))
    categ = F.when(F.col("lang") == "fr", "Non-text").when(F.col("toxic") == 1, "Trash").when(F.col("toxic") == 0, "Clear").otherwise("")
    df = _t(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    decision = lines.line_decision(F.col("text"), categ, S.safe_double(quality), min_chars=100, min_chars_non_text=300, min_letter_ratio=0.8)
    return df.select("doc_id", decision.alias("d")).select("doc_id", "d.band", "d.keep", "d.reason")


def context_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context of every turn."""
    return lines.context_windows(_turns(spark, sf_dir)).select("doc_id", "pos", "context")


def context_window_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same contexts with documents split over ranges of positions."""
    return lines.context_windows_split(_turns(spark, sf_dir), partitions=16).select("doc_id", "pos", "context")


def word_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping chunks of 400 words of every document."""
    df = _t(spark, sf_dir, "documents").select("doc_id", S.words_of(F.col("text")).alias("w"))
    chunks = df.select("doc_id", F.posexplode(K.word_chunks(F.col("w"))).alias("chunk_no", "c"))
    return chunks.select("doc_id", "chunk_no", F.size("c").alias("n_words"), F.md5(F.array_join("c", " ")).alias("digest"))


def fitted_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of words halved until each has 600 characters at most."""
    df = _t(spark, sf_dir, "documents").select("doc_id", S.words_of(F.col("text")).alias("w"))
    cost = lambda c: F.length(F.array_join(c, ""))
    chunks = K.fitted_chunks(K.word_chunks(F.col("w")), cost, 600)
    return df.select("doc_id", F.posexplode(chunks).alias("pos", "c")).select("doc_id", "pos", F.size("c").alias("n_words"), F.md5(F.array_join("c", " ")).alias("digest"))


def stub_vectors(phrases: list[str]):
    """A stand-in encoder: the sum of the digests of a phrase's words."""
    import hashlib

    import numpy as np

    words = [[np.frombuffer(hashlib.sha256(w.lower().encode()).digest(), np.uint8).astype(float) - 100 for w in p.split()] for p in phrases]
    return np.array([np.sum(w, axis=0) + 1e-3 * len(p) * np.arange(32) for w, p in zip(words, phrases, strict=True)])


def chunk_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of turns by a stand-in encoder, best over chunks of twelve words."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("([A-Za-z]+)"), F.lit(1))
    df = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.explode(K.word_chunks(words, 12, 2)).alias("words"))
    return ranking.rank_chunks(df, stub_vectors, 4)


def best_score_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best share of each word over a document's chunks, then the top five."""
    df = dealt(_t(spark, sf_dir, "documents").select("doc_id", "text"), "text", "doc_id")  # the one exchange: all that follows is within a document
    df = df.select("doc_id", S.words_of(F.lower("text")).alias("w"))
    chunks = df.select("doc_id", F.posexplode(K.word_chunks(F.col("w"))).alias("chunk_no", "c"))
    words = chunks.select("doc_id", "chunk_no", F.size("c").alias("n"), F.explode("c").alias("word")).where(F.length("word") > 3)
    scored = words.groupBy("doc_id", "chunk_no", "word").agg((F.count(F.lit(1)) / F.first("n")).alias("score"))
    return K.best_score_merge(scored, ["doc_id"], "word", "score", 5).select("doc_id", "rank", "word", "score")


def form_lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent word of each four-letter form, the first seen among equals."""
    words = K.surface_words(dealt(_t(spark, sf_dir, "documents").select("doc_id", "text"), "text", "doc_id"))
    tokens = words.select("doc_id", "pos", F.substring("word", 1, 4).alias("form"), F.col("word").alias("lemma"))
    return lines.form_lemmas(tokens)


def stem_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether neighbouring turns share a five-letter stem."""
    t = _t(spark, sf_dir, "conversations")
    nxt = t.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("other"))
    plain = lambda c: F.regexp_replace(c, r"[^A-Za-z ]", " ")
    both = t.join(nxt, ["conv_id", "turn"])
    a, b = S.stems(plain(F.col("text"))), S.stems(plain(F.col("other")))
    return both.select("conv_id", "turn", F.size(a).alias("stems"), F.arrays_overlap(a, b).alias("supported"))


def stable_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic numbers of every part."""
    unit = S.stable_unit(F.col("p_name"), F.col("p_partkey"))
    return _t(spark, sf_dir, "part").select("p_partkey", unit.alias("unit"), S.lane(unit, 0.8, 0.3).alias("lane"))


def normalised_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised texts' digests (case folding goes beyond SQL's lower)."""
    return _t(spark, sf_dir, "documents").select("doc_id", F.md5(S.norm_label("text")).alias("digest"))


def czech_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct words of whole texts in Czech order, by initial."""
    words = _t(spark, sf_dir, "documents").select(F.explode(F.split(F.trim("text"), r"\s+")).alias("label")).distinct().where("label <> ''")
    from pyspark.sql import Window

    keyed = words.withColumn("key", S.czech_order("label")).withColumn("initial", F.lower(F.substring("label", 1, 1)))
    return keyed.select("label", F.row_number().over(Window.partitionBy("initial").orderBy("key")).alias("rank"))


def statistical_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords by text statistics of every document."""
    return ranking.rank_statistical(_t(spark, sf_dir, "documents"))


def mmr_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of each label by relevance and diversity."""
    return ranking.rank_by_embedding(_t(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", top=10)


def stub_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered calls of a stand-in model that fails on every turn with a question mark."""
    df = _turns(spark, sf_dir).select("doc_id", "pos", F.coalesce("text", F.lit("")).alias("prompt"))

    def reply(prompt: str) -> str:
        if "?" in prompt:
            raise ValueError("no answer")
        return str(len(prompt))

    return enrich.enrich_in_order(df, reply, max_consecutive_errors=2)


def stub_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checked replies of the deterministic stand-in."""
    reply = enrich.stub_reply(F.coalesce("text", F.lit("")))
    schema = "extracted_keywords_cs array<string>, category string, confidence_score double"
    read = _turns(spark, sf_dir).select("doc_id", "pos", enrich.checked_reply(reply, schema).alias("r"))
    return read.select("doc_id", "pos", F.array_join("r.extracted_keywords_cs", ",").alias("keywords"), "r.category", "r.confidence_score")


def abort_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a user's events would be given up after two errors in a row."""
    e = _t(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("pos"), (F.col("event_type") == "error").alias("failed"))
    return enrich.abort_points(e, 2)


def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lenient parse of events' properties: a number clamped to [0, 50], null where there is none."""
    k = F.from_json("props", "k string")["k"].try_cast("double")
    return _t(spark, sf_dir, "events").select("event_id", enrich.clamped(k, 0.0, 50.0).alias("k"))


_TURNS = """turns AS (
  SELECT conv_id AS doc_id, turn AS pos, CAST(turn // 3 AS VARCHAR) AS page, turn AS line, text, role,
    CASE WHEN role = 'system' THEN 'Header' WHEN turn % 4 = 3 THEN 'Trash' ELSE 'Clear' END AS categ FROM conversations)"""
_WORDS = "list_filter(string_split_regex({}, '\\s+'), lambda w: w <> '')"
_CHUNKS = f"""
words AS (SELECT doc_id, {{}} AS w FROM documents),
starts AS (SELECT doc_id, w, len(w) AS n, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) <= 400 THEN [0] ELSE range(0, len(w), 350) END) AS s FROM words),
chunks AS (SELECT doc_id, CAST(s // 350 AS INTEGER) AS chunk_no, list_slice(w, s + 1, least(s + 400, n)) AS c FROM starts)"""
_PAGES = """pages AS (SELECT conv_id AS doc_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY min(turn)) AS INTEGER) AS page_pos, role AS page,
  string_agg(coalesce(text, ''), ' ' ORDER BY turn) AS text, count(*) AS n_lines FROM conversations GROUP BY conv_id, role)"""

ORACLES = {
    "page_group": f"WITH {_PAGES} SELECT * FROM pages",
    "document_text": f"WITH {_PAGES} SELECT doc_id, string_agg(text, ' ' ORDER BY page_pos) AS text FROM pages GROUP BY doc_id",
    "line_filter": """
WITH raw AS (
  SELECT d.doc_id, coalesce(text, '') AS t,
    CASE WHEN lang = 'fr' THEN 'Non-text' WHEN toxic = 1 THEN 'Trash' WHEN toxic = 0 THEN 'Clear' ELSE '' END AS categ,
    try_cast(CASE WHEN n_chars % 5 = 0 OR n_chars % 7 = 0 THEN NULL ELSE '0.' || lpad(CAST(n_chars % 1000 AS VARCHAR), 3, '0') END AS DOUBLE) AS q
  FROM documents d LEFT JOIN labels l USING (doc_id)),
b AS (SELECT doc_id, t, length(t) AS n, CASE WHEN q < 0.40 THEN 'Trash' WHEN q < 0.70 AND categ <> 'Trash' THEN 'Noisy' ELSE categ END AS band FROM raw),
r AS (SELECT doc_id, band, CASE WHEN t = '' THEN 'empty' WHEN band IN ('Trash', 'Empty') THEN 'categ:' || band
    WHEN band = 'Non-text' THEN CASE WHEN n < 300 THEN 'non_text_short'
      WHEN length(regexp_replace(t, '[^\\p{L}]', '', 'g')) / n < 0.8 THEN 'non_text_letters' ELSE '' END
    WHEN n < 100 THEN 'short' ELSE '' END AS reason FROM b)
SELECT doc_id, band, reason = '' AS keep, reason FROM r""",
    "context_window": f"""
WITH {_TURNS},
shown AS (SELECT *, categ NOT IN ('Trash', 'Empty', 'Non-text') AS clear, trim(coalesce(text, '')) AS t,
    '[P' || page || ' L' || line || '] ' || trim(coalesce(text, '')) AS shown FROM turns),
framed AS (SELECT *, row_number() OVER o - 1 AS i,
    CASE WHEN clear THEN sum(CAST(clear AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) END AS nth,
    last_value(CASE WHEN categ IN ('Header', 'Heading') THEN t END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS section,
    list({{'p': pos, 'g': page, 'c': clear, 's': shown}}) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS frame
  FROM shown WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
heads AS (SELECT doc_id, max(CASE WHEN nth = 1 THEN '    ' || shown END) AS h1, max(CASE WHEN nth = 2 THEN '    ' || shown END) AS h2 FROM framed GROUP BY doc_id)
SELECT f.doc_id, f.pos, concat_ws(chr(10),
  CASE WHEN i > 4 THEN concat_ws(chr(10), '--- GLOBAL DOCUMENT HEADER ---', h1, h2) END,
  '--- CURRENT SECTION: ' || coalesce(section, 'Unknown Section') || ' ---', '--- LOCAL CONTEXT WINDOW ---',
  array_to_string(list_transform(list_filter(frame, lambda r: r.p = f.pos OR (r.g = f.page AND r.c)),
    lambda r: CASE WHEN r.p = f.pos THEN '<target_line> >>> ' || r.s || ' </target_line>' ELSE '    ' || r.s END), chr(10))) AS context
FROM framed f JOIN heads USING (doc_id)""",
    "word_chunks": f"""
WITH {_CHUNKS.format(_WORDS.format("coalesce(text, '')"))}
SELECT doc_id, chunk_no, CAST(len(c) AS INTEGER) AS n_words, md5(array_to_string(c, ' ')) AS digest FROM chunks""",
    "fitted_chunks": f"""
WITH RECURSIVE {_CHUNKS.format(_WORDS.format("coalesce(text, '')"))},
h(doc_id, k, c) AS (
  SELECT doc_id, lpad(CAST(chunk_no AS VARCHAR), 6, '0'), c FROM chunks
  UNION ALL SELECT doc_id, k || x, CASE x WHEN 'a' THEN list_slice(c, 1, CAST(ceil(len(c) / 2) AS INTEGER)) ELSE list_slice(c, CAST(ceil(len(c) / 2) AS INTEGER) + 1, len(c)) END
  FROM h, (SELECT unnest(['a', 'b']) AS x) WHERE length(array_to_string(c, '')) > 600 AND len(c) > 1)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS INTEGER) AS pos, CAST(len(c) AS INTEGER) AS n_words, md5(array_to_string(c, ' ')) AS digest
FROM h WHERE NOT (length(array_to_string(c, '')) > 600 AND len(c) > 1)""",
    "best_score_merge": f"""
WITH {_CHUNKS.format(_WORDS.format("lower(text)"))},
each AS (SELECT doc_id, chunk_no, len(c) AS n, unnest(c) AS word FROM chunks),
scored AS (SELECT doc_id, chunk_no, word, count(*) / any_value(n) AS score FROM each WHERE length(word) > 3 GROUP BY ALL),
best AS (SELECT doc_id, word, max(score) AS score FROM scored GROUP BY ALL)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, word) AS INTEGER) AS rank, word, score FROM best QUALIFY rank <= 5""",
    "form_lemmas": """
WITH words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos
  FROM (SELECT doc_id, string_split_regex(lower(trim(text)), '[ \\t\\n\\x0B\\f\\r]+') AS w FROM documents)),
counted AS (SELECT doc_id, substr(word, 1, 4) AS form, word AS lemma, count(*) AS n, min(pos) AS first FROM words
  WHERE regexp_full_match(word, '\\p{L}+') AND length(word) > 1 GROUP BY ALL)
SELECT doc_id, form, lemma FROM counted QUALIFY row_number() OVER (PARTITION BY doc_id, form ORDER BY n DESC, first) = 1""",
    "stem_overlap": """
WITH s AS (SELECT conv_id, turn, list_distinct(list_transform(list_filter(regexp_extract_all(lower(regexp_replace(text, '[^A-Za-z ]', ' ', 'g')), '\\w+'),
    lambda w: length(w) >= 3), lambda w: substr(w, 1, 5))) AS st FROM conversations)
SELECT a.conv_id, a.turn, CAST(len(a.st) AS INTEGER) AS stems, list_has_any(a.st, b.st) AS supported FROM s a JOIN s b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""",
    "stable_units": """
WITH u AS (SELECT p_partkey, sha256(p_name || chr(31) || CAST(p_partkey AS VARCHAR)) AS h FROM part),
v AS (SELECT p_partkey, CAST(CAST('0x' || substr(h, 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE
    + CAST(CAST('0x' || substr(h, 9, 8) AS BIGINT) AS DOUBLE) / 18446744073709551616.0::DOUBLE AS unit FROM u)
SELECT p_partkey, unit, CASE WHEN unit >= 0.8 THEN 'accept' WHEN unit < 0.3 THEN 'review' ELSE 'escalate' END AS lane FROM v""",
    "abort_points": """
WITH r AS (SELECT user_id AS doc_id, event_id AS pos, event_type = 'error' AS failed,
    sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM events),
c AS (SELECT *, row_number() OVER (PARTITION BY doc_id, island ORDER BY pos) AS k FROM r WHERE failed)
SELECT doc_id, min(pos) AS abort_pos FROM c WHERE k = 2 GROUP BY doc_id""",
    "json_fields": """
WITH e AS (SELECT event_id, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events) SELECT event_id, CASE WHEN k IS NOT NULL THEN greatest(0.0::DOUBLE, least(50.0::DOUBLE, k)) END AS k FROM e""",
    "stub_replies": """
WITH t AS (SELECT conv_id, turn, coalesce(text, '') AS t FROM conversations),
w AS (SELECT conv_id, turn, list_filter(string_split_regex(lower(t), '\\W+'), lambda x: length(x) > 3) AS w, sha256(t) AS h FROM t)
SELECT conv_id AS doc_id, turn AS pos, array_to_string(list_slice(list_filter(w, lambda x, i: list_position(w, x) = i), 1, 3), ',') AS keywords, coalesce(w[1], 'none') AS category,
  round(CAST(CAST('0x' || substr(h, 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE + CAST(CAST('0x' || substr(h, 9, 8) AS BIGINT) AS DOUBLE) / 18446744073709551616.0::DOUBLE, 6) AS confidence_score FROM w""",
    "stub_enrich": """
WITH r AS (SELECT conv_id AS doc_id, turn AS pos, coalesce(text, '') AS t, contains(coalesce(text, ''), '?') AS failed FROM conversations),
i AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM r),
k AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id, island ORDER BY pos) AS k FROM i WHERE failed),
a AS (SELECT doc_id, min(pos) AS stop FROM k WHERE k = 2 GROUP BY doc_id)
SELECT doc_id, pos, CASE WHEN pos > coalesce(stop, pos) THEN 'unprocessed' WHEN failed THEN 'error' ELSE 'processed' END AS status,
  CASE WHEN pos > coalesce(stop, pos) THEN NULL WHEN failed THEN 'no answer' ELSE CAST(length(t) AS VARCHAR) END AS reply FROM r LEFT JOIN a USING (doc_id)""",
}

ORACLES["context_window_split"] = ORACLES["context_window"]

QUERIES = {
    f.__name__: f
    for f in (
        page_group, document_text, line_filter, context_window, context_window_split, word_chunks, fitted_chunks, chunk_keywords, best_score_merge, form_lemmas, stem_overlap, stable_units,
        normalised_labels, czech_sort, statistical_keywords, mmr_keywords, stub_enrich, stub_replies, abort_points, json_fields,
    )
}
