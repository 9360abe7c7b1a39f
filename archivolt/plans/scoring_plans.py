"""Queries of the scoring and record operators over line items, orders, labels and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivolt.functions import scalars as S
from archivolt.operators import enrich, records, scoring


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as picks of four runs; repeated keys keep their last row in a total order."""
    li = _t(spark, sf_dir, "lineitem")
    name = F.element_at(F.array(*(F.lit(x) for x in ("base_m", "base_R1_m", "other_x", "other_R2_x"))), (F.col("l_suppkey") % 4 + 1).cast("int"))
    raw = li.select(
        name.alias("run"),
        (F.col("l_orderkey") % 5).cast("string").alias("file_id"),
        (F.col("l_orderkey") % 200).cast("int").alias("page"),
        F.col("l_linenumber").alias("line"),
        F.concat("l_returnflag", F.when(F.col("l_tax") > 0.06, F.lit("/x")).otherwise(F.lit(""))).alias("category"),
        F.col("l_discount").alias("confidence"),
        (F.col("l_linestatus") == "O").alias("supported"),
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate",
    )
    order = [F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")]
    order += [F.col("category"), F.col("confidence"), F.col("supported")]
    return scoring.last_picks(raw, order).select("run", *scoring.KEY, "category", "confidence", "supported")


def _expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    keys = o.select((F.col("o_orderkey") % 5).cast("string").alias("file_id"), (F.col("o_orderkey") % 200).cast("int").alias("page"), F.explode(F.sequence(F.lit(1), F.lit(4))).alias("line"))
    return keys.distinct()


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage, shares and confidence mass of every run."""
    gold = _expected(spark, sf_dir).where("line = 1").withColumn("category", F.lit("A"))
    out = scoring.run_metrics(_picks(spark, sf_dir), _expected(spark, sf_dir), "N", gold, ("R/x",))
    ratios = ("meta_share", "no_shared_word_share", "confidence_top2_share", "confidence_mean", "gold_accuracy")
    return out.withColumns({c: F.round(c, 6) for c in ratios})


def run_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agreement of every pair of runs."""
    return scoring.run_agreement(_picks(spark, sf_dir), "N")


def before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-runs against their baselines."""
    picks = _picks(spark, sf_dir)
    metrics = scoring.run_metrics(picks, _expected(spark, sf_dir), "N")
    return scoring.before_after(metrics, picks, scoring.run_agreement(picks, "N"), ("missing", "meta", "no_shared_word"))


def forced_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unsupported picks with their reason."""
    return scoring.forced_picks(_picks(spark, sf_dir), "N", ("R/x",))


def top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most frequent categories of each run."""
    return scoring.top_counts(_picks(spark, sf_dir), ["run"], "category", 3, "top")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with a confidence from the text's length."""
    d = _t(spark, sf_dir, "documents").select("doc_id", ((F.col("n_chars") % 101) / 100.0).alias("confidence"))
    return _t(spark, sf_dir, "labels").join(d, "doc_id").select("doc_id", "confidence", (F.col("quality") == 1).alias("correct"), "quality", "toxic")


def brier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean multi-class Brier score."""
    p = F.create_map(F.lit("good"), F.col("confidence"), F.lit("bad"), 1 - F.col("confidence"))
    df = _judged(spark, sf_dir).select(p.alias("probabilities"), F.when(F.col("correct"), "good").otherwise("bad").alias("gold"))
    return scoring.brier(df).select(F.round("brier", 9).alias("brier"))


def ece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected calibration error in ten bins."""
    return scoring.expected_calibration_error(_judged(spark, sf_dir)).select(F.round("ece", 9).alias("ece"))


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage and error by descending confidence."""
    return scoring.coverage_curve(_judged(spark, sf_dir))


def threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The widest coverage within a target error."""
    return scoring.pick_threshold(scoring.coverage_curve(_judged(spark, sf_dir)), 0.15)


def lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by lane."""
    lane = S.lane(F.col("confidence"), 0.8, 0.3)
    return _judged(spark, sf_dir).groupBy(lane.alias("lane")).agg(F.count(F.lit(1)).alias("n"))


def mcnemar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact test of the discordant labels."""
    a, b = F.col("quality") == 1, F.col("toxic") == 1
    counts = _judged(spark, sf_dir).agg(F.count_if(a & ~b).alias("b"), F.count_if(~a & b).alias("c"))
    return counts.select("b", "c", F.round(S.mcnemar_exact("b", "c"), 6).alias("p"))


def answer_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability maps made of line items, with every kind of fault."""
    li = _t(spark, sf_dir, "lineitem")
    p = F.create_map(F.lit("a"), F.col("l_discount") * 5, F.lit("b"), 1 - F.col("l_discount") * 5 + F.when(F.col("l_linenumber") == 3, 0.2).otherwise(0.0))
    choice = F.when(F.col("l_linenumber") == 2, "z").when(F.col("l_quantity") > 25, "a").otherwise("b")
    options = F.when(F.col("l_linenumber") == 4, F.array(F.lit("a"), F.lit("c"))).otherwise(F.array(F.lit("b"), F.lit("a")))
    problem = scoring.answer_problem(options, p, choice)
    return li.groupBy(F.coalesce(problem, F.lit("ok")).alias("problem")).agg(F.count(F.lit(1)).alias("n"))


def record_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders patched by what their line items sum to."""
    base = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.lit(None).cast("long").alias("n_lines"), F.col("o_orderkey").alias("pos"))
    li = _t(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") * 3).alias("o_orderkey"))
    patch = li.agg(F.count(F.lit(1)).alias("n_lines"), F.max("l_linestatus").alias("o_orderstatus")).withColumn("pos", F.col("o_orderkey"))
    return records.upsert(base, patch, ["o_orderkey"], ["n_lines"]).select("o_orderkey", "o_orderstatus", "n_lines")


def line_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items that name an order position which another table lacks."""
    rows = _t(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 50).alias("doc_id"), F.col("l_suppkey").alias("page"), F.col("l_linenumber").alias("line"))
    lines = _t(spark, sf_dir, "orders").select((F.col("o_orderkey") % 50).alias("doc_id"), (F.col("o_custkey") % 100).cast("double").alias("page"), (F.col("o_orderkey") % 4 + 1).alias("line"))
    return records.missing_lines(rows, lines).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page and line statistics of every source: documents are its pages, conversations' turns its lines."""
    d = _t(spark, sf_dir, "documents").select(F.col("source").alias("doc_id"), F.when(F.col("n_chars") % 3 > 0, (F.col("n_chars") % 997).cast("double")).alias("quality_score"), F.when(F.col("n_chars") < 500, "empty").otherwise("text").alias("content_status"))
    c = _t(spark, sf_dir, "conversations").select(F.concat(F.lit("src"), F.col("conv_id") % 20).alias("doc_id"), F.when(F.col("turn") > 0, F.col("role")).alias("categ"), F.when(F.col("turn") == 2, "block").alias("unit"))
    out = records.quality_summary(d, c)
    shown = F.array_join(F.transform("by_categ", lambda x: F.concat_ws("=", x["categ"], x["n"].cast("string"))), ",")
    return out.withColumn("by_categ", shown).withColumns({c: F.round(c, 6) for c in ("score_mean", "score_median")})


def renumbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns whose conversation begins at 0 numbered from 1, and references moved along."""
    c = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("role").alias("page"), F.col("turn").alias("line"))
    new = records.one_based_lines(c)
    refs = c.where("line % 2 = 0").withColumn("line", F.col("line") - 1)
    moved = records.moved_references(refs, new)
    return new.select("doc_id", "page", "line", F.lit("line").alias("kind")).union(moved.select("doc_id", "page", "line", F.lit("reference")))


def doc_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each source folded into one: the first language, the last length, and whether languages disagree."""
    d = _t(spark, sf_dir, "documents")
    out = records.fold_records(d, "source", "doc_id", ["n_chars"], ["lang"])
    return out.select("source", "n_chars", "lang", F.array_join("conflicts", ",").alias("conflicts"))


def notes_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as limit notes, added by type and user."""
    e = _t(spark, sf_dir, "events")
    notes = e.select(F.col("event_type").alias("limit"), (F.col("user_id") % 3).alias("effect"), F.lit(1).cast("long").alias("count"), F.when(F.col("event_id") % 7 == 0, F.col("props")).alias("detail"), F.col("value"), F.col("event_id").alias("pos"))
    return records.merge_notes(notes)


def run_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as stages of runs, folded by user."""
    e = _t(spark, sf_dir, "events")
    logs = e.select("user_id", F.lit(1).cast("long").alias("processed"), (F.col("event_type") == "view").cast("long").alias("skipped"), F.col("ts").alias("start"), F.col("ts").alias("end"), F.concat_ws(":", "event_type", "event_id").alias("stage"), (F.col("event_type") == "error").alias("failed"))
    return records.fold_runs(logs, "user_id")


def controlled_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct controlled values of several tables."""
    return records.controlled_values({"lang": _t(spark, sf_dir, "documents").select("lang"), "role": _t(spark, sf_dir, "conversations").select("role"), "type": _t(spark, sf_dir, "part").select("p_type")})


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of every user from counts of events."""
    from archivolt.operators.lines import outcome

    e = _t(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("results"), F.count_if(F.col("value") > 60).alias("attempted"), F.count_if(F.col("value") > 95).alias("errors"))
    return e.select("user_id", outcome(F.col("results"), F.col("attempted"), F.col("errors"), F.lit(0)).alias("outcome"))


def whole_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations of which no turn is very short."""
    c = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", F.length("text").alias("n"))
    return enrich.contributing(c, c.where("n < 40")).select("doc_id", "turn", "n")


_PICKS = """p AS (
  SELECT CASE l_suppkey % 4 WHEN 0 THEN 'base_m' WHEN 1 THEN 'base_R1_m' WHEN 2 THEN 'other_x' ELSE 'other_R2_x' END AS run,
    CAST(l_orderkey % 5 AS VARCHAR) AS file_id, CAST(l_orderkey % 200 AS INTEGER) AS page, l_linenumber AS line,
    l_returnflag || CASE WHEN l_tax > 0.06 THEN '/x' ELSE '' END AS category, l_discount AS confidence, l_linestatus = 'O' AS supported
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey % 4, l_orderkey % 5, l_orderkey % 200, l_linenumber
    ORDER BY l_orderkey DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_shipdate DESC,
      l_returnflag || CASE WHEN l_tax > 0.06 THEN '/x' ELSE '' END DESC, l_discount DESC, l_linestatus DESC) = 1),
x AS (SELECT DISTINCT CAST(o_orderkey % 5 AS VARCHAR) AS file_id, CAST(o_orderkey % 200 AS INTEGER) AS page, CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS line FROM orders)"""
_AGREE = """ag AS (
  SELECT n.run_a, n.run_b, count(a.category) AS both_content, count(CASE WHEN a.category = b.category THEN 1 END) AS same
  FROM (SELECT s.run AS run_a, t.run AS run_b FROM (SELECT DISTINCT run FROM p) s JOIN (SELECT DISTINCT run FROM p) t ON s.run < t.run) n
  LEFT JOIN (SELECT a.run AS ra, b.run AS rb, a.category, b.category AS cb FROM p a JOIN p b ON a.file_id = b.file_id AND a.page = b.page AND a.line = b.line
    WHERE a.run < b.run AND a.category <> 'N' AND b.category <> 'N') a ON a.ra = n.run_a AND a.rb = n.run_b
  LEFT JOIN LATERAL (SELECT a.cb AS category) b ON true GROUP BY ALL)"""
_JUDGED = """j AS (SELECT l.doc_id, (n_chars % 101) / 100.0::DOUBLE AS confidence, quality = 1 AS correct, quality, toxic FROM labels l JOIN documents d USING (doc_id))"""
_CURVE = """c AS (SELECT confidence AS threshold, count(*) AS n, count(*) FILTER (NOT correct) AS w FROM j GROUP BY ALL),
curve AS (SELECT threshold, sum(n) OVER o / sum(n) OVER () AS coverage, sum(w) OVER o / sum(n) OVER o AS error FROM c WINDOW o AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING))"""

ORACLES = {
    "run_metrics": f"""
WITH {_PICKS},
q AS (SELECT p.*, x.line IS NOT NULL AS e, CASE WHEN x.line = 1 THEN 'A' END AS g FROM p LEFT JOIN x USING (file_id, page, line)),
two AS (SELECT run, sum(c) AS two FROM (SELECT run, confidence, count(*) AS c FROM p WHERE category <> 'N' GROUP BY run, confidence
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY count(*) DESC, confidence) <= 2) GROUP BY run),
b AS (SELECT run, count(DISTINCT file_id) AS documents, (SELECT count(*) FROM x) AS expected, count(*) AS produced, count(*) FILTER (e) AS met,
  count(*) FILTER (category = 'N') AS meta, count(*) FILTER (category <> 'N') AS content, count(DISTINCT CASE WHEN category <> 'N' THEN category END) AS distinct_categories,
  count(*) FILTER (category <> 'N' AND contains(category, '/')) AS composite_categories, count(*) FILTER (category <> 'N' AND NOT supported) AS forced_capital,
  count(*) FILTER (category = 'R/x' AND NOT supported) AS watch_hits, count(*) FILTER (category <> 'N' AND NOT supported) AS no_shared_word,
  count(DISTINCT CASE WHEN category <> 'N' THEN confidence END) AS confidence_distinct, avg(CASE WHEN category <> 'N' THEN confidence END) AS confidence_mean,
  count(g) AS gold_lines, count(*) FILTER (g = category) AS gold_exact FROM q GROUP BY run)
SELECT run, documents, expected, produced, expected - met AS missing, produced - met AS unexpected, meta, round(meta / produced, 6) AS meta_share, content, distinct_categories,
  composite_categories, forced_capital, watch_hits, no_shared_word, round(no_shared_word / content, 6) AS no_shared_word_share, confidence_distinct,
  round(CAST(two AS DOUBLE) / content, 6) AS confidence_top2_share, round(confidence_mean, 6) AS confidence_mean, gold_lines, CASE WHEN gold_lines > 0 THEN gold_exact END AS gold_exact,
  CASE WHEN gold_lines > 0 THEN round(gold_exact / gold_lines, 6) END AS gold_accuracy FROM b JOIN two USING (run)""",
    "run_agreement": f"WITH {_PICKS}, {_AGREE} SELECT *, CASE WHEN both_content > 0 THEN same / both_content END AS agreement FROM ag",
    "before_after": f"""
WITH {_PICKS}, {_AGREE},
m AS (SELECT run, (SELECT count(*) FROM x) - count(x.line) AS missing, count(*) FILTER (category = 'N') AS meta, count(*) FILTER (category <> 'N' AND NOT supported) AS no_shared_word
  FROM p LEFT JOIN x USING (file_id, page, line) GROUP BY run),
b AS (SELECT a.run, o.run AS baseline, a.missing AS missing_after, a.meta AS meta_after, a.no_shared_word AS no_shared_word_after,
  o.missing AS missing_before, o.meta AS meta_before, o.no_shared_word AS no_shared_word_before
  FROM m a JOIN m o ON o.run = regexp_replace(a.run, '_R\\d+_', '_') WHERE a.run <> o.run)
SELECT b.*, (SELECT count(*) FILTER (u.category <> v.category) FROM p u JOIN p v USING (file_id, page, line) WHERE u.run = b.run AND v.run = b.baseline) AS lines_changed,
  (SELECT CASE WHEN both_content > 0 THEN same / both_content END FROM ag WHERE run_a = least(b.run, b.baseline) AND run_b = greatest(b.run, b.baseline)) AS content_agreement FROM b""",
    "forced_picks": f"WITH {_PICKS} SELECT run, file_id, page, line, category, confidence, 'capital' AS reason FROM p WHERE category <> 'N' AND NOT supported",
    "top_categories": f"""
WITH {_PICKS}, c AS (SELECT run, category, count(*) AS n FROM p GROUP BY run, category QUALIFY row_number() OVER (PARTITION BY run ORDER BY count(*) DESC, category) <= 3)
SELECT run, string_agg(category || ' ' || n, '; ' ORDER BY n DESC, category) AS top FROM c GROUP BY run""",
    "brier": f"WITH {_JUDGED} SELECT round(avg(2 * power(CASE WHEN correct THEN 1 - confidence ELSE confidence END, 2)), 9) AS brier FROM j",
    "ece": f"""
WITH {_JUDGED}, b AS (SELECT least(9, greatest(0, ceil(confidence * 10) - 1)) AS bin, count(*) AS n, sum(confidence) AS c, count(*) FILTER (correct) AS h FROM j GROUP BY ALL)
SELECT round(sum(abs(h - c)) / sum(n), 9) AS ece FROM b""",
    "coverage": f"WITH {_JUDGED}, {_CURVE} SELECT threshold, CAST(coverage AS DOUBLE) AS coverage, CAST(error AS DOUBLE) AS error FROM curve",
    "threshold": f"WITH {_JUDGED}, {_CURVE} SELECT threshold, CAST(coverage AS DOUBLE) AS coverage, CAST(error AS DOUBLE) AS error FROM curve WHERE error <= 0.15 ORDER BY threshold LIMIT 1",
    "lanes": f"WITH {_JUDGED} SELECT CASE WHEN confidence >= 0.8 THEN 'accept' WHEN confidence < 0.3 THEN 'review' ELSE 'escalate' END AS lane, count(*) AS n FROM j GROUP BY ALL",
    "answer_check": """
WITH a AS (SELECT l_linenumber AS k, l_quantity AS q, l_discount * 5 AS pa, 1 - l_discount * 5 + CASE WHEN l_linenumber = 3 THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END AS pb FROM lineitem),
c AS (SELECT *, CASE WHEN k = 2 THEN NULL WHEN q > 25 THEN pa ELSE pb END AS picked FROM a)
SELECT CASE WHEN k = 4 THEN 'keys' WHEN NOT (pa BETWEEN 0 AND 1 AND pb BETWEEN 0 AND 1) THEN 'range' WHEN abs(pa + pb - 1) > 0.001 + 2 * 0.00005 THEN 'sum'
  WHEN picked IS NULL THEN 'choice' WHEN picked < greatest(pa, pb) - 0.001 THEN 'not_most_probable' ELSE 'ok' END AS problem, count(*) AS n FROM c GROUP BY ALL""",
    "record_upsert": """
WITH pt AS (SELECT l_orderkey * 3 AS o_orderkey, count(*) AS n_lines FROM lineitem GROUP BY ALL)
SELECT coalesce(o.o_orderkey, pt.o_orderkey) AS o_orderkey, o.o_orderstatus, pt.n_lines FROM orders o FULL JOIN pt ON o.o_orderkey = pt.o_orderkey""",
    "line_integrity": """
SELECT l_orderkey % 50 AS doc_id, count(*) AS n FROM lineitem l WHERE l_orderkey % 50 IN (SELECT o_orderkey % 50 FROM orders) AND NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_orderkey % 50 = l.l_orderkey % 50 AND o.o_custkey % 100 = l.l_suppkey AND o.o_orderkey % 4 + 1 = l.l_linenumber) GROUP BY ALL""",
    "quality_summary": """
WITH d AS (SELECT source AS doc_id, CASE WHEN n_chars % 3 > 0 THEN CAST(n_chars % 997 AS DOUBLE) END AS q, CASE WHEN n_chars < 500 THEN 'empty' ELSE 'text' END AS st FROM documents),
c AS (SELECT 'src' || (conv_id % 20) AS doc_id, CASE WHEN turn > 0 THEN role END AS categ, turn = 2 AS block FROM conversations),
pg AS (SELECT doc_id, count(*) AS pages_total, count(*) FILTER (st = 'empty') AS pages_empty, count(q) AS pages_scored, round(avg(q), 6) AS score_mean, round(median(q), 6) AS score_median,
  min(q) AS score_min, max(q) AS score_max FROM d GROUP BY doc_id),
ln AS (SELECT doc_id, count(*) AS lines_total, count(*) FILTER (block) AS block_units FROM c GROUP BY doc_id),
ct AS (SELECT doc_id, string_agg(categ || '=' || n, ',' ORDER BY categ) AS by_categ FROM (SELECT doc_id, categ, count(*) AS n FROM c WHERE NOT block AND categ IS NOT NULL GROUP BY ALL) GROUP BY doc_id)
SELECT doc_id, coalesce(pages_total, 0) AS pages_total, coalesce(pages_empty, 0) AS pages_empty, coalesce(pages_scored, 0) AS pages_scored, score_mean, score_median, score_min, score_max,
  coalesce(lines_total, 0) AS lines_total, coalesce(block_units, 0) AS block_units, by_categ FROM pg FULL JOIN ln USING (doc_id) LEFT JOIN ct USING (doc_id)""",
    "renumbered_lines": """
WITH c AS (SELECT conv_id AS doc_id, role AS page, turn AS line FROM conversations),
s AS (SELECT *, CASE WHEN min(line) OVER (PARTITION BY doc_id, page) = 0 THEN 1 ELSE 0 END AS s FROM c)
SELECT doc_id, page, line + s AS line, 'line' AS kind FROM s UNION ALL SELECT doc_id, page, CASE WHEN line - 1 + s >= 1 THEN line - 1 + s END, 'reference' FROM s WHERE line % 2 = 0""",
    "doc_fold": """
SELECT source, arg_max(n_chars, doc_id) AS n_chars, arg_min(lang, doc_id) AS lang, CASE WHEN count(DISTINCT lang) > 1 THEN 'lang' ELSE '' END AS conflicts FROM documents GROUP BY source""",
    "notes_merge": """
SELECT event_type AS "limit", user_id % 3 AS effect, count(*) AS count, arg_min(props, event_id) FILTER (event_id % 7 = 0) AS detail, arg_min(value, event_id) AS value FROM events GROUP BY ALL""",
    "run_fold": """
SELECT user_id, count(*) AS processed, count(*) FILTER (event_type = 'view') AS skipped, min(ts) AS start, max(ts) AS "end",
  arg_min(event_type || ':' || event_id, {'t': ts, 's': event_type || ':' || event_id}) AS first_stage, arg_max(event_type || ':' || event_id, {'t': ts, 's': event_type || ':' || event_id}) AS last_stage,
  bool_or(event_type = 'error') AS any_failed FROM events GROUP BY user_id""",
    "controlled_values": "SELECT DISTINCT 'lang' AS scheme, lang AS value FROM documents UNION SELECT 'role', role FROM conversations UNION SELECT 'type', p_type FROM part",
    "mcnemar": """
WITH j AS (SELECT count(*) FILTER (quality = 1 AND toxic <> 1) AS b, count(*) FILTER (quality <> 1 AND toxic = 1) AS c FROM labels JOIN documents USING (doc_id)),
t AS (SELECT b, c, b + c AS n, unnest(range(0, least(b, c) + 1)) AS i FROM j)
SELECT b, c, round(least(1.0::DOUBLE, 2 * sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) - n * ln(2)))), 6) AS p FROM t GROUP BY b, c""",
    "outcomes": """
SELECT user_id, CASE WHEN count(*) FILTER (value > 95) > 0 THEN 'failed' WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN 'contributed'
  WHEN count(*) FILTER (value > 60) > 0 THEN 'empty' ELSE 'not_asked' END AS outcome FROM events GROUP BY user_id""",
    "whole_documents": """
SELECT conv_id AS doc_id, turn, CAST(length(text) AS INTEGER) AS n FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE length(text) < 40)""",
}

QUERIES = {
    f.__name__: f
    for f in (
        run_metrics, run_agreement, before_after, forced_picks, top_categories, brier, ece, coverage, threshold, lanes, mcnemar, answer_check,
        record_upsert, line_integrity, quality_summary, renumbered_lines, doc_fold, notes_merge, run_fold, controlled_values, outcomes, whole_documents,
    )
}
