"""Scoring of labelling runs: metrics, agreement, re-runs, calibration and thresholds.

Picks have the columns run, file_id, page, line, category, confidence, supported; one row for each run and key.
Undefined ratios are null; they are rendered as empty text by the sinks alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivolt.functions.scalars import ece_bin

KEY = ["file_id", "page", "line"]
#: Labels that are watched, and the ending that marks a re-run of another run.
WATCH = ("Artemísion", "zvonice", "prahory", "Pentelikon", "jámová kultura")
RERUN = r"^(.+?)_R\d+_(.+)$"


def share(part: Column, whole: Column) -> Column:
    """Ratio; null where it is undefined."""
    return F.when(whole > 0, part / whole)


def last_picks(picks: DataFrame, order: Sequence[Column]) -> DataFrame:
    """One pick for each run and key: the last in the given total order."""
    w = Window.partitionBy("run", *KEY).orderBy(*[c.desc() for c in order])
    return picks.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def top_counts(rows: DataFrame, keys: Sequence[str], value: str, n: int, name: str) -> DataFrame:
    """(keys, name): the ``n`` most frequent values with their counts, "value count; ...", ties by value."""
    counted = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*keys).orderBy(F.desc("c"), F.asc(value))
    ranked = counted.withColumn("k", F.row_number().over(w)).where(F.col("k") <= n)
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", F.concat_ws(" ", F.col(value), F.col("c").cast("string")).alias("t")))), lambda x: x["t"]), "; ")
    return ranked.groupBy(*keys).agg(text.alias(name))


def _capital(category: Column) -> Column:
    first = F.substring(category, 1, 1)
    return (first == F.upper(first)) & (first != F.lower(first))


def run_metrics(picks: DataFrame, expected: DataFrame, meta: str, gold: DataFrame | None = None, watch: Sequence[str] = WATCH) -> DataFrame:
    """One row for each run: coverage of the expected keys, shares, forced picks, confidence mass, exact matches with gold."""
    content = F.col("category") != meta
    forced = content & ~F.col("supported")
    capital, watched = forced & _capital(F.col("category")), forced & F.col("category").isin(*watch)
    keyed = picks.join(expected.select(*KEY, F.lit(True).alias("__e")).distinct(), KEY, "left")
    if gold is not None:
        keyed = keyed.join(gold.select(*KEY, F.col("category").alias("__g")), KEY, "left")
    else:
        keyed = keyed.withColumn("__g", F.lit(None).cast("string"))
    one = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    base = keyed.groupBy("run").agg(
        F.count_distinct("file_id").alias("documents"),
        F.count(F.lit(1)).alias("produced"),
        one(F.col("__e")).alias("met"),
        one(~content).alias("meta"),
        one(content).alias("content"),
        F.count_distinct(F.when(content, F.col("category"))).alias("distinct_categories"),
        one(content & F.contains("category", F.lit("/"))).alias("composite_categories"),
        one(capital).alias("forced_capital"),
        one(watched).alias("watch_hits"),
        one(forced).alias("no_shared_word"),
        F.count_distinct(F.when(content, F.col("confidence"))).alias("confidence_distinct"),
        F.avg(F.when(content, F.col("confidence"))).alias("confidence_mean"),
        F.count(F.when(content, F.col("confidence"))).alias("__conf"),
        F.count("__g").alias("gold_lines"),
        one(F.col("__g") == F.col("category")).alias("gold_exact"),
    )
    valued = picks.where(content & F.col("confidence").isNotNull()).groupBy("run", "confidence").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("run").orderBy(F.desc("c"), F.asc("confidence"))
    two = valued.withColumn("k", F.row_number().over(w)).where("k <= 2").groupBy("run").agg(F.sum("c").alias("__two"))
    total = expected.select(*KEY).distinct().agg(F.count(F.lit(1)).alias("expected"))
    out = base.join(two, "run", "left").join(F.broadcast(total))  # one row
    return out.select(
        "run",
        "documents",
        "expected",
        "produced",
        (F.col("expected") - F.col("met")).alias("missing"),
        (F.col("produced") - F.col("met")).alias("unexpected"),
        "meta",
        share(F.col("meta"), F.col("produced")).alias("meta_share"),
        "content",
        "distinct_categories",
        "composite_categories",
        "forced_capital",
        "watch_hits",
        "no_shared_word",
        share(F.col("no_shared_word"), F.col("content")).alias("no_shared_word_share"),
        "confidence_distinct",
        share(F.col("__two"), F.col("__conf")).alias("confidence_top2_share"),
        "confidence_mean",
        "gold_lines",
        F.when(F.col("gold_lines") > 0, F.col("gold_exact")).alias("gold_exact"),
        share(F.col("gold_exact"), F.col("gold_lines")).alias("gold_accuracy"),
    )


def run_agreement(picks: DataFrame, meta: str) -> DataFrame:
    """(run_a, run_b, both_content, same, agreement) of every pair of runs; pairs without a common line have zero."""
    content = picks.where(F.col("category") != meta).select("run", *KEY, "category")
    a = content.select(F.col("run").alias("run_a"), *KEY, F.col("category").alias("ca"))
    b = content.select(F.col("run").alias("run_b"), *KEY, F.col("category").alias("cb"))
    met = a.join(b, KEY).where("run_a < run_b").groupBy("run_a", "run_b")
    met = met.agg(F.count(F.lit(1)).alias("both_content"), F.count_if(F.col("ca") == F.col("cb")).alias("same"))
    names = picks.select("run").distinct()
    pairs = names.toDF("run_a").join(F.broadcast(names.toDF("run_b")), F.col("run_a") < F.col("run_b"))  # runs are few
    out = pairs.join(met, ["run_a", "run_b"], "left").fillna(0, ["both_content", "same"])
    return out.withColumn("agreement", share(F.col("same"), F.col("both_content")))


def before_after(metrics: DataFrame, picks: DataFrame, agreement: DataFrame, columns: Sequence[str], pattern: str = RERUN) -> DataFrame:
    """One row for each re-run whose baseline is present: metrics before and after, and lines whose category changed."""
    base = F.concat_ws("_", F.regexp_extract("run", pattern, 1), F.regexp_extract("run", pattern, 2))
    again = metrics.where(F.col("run").rlike(pattern)).withColumn("baseline", base)
    old = metrics.select(F.col("run").alias("baseline"), *(F.col(c).alias(f"{c}_before") for c in columns))
    pairs = again.select("run", "baseline", *(F.col(c).alias(f"{c}_after") for c in columns)).join(old, "baseline")
    a = picks.select("run", *KEY, F.col("category").alias("ca")).join(pairs.select("run", "baseline"), "run")
    b = picks.select(F.col("run").alias("baseline"), *KEY, F.col("category").alias("cb"))
    changed = a.join(b, ["baseline", *KEY]).groupBy("run").agg(F.count_if(F.col("ca") != F.col("cb")).alias("lines_changed"))
    both = agreement.select(F.col("run_a").alias("x"), F.col("run_b").alias("y"), "agreement")
    lo, hi = F.least("run", "baseline"), F.greatest("run", "baseline")
    out = pairs.join(changed, "run", "left").fillna(0, ["lines_changed"])
    return out.join(both, (lo == F.col("x")) & (hi == F.col("y")), "left").drop("x", "y").withColumnRenamed("agreement", "content_agreement")


def forced_picks(picks: DataFrame, meta: str, watch: Sequence[str] = WATCH) -> DataFrame:
    """Unsupported picks with the reason (capital, watch), in order."""
    reason = F.when(_capital(F.col("category")), "capital").when(F.col("category").isin(*watch), "watch")
    found = picks.where((F.col("category") != meta) & ~F.col("supported")).withColumn("reason", reason).where("reason is not null")
    return found.select("run", *KEY, "category", "confidence", "reason").orderBy("run", *KEY)


def brier(rows: DataFrame, probabilities: str = "probabilities", gold: str = "gold") -> DataFrame:
    """(brier): mean multi-class Brier score of maps from option to probability."""
    error = F.aggregate(
        F.map_entries(probabilities), F.lit(0.0), lambda acc, e: acc + F.pow(e["value"] - F.when(e["key"] == F.col(gold), 1.0).otherwise(0.0), 2)
    )
    return rows.agg(F.avg(error).alias("brier"))


def expected_calibration_error(rows: DataFrame, bins: int = 10, confidence: str = "confidence", correct: str = "correct") -> DataFrame:
    """(ece): bins of equal width, weighted by their size."""
    hit = F.col(correct).cast("int").cast("double")
    binned = rows.groupBy(ece_bin(F.col(confidence), bins).alias("bin"))
    binned = binned.agg(F.count(F.lit(1)).alias("n"), F.sum(confidence).alias("c"), F.sum(hit).alias("h"))
    return binned.agg((F.sum(F.abs(F.col("h") - F.col("c"))) / F.sum("n")).alias("ece"))


def coverage_curve(rows: DataFrame, confidence: str = "confidence", correct: str = "correct") -> DataFrame:
    """(threshold, coverage, error) for each distinct confidence, highest first.

    Rows are added by value before the running sums, so the window holds one row for each distinct confidence.
    """
    wrong = (~F.col(correct)).cast("long")
    counted = rows.groupBy(F.col(confidence).alias("threshold")).agg(F.count(F.lit(1)).alias("n"), F.sum(wrong).alias("w"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    run = Window.partitionBy(F.lit(1)).orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    seen = counted.select("threshold", F.sum("n").over(run).alias("s"), F.sum("w").over(run).alias("w"), total.alias("all"))
    return seen.select("threshold", (F.col("s") / F.col("all")).alias("coverage"), (F.col("w") / F.col("s")).alias("error"))


def pick_threshold(curve: DataFrame, target_error: float) -> DataFrame:
    """The row of the widest coverage whose error is within the target; none when no row is."""
    fit = curve.where(F.col("error") <= target_error)
    return fit.agg(F.min_by(F.struct("threshold", "coverage", "error"), "threshold").alias("r")).where("r is not null").select("r.*")


def sum_tolerance(options: Column) -> Column:
    """Tolerance of a probability map's sum."""
    return 1e-3 + options * 5e-5


def answer_problem(options: Column, probabilities: Column, choice: Column, slack: float = 1e-3) -> Column:
    """Why a choice answer is invalid (keys, range, sum, choice, not_most_probable), or null."""
    values, keys = F.map_values(probabilities), F.array_sort(F.map_keys(probabilities))
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    picked = F.try_element_at(probabilities, choice)
    return (
        F.when(probabilities.isNull() | (keys != F.array_sort(options)), "keys")
        .when(~F.forall(values, lambda v: v.between(0.0, 1.0)), "range")
        .when(F.abs(total - 1.0) > sum_tolerance(F.size(options)), "sum")
        .when(picked.isNull(), "choice")
        .when(picked < F.array_max(values) - slack, "not_most_probable")
    )


def score_runs(picks: DataFrame, expected: DataFrame, meta: str, unreadable: DataFrame, gold: DataFrame | None = None, watch: Sequence[str] = WATCH) -> dict[str, DataFrame]:
    """All tables of a scoring run: runs, agreement, before_after, forced, and unreadable (run, file). Lazy, from the same picks."""
    runs = run_metrics(picks, expected, meta, gold, watch)
    agreement = run_agreement(picks, meta)
    compared = [c for c in runs.columns if c not in ("run", "expected", "gold_lines", "gold_exact", "gold_accuracy")]
    return {
        "runs": runs,
        "agreement": agreement,
        "before_after": before_after(runs, picks, agreement, compared),
        "forced": forced_picks(picks, meta, watch),
        "unreadable": unreadable.select("run", "file").distinct().orderBy("run", "file"),
    }
