"""Placing terms by walking a decision tree, all terms of a level at once.

At a node a term is asked which of the node's children fits. Children come in chunks of at most ``most_options``; the chunks'
winners meet in a second round, and the best of the winners is the best of all. An answer is a score, an integer or a decimal,
so that comparisons are exact; a child below ``least`` doesn't fit. The term moves to the best child, ties to the smaller rank.
Where no child fits, or none is left, it stops if the node's own score is at least ``accept``, else it goes back to the parent
and on to the next best child; a term that comes back to the root with nothing left has no place. A leaf below ``accept`` only
leads back, so it isn't entered, and what stands behind a leaf that accepts is never reached.

One step moves all terms that still walk: those at a node that they haven't seen are asked, the others go on with the answers
that they have, so no question is counted twice. Asking is a join with the node's children; of a term's answers at a node it keeps
the inner children that fit and one leaf, so what is kept grows with the inner nodes, not with the pairs of terms and options.
Children are broadcast up to a counted number, so that the pairs are summed up as they come, and neither sorted nor moved; the
answer, a deterministic column, is evaluated a second time for the leaves, to find the least rank of the greatest score. The
number of pairs, terms times options of the nodes that they visit, is the task's own, and says how many tasks ask. Each step
writes the state of the terms in the checkpoint folder, without the path once a term is placed. The number of steps is that of
the longest walk, not of the terms.

Defined results: a tree of one root, without children, or with a root that nobody reaches gives null for all terms. Null scores
don't fit. Repeated terms are placed each. Terms with a null id are not walked: their node is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivolt.operators.graph import chunked, cut

MOST_OPTIONS = 254
#: Options up to which, counted, they are broadcast.
BROADCAST_OPTIONS = 1_000_000
#: Pairs of a term and an option that a task puts.
TASK_PAIRS = 10_000_000


def options_of(children: DataFrame, most_options: int = MOST_OPTIONS) -> DataFrame:
    """(node, child, rank, chunk) and the other columns of ``children`` (parent, child, rank and what answers need)."""
    return chunked(children, most_options).withColumnRenamed("parent", "node")


def _asked(at: DataFrame, terms: DataFrame, options: DataFrame, answer: Column, least: Column, accept: Column, small: bool, tasks: int) -> DataFrame:
    """(id, node) to (id, node, offers): the children that fit and lead further, best first, up to the first leaf that accepts."""
    here = cut(at.select("id", "node").distinct().join(terms, "id").repartition(tasks, "id"))

    def scored(asked: DataFrame, leaf: bool) -> DataFrame:
        own = options.where(F.col("leaf") == leaf)
        return asked.join(F.broadcast(own) if small else own, "node").withColumn("score", answer)

    offer = F.struct((-F.col("score")).alias("neg"), F.col("place").alias("rank"), "child", "score")
    # plain maxima and minima, whose sums are updated in place: first of scores, then of the ranks that have the greatest
    most = scored(here, True).where((F.col("score") >= least) & (F.col("score") >= accept)).groupBy("id", "node").agg(F.max("score").alias("__most"))
    first = scored(here.join(most, ["id", "node"]), True).where("score = __most").groupBy("id", "node", "score").agg(F.min("place").alias("place"))
    best = first.join(options.select("node", "place", "child"), ["node", "place"]).select("id", "node", offer.alias("leaf"))
    inner = scored(here, False).where(F.col("score") >= least).groupBy("id", "node").agg(F.sort_array(F.collect_list(offer)).alias("inner"))
    both = best.join(inner, ["id", "node"], "full_outer")
    before = F.filter("inner", lambda x: F.col("leaf").isNull() | (x < F.col("leaf")))
    last = F.when(F.col("leaf").isNotNull(), F.array("leaf"))
    none = F.array().cast(dict(inner.dtypes)["inner"])
    return both.select("id", "node", F.concat(F.coalesce(before, none), F.coalesce(last, none)).alias("offers"))


def walk(
    terms: DataFrame, children: DataFrame, root: Column, answer: Column, *, least: Column, accept: Column, most_options: int = MOST_OPTIONS, most_steps: int = 10_000
) -> DataFrame:
    """(id, node, questions, steps): where every term comes to rest, how many options it was asked about, and its steps.

    ``terms``: id (unique) and what answers need; ``children``: parent, child, rank and what answers need. ``answer`` is a
    column over both, whose names must differ.
    """
    options = cut(options_of(children, most_options))
    sizes = options.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    small = options.count() <= BROADCAST_OPTIONS
    place = F.row_number().over(Window.partitionBy("node").orderBy("rank", "child")).cast("bigint")  # ranks, each once
    options = options.withColumn("place", place).join(sizes.select(F.col("node").alias("child"), F.lit(False).alias("leaf")), "child", "left").withColumn("leaf", F.coalesce("leaf", F.lit(True)))
    options = cut(options)
    known = terms.where("id is not null")
    # path: of each node on the way its offers, the next of them, and the node's own score; the last is where the term stands
    score = answer_type(known, options, answer)
    offers = f"array<struct<neg:{score},rank:bigint,child:{dict(options.dtypes)['child']},score:{score}>>"
    empty = F.struct(root.alias("node"), F.lit(None).cast(score).alias("score"), F.lit(None).cast(offers).alias("offers"), F.lit(0).alias("next"))
    state = cut(known.select("id", F.array(empty).alias("path"), F.lit(0).cast("bigint").alias("questions"), F.lit(0).alias("steps"), F.lit(None).cast(dict(options.dtypes)["child"]).alias("found"), F.lit(False).alias("done")))
    for _ in range(most_steps):
        walking = state.where("not done")
        fresh = walking.select("id", F.try_element_at("path", F.lit(-1)).alias("top")).where("top.offers is null").select("id", F.col("top.node").alias("node"))
        counted = fresh.join(sizes, "node").select("id", F.col("n").alias("__q"))
        left = walking.agg(F.count(F.lit(1)).alias("n")).join(counted.agg(F.sum("__q").alias("q"))).first()
        if not left["n"]:
            break
        got = _asked(fresh, known, options, answer, least, accept, small, 1 + (left["q"] or 0) // TASK_PAIRS).withColumnRenamed("node", "__n")
        both = state.join(got, "id", "left").join(counted, "id", "left")
        top = F.try_element_at("path", F.lit(-1))
        own = F.coalesce(top["offers"], F.col("offers").cast(offers), F.array().cast(offers))
        down = F.get(own, top["next"])
        kept = F.slice("path", 1, F.greatest(F.size("path") - 1, F.lit(0)))
        here = F.struct(top["node"].alias("node"), top["score"].alias("score"), own.alias("offers"), (top["next"] + 1).alias("next"))
        below = F.struct(down["child"].alias("node"), down["score"].alias("score"), F.lit(None).cast(offers).alias("offers"), F.lit(0).alias("next"))
        stops = down.isNull() & F.coalesce(top["score"] >= accept, F.lit(False))
        ends = F.col("done") | stops | (down.isNull() & (F.size("path") <= 1))
        path = F.when(~ends, F.when(down.isNotNull(), F.concat(kept, F.array(here, below))).otherwise(kept))
        state = cut(
            both.select(
                "id",
                path.alias("path"),
                (F.col("questions") + F.when(F.col("done"), 0).otherwise(F.coalesce("__q", F.lit(0)))).alias("questions"),
                (F.col("steps") + F.when(F.col("done"), 0).otherwise(1)).alias("steps"),
                F.when(~F.col("done") & stops, top["node"]).otherwise(F.col("found")).alias("found"),
                ends.alias("done"),
            )
        )
    else:
        raise ValueError(f"terms still walk after {most_steps} steps")
    out = state.select("id", F.col("found").alias("node"), "questions", "steps")
    return terms.select("id").distinct().join(out, "id", "left")


def answer_type(terms: DataFrame, options: DataFrame, answer: Column) -> str:
    """The type of the answers."""
    both = T.StructType([*terms.schema.fields, *options.schema.fields])
    return terms.sparkSession.createDataFrame([], both).select(answer.alias("a")).dtypes[0][1]
