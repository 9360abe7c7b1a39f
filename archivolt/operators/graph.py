"""Hierarchy operators: parents, roots, subtrees, depth, chunks and options of a decision tree.

Nodes have ids, edges are (child, parent), with one parent for each child. Paths are followed by pointer doubling, so a
hierarchy of any depth takes as many joins as the logarithm of its depth, and each join is spread over the cluster.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from archivolt.functions.scalars import czech_order

RESERVED = ("<this term>", "none_of_these")


def choose_parents(terms: DataFrame, near: DataFrame, broader: DataFrame) -> DataFrame:
    """(child, parent, via): one parent for each term, the nearest ancestor of the first source, else the first broader term
    of the second, in the same theme and never itself.

    ``terms``: pos, theme, ids (array of source, id). ``near``: theme, id, ancestor. ``broader``: id, at, ancestor.
    """
    ident = terms.select("pos", "theme", F.posexplode("ids").alias("i", "x")).select("pos", "theme", "i", F.col("x.source").alias("source"), F.col("x.id").alias("id"))
    by_id = ident.select("theme", F.col("id").alias("ancestor"), F.col("pos").alias("parent")).distinct()
    one = ident.join(near, ["theme", "id"]).join(by_id, ["theme", "ancestor"]).where("parent <> pos")
    one = one.groupBy("pos").agg(F.min(F.struct("i", "parent"))["parent"].alias("first"))
    two = ident.join(broader, "id").join(by_id, ["theme", "ancestor"]).where("parent <> pos")
    two = two.groupBy("pos").agg(F.min(F.struct("i", "at", "parent"))["parent"].alias("second"))
    both = one.join(two, "pos", "full_outer")
    via = F.when(F.col("first").isNotNull(), "nearest").otherwise("broader")
    conflict = F.coalesce(F.col("first") != F.col("second"), F.lit(False))
    return both.select(F.col("pos").alias("child"), F.coalesce("first", "second").alias("parent"), via.alias("via"), conflict.alias("conflict"))


def _checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one is set only in local mode where none is named."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="archivolt-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cuts lineage in the session's checkpoint folder."""
    _checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the session's checkpoint folder, for tables that a query writes and reads again."""
    return f"{_checkpoint_folder(spark).rstrip('/')}/archivolt-{uuid.uuid4().hex}"


def break_cycles(edges: DataFrame) -> DataFrame:
    """Edges without the one that leaves the smallest node of each cycle.

    Parents are unique, so pointers can be doubled. Each doubling drops the chains that end, as long as there are any; when
    it drops none, all that are left run into a cycle. Once they have taken as many steps as there are of them, their ends
    are the nodes on cycles, and the least node that such an end has met is its cycle's.
    """
    jump = edges.select(F.col("child").alias("start"), F.col("parent").alias("node"), F.least("child", "parent").alias("low"))
    before, left, steps = -1, edges.count(), 1
    while left and (left != before or steps < left):
        far = jump.select(F.col("start").alias("node"), F.col("node").alias("next"), F.col("low").alias("far"))
        jump = cut(jump.join(far, "node").select("start", F.col("next").alias("node"), F.least("low", "far").alias("low")))
        before, left, steps = left, jump.count(), 2 * steps
    if not left:
        return edges
    cyclic = jump.select(F.col("node").alias("start")).distinct()
    first = jump.join(cyclic, "start", "left_semi").where("start = low").select(F.col("start").alias("child"))
    return edges.join(first, "child", "left_anti")


def ancestors_of(nodes: DataFrame, edges: DataFrame, marked: DataFrame | None = None) -> DataFrame:
    """(id, root, level, hit): the topmost ancestor of every node, how far up it is, and whether the node or any ancestor is
    among ``marked`` (id). A node whose parent is no node is a root. Raises on a cycle.
    """
    known = nodes.select("id").distinct()
    inner = edges.select(F.col("child").alias("id"), "parent").join(known.select(F.col("id").alias("parent")), "parent", "left_semi")
    up = known.join(inner, "id", "left")
    hit = F.lit(False)
    if marked is not None:
        up = up.join(marked.select("id", F.lit(True).alias("__m")).distinct(), "id", "left")
        hit = F.coalesce("__m", F.lit(False))
    up = cut(up.select("id", F.coalesce("parent", "id").alias("root"), F.col("parent").isNotNull().cast("long").alias("level"), hit.alias("hit")))
    most, steps = up.count(), 1
    while True:
        far = up.select(F.col("id").alias("root"), F.col("root").alias("__top"), F.col("level").alias("__more"), F.col("hit").alias("__hit"))
        both = up.join(far, "root")
        after = both.select("id", F.col("__top").alias("root"), (F.col("level") + F.col("__more")).alias("level"), (F.col("hit") | F.col("__hit")).alias("hit"))
        moved = both.where("__top <> root").count()
        if not moved:
            return after
        if steps > 2 * most:
            raise ValueError("the edges have a cycle")
        up, steps = cut(after), 2 * steps


def roots_of(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, root, level): the topmost ancestor of every node, at level 0 for a root. Raises on a cycle."""
    return ancestors_of(nodes, edges).select("id", "root", F.col("level").cast("int").alias("level"))


def withheld(nodes: DataFrame, edges: DataFrame, forms: DataFrame) -> DataFrame:
    """(id): the given nodes with all that lies below them."""
    return ancestors_of(nodes, edges, forms).where("hit").select("id")


def sorted_children(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(parent, child, rank): children in Czech order of their labels (``nodes``: id, label)."""
    named = edges.join(nodes.select(F.col("id").alias("child"), "label"), "child").withColumn("key", czech_order("label"))
    return named.select("parent", "child", F.row_number().over(Window.partitionBy("parent").orderBy("key", "child")).alias("rank"))


def chunked(children: DataFrame, size: int) -> DataFrame:
    """Adds ``chunk``: children split evenly into the fewest chunks of at most ``size``."""
    n = F.count(F.lit(1)).over(Window.partitionBy("parent"))
    step = F.ceil(n / F.ceil(n / size))
    return children.withColumn("chunk", F.floor((F.col("rank") - 1) / step).cast("int"))


def node_options(children: DataFrame, nodes: DataFrame) -> DataFrame:
    """(parent, rank, label, child): options with unique labels; a repeated or reserved label gets the English one, else the id.

    ``nodes``: id, label, en.
    """
    df = children.join(nodes.select(F.col("id").alias("child"), "label", "en"), "child")
    first = F.row_number().over(Window.partitionBy("parent", "label").orderBy("rank")) == 1
    taken = ~first | F.col("label").isin(*RESERVED)
    df = df.withColumn("label", F.when(taken & F.col("en").isNotNull(), F.format_string("%s [%s]", "label", "en")).otherwise(F.col("label")))
    again = F.row_number().over(Window.partitionBy("parent", "label").orderBy("rank")) > 1
    label = F.when(again | F.col("label").isin(*RESERVED), F.format_string("%s <%s>", F.col("label"), F.col("child").cast("string"))).otherwise(F.col("label"))
    return df.withColumn("label", label).select("parent", "rank", "label", "child")


def tree_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: nodes, roots, inner nodes, deepest level, widest node's children."""
    levels = roots_of(nodes, edges)
    width = edges.groupBy("parent").agg(F.count(F.lit(1)).alias("n"))
    a = levels.agg(F.count(F.lit(1)).alias("nodes"), F.count_if(F.col("level") == 0).alias("roots"), F.max("level").alias("deepest"))
    b = width.agg(F.count(F.lit(1)).alias("inner_nodes"), F.max("n").alias("widest"))
    return a.join(F.broadcast(b))  # one row each


def chained_pages(pages: DataFrame) -> DataFrame:
    """(path, at): saved pages of a harvest in the order of its resumption tokens, from the page without a request.

    ``pages``: path, request (the token that asked for the page; null for the first), token (null or blank on the last),
    problem. The chain ends at a page that is missing or has a problem: what came before is a partial result.
    """
    good = pages.where("problem is null")
    token = good.select(F.col("path").alias("parent"), F.nullif(F.trim("token"), F.lit("")).alias("request")).where("request is not null")
    edges = good.select(F.col("path").alias("child"), "request").join(token, "request").groupBy("child").agg(F.min("parent").alias("parent"))
    first = good.where("request is null").select(F.col("path").alias("root"))
    return roots_of(good.select(F.col("path").alias("id")), edges).join(first, "root", "left_semi").select(F.col("id").alias("path"), F.col("level").alias("at"))
