"""Line operators: quality decision, context windows, pages and form-to-lemma lookup.

Lines have the columns doc_id, pos (their order in the document), page, line, text, categ, quality_score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivolt.functions.scalars import letter_ratio
from archivolt.operators.graph import cut

#: Category labels that are always skipped, and those that give no context.
SKIPPED = ("Trash", "Empty")
NOISE = ("Trash", "Empty", "Non-text")
HEADINGS = ("Header", "Heading")


def quality_band(categ: Column, quality: Column) -> Column:
    """Category after re-banding: under 0.40 Trash, under 0.70 Noisy unless Trash already; unknown quality changes nothing."""
    return F.when(quality < 0.40, "Trash").when((quality < 0.70) & (categ != "Trash"), "Noisy").otherwise(categ)


def line_decision(
    text: Column,
    categ: Column,
    quality: Column,
    include_non_text: bool = True,
    min_chars: int = 3,
    min_chars_non_text: int = 8,
    min_letter_ratio: float = 0.40,
) -> Column:
    """Struct (keep, reason): whether a line is worth sending on. Bands are applied first and override any category."""
    text, band = F.coalesce(text, F.lit("")), quality_band(F.coalesce(categ, F.lit("")), quality)
    n = F.length(text)
    non_text = (
        F.when(F.lit(not include_non_text), "non_text_excluded")
        .when(n < min_chars_non_text, "non_text_short")
        .when(letter_ratio(text) < min_letter_ratio, "non_text_letters")
        .otherwise("")
    )
    reason = (
        F.when(text == "", "empty")
        .when(band.isin(*SKIPPED), F.concat(F.lit("categ:"), band))
        .when(band == "Non-text", non_text)
        .when(n < min_chars, "short")
        .otherwise("")
    )
    return F.struct((reason == "").alias("keep"), reason.alias("reason"), band.alias("band"))


def expected_keys(lines: DataFrame, **settings) -> DataFrame:
    """Distinct (file_id, page, line) of kept lines whose page and line are integers."""
    keyed = lines.withColumns({"page": F.col("page").try_cast("int"), "line": F.col("line").try_cast("int")})
    keep = line_decision(F.col("text"), F.col("categ"), F.col("quality_score"), **settings)["keep"]
    return keyed.where(F.col("page").isNotNull() & F.col("line").isNotNull() & keep).select("file_id", "page", "line").distinct()


def context_windows(lines: DataFrame, window: int = 2) -> DataFrame:
    """Adds ``context``: document head, current section, and the lines around each one.

    The frame counts all rows; rows of other pages and noise are dropped inside it. The head (first two lines that are no
    noise) is shown for rows beyond the frame of the first ones only.
    """
    ordered = Window.partitionBy("doc_id").orderBy("pos")
    df = _marked(lines).withColumns(
        {
            "__i": F.row_number().over(ordered) - 1,
            "__section": F.last("__heading", True).over(ordered.rowsBetween(Window.unboundedPreceding, -1)),
        }
    )
    nth = F.sum(F.col("__clear").cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn("__nth", F.when(F.col("__clear"), nth))
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = [F.max(F.when(F.col("__nth") == k, F.concat(F.lit("    "), F.col("__row.shown")))).over(whole) for k in (1, 2)]
    df = df.withColumns({"__frame": F.collect_list("__row").over(ordered.rowsBetween(-window, window)), "__h1": heads[0], "__h2": heads[1]})
    return df.withColumn("context", _context(window)).select(*lines.columns, "context")


def _marked(lines: DataFrame) -> DataFrame:
    """Adds what contexts show of each line: ``__clear`` (no noise), ``__row`` and ``__heading``."""
    text, categ = F.trim(F.coalesce("text", F.lit(""))), F.trim(F.coalesce("categ", F.lit("")))
    place = F.concat(F.lit("[P"), F.col("page").cast("string"), F.lit(" L"), F.col("line").cast("string"), F.lit("] "), text)
    clear = ~categ.isin(*NOISE)
    row = F.struct(F.col("pos"), F.col("page"), clear.alias("clear"), place.alias("shown"))
    return lines.withColumns({"__clear": clear, "__row": row, "__heading": F.when(categ.isin(*HEADINGS), text)})


def _context(window: int) -> Column:
    """The context of a line, of its frame, its section and the document's first clear lines."""
    near = F.filter("__frame", lambda r: (r["pos"] == F.col("pos")) | (r["page"].eqNullSafe(F.col("page")) & r["clear"]))
    shown = F.transform(
        near,
        lambda r: F.when(r["pos"] == F.col("pos"), F.concat(F.lit("<target_line> >>> "), r["shown"], F.lit(" </target_line>"))).otherwise(
            F.concat(F.lit("    "), r["shown"])
        ),
    )
    head = F.when(F.col("__i") > window + 2, F.concat_ws("\n", F.lit("--- GLOBAL DOCUMENT HEADER ---"), "__h1", "__h2"))
    section = F.concat(F.lit("--- CURRENT SECTION: "), F.coalesce("__section", F.lit("Unknown Section")), F.lit(" ---"))
    return F.concat_ws("\n", head, section, F.lit("--- LOCAL CONTEXT WINDOW ---"), F.array_join(shown, "\n"))


def context_windows_split(lines: DataFrame, window: int = 2, partitions: int | None = None) -> DataFrame:
    """As ``context_windows``, for documents that no task should hold: those are split at positions.

    Lines are dealt into ranges of (document, position), written once. A range's part of a document leaves one row: its number
    of lines, its last heading, its first two clear lines, and as many lines at either end as a frame reaches (the halo). A scan
    over a document's parts in order, as few as there are ranges, says what stands before and behind each part; it comes back
    to the part's lines, whose windows then end at the part. A document of all lines is spread over all ranges.

    Positions are unique in a document. ``partitions`` is the number of ranges, the session's shuffle partitions if none is named.
    """
    n = partitions or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lines.repartitionByRange(n, "doc_id", "pos").withColumn("__part", F.spark_partition_id())
    df = _marked(cut(dealt))
    own = Window.partitionBy("doc_id", "__part").orderBy("pos")
    last = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = df.withColumns({"__k": F.row_number().over(own), "__n": F.count(F.lit(1)).over(last), "__c": F.sum(F.col("__clear").cast("int")).over(own.rowsBetween(Window.unboundedPreceding, 0))})

    def some(condition: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(condition, F.struct("pos", F.col("__row").alias("row")))))

    parts = df.groupBy("doc_id", "__part").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.when(F.col("__heading").isNotNull(), F.struct("pos", F.col("__heading").alias("heading"))))["heading"].alias("heading"),
        some(F.col("__clear") & (F.col("__c") <= 2)).alias("clear"),
        some(F.col("__k") <= window).alias("first"),
        some(F.col("__k") > F.col("__n") - window).alias("last"),
    )
    order = Window.partitionBy("doc_id").orderBy("__part")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    flat = lambda c, frame: F.flatten(F.collect_list(c).over(frame))
    rows = lambda c: F.transform(c, lambda x: x["row"])
    behind, ahead = (F.coalesce(rows(flat(c, order.rowsBetween(*frame)))) for c, frame in (("last", (-window, -1)), ("first", (1, window))))
    heads = F.transform(rows(F.slice(flat("clear", order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), 1, 2)), lambda r: F.concat(F.lit("    "), r["shown"]))
    parts = parts.select(
        "doc_id",
        "__part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__above"),
        F.last("heading", True).over(before).alias("__up"),
        behind.alias("__behind"),
        ahead.alias("__ahead"),
        heads.alias("__heads"),
    )
    both = df.join(parts, ["doc_id", "__part"])
    near = F.collect_list("__row").over(own.rowsBetween(-window, window))
    lack, over = F.greatest(F.lit(0), window + 1 - F.col("__k")), F.greatest(F.lit(0), window - (F.col("__n") - F.col("__k"))).cast("int")
    tail = F.slice("__behind", F.greatest(F.size("__behind") - lack, F.lit(0)) + 1, lack)
    both = both.withColumns(
        {
            "__frame": F.concat(tail, near, F.slice("__ahead", F.lit(1), over)),
            "__i": F.col("__above") + F.col("__k") - 1,
            "__section": F.coalesce(F.last("__heading", True).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.col("__up")),
            "__h1": F.get("__heads", F.lit(0)),
            "__h2": F.get("__heads", F.lit(1)),
        }
    )
    return both.withColumn("context", _context(window)).select(*lines.columns, "context")


def pages_of(lines: DataFrame, joiner: str = " ") -> DataFrame:
    """(doc_id, page_pos, page, text, n_lines): lines joined by page, pages in order of first appearance."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", F.coalesce("text", F.lit("")).alias("text"))))
    grouped = lines.groupBy("doc_id", "page").agg(F.min("pos").alias("first"), ordered.alias("parts"), F.count(F.lit(1)).alias("n_lines"))
    order = Window.partitionBy("doc_id").orderBy("first")
    text = F.array_join(F.transform("parts", lambda p: p["text"]), joiner)
    return grouped.select("doc_id", F.row_number().over(order).alias("page_pos"), "page", text.alias("text"), "n_lines")


def documents_of(pages: DataFrame, joiner: str = " ") -> DataFrame:
    """(doc_id, text): pages joined in their order, which can differ from line order."""
    ordered = F.sort_array(F.collect_list(F.struct("page_pos", "text")))
    return pages.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda p: p["text"]), joiner).alias("text"))


def form_lemmas(tokens: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(keys, form, lemma): the most frequent lemma of each folded form, the first seen among equals."""
    keys = list(keys)
    counted = tokens.where(F.col("lemma").isNotNull() & (F.col("lemma") != "_")).groupBy(*keys, "form", "lemma")
    counted = counted.agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    return counted.groupBy(*keys, "form").agg(F.max_by("lemma", F.struct("n", (-F.col("first")).alias("f"))).alias("lemma"))


def outcome(results: Column, attempted: Column, errors: Column, aborted: Column) -> Column:
    """Outcome of a document: failed, contributed, empty or not_asked; any failed line fails the document."""
    return F.when((aborted > 0) | (errors > 0), "failed").when(results > 0, "contributed").when(attempted > 0, "empty").otherwise("not_asked")
