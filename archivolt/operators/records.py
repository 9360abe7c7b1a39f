"""Document-record operators: upserts, integrity, summaries, migration and folding of partial records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivolt.functions.scalars import key_text


def _keys(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    kinds = dict(df.dtypes)
    return [key_text(F.col(k), kinds[k]).alias(f"__k{i}") for i, k in enumerate(keys)]


def upsert(base: DataFrame, patch: DataFrame, keys: Sequence[str], granted: Sequence[str], pos: str = "pos") -> DataFrame:
    """Base rows with the granted fields of matching patches, and unmatched patches appended.

    Keys are compared as text (1, 1.0 and "1" agree). A patch's null overwrites. Of equal base keys only the last row is
    patched; of equal patch keys the last one counts. Fields outside ``granted`` are not written. ``pos`` orders both.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    last = Window.partitionBy(*names).orderBy(F.desc(pos))
    left = base.select("*", *_keys(base, keys)).withColumn("__last", F.row_number().over(last) == 1)
    fields = [*keys, *(f for f in granted if f not in keys)]
    right = patch.select(*fields, pos, *_keys(patch, keys)).withColumn("__n", F.row_number().over(last)).where("__n = 1")
    right = right.select(*names, *(F.col(f).alias(f"__p_{f}") for f in fields), F.col(pos).alias("__p_pos"), F.lit(True).alias("__hit"))
    match = F.col("l.__last")
    for n in names:
        match = match & (F.col(f"l.{n}") == F.col(f"r.{n}"))
    both = left.alias("l").join(right.alias("r"), match, "full_outer")
    new = F.col("l.__last").isNull()
    out = []
    for c in base.columns:
        own = F.col(f"l.{c}")
        if c in keys:
            out.append(F.when(new, F.col(f"r.__p_{c}")).otherwise(own).alias(c))
        elif c in granted:
            out.append(F.when(F.col("r.__hit"), F.col(f"r.__p_{c}")).otherwise(own).alias(c))
        elif c == pos:
            out.append(F.when(new, F.col("r.__p_pos")).otherwise(own).alias(c))
        else:
            out.append(own.alias(c))
    return both.select(*out)


def refused_fields(patch: DataFrame, granted: Sequence[str], keys: Sequence[str]) -> list[str]:
    """Columns of a patch that its writer may not write."""
    return sorted(set(patch.columns) - set(granted) - set(keys))


def missing_lines(rows: DataFrame, lines: DataFrame, keys: Sequence[str] = ("page", "line"), doc: str = "doc_id") -> DataFrame:
    """Rows that name a line which their document doesn't have; rows without a line, and documents without lines, pass."""
    names = [f"__k{i}" for i in range(len(keys))]
    known = lines.select(doc, *_keys(lines, keys)).distinct()
    has = lines.select(doc).distinct()
    named = rows.where(F.col(keys[-1]).isNotNull()).select("*", *_keys(rows, keys))
    return named.join(has, doc, "left_semi").join(known, [doc, *names], "left_anti").select(*rows.columns)


def lost_fields(merged: DataFrame, patch: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(keys, field): fields that a patch set and the merged rows don't have."""
    old = merged.select(*keys, *(F.col(f).alias(f"__m_{f}") for f in fields), F.lit(True).alias("__hit"))
    both = patch.join(old, list(keys), "left")
    lost = F.filter(F.array(*(F.when(F.col(f).isNotNull() & F.col(f"__m_{f}").isNull(), F.lit(f)) for f in fields)), lambda x: x.isNotNull())
    return both.select(*keys, F.explode(lost).alias("field"))


def quality_summary(pages: DataFrame, lines: DataFrame, doc: str = "doc_id") -> DataFrame:
    """One row for each document: page counts and exact score statistics; line counts, those of block units apart.

    ``pages``: quality_score, content_status; ``lines``: categ, unit.
    """
    score = F.col("quality_score").cast("double")
    p = pages.groupBy(doc).agg(
        F.count(F.lit(1)).alias("pages_total"),
        F.count_if(F.col("content_status") == "empty").alias("pages_empty"),
        F.count(score).alias("pages_scored"),
        F.avg(score).alias("score_mean"),
        F.median(score).alias("score_median"),
        F.min(score).alias("score_min"),
        F.max(score).alias("score_max"),
    )
    block = F.coalesce(F.col("unit") == "block", F.lit(False))
    named = ~block & (F.coalesce("categ", F.lit("")) != "")
    each = lines.where(named).groupBy(doc, "categ").agg(F.count(F.lit(1)).alias("n"))
    each = each.groupBy(doc).agg(F.sort_array(F.collect_list(F.struct("categ", "n"))).alias("by_categ"))
    total = lines.groupBy(doc).agg(F.count(F.lit(1)).alias("lines_total"), F.count_if(block).alias("block_units"))
    out = p.join(total, doc, "full_outer").join(each, doc, "left")
    return out.fillna(0, ["pages_total", "pages_empty", "pages_scored", "lines_total", "block_units"])


def one_based_lines(lines: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Lines of pages that begin at 0 are renumbered from 1; adds ``shifted``, by which references must move too."""
    low = F.min("line").over(Window.partitionBy(doc, "page"))
    shift = F.when(low == 0, 1).otherwise(0)
    return lines.withColumn("shifted", shift).withColumn("line", F.col("line") + F.col("shifted"))


def moved_references(rows: DataFrame, lines: DataFrame, doc: str = "doc_id") -> DataFrame:
    """References to renumbered pages move along; a line below 1 becomes unknown."""
    moved = lines.where("shifted = 1").select(doc, "page", F.lit(1).alias("__s")).distinct()
    line = F.col("line") + F.coalesce("__s", F.lit(0))
    return rows.join(moved, [doc, "page"], "left").withColumn("line", F.when(line >= 1, line)).select(*rows.columns)


def migrated_pages(pages: DataFrame, lines: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Fills page_index (the label if it is a positive number, else the position) and content_status (text where lines are);
    an empty page loses its score. ``pages`` has pos, from 1."""
    number = F.col("page").try_cast("int")
    with_lines = lines.select(doc, "page", F.lit(True).alias("__t")).distinct()
    index = F.coalesce("page_index", F.when(F.col("page").rlike("^[0-9]+$") & (number > 0), number), F.col("pos").cast("int"))
    status = F.coalesce("content_status", F.when(F.col("__t"), "text").otherwise("empty"))
    out = pages.join(with_lines, [doc, "page"], "left").withColumns({"page_index": index, "content_status": status})
    return out.withColumn("quality_score", F.when(F.col("content_status") != "empty", F.col("quality_score"))).select(*pages.columns)


def fold_records(parts: DataFrame, doc: str, order: str, blocks: Sequence[str], identity: Sequence[str]) -> DataFrame:
    """One record from partial ones: the last non-null block wins, the first identity value wins.

    Adds ``conflicts``: identity fields in which the parts disagree.
    """
    last = [F.max_by(F.col(b), F.when(F.col(b).isNotNull(), F.col(order))).alias(b) for b in blocks]
    first = [F.min_by(F.col(i), F.when(F.col(i).isNotNull(), F.col(order))).alias(i) for i in identity]
    clash = F.filter(F.array(*(F.when(F.count_distinct(F.col(i)) > 1, F.lit(i)) for i in identity)), lambda x: x.isNotNull())
    return parts.groupBy(doc).agg(*last, *first, clash.alias("conflicts"))


def set_block(records_: DataFrame, payload: DataFrame, block: str, key: str = "doc_id") -> DataFrame:
    """Records with one block replaced as a whole where the payload has their key; a null payload empties the block."""
    new = payload.select(key, F.col(block).alias("__new"), F.lit(True).alias("__hit"))
    both = records_.join(new, key, "left")
    return both.withColumn(block, F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(block))).select(*records_.columns)


def first_writer(existing: DataFrame, incoming: DataFrame, key: str, identity: Sequence[str], described: Sequence[str]) -> DataFrame:
    """Source fields: existing values stay, missing ones are filled; ``conflicts`` and ``notes`` name differing fields."""
    new = incoming.select(key, *(F.col(c).alias(f"__n_{c}") for c in [*identity, *described]))
    both = existing.join(new, key, "left")

    def differing(names: Sequence[str]) -> Column:
        found = F.array(*(F.when(F.col(c).isNotNull() & F.col(f"__n_{c}").isNotNull() & (F.col(c) != F.col(f"__n_{c}")), F.lit(c)) for c in names))
        return F.filter(found, lambda x: x.isNotNull())

    values = [F.coalesce(F.col(c), F.col(f"__n_{c}")).alias(c) for c in [*identity, *described]]
    return both.select(key, *values, differing(identity).alias("conflicts"), differing(described).alias("notes"))


def merge_notes(notes: DataFrame, keys: Sequence[str] = ("limit", "effect")) -> DataFrame:
    """Limit notes added by their key: counts sum, the first detail and value stay. ``pos`` orders them."""
    return notes.groupBy(*keys).agg(F.sum("count").alias("count"), F.min_by("detail", F.when(F.col("detail").isNotNull(), F.col("pos"))).alias("detail"), F.min_by("value", F.when(F.col("value").isNotNull(), F.col("pos"))).alias("value"))


def fold_runs(logs: DataFrame, key: str) -> DataFrame:
    """Run logs folded by key: sums, first start, last end, values of the first and last stage, whether any failed; the
    components of all stages, each once, where the logs have them."""
    parts = [F.array_sort(F.array_distinct(F.flatten(F.collect_list("components")))).alias("components")] if "components" in logs.columns else []
    return logs.groupBy(key).agg(
        F.sum("processed").alias("processed"),
        F.sum("skipped").alias("skipped"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.min_by("stage", F.struct("start", "stage")).alias("first_stage"),
        F.max_by("stage", F.struct("end", "stage")).alias("last_stage"),
        F.bool_or("failed").alias("any_failed"),
        *parts,
    )


def controlled_values(frames: dict[str, DataFrame]) -> DataFrame:
    """(scheme, value): distinct values of several blocks; each frame has the one column that its scheme names."""
    out = None
    for scheme, df in frames.items():
        part = df.select(F.lit(scheme).alias("scheme"), F.col(df.columns[0]).cast("string").alias("value"))
        out = part if out is None else out.union(part)
    return out.where("value is not null").distinct()


def project_results(results: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Results as items of their records: a page is text, a line stays only if it is 1 or more and, where the record's lines
    are given, names one of them; items with a page get a citation.

    ``results``: doc_id, page, line (integer or null) and further fields. ``lines``: doc_id, page, line.
    """
    fit = F.when(F.col("line") >= 1, F.col("line"))
    out = results.withColumns({"page": F.col("page").cast("string"), "line": fit})
    if lines is not None:
        known = lines.where("line is not null").select("doc_id", *_keys(lines, ["page", "line"])).distinct().withColumn("__hit", F.lit(True))
        out = out.select("*", *_keys(out, ["page", "line"])).join(known, ["doc_id", "__k0", "__k1"], "left")
        out = out.withColumn("line", F.when(F.col("__hit"), F.col("line"))).drop("__hit", "__k0", "__k1")
    cited = F.when(F.col("page").isNotNull(), F.concat(F.lit("[Source: "), F.col("doc_id").cast("string"), F.lit(", Page "), "page", F.lit("]")))
    return out.withColumn("citation", cited).select(*results.columns, "citation")


#: The run log's current version, and the status of a run that ended.
LOG_MAJOR, COMPLETED = 3, "completed"


def migrated_logs(logs: DataFrame) -> DataFrame:
    """Run logs of any older version in the current one; a newer one raises.

    ``logs``: schema_version and, as versions have them, statistics (1: processed, skipped), processed, skipped, license,
    components, limits_applied, limits, action_status. Version 1 kept its counts in a structure; version 2 kept a calculated
    licence, which goes, and limits under another name, and was written by runs that had ended.
    """
    major = F.coalesce(F.split_part("schema_version", F.lit("."), F.lit(1)).try_cast("int"), F.lit(1))
    checked = F.when(major > LOG_MAJOR, F.raise_error(F.concat(F.lit("newer version "), "schema_version")).cast("int")).otherwise(major)
    first = F.col("__v") < 2
    old = F.col("__v") < LOG_MAJOR
    out = logs.withColumn("__v", checked).withColumns(
        {
            "processed": F.when(first, F.coalesce("processed", "statistics.processed")).otherwise(F.col("processed")),
            "skipped": F.when(first, F.coalesce("skipped", "statistics.skipped")).otherwise(F.col("skipped")),
            "components": F.when(old, F.coalesce("components", F.array().cast("array<string>"))).otherwise(F.col("components")),
            "limits": F.when(old, F.coalesce("limits", "limits_applied", F.array().cast("array<string>"))).otherwise(F.col("limits")),
            "action_status": F.when(old, F.coalesce("action_status", F.lit(COMPLETED))).otherwise(F.col("action_status")),
            "schema_version": F.when(old, F.lit(f"{LOG_MAJOR}.0")).otherwise(F.col("schema_version")),
        }
    )
    return out.drop("__v", "statistics", "license", "limits_applied")


def run_counters(inputs: DataFrame, key: str = "run") -> DataFrame:
    """One row for each run: inputs, processed, skipped, outputs by type, skip reasons by frequency, limit notes, seconds.

    ``inputs``: run, status ("processed", "skipped"), output_type, reason, limited (boolean), started, ended (timestamps).
    """
    ok = F.col("status") == "processed"
    base = inputs.groupBy(key).agg(
        F.count(F.lit(1)).alias("inputs"),
        F.count_if(ok).alias("processed"),
        F.count_if(~ok).alias("skipped"),
        F.count_if(F.coalesce("limited", F.lit(False))).alias("limited"),
        (F.unix_seconds(F.max("ended").cast("timestamp")) - F.unix_seconds(F.min("started").cast("timestamp"))).alias("seconds"),
    )

    def listed(rows: DataFrame, value: str, name: str) -> DataFrame:
        counted = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
        parts = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col(value).alias("v")))), lambda x: F.concat_ws(" ", x["v"], (-x["o"]).cast("string")))
        return counted.groupBy(key).agg(F.array_join(parts, "; ").alias(name))

    out = base.join(listed(inputs.where(ok), "output_type", "outputs"), key, "left").join(listed(inputs.where(~ok), "reason", "reasons"), key, "left")
    return out.fillna("", ["outputs", "reasons"])
