"""Quality rules: cross-document line frequency, in DataFrame functions only.

Lines are normalised (lower case, ASCII white space collapsed and trimmed) and hashed. For each host the distinct
documents of every line are counted, documents with equal texts as one, so exact copies alone make no line frequent. A
line that occurs in more documents of a host than the limit allows is removed everywhere but in its first document
(smallest id). The limit is ``min_documents`` at any size of the host; a caller may ask for ``share`` of the host's distinct
texts where that is more. A document that loses
lines and keeps fewer than ``min_words`` words, or less than ``min_left`` of its words, is depleted and rejected. The
base rules (length, repeated eight-word windows) come first.

Scale: lines are split and hashed once, into a table of hashes in the shared folder. What is shuffled is one row for each line
with a word (host, two hashes, id), combined before the exchange; counts are by (host, line), so a host with a third of all rows spreads over all tasks. Lines under the smallest possible limit
are dropped before hosts' sizes are joined. A very frequent line is a skewed join key, which adaptive execution splits.
Repeated windows are found within a row by sorting hashes, in n log n steps for n words.

Defined results: a null text has no words and fails the base rules; a null host is a host of its own. A null id ranks
after all others. Rows that agree in id and text share their verdict; each is returned. A very long text or line is a row
like any other (its windows are sorted in the row, some 30 bytes for each word). Other columns may have any name; those that
clash with results are left out of ``with_text``. No documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.llm._common import written

SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Up to this many removed lines are broadcast.
BROADCAST_LINES = 500_000


def _word_array(text: Column) -> Column:
    """Words between ASCII white space."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def base_counts(docs: DataFrame, text_col: str, carry: list[str]) -> DataFrame:
    """The carried columns and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of whole texts.

    ``n_repeat_words`` counts the words inside eight-word windows that occur twice or more in the text. Windows are
    compared by 64-bit hashes; positions of repeated ones are found by sorting (hash, position).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(*carry, text.alias("__av_text"))
    t = F.col("__av_text")
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = df.select(
        *carry,
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("__av_lines"),
        F.transform(_word_array(t), lambda w: F.xxhash64(w)).alias("__av_h"),
    )
    kept = [*carry, "word_chars", "n_symbols"]
    h = F.col("__av_h")
    windows = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(h) - WINDOW, F.lit(0))),
        lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(WINDOW))),
    )
    df = df.select(
        *kept,
        (F.size("__av_lines") - F.size(F.array_distinct("__av_lines"))).cast("long").alias("n_dup_lines"),
        F.size(h).cast("long").alias("n_words"),
        F.when(F.size(h) > WINDOW, windows).otherwise(F.array().cast("array<bigint>")).alias("__av_w"),
    )
    kept += ["n_dup_lines", "n_words"]
    # (hash, position) in order; a window is repeated when a neighbour has its hash
    placed = F.sort_array(F.transform("__av_w", lambda w, i: F.struct(w.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    repeats = F.size(F.array_distinct("__av_w")) < F.size("__av_w")
    df = df.select(*kept, F.when(repeats, placed).otherwise(none).alias("__av_s"))
    s = F.col("__av_s")
    like_last = F.zip_with(s, F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), s), lambda x, y: F.struct(x.i.alias("i"), x.h.eqNullSafe(y.h).alias("e")))
    df = df.select(*kept, F.filter(like_last, lambda x: x.i.isNotNull()).alias("__av_e"))
    e = F.col("__av_e")
    later = F.concat(F.filter(e, lambda x, i: i > 0), F.array(F.lit(None).cast("struct<i:int,e:boolean>")))
    marked = F.zip_with(e, later, lambda x, y: F.when(x.e | F.coalesce(y.e, F.lit(False)), x.i))
    df = df.select(*kept, F.sort_array(F.filter(marked, lambda x: x.isNotNull())).alias("__av_p"))
    p = F.col("__av_p")
    after = F.filter(p, lambda x, i: i > 0)
    gaps = F.zip_with(p, after, lambda x, y: F.coalesce(F.least(y - x, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, x: acc + x)
    # a row number times nothing: a filter on the counts must not be pushed below, where it would repeat all of this
    barrier = F.monotonically_increasing_id().bitwiseAND(F.lit(0))
    return df.select(*kept, (covered + barrier).alias("n_repeat_words"))


def _lines(docs: DataFrame, id_col: str, host_col: str, text_col: str) -> DataFrame:
    """One row for each line with a word: host, id, text hash, position, line hash, words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(host_col).alias("host"), F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), F.posexplode(F.split(text, "\n")).alias("pos", "line")
    )
    plain = F.btrim(F.regexp_replace(F.lower("line"), SPACE_CLASS + "+", " "), F.lit(" "))
    base = base.select("host", "id", "th", "pos", plain.alias("plain")).where("plain <> ''")
    words = F.length("plain") - F.length(F.translate("plain", " ", "")) + 1
    return base.select("host", "id", "th", "pos", F.xxhash64("plain").alias("lh"), words.cast("long").alias("words"))


def frequent_lines(lines: DataFrame, docs: DataFrame, host_col: str, text_col: str, min_documents: int, share: float) -> DataFrame:
    """(host, lh, first): lines above their host's limit, with the first document's id and text hash."""
    once = lines.groupBy("host", "lh", "th").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("first"))
    counted = once.groupBy("host", "lh").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("first", "th")).alias("first"))
    counted = counted.where(F.col("n") > min_documents)
    if share <= 0:
        return counted.select("host", "lh", F.col("first.first.id").alias("first_id"), F.col("first.th").alias("first_th"))
    texts = docs.select(F.col(host_col).alias("host"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th")).distinct()
    hosts = texts.groupBy("host").agg(F.count(F.lit(1)).alias("all"))
    joined = counted.alias("c").join(hosts.alias("h"), F.col("c.host").eqNullSafe(F.col("h.host")))
    return joined.where(F.col("n") > F.col("all") * share).select("c.host", "lh", F.col("first.first.id").alias("first_id"), F.col("first.th").alias("first_th"))


def removed_lines(
    docs: DataFrame, *, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", min_documents: int = 50, share: float = 0.0
) -> DataFrame:
    """(id, th, removed positions, removed words) of the documents that lose lines; ``th`` is the text's hash."""
    lines = written(_lines(docs, id_col, host_col, text_col), "lines")
    frequent = written(frequent_lines(lines, docs, host_col, text_col, min_documents, share), "frequent_lines")
    hits = lines.alias("l").join(frequent.alias("f"), (F.col("l.lh") == F.col("f.lh")) & F.col("l.host").eqNullSafe(F.col("f.host")))
    own = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("th") == F.col("first_th"))
    hits = hits.where(~own).select("id", "th", "pos", "words").distinct()
    return hits.groupBy("id", "th").agg(F.collect_list("pos").alias("positions"), F.sum("words").alias("removed_words"))


def line_quality(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    host_col: str = "source",
    text_col: str = "text",
    min_documents: int = 50,
    share: float = 0.0,
    min_words: int = 20,
    min_left: float = 0.3,
    with_text: bool = False,
) -> DataFrame:
    """One row per document: id, n_words, the base counts, base_failed, kept, removed_words; ``with_text`` adds every other
    column of the documents and ``clean_text``, the text without removed lines (null where no text is)."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    results = {*counts, "base_failed", "kept", "removed_words", "clean_text"}
    rest = [c for c in docs.columns if c not in results and c != id_col] if with_text else []
    source = docs.withColumn("__av_th", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    base = base_counts(source, text_col, [id_col, *rest, "__av_th"])
    lost = removed_lines(docs, id_col=id_col, host_col=host_col, text_col=text_col, min_documents=min_documents, share=share)
    if with_text:  # whole texts move unless what is joined is small
        lost = written(lost, "removed_lines")
        if (lost.agg(F.sum(F.size("positions"))).first()[0] or 0) <= BROADCAST_LINES:
            lost = F.broadcast(lost)
    both = base.alias("b").join(lost.alias("r"), F.col(f"b.{id_col}").eqNullSafe(F.col("r.id")) & (F.col("__av_th") == F.col("r.th")), "left")
    removed = F.coalesce(F.col("r.removed_words"), F.lit(0)).cast("long")
    n_words = F.col("b.n_words")
    left = n_words - removed
    failed = (n_words < 20) | (100 * F.col("b.n_repeat_words") > 30 * n_words)
    depleted = (removed > 0) & ((left < min_words) | (left < n_words * min_left))
    out = both.select(
        *(F.col(f"b.`{c}`") for c in [id_col, *rest, *counts]),
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        removed.alias("removed_words"),
        F.col("r.positions").alias("__av_positions"),
    )
    if with_text:
        # positions are few for each document: a line is dropped when its place is among them
        text = F.array_join(F.filter(F.split(F.col(text_col), "\n"), lambda x, i: ~F.array_contains("__av_positions", i)), "\n")
        out = out.withColumn("clean_text", F.when(F.col("__av_positions").isNull(), F.col(text_col)).otherwise(text))
    return out.drop("__av_positions")
