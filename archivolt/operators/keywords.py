"""Statistical keyword operators: weighted lemma counts, chunking and best-score merging."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Frequent administrative lemmas that the weighted count penalises.
ADMIN_LEMMAS = (
    "zpráva", "projekt", "číslo", "datum", "rok", "strana", "tabulka", "příloha", "text", "obsah", "kapitola", "část", "oddíl",
)


def surface_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per lower-cased alphabetic word longer than one letter: (doc_id, pos, word).

    A null or empty text gives no rows; a null id is kept as it is.
    """
    words = F.split(F.lower(F.trim(F.col(text_col))), r"\s+")
    exploded = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(words).alias("pos", "word"))
    return exploded.where(F.col("word").rlike(r"^\p{L}+$") & (F.length("word") > 1))


def weighted_top_lemmas(
    lemmas: DataFrame,
    num_keywords: int = 10,
    penalty: float = 0.3,
    stop: Sequence[str] = ADMIN_LEMMAS,
    keys: Sequence[str] = ("doc_id",),
    lemma_col: str = "word",
    pos_col: str = "pos",
) -> DataFrame:
    """Top keywords per key by count, ties by first occurrence.

    The 2N most frequent are chosen before stop lemmas are scaled by ``penalty``, then ordered again;
    a lemma outside the first 2N never returns. Result: keys, rank, keyword, score.
    """
    keys = list(keys)
    counted = lemmas.groupBy(*keys, lemma_col).agg(F.count(F.lit(1)).alias("n"), F.min(pos_col).alias("first_pos"))
    first = Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc("first_pos"))
    head = counted.withColumn("rank_n", F.row_number().over(first)).where(F.col("rank_n") <= 2 * num_keywords)
    score = F.when(F.col(lemma_col).isin(*stop), F.col("n") * F.lit(penalty)).otherwise(F.col("n").cast("double"))
    second = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("rank_n"))
    ranked = head.withColumn("score", score).withColumn("rank", F.row_number().over(second))
    return ranked.where(F.col("rank") <= num_keywords).select(*keys, "rank", F.col(lemma_col).alias("keyword"), "score")


def word_chunks(words: Column, size: int = 400, overlap: int = 50) -> Column:
    """Array of overlapping word windows. Up to ``size`` words there is one; beyond, one starts every ``size - overlap``
    words, so the last can lie wholly inside the one before it. No words: an empty array."""
    step = size - overlap
    n = F.size(words)
    many = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(step)), lambda s: F.slice(words, s + 1, F.lit(size)))
    return F.when(n == 0, F.array().cast("array<array<string>>")).when(n <= size, F.array(words)).otherwise(many)


def fitted_chunks(chunks: Column, cost: Callable[[Column], Column], limit: int, size: int = 400) -> Column:
    """Chunks that are halved (the first half the larger) until each costs ``limit`` at most or is a single word.

    ``cost`` is an encoder's length of an array of words; chunks have up to ``size`` words.
    """

    def halved(c: Column) -> Column:
        half = F.ceil(F.size(c) / 2).cast("int")
        return F.when((cost(c) > limit) & (F.size(c) > 1), F.array(F.slice(c, 1, half), F.slice(c, half + 1, F.size(c) - half))).otherwise(F.array(c))

    for _ in range(max(1, (size - 1).bit_length())):
        chunks = F.flatten(F.transform(chunks, halved))
    return chunks


def best_score_merge(scored: DataFrame, keys: Sequence[str], phrase: str, score: str, num_keywords: int) -> DataFrame:
    """Best score of each phrase over all chunks, then the top ``num_keywords`` per key (ties by phrase)."""
    keys = list(keys)
    best = scored.groupBy(*keys, phrase).agg(F.max(score).alias(score))
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(phrase))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= num_keywords)
