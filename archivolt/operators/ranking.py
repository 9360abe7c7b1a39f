"""Keyword ranking by statistics of a text, and by embeddings with diversity."""

from __future__ import annotations

import heapq
import math
import re
import sys
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivolt.operators.graph import cut
from archivolt.operators.tasks import bounded_batches, dealt

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text in a task that ranks keywords, which takes it some seconds.
RANK_BYTES = 2 << 20

_TOKEN = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|\d+|[^\w\s]", re.U)
_END = re.compile(r"(?<=[.!?])\s+")


def statistical_keywords(text: str, top: int, max_words: int = 3, dedup: float = 0.9, window: int = 1) -> list[tuple[str, float]]:
    """Unsupervised single-document keywords after Campos et al. (2020), lower scores first.

    A term's score joins its case, its position, its frequency, the spread over sentences and how varied its neighbours are;
    a candidate's is the product of its terms' over their sum, divided by its frequency. Similar candidates are dropped.
    """
    sentences = [_TOKEN.findall(s) for s in _END.split(text) if s.strip()]
    tf, upper, where = Counter(), Counter(), defaultdict(list)
    left, right, beside, behind = defaultdict(set), defaultdict(set), Counter(), Counter()  # a term's distinct neighbours, and how many it has
    grams, shown = {}, {}
    for i, tokens in enumerate(sentences):
        low = [t.lower() for t in tokens]
        word = [t[0].isalpha() and len(t) > 2 for t in tokens]
        for j, t in enumerate(tokens):
            if not word[j]:
                continue
            own = low[j]
            tf[own] += 1
            where[own].append(i)
            if j > 0 and t[0].isupper():
                upper[own] += 1
            for k in range(max(0, j - window), j):
                if word[k]:
                    left[own].add(low[k])
                    beside[own] += 1
                    right[low[k]].add(own)
                    behind[low[k]] += 1
            for n in range(j + 1, min(j + max_words, len(tokens)) + 1):
                if not word[n - 1]:
                    break
                gram = own if n == j + 1 else " ".join(low[j:n])
                if gram in grams:
                    grams[gram] += 1
                else:
                    grams[gram], shown[gram] = 1, (i, j, n)
    if not tf:
        return []
    values = np.array(list(tf.values()), float)
    mean, spread, most = values.mean(), values.std(), values.max()
    weight = {}
    for t, n in tf.items():
        at = where[t]  # ascending
        case = upper[t] / (1 + math.log(n))
        place = math.log(math.log(3 + (at[n // 2] if n % 2 else (at[n // 2 - 1] + at[n // 2]) / 2)))
        norm = n / (mean + spread)
        varied = 1 + (len(left[t]) / max(beside[t], 1) + len(right[t]) / max(behind[t], 1)) * n / most
        wide = len(set(at)) / len(sentences)
        weight[t] = (varied * place) / (case + norm / varied + wide / varied)
    scored = []
    for gram, n in grams.items():
        parts = [weight[t] for t in gram.split()]
        scored.append((math.prod(parts) / (n * (1 + sum(parts))), gram))
    heapq.heapify(scored)
    out: list[tuple[str, float]] = []
    while scored and len(out) < top:
        score, gram = heapq.heappop(scored)
        if not any(_alike(gram, g.lower(), dedup) for g, _ in out):
            i, j, n = shown[gram]
            out.append((" ".join(sentences[i][j:n]), score))
    return out


def _alike(a: str, b: str, least: float) -> bool:
    """Whether the character ratio is at least ``least``; its bounds by lengths and by common characters come first."""
    both = len(a) + len(b)
    if both and (2.0 * min(len(a), len(b)) / both < least or 2.0 * (Counter(a) & Counter(b)).total() / both < least):
        return False
    return SequenceMatcher(None, a, b).ratio() >= least


def rank_statistical(docs: DataFrame, top: int = 10, max_words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, rank, keyword, score): statistical keywords, scores turned to [0, 1] with the best at 1."""
    kind = dict(docs.dtypes)[id_col]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for doc, text in zip(pdf[id_col], pdf[text_col], strict=True):
                found = [(k, 1 / (s + 1e-10)) for k, s in statistical_keywords(text or "", top, max_words)]
                best = max((s for _, s in found), default=1.0)
                rows += [(doc, i, k, s / best) for i, (k, s) in enumerate(found, 1)]
            yield pd.DataFrame(rows, columns=[id_col, "rank", "keyword", "score"])

    bounded_batches(docs.sparkSession)
    source = dealt(docs.select(id_col, text_col), text_col, task_bytes=RANK_BYTES)  # even tasks, few enough to be worth a worker
    return source.mapInPandas(run, f"`{id_col}` {kind}, rank int, keyword string, score double")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def _unit(v: Column) -> Column:
    norm = F.greatest(F.sqrt(_dot(v, v)), F.lit(1e-12))
    return F.transform(v, lambda x: x / norm)


def rank_by_embedding(items: DataFrame, group: str, item: str, vector: str, top: int = 5, diversity: float = 0.5) -> DataFrame:
    """(group, rank, item): the items of each group by relevance to its mean, with diversity (Carbonell and Goldstein, 1998).

    Each round picks one item of every group: the one whose relevance, less its likeness to those already picked, is the
    greatest (ties: the smallest item). A round is an aggregation and a join with the picks, so a group may have any size.
    """
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = items.select(F.col(group).alias("g"), F.col(item).alias("i"), v.alias("v"))
    dims = rows.select("g", F.posexplode("v").alias("d", "x")).groupBy("g", "d").agg(F.avg("x").alias("x"))
    means = dims.groupBy("g").agg(_unit(F.transform(F.sort_array(F.collect_list(F.struct("d", "x"))), lambda s: s["x"])).alias("m"))
    now = rows.join(means, "g").select("g", "i", _unit(F.col("v")).alias("u"), _dot(_unit(F.col("v")), F.col("m")).alias("near"), F.lit(None).cast("double").alias("closest"))
    picks = None
    for k in range(1, top + 1):
        now = cut(now)
        value = F.when(F.col("closest").isNull(), F.col("near")).otherwise((1 - diversity) * F.col("near") - diversity * F.col("closest"))
        order = now.withColumn("__o", value).groupBy("g").agg(F.max("__o").alias("__m"))
        first = now.withColumn("__o", value).join(order, "g").where(F.col("__o") == F.col("__m")).groupBy("g").agg(F.min_by(F.struct("i", "u"), "i").alias("p"))
        first = cut(first.select("g", F.col("p.i").alias("pi"), F.col("p.u").alias("pu")))
        part = first.select(F.col("g").alias(group), F.lit(k).alias("rank"), F.col("pi").alias(item))
        picks = part if picks is None else picks.union(part)
        both = now.join(first, "g").where("i <> pi")
        now = both.select("g", "i", "u", "near", F.greatest("closest", _dot(F.col("u"), F.col("pu"))).alias("closest"))
    return picks


def phrases_of(words: list[str], most: int = 3) -> list[str]:
    """Distinct runs of one to ``most`` words, in order of first appearance."""
    return list(dict.fromkeys(" ".join(words[a : a + n]) for n in range(1, most + 1) for a in range(len(words) - n + 1)))


def rank_chunks(chunks: DataFrame, embed: Callable[[list[str]], np.ndarray], top: int = 5, diversity: float = 0.5, most: int = 3, id_col: str = "doc_id") -> DataFrame:
    """(id, rank, keyword, score): phrases of a document's chunks by an injected encoder, scores to six decimals.

    ``chunks``: id, words. Of each chunk the ``top`` phrases by maximal marginal relevance to the chunk are taken with their
    likeness to it; a phrase's score is its best over all chunks. A chunk is bounded, and so is what one call encodes.
    """
    kind = dict(chunks.dtypes)[id_col]

    def one(words: list[str]) -> list[tuple[str, float]]:
        phrases = phrases_of(words, most)
        if not phrases:
            return []
        vectors = embed([" ".join(words), *phrases]).astype(float)
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        near, own = vectors[1:] @ vectors[0], vectors[1:]
        taken = [int(np.argmax(near))]
        closest = own @ own[taken[0]]
        while len(taken) < min(top, len(phrases)):
            value = (1 - diversity) * near - diversity * closest
            value[taken] = -np.inf
            taken.append(int(np.argmax(value)))
            closest = np.maximum(closest, own @ own[taken[-1]])
        return [(phrases[i], round(float(near[i]), 6)) for i in taken]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(doc, k, s) for doc, words in zip(pdf[id_col], pdf["words"], strict=True) for k, s in one(list(words))]
            yield pd.DataFrame(rows, columns=[id_col, "keyword", "score"])

    bounded_batches(chunks.sparkSession)
    found = chunks.select(id_col, "words").mapInPandas(run, f"`{id_col}` {kind}, keyword string, score double")
    best = found.groupBy(id_col, "keyword").agg(F.max("score").alias("score"))
    return top_ranked(best, [id_col], top).select(id_col, "rank", "keyword", "score")


def top_ranked(scored: DataFrame, keys: list[str], top: int) -> DataFrame:
    """The ``top`` rows of each key by score, ties by keyword; adds rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("keyword"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
