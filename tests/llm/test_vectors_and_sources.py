"""Centroid clustering, exact search and the source audit against brute force: ties, nulls, repeated rows, empty tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re

import numpy as np
import pytest

from archivolt.llm import centroids, divergence, top_search

NAN, INF = float("nan"), float("inf")


def vectors(spark, rows):
    """(vec_id, embedding) with columns whose names clash with results."""
    rows = [(i, v, "c", 7, 1.5) for i, v in rows]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster string, score int, inertia double")


def ints(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def brute_lloyd(rows, k, rounds, dims):
    kept = [(i, ints(v)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in kept)
    centres = [v for _, _, v in first[:k]]

    def assign(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        own = collections.defaultdict(list)
        for _, v in kept:
            own[assign(v)[1]].append(v)
        for c, members in own.items():
            centres[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    got = [(i, *assign(v)[::-1]) for i, v in kept]
    per = collections.Counter()
    for _, c, d in got:
        per[c] += d
    return sorted(((i, c, d, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for i, c, d in got), key=str)


@pytest.mark.parametrize("k", [3, 50])
def test_lloyd_equals_brute_force(spark, k):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(40, 60)]  # ties: many equal vectors, and centroids at one place
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[3][1]), (61, None), (62, [1.0, None, 0.0, 0.0]), (63, [1.0, NAN, 0.0, 0.0])]
    rows += [(64, [INF, 0.0, 0.0, 0.0]), (65, [1.0]), (66, []), (67, [-3000.0, 3000.0, 1e-9, -1e-9])]
    found = centroids.cluster(vectors(spark, rows).repartition(5), k=k, rounds=5, dims=4)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_lloyd(rows, k, 5, 4)


def test_lloyd_without_vectors_and_beyond_its_limit(spark):
    assert centroids.cluster(vectors(spark, []), dims=2).collect() == []
    assert centroids.cluster(vectors(spark, [(1, None), (2, [1.0])]), dims=2).collect() == []
    with pytest.raises(Exception, match="refused"):
        centroids.cluster(vectors(spark, [(1, [1e30, 0.0])]), dims=2).collect()


def test_sums_of_clusters_leave_tasks_as_few_rows(spark):
    """A cluster that holds nearly all vectors costs each task one sum."""
    rows = [(i, [0.0, float(i == 0)]) for i in range(3000)]
    got = centroids.cluster(vectors(spark, rows).repartition(4), k=2, rounds=2, dims=2).collect()
    assert len(got) == 3000 and {r.inertia for r in got} == {sum(r.distance for r in got)}


def brute_search(rows, k):
    live = [(n, i, ints(v)) for n, (i, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, v in live:
        if i is None or i % 50:
            continue
        near = [(-sum(a * b for a, b in zip(v, w, strict=True)), j is None, j or 0) for m, j, w in live if m != n and len(w) == len(v)]
        out += [(i, rank, None if null else j, -s) for rank, (s, null, j) in enumerate(sorted(near)[:k], 1)]
    return sorted(out, key=str)


def searched(frame, k=5):
    found = top_search.exact_top_k(frame, (frame["vec_id"] % 50) == 0, k=k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("block", [(1024, 4096), (2, 7)])
def test_search_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(top_search, "QUERY_BLOCK", block[0])
    monkeypatch.setattr(top_search, "CANDIDATE_BLOCK", block[1])
    monkeypatch.setattr(top_search, "STEP_CANDIDATES", 16)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=18).tolist()) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 400)]  # a vector that a quarter of the rows hold
    rows += [(0, rows[0][1]), (50, rows[5][1]), (None, rows[50][1]), (-50, rows[9][1]), (450, None), (500, [1.0, NAN]), (550, [None])]
    rows += [(600, []), (601, []), (650, [3.0]), (700, [1.0, 2.0]), (701, [-1.0, 0.5]), (750, [0.0] * 18)]
    assert searched(vectors(spark, rows).repartition(6)) == brute_search(rows, 5)


def test_search_of_few_none_and_too_large(spark):
    assert searched(vectors(spark, [])) == []
    assert searched(vectors(spark, [(50, [1.0])])) == []
    assert searched(vectors(spark, [(50, [1.0]), (51, [2.0])])) == [(50, 1, 51, 256 * 512)]
    with pytest.raises(Exception, match="refused"):
        searched(vectors(spark, [(50, [8e6] * 4), (51, [8e6] * 4)]))


def test_bounds_are_upper_bounds_and_tighten():
    rng = np.random.default_rng(3)
    x, y = rng.integers(-500, 500, (50, 19)), rng.integers(-500, 500, (60, 19))
    exact, slack = x @ y.T, []
    for s in (1, 2, 4, 8, 19):
        bound = top_search.segment_features(x, s) @ top_search.segment_features(y, s).T
        assert (bound >= exact - 1e-6).all()
        slack.append((bound - exact).mean())
    assert slack[0] > slack[2] > slack[-1] and np.isclose(slack[-1], 0, atol=1e-6)


def brute_audit(docs, least, k):
    docs = [tuple(x or "" for x in d) for d in docs]
    words = [[w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t)] for t, _, _ in docs]
    df, lang_n, n = collections.Counter(), collections.Counter(), collections.Counter()
    for w, (_, lang, source) in zip(words, docs, strict=True):
        df.update((lang, t) for t in set(w))
        lang_n.update((lang, t) for t in w)
        n.update((lang, source, t) for t in w)
    groups = sorted({d[1:] for d in docs})
    kept = {lang: [t for (x, t), c in df.items() if x == lang and c >= least] for lang, _ in groups}

    def share(count, total, v):
        return 1 + 10**9 * (count + 5) // (total + 5 * v)

    p, out = {}, []
    for lang, source in groups:
        total = sum(n[lang, source, t] for t in kept[lang])
        p[lang, source] = {t: share(n[lang, source, t], total, len(kept[lang])) for t in kept[lang]}
    for lang, source in groups:
        total = sum(lang_n[lang, t] for t in kept[lang])
        own = p[lang, source]
        pairs = [(-sum(abs(own[t] - p[lang, o][t]) for t in own), o.encode()) for x, o in groups if x == lang and o != source]
        terms = [(q - own[t], t.encode()) for t in own if n[lang, source, t] and own[t] > (q := share(lang_n[lang, t], total, len(own)))]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:k])):
            out += [(lang, source, part, item.decode(), -v, r) for r, (v, item) in enumerate(found, 1)]
    return sorted(out)


def some_documents(seed, n=260):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{chr(97 + i // 20)}{chr(97 + i % 20)}" for i in range(120)] + ["Élan", "STRASSE", "straße", "ЖУК"]
    out = []
    for i in range(n):
        lang, source = rng.choice(["en", "de"], p=[0.8, 0.2]), f"s{rng.integers(0, 6) * rng.integers(0, 2)}"
        words = rng.choice(vocabulary, int(rng.integers(0, 60)), p=(z := 1 / np.arange(1, len(vocabulary) + 1)) / z.sum())
        out.append((" ".join(words) + ("\tX1y2Z" if i % 3 else ""), lang, source))
    out += [(None, "en", "s1"), ("", "xx", None), ("alone here", None, "s1"), ("same words " * 3, "en", None), *out[:20]]
    return out + [("wa " * 5000 + "end", "en", "long")]


def audited(spark, docs, **how):
    rows = [(*d, i, "pair", 1) for i, d in enumerate(docs)]
    found = divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string, n long, part string, rank int").repartition(5), **how)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("small", [False, True])
def test_audit_equals_brute_force(spark, monkeypatch, small):
    """Also with cells of few postings and sources, tasks that send often, and joins instead of broadcasts."""
    if small:
        for name, value in (("HELD", 40), ("CELL_POSTINGS", 60), ("CELL_SOURCES", 2), ("BROADCAST_ROWS", 0)):
            monkeypatch.setattr(divergence, name, value)
    docs = some_documents(5)
    for k in (1, 5, 50):
        assert audited(spark, docs, min_documents=8, k=k) == brute_audit(docs, 8, k)


def test_audit_of_nothing_and_without_kept_terms(spark):
    assert audited(spark, []) == []
    docs = [("one two", "en", "a"), ("three", "en", "b"), ("", "de", "a")]
    assert audited(spark, docs) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_ties_at_the_last_rank_are_all_seen(spark):
    docs = [(f"t{chr(97 + i)} common", "en", "a") for i in range(20)] * 2 + [("common", "en", "b")] * 40
    assert audited(spark, docs, min_documents=2, k=3) == brute_audit(docs, 2, 3)


def test_large_counts_stay_exact():
    n = np.array([1, 10**10, 3 * 10**12])
    assert divergence._shares(n, 4 * 10**12, 7).tolist() == [1 + 10**9 * (x + 5) // (4 * 10**12 + 35) for x in n.tolist()]
