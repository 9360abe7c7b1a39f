"""Every registered query of the base library runs, and agrees with its SQL where it has one."""

from __future__ import annotations

import collections
import difflib
import hashlib
import itertools
import re
import unicodedata

import numpy as np
import oracle
import pyarrow.parquet as pq
import pytest

from archivolt import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        oracle.compare(df, ORACLES[name], sf_dir)
    else:
        BRUTE_FORCE[name](df.collect(), sf_dir)


def _rows(sf_dir, name, *columns):
    return pq.read_table(f"{sf_dir}/{name}.parquet", columns=list(columns)).to_pylist()


def _check_normalised_labels(got, sf_dir):
    def norm(t):
        return " ".join(unicodedata.normalize("NFC", t or "").replace("\xa0", " ").casefold().split())

    want = {r["doc_id"]: hashlib.md5(norm(r["text"]).encode()).hexdigest() for r in _rows(sf_dir, "documents", "doc_id", "text")}
    assert {r.doc_id: r.digest for r in got} == want


def _check_czech_sort(got, sf_dir):
    words = {w for r in _rows(sf_dir, "documents", "text") for w in re.split("[ \t\n\x0b\f\r]+", (r["text"] or "").strip(" ")) if w}
    assert {r.label for r in got} == words
    order = "a b c č d e f g h ch i j k l m n o p q r ř s š t u v w x y z ž".split()
    plain = dict(zip("áéěíóúůýďťň", "aeeiouuydtn", strict=True))
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        by[r.label[:1].lower()].append(r.label)
    for own in by.values():
        firsts = []
        for w in own:
            letters = [c for c in re.findall("ch|.", w.lower(), re.S)]
            if all(plain.get(c, c) in order for c in letters):  # words of the alphabet alone, in order by its letters
                firsts.append([order.index(plain.get(c, c)) for c in letters])
        assert firsts == sorted(firsts)


def _check_statistical_keywords(got, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in _rows(sf_dir, "documents", "doc_id", "text")}
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for doc, rows in by.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1)) and len(rows) <= 10
        assert rows[0].score == 1.0 and all(a.score >= b.score for a, b in zip(rows, rows[1:], strict=False))
        bare = re.sub(r"\W+", " ", texts[doc])
        assert all(re.sub(r"\W+", " ", r.keyword) in bare for r in rows)
        for i, a in enumerate(rows):
            assert all(difflib.SequenceMatcher(None, a.keyword.lower(), b.keyword.lower()).ratio() < 0.9 or difflib.SequenceMatcher(None, b.keyword.lower(), a.keyword.lower()).ratio() < 0.9 for b in rows[:i])


def _check_mmr_keywords(got, sf_dir):
    by = collections.defaultdict(list)
    for r in sorted(_rows(sf_dir, "embeddings", "vec_id", "embedding", "label"), key=lambda r: r["vec_id"]):
        by[r["label"]].append((r["vec_id"], np.array(r["embedding"], float)))
    found = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        found[r.label].append(r.vec_id)
    cosine = lambda a, b: float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))
    for label, own in by.items():
        mean = np.mean([v for _, v in own], axis=0)
        vectors, chosen = dict(own), []
        while len(chosen) < min(10, len(own)):
            value = {i: 0.5 * cosine(v, mean) - 0.5 * max((cosine(v, vectors[c]) for c in chosen), default=0.0) for i, v in own if i not in chosen}
            if not chosen:
                value = {i: cosine(v, mean) for i, v in own}
            chosen.append(max(value, key=value.get))
        assert found[label] == chosen


def _check_chunk_keywords(got, sf_dir):
    from archivolt.plans.text_plans import stub_vectors

    best = collections.defaultdict(dict)
    for r in _rows(sf_dir, "conversations", "conv_id", "text"):
        words = re.findall("[A-Za-z]+", r["text"] or "")
        starts = [0] if 0 < len(words) <= 12 else range(0, len(words), 10)
        for a in starts:
            own = words[a : a + 12]
            phrases = list(dict.fromkeys(" ".join(own[i : i + n]) for n in (1, 2, 3) for i in range(len(own) - n + 1)))
            v = stub_vectors([" ".join(own), *phrases])
            v = v / np.linalg.norm(v, axis=1, keepdims=True)
            near, like, taken = v[1:] @ v[0], v[1:] @ v[1:].T, []
            while len(taken) < min(4, len(phrases)):
                value = near if not taken else 0.5 * near - 0.5 * like[:, taken].max(1)
                taken.append(max((i for i in range(len(phrases)) if i not in taken), key=lambda i: value[i]))
            for i in taken:
                old = best[r["conv_id"]].get(phrases[i], -9.0)
                best[r["conv_id"]][phrases[i]] = max(old, round(float(near[i]), 6))
    want = {(d, k, p, s) for d, own in best.items() for k, (p, s) in enumerate(sorted(own.items(), key=lambda x: (-x[1], x[0]))[:4], 1)}
    have = {(r.doc_id, r["rank"], r.keyword, r.score) for r in got}
    assert len(have & want) >= 0.95 * len(want) and len(have) == len(want)  # phrases of the same words tie up to the last bit


def _check_collision_review(got, sf_dir):
    by = collections.defaultdict(set)
    for r in _rows(sf_dir, "part", "p_name", "p_type"):
        by[r["p_name"].lower()].add(r["p_type"].lower())
    assert {r.n: r.glosses.split(",") for r in got} == {n: sorted(g) for n, g in by.items() if len(g) > 1}

    def alike(a, b):
        x, y = sorted((a, b))
        left, right = set(x.split()), set(y.split())
        return max(difflib.SequenceMatcher(None, x, y).ratio(), len(left & right) / len(left | right))

    assert all(abs(r.worst - min(alike(a, b) for a, b in itertools.combinations(r.glosses.split(","), 2))) < 1e-6 for r in got)


BRUTE_FORCE = {n.removeprefix("_check_"): f for n, f in list(globals().items()) if n.startswith("_check_")}


def test_every_query_is_checked():
    assert set(QUERIES) == set(ORACLES) | set(BRUTE_FORCE)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
