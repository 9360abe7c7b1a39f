"""The registered training-data queries against SQL or brute force over the whole tables of sf0.001, every column."""

from __future__ import annotations

import collections
import hashlib
import html.parser
import math
import re
import zlib

import numpy as np
import oracle
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_llm import WORD, brute_secrets

from archivolt.llm import pii, queries, warc
from archivolt.llm.oracles import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}


@pytest.fixture(scope="module")
def found(spark):
    made: dict = {}

    def rows(name):
        if name not in made:
            made[name] = queries.queries()[name](spark, SF).collect()
        return made[name]

    return rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, name):
    oracle.compare(queries.queries()[name](spark, SF), queries.oracle_sql()[name], SF)


def test_quality_model(found, texts):
    labels = {r["doc_id"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist() if r["quality"] == 1}
    got = found("op2_quality_model")
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        b = re.sub(rb"[ \t\n\x0b\x0c\r]+", b" ", texts[r.doc_id].encode())
        assert (r.n_bytes, r.trusted) == (len(b), r.doc_id in labels)
        assert r.kept == (bool(b) and r.perplexity <= r.threshold) and (not b or 1 < r.perplexity < 5000)
    assert len({(r.lang, r.threshold) for r in got}) == len({r.lang for r in got})
    good = [r.kept for r in got if r.trusted]
    assert sum(good) > 0.95 * len(good)


def test_secret_scan(found, texts):
    got = found("op3_secret_scan")
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        want = brute_secrets(texts[r.doc_id])
        base = [f"{k}:{a}:{b}" for a, _, b, k in want]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for *_, k in want) for n in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("random")] == base
        for s in spans:
            kind, a, b = s.split(":")
            assert kind != "random" or re.fullmatch(r"[A-Za-z0-9+/_-]{20,}={0,2}", texts[r.doc_id][int(a) : int(b)])


def test_sentencepiece(found, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))
    got = found("op4_sentencepiece")
    assert len(got) == len(texts)
    for r in got:
        ids = sp.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_sharding(found, texts):
    got = found("op5_sharding")
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts.items()}
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert set(by) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1


def brute_disclosure(texts, window=2, least=0.9, remove=0.97):
    """Term spans of every text, straight from the definition."""
    edges = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())

    def base(t):
        out = [(m.start(), m.end(), k) for k, n in enumerate(pii.KINDS) for m in re.finditer(pii.PATTERNS[n], t) if pii._passes(n, m[0])]
        return sorted(out, key=lambda x: (x[0], x[2]))

    def terms(t, spans):
        for m in WORD.finditer(t):
            bare = m[0].strip(edges)
            a = m.start() + m[0].find(bare)
            if bare and not any(s < a + len(bare) and a < e for s, e, _ in spans):
                yield bare.lower(), a, a + len(bare), t.count("\n", 0, a)

    joint, holds, lines = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    documents = collections.Counter()
    own = {}
    for i, t in texts.items():
        documents.update({w.strip(edges).lower() for w in WORD.findall(t)} - {""})
        spans = base(t)
        places = list(terms(t, spans))
        near = collections.defaultdict(set)
        for a, b, k in spans:
            at = t.count("\n", 0, a)
            near[pii.entity_of(pii.KINDS[k], t[a:b])].update(range(at - window, at + window + 1))
        own[i] = spans, places, set(near)
        for e, at in near.items():
            holds[e] += 1
            firsts = {}
            for term, _, _, line in places:
                if line in at:
                    firsts.setdefault(term, line)
            for term, line in firsts.items():
                joint[e, term] += 1
                lines[e, term].add(t.split("\n")[line])
    n = len(texts)
    action = {}
    for (e, term), j in joint.items():
        prior, s = holds[e] / n, len(lines[e, term])
        drawn = (j / documents[term] * s + prior) / (s + 1)
        d = math.log(drawn / prior) / -math.log(prior)
        if d >= least:
            action[e, term] = int(d >= remove)
    return {i: (spans, [(a, b, max(action[e, term] for e in entities if (e, term) in action)) for term, a, b, _ in places if any((e, term) in action for e in entities)]) for i, (spans, places, entities) in own.items()}


def test_pii(found, texts):
    want, got = brute_disclosure(texts), found("op6_pii")
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        spans, places = want[r.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for *_, k in spans) for i in range(4))
        base = [f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        every = r.spans.split(",") if r.spans else []
        assert [x for x in every if not x.startswith("term")] == base
        assert [x for x in every if x.startswith("term")] == [f"term:{a}:{b}" for a, b, _ in places]
        assert [int(x.split(":")[1]) for x in every] == sorted(int(x.split(":")[1]) for x in every)


def test_disclosure_equals_its_definition(spark, texts):
    """At thresholds that small data can reach, for the query's own need some thousand documents."""
    want = brute_disclosure(texts, least=0.6, remove=0.8)
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("term", F.lit("clash"))
    got = pii.find_personal_data(docs, carry=["doc_id", "term"], generalise_at=0.6, remove_at=0.8).collect()
    assert {r.doc_id: [(x.s, x.e, x.k) for x in r.terms] for r in got} == {i: places for i, (_, places) in want.items()}
    assert sum(len(p) for _, p in want.values()) > 100 and {k for _, p in want.values() for *_, k in p} == {0, 1}


def test_token_files(found, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    start = 0
    for r in sorted(found("op7_token_files"), key=lambda r: r.doc_id):
        ids = [*tok.encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(found("op7_token_files")) == len(texts)


class _Text(html.parser.HTMLParser):
    """Words of a page by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.silent, self.links = [], 0, []

    def handle_starttag(self, tag, attrs):
        self.silent += tag in warc.SILENT
        self.parts += ["\n"] * (tag in warc.BLOCKS)
        self.links += [v or "" for k, v in attrs if tag == "a" and k == "href"]

    def handle_endtag(self, tag):
        self.silent -= tag in warc.SILENT
        self.parts += ["\n"] * (tag in warc.BLOCKS)

    def handle_data(self, data):
        self.parts += [] if self.silent else [data]


def test_warc_derivatives(found):
    pages = {r["page_id"]: r for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    got = collections.defaultdict(dict)
    for r in found("op8_warc_derivatives"):
        got[r.page_id][r.warc_type] = r
    assert set(got) == set(pages) and all(set(v) == {"metadata", "conversion"} for v in got.values())
    same = 0
    for i, both in got.items():
        body = (pages[i]["html"] or "").encode()
        meta, text = both["metadata"], both["conversion"]
        assert meta.refers_to == text.refers_to and meta.record_id != text.record_id and meta.target_uri == pages[i]["url"]
        assert meta.source_digest == text.source_digest == warc.digest(body)
        parser = _Text()
        parser.feed(body.decode())
        parser.close()
        plain = "\n".join(x for x in (" ".join(line.split()) for line in "".join(parser.parts).split("\n")) if x).encode()
        same += (text.content_length, text.block_digest, text.block_sha256) == (len(plain), warc.digest(plain), hashlib.sha256(plain).hexdigest())
    assert same >= 0.95 * len(pages)  # the two parsers part on malformed pages
