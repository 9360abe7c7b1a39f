"""DuckDB SQL of the training-data queries that SQL can express over whole tables: a plain restatement of each result."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = r"[ \t\n\x0B\f\r]"
_WORD = r"[^ \t\n\x0B\f\r]+"
_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLDED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

LINE_QUALITY = f"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
g AS (SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 7, 0) + 1), lambda i: array_to_string(w[i:i + 7], chr(31)))) AS g, unnest(range(1, greatest(len(w) - 7, 0) + 1)) AS i FROM d),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
c AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM r, range(8) x(j) GROUP BY doc_id),
l AS (SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS line FROM d),
u AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id),
p AS (SELECT doc_id, host, t, trim(regexp_replace(lower(line), '{_SPACE}+', ' ', 'g')) AS plain FROM l),
f AS (SELECT host, plain, min(doc_id) AS first FROM p WHERE plain <> '' GROUP BY host, plain HAVING count(DISTINCT t) > 50),
q AS (SELECT doc_id, sum(length(plain) - length(replace(plain, ' ', '')) + 1) AS n FROM p JOIN f USING (host, plain) WHERE doc_id <> first GROUP BY doc_id),
b AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
  coalesce(u.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, CAST(coalesce(q.n, 0) AS BIGINT) AS removed_words
  FROM d LEFT JOIN u USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN q USING (doc_id)),
x AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT *, NOT base_failed AND NOT (removed_words > 0 AND (n_words - removed_words < 20 OR n_words - removed_words < n_words * 0.3)) AS kept FROM x"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '{_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, chr(31))]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], chr(31))) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
t AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(doc_id, m) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, t.y FROM r JOIN t ON r.m = t.x),
k AS (SELECT doc_id, min(m) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM k LEFT JOIN n USING (doc_id)"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '{_ITEM_WORD}') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_FOLDED}, '{_ITEM_WORD}') AS w FROM benchmark),
k AS (SELECT DISTINCT item, least(len(w), 13) AS m, unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2), lambda a: array_to_string(w[a:a + least(len(w), 13) - 1], chr(31)))) AS g FROM i WHERE len(w) > 0),
m AS (SELECT DISTINCT m FROM k),
v AS (SELECT doc_id, m, unnest(range(1, greatest(len(w) - m, -1) + 2)) AS a, w FROM d, m),
h AS (SELECT doc_id, v.m, a, item FROM v JOIN k ON v.m = k.m AND array_to_string(w[a:a + v.m - 1], chr(31)) = k.g),
c AS (SELECT doc_id, count(DISTINCT a + j) AS n_hit FROM h, range(13) x(j) WHERE j < m GROUP BY doc_id),
o AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM h GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN c USING (doc_id) LEFT JOIN o USING (doc_id)"""

_INTEGERS = "list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))"
_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _rounds(n: int) -> str:
    """Assignment a0 by the centroids c0, centroids c1 by their means, and so on to a``n``."""
    out = []
    for i in range(n + 1):
        square = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
        out.append(
            f"d{i} AS MATERIALIZED (SELECT v.r, c.c, CAST({square} AS BIGINT) AS d FROM v, c{i} c),"
            f"a{i} AS MATERIALIZED (SELECT r, c, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"
        )
        if i < n:
            mean = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
            out.append(
                f"s{i} AS (SELECT c, j, sum(x[j]) AS s, count(*) AS n FROM a{i} JOIN v USING (r), range(1, 65) t(j) GROUP BY c, j),"
                f"m{i} AS (SELECT c, list({mean} ORDER BY j) AS x FROM s{i} GROUP BY c),"
                f"c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.x, o.x) AS x FROM c{i} o LEFT JOIN m{i} m USING (c))"
            )
    return ",".join(out)


CENTROIDS = f"""
WITH v AS MATERIALIZED (SELECT vec_id, {_INTEGERS} AS x, row_number() OVER () AS r FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), x) - 1 AS c, x FROM v ORDER BY c LIMIT 40),
{_rounds(5)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c5.x, ',')) AS centroid_sha256 FROM a5 a JOIN v USING (r) JOIN c5 ON c5.c = a.c"""

_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def _p(count: str, total: str, kept: str) -> str:
    return f"1 + (CAST(1000000000 AS HUGEINT) * ({count} + 5)) // ({total} + 5 * {kept})"


DIVERGENCE = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({_FOLDED}, '{_TERM}') AS w FROM documents),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
o AS MATERIALIZED (SELECT r, lang, source, t, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS t FROM d) GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, t, sum(n) AS n FROM o GROUP BY lang, t HAVING count(*) >= 30),
l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
c AS MATERIALIZED (SELECT lang, source, t, sum(o.n) AS n FROM o JOIN k USING (lang, t) GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
p AS MATERIALIZED (SELECT lang, g.source, k.t, coalesce(c.n, 0) AS n, {_p("coalesce(c.n, 0)", "coalesce(s.n, 0)", "l.v")} AS p, {_p("k.n", "l.n", "l.v")} AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN s USING (lang, source) LEFT JOIN c USING (lang, source, t)),
e AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(e.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN e ON e.lang = a.lang AND e.source = a.source AND e.item = b.source),
y AS (SELECT lang, source, 'term' AS part, t AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
z AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM x UNION ALL SELECT * FROM y))
SELECT * FROM z WHERE part = 'pair' OR rank <= 50"""

TOP_SEARCH = f"""
WITH v AS (SELECT vec_id, {_INTEGERS} AS x, row_number() OVER () AS r FROM embeddings WHERE {_FINITE}),
s AS (SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.x) = len(b.x))
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5"""

ORACLES = {"op1_line_quality": LINE_QUALITY, "op9_near_duplicates": NEAR_DUPLICATES, "op10_decontamination": DECONTAMINATION}
ORACLES |= {"op11_centroids": CENTROIDS, "op12_divergence": DIVERGENCE, "op13_top_search": TOP_SEARCH}
