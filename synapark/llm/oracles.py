"""DuckDB SQL for the corpus queries that SQL can express on whole tables."""

SHARDING = """
WITH polynomial AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
sized AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 16 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
checked AS (SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc FROM sized, polynomial),
run AS (SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS before, sum(size) OVER () AS total FROM checked),
cut AS (SELECT *, least(39, before * 40 // total) AS shard FROM run)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(shard AS INT) AS shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INT) AS grown_shard FROM cut
"""

COVER_TREE = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a), c AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(least(c.b, vec_id), vec_id) AS component_id, coalesce(least(c.b, vec_id), vec_id) = vec_id AS kept FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
"""

MINHASH = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= 75 * (x.n + y.n - k)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a), c AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(c.b, d.doc_id), d.doc_id) AS component_id, coalesce(least(c.b, d.doc_id), d.doc_id) = d.doc_id AS kept FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.a = d.doc_id
"""

SUFFIXES = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, unnest(range(1, length(h), 2)) AS p, h FROM h),
s AS (SELECT doc_id, p, substr(h, p, 2) AS x, CASE WHEN p + 199 <= length(h) THEN md5(substr(h, p, 200)) END AS w FROM b),
o AS (SELECT *, w IS NOT NULL AND row_number() OVER (PARTITION BY w ORDER BY doc_id, p) > 1 AS again FROM s),
g AS (SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM o),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS head FROM g),
k AS (SELECT doc_id, count(*) AS n, sum(CASE WHEN gone THEN 1 ELSE 0 END) AS r, sum(CASE WHEN head THEN 1 ELSE 0 END) AS m, string_agg(CASE WHEN gone THEN '' ELSE x END, '' ORDER BY p) AS rest FROM e GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_bytes, CAST(coalesce(r, 0) AS BIGINT) AS n_removed, CAST(coalesce(m, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(rest, ''))) AS kept_sha256 FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id
"""

DIVERGENCE = """
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w, row_number() OVER () AS i FROM documents),
t AS (SELECT lang, source, i, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS whole FROM t GROUP BY lang, term HAVING count(DISTINCT i) >= 30),
v AS (SELECT lang, count(*) AS v, sum(whole) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (coalesce(n.n, 0) + 5 * v.v) AS p, 1 + (CAST(1000000000 AS HUGEINT) * (k.whole + 5)) // (v.total + 5 * v.v) AS q
  FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
r AS (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f)
SELECT lang, source, part, item, value, CAST(rank AS INT) AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""
