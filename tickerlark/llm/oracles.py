"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

OP5 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) < 2 THEN words
    ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS g FROM w
), t AS (
  SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s
), e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.x = b.x AND a.doc_id <> b.doc_id
    AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), r AS (
  SELECT doc_id AS node, doc_id AS reach FROM s
  UNION
  SELECT e.b, r.reach FROM r JOIN e ON e.a = r.node
)
SELECT s.doc_id, len(any_value(s.g)) AS n_shingles, min(r.reach) AS component_id, s.doc_id = min(r.reach) AS kept
FROM s JOIN r ON r.node = s.doc_id GROUP BY s.doc_id
"""

OP6 = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS t FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(t, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(t, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), o AS (
  SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 WHEN quality IS NOT NULL THEN 0 END) AS bad FROM labels GROUP BY doc_id
), h0 AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k FROM p LEFT JOIN o ON o.doc_id = p.page_id GROUP BY host
), h1 AS (
  SELECT *, CASE WHEN len(string_split(host, '.')) < 2 THEN host ELSE array_to_string(string_split(host, '.')[-2:], '.') END AS two FROM h0
), h AS (
  SELECT host, n, k,
    CASE WHEN two IN ('co.uk', 'org.uk', 'com.au', 'co.jp', 'com.br') THEN array_to_string(string_split(host, '.')[-3:], '.') ELSE two END AS domain,
    CASE WHEN two IN ('co.uk', 'org.uk', 'com.au', 'co.jp', 'com.br') THEN two ELSE string_split(host, '.')[-1] END AS suffix FROM h1
), g AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS mu FROM h),
s0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(mu) AS mu FROM h, g GROUP BY suffix),
sr AS (SELECT 1 / least(0.5, greatest(0.001, coalesce((sum((k - n * mu) ** 2 / (mu * (1 - mu))) - sum(n)) / nullif(sum(n * (n - 1)), 0), 0))) - 1 AS m FROM s0),
s AS (SELECT suffix, (k + m * mu) / (n + m) AS mu FROM s0, sr),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k, any_value(mu) AS mu FROM h JOIN s USING (suffix) GROUP BY domain, suffix),
dr AS (SELECT 1 / least(0.5, greatest(0.001, coalesce((sum((k - n * mu) ** 2 / (mu * (1 - mu))) - sum(n)) / nullif(sum(n * (n - 1)), 0), 0))) - 1 AS m FROM d0),
d AS (SELECT domain, suffix, (k + m * mu) / (n + m) AS mu FROM d0, dr),
x0 AS (SELECT host, n, k, mu FROM h JOIN d USING (domain, suffix)),
xr AS (SELECT 1 / least(0.5, greatest(0.001, coalesce((sum((k - n * mu) ** 2 / (mu * (1 - mu))) - sum(n)) / nullif(sum(n * (n - 1)), 0), 0))) - 1 AS m FROM x0),
x AS (SELECT host, k + m * mu AS a, n - k + m * (1 - mu) AS b FROM x0, xr),
y AS (SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.25 AS bad FROM x),
z AS (
  SELECT page_id, host, path, bad, CASE
    WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM p JOIN y USING (host)
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN bad THEN 'block' ELSE 'allow' END AS verdict FROM z
"""

OP9 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

OP10 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) + 1
    + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

OP11 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) < 4 THEN [array_to_string(words, ' ')][1:least(len(words), 1)]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS g FROM w
), t AS (
  SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s
), e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.x = b.x AND a.doc_id <> b.doc_id
    AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), r AS (
  SELECT doc_id AS node, doc_id AS reach FROM s
  UNION
  SELECT e.b, r.reach FROM r JOIN e ON e.a = r.node
), k AS (SELECT a AS doc_id, count(*) AS n FROM e GROUP BY a)
SELECT s.doc_id, len(any_value(s.g)) AS n_shingles, min(r.reach) AS component_id, coalesce(any_value(k.n), 0) AS n_links
FROM s JOIN r ON r.node = s.doc_id LEFT JOIN k ON k.doc_id = s.doc_id GROUP BY s.doc_id
"""

OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), t AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p FROM f),
l AS (SELECT lang, term, sum(n) AS n FROM f GROUP BY lang, term),
q AS (SELECT lang, term, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q FROM l),
b AS (SELECT a.lang, a.source, z.source AS item, sum(abs(a.p - z.p)) AS value FROM p a JOIN p z ON a.lang = z.lang AND a.term = z.term AND a.source <> z.source GROUP BY a.lang, a.source, z.source),
w AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(b.value, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN b ON b.lang = x.lang AND b.source = x.source AND b.item = y.source
  UNION ALL SELECT p.lang, p.source, 'term', p.term, p.p - q.q FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q
), z AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM w)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM z WHERE part = 'pair' OR rank <= 50
"""

OP13 = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
), r AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents
), u AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, run, count(*) AS m FROM r GROUP BY 1, 2),
h AS (
  SELECT run, m, xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), CAST(128 + (unicode(c) & 63) AS BIGINT)] END))),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h FROM u, tab
), x AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, m FROM h),
v AS (SELECT word, CAST(sum(m) AS BIGINT) AS n FROM x WHERE length(word) >= 5 GROUP BY word HAVING sum(m) >= 3),
s AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
e AS (SELECT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS less, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS hole FROM s),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM e a JOIN e b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT e.word, e.n, v.word, v.n FROM e JOIN v ON v.word = e.less
  UNION SELECT v.word, v.n, e.word, e.n FROM e JOIN v ON v.word = e.less
), o AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS rank, count(*) OVER (PARTITION BY word) AS n_near FROM near),
f AS (
  SELECT v.word, v.n, coalesce(o.n_near, 0) AS n_near, CASE WHEN o.other_n >= 2 * v.n THEN o.other END AS form, CASE WHEN o.other_n >= 2 * v.n THEN o.other_n END AS form_n
  FROM v LEFT JOIN o ON o.word = v.word AND o.rank = 1
), w AS (
  SELECT word, word AS root FROM f
  UNION SELECT w.word, f.form FROM w JOIN f ON f.word = w.root WHERE f.form IS NOT NULL
), z AS (SELECT w.word, w.root FROM w JOIN f ON f.word = w.root WHERE f.form IS NULL)
SELECT f.word, f.form, z.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM f JOIN z USING (word)
"""

ORACLES = {"op5_near_duplicates": OP5, "op6_url_filter": OP6, "op9_top_products": OP9, "op10_chat_format": OP10, "op11_set_join": OP11, "op12_source_divergence": OP12, "op13_spelling_variants": OP13}
