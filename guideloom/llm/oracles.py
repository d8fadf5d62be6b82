"""DuckDB SQL of the registered queries that SQL can express, by plain means and without the operators' filters."""

from .licenses import TEMPLATES

OP1 = r"""
WITH d AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
         ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM documents),
s AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source) x),
-- sources in the order in which they reach their caps; with the first k at theirs, the level that shares the rest
k AS (
  SELECT row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS n, cap / weight AS full_at,
         (1.5 * (SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s),
lv AS (SELECT arg_min(level, n) FILTER (WHERE level <= full_at) AS level FROM k),
g AS (
  SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::INT AS whole
  FROM (SELECT s.*, least(cap, weight * level) AS target FROM s, lv) x),
same AS (SELECT source, draw, sum(size)::BIGINT AS words FROM d GROUP BY source, draw),
run AS (SELECT source, draw, words, sum(words) OVER (PARTITION BY source ORDER BY draw) AS upto FROM same),
m AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.whole + CASE WHEN g.target - g.whole * g.source_size > 0 AND run.upto - run.words / 2.0::DOUBLE <= g.target - g.whole * g.source_size THEN 1 ELSE 0 END AS copies
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source JOIN run ON d.source IS NOT DISTINCT FROM run.source AND d.draw = run.draw)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies::INT AS copies FROM m
"""

OP8 = r"""
WITH p AS (
  SELECT page_id, url,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
         coalesce(regexp_replace(regexp_replace(regexp_extract(url, '://[^/?#]*[^?#]*\?([^#]*)', 1), '(^|&)utm_[^&]*', '', 'g'), '^&', ''), '') AS query
  FROM pages),
c AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS canon FROM p),
listed AS (
  SELECT DISTINCT canon FROM c WHERE regexp_matches(host, '(^|\.)(spam-farm|cheap-pills)\.')),
rules(verdict, h, pre) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (
  SELECT page_id, url, h || pre AS rule, verdict,
         row_number() OVER (PARTITION BY page_id, url ORDER BY length(h || pre) DESC, h || pre) AS n
  FROM (SELECT DISTINCT page_id, url, host, path FROM c) d JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre))
SELECT c.page_id, c.host, c.path, f.rule, coalesce(f.verdict, CASE WHEN l.canon IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, l.canon IS NOT NULL AS listed
FROM c LEFT JOIN fit f ON f.n = 1 AND f.page_id IS NOT DISTINCT FROM c.page_id AND f.url IS NOT DISTINCT FROM c.url
LEFT JOIN listed l ON l.canon = c.canon
"""

OP3 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
sh AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(words) >= 3 THEN list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END)) AS s FROM w),
ids AS (SELECT s, dense_rank() OVER (ORDER BY s) AS v FROM (SELECT s FROM sh GROUP BY s HAVING count(*) > 1) m),
few AS (SELECT sh.doc_id, ids.v FROM sh JOIN ids USING (s)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM few a JOIN few b ON a.v = b.v AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, a AS r FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.r = edges.a),
comp AS (SELECT a, min(r) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(comp.c, d.doc_id) AS component_id, d.doc_id = coalesce(comp.c, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN comp ON comp.a = d.doc_id
"""

OP4 = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, i, b[i + 1:i + 100] AS s FROM (SELECT r, b, unnest(range(0, octet_length(b) - 99)) AS i FROM d WHERE octet_length(b) >= 100) x),
first AS (SELECT s, min(r * 4294967296 + i) AS at FROM w GROUP BY s HAVING count(*) > 1),
again AS (SELECT w.r, w.i FROM w JOIN first USING (s) WHERE w.r * 4294967296 + w.i > first.at),
-- maximal runs of removed bytes: windows whose starts are at most 100 apart run together
step AS (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 100 THEN 0 ELSE 1 END AS new FROM again),
run AS (SELECT r, min(i) AS a, max(i) + 100 AS z FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM step) x GROUP BY r, g),
gap AS (
  SELECT r, z AS a, coalesce(lead(a) OVER (PARTITION BY r ORDER BY a), 4294967296) AS z FROM run
  UNION ALL SELECT r, 0, min(a) FROM run GROUP BY r),
kept AS (SELECT r, unhex(string_agg(hex(b[gap.a + 1:gap.z]), '' ORDER BY gap.a)) AS b FROM gap JOIN d USING (r) GROUP BY r),
n AS (SELECT r, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans FROM run GROUP BY r)
SELECT d.doc_id, octet_length(d.b)::BIGINT AS n_bytes, coalesce(n.n_removed, 0) AS n_removed, coalesce(n.n_spans, 0) AS n_spans, sha256(coalesce(kept.b, d.b)) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN kept USING (r)
"""

_NOTICES = ", ".join(f"('{label}', '{text}')" for label, text in TEMPLATES)

OP6 = rf"""
WITH low AS (SELECT doc_id, row_number() OVER () AS r, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, r, list_filter(regexp_split_to_array(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM low),
phrases(phrase, label, k) AS (VALUES ('under the mit license', 'mit', 4), ('apache license version 2', 'apache-2', 4), ('cc by nc', 'cc-by-nc', 3)),
place AS (SELECT r, label, unnest(list_filter(range(0, len(words)), lambda i: array_to_string(words[i + 1:i + k], ' ') = phrase)) AS p FROM w, phrases),
base AS (SELECT r, count(*) AS n, min(p) AS a, max(p) AS z, list_sort(list_distinct(list(label))) AS labels FROM place GROUP BY r),
notices(label, notice) AS (VALUES {_NOTICES}),
n AS (SELECT label, list_distinct(list_filter(regexp_split_to_array(translate(notice, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS s FROM notices),
block AS (SELECT r, list_distinct(words[32 * b + 1:32 * b + 64]) AS s FROM (SELECT r, words, unnest(range(0, (len(words) - 1) // 32 + 1)) AS b FROM w WHERE len(words) > 0)),
met AS (SELECT r, label, len(list_intersect(block.s, n.s)) / len(n.s) AS share FROM block, n WHERE len(list_intersect(block.s, n.s)) >= ceil(0.8 * len(n.s) - 1e-9)),
more AS (SELECT r, list_distinct(list(label)) AS labels, max(share) AS share FROM met GROUP BY r)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, base.a::BIGINT AS first_word, base.z::BIGINT AS last_word,
       coalesce(array_to_string(base.labels, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels,
       CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE round(coalesce(more.share, 0.0)::DOUBLE, 6) END AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN more USING (r)
"""

QUALITY_COUNTS = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT r, i, array_to_string(words[i:i + 2], ' ') AS s FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w) x),
twice AS (SELECT r, i FROM win JOIN (SELECT r, s FROM win GROUP BY r, s HAVING count(*) > 1) m USING (r, s)),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) v(k) GROUP BY r),
c AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
"""


def _spans(kind: int, name: str, pattern: str, group: int, least: int) -> str:
    """Starts and ends of a pattern's matches, from the lengths of what stands between them."""
    return rf"""
  SELECT r, {kind} AS k, '{name}' AS kind, a[i] AS "start", a[i] + length(m[i]) AS "end" FROM (
    SELECT r, m, g, list_transform(range(1, len(m) + 1), lambda i: list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)) AS a, unnest(range(1, len(m) + 1)) AS i
    FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS g, regexp_split_to_array(t, '{pattern}') AS gaps FROM d) x) y
  WHERE length(g[i]) >= {least}"""


_ASSIGN = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "(password|passwd|secret|token|api_?key)") + r"""["\x27]?\x20*[:=]\x20*["\x27]?([A-Za-z0-9+/_.=-]+)"""

SECRET_BASE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join([_spans(0, "assign", _ASSIGN, 2, 8), _spans(1, "access", "AKIA[A-Z0-9]+", 0, 16), _spans(2, "hex", "[0-9a-f]+", 0, 32)])}),
g AS (SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex, string_agg(kind || ':' || "start"::BIGINT || ':' || "end"::BIGINT, ',' ORDER BY "start", k) AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256
FROM d LEFT JOIN g USING (r)
"""

MEDIA_PAYLOADS = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
n AS (SELECT doc_id, b, octet_length(b) AS n, greatest(1, ceil(octet_length(b) / 576))::BIGINT * 576 AS whole FROM d)
SELECT doc_id, n::BIGINT AS n_bytes, whole::BIGINT AS payload_bytes, sha256(b || unhex(repeat('ff', (whole - n)::INT))) AS payload_sha256 FROM n
"""

#: Checksums of bytes given as hex digits; the table is made by its rule.
CRC_TABLE = "crc AS (SELECT list(c ORDER BY i) AS crc_table FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) AS c FROM range(256) r(i)))"


def crc32_of(digits: str) -> str:
    """SQL for the CRC-32 of what hex digits stand for; crc is among the tables."""
    of_bytes = f"list_transform(range(length({digits}) // 2), lambda j: ('0x' || substr({digits}, 2 * j + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {of_bytes}), lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295)"


_LOWER_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FEATURES = rf"unnest(regexp_extract_all({_LOWER_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w"

OP11 = rf"""
WITH {CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
dw AS (SELECT r, w, count(*) AS n FROM (SELECT r, {_FEATURES} FROM d) x GROUP BY r, w),
bw AS (SELECT w, count(*) AS n FROM (SELECT {_FEATURES} FROM benchmark) x GROUP BY w),
v AS (SELECT w, {crc32_of('h')} % 10000 AS bucket FROM (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM bw) y) x, crc),
s AS (SELECT bucket, sum(n)::DOUBLE AS s FROM dw JOIN v USING (w) GROUP BY bucket),
t AS (SELECT bucket, sum(n)::DOUBLE AS t FROM bw JOIN v USING (w) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000) / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000))))::BIGINT AS gain FROM (SELECT DISTINCT bucket FROM v) b LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
f AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM dw JOIN v USING (w) JOIN g USING (bucket) GROUP BY r),
sc AS (SELECT r, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
       coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM d LEFT JOIN f USING (r)),
k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS k, count(*) OVER () AS n FROM sc WHERE n_features >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score, CASE WHEN k <= 10 * n // 100 THEN k END::BIGINT AS rank FROM sc LEFT JOIN k USING (r)
"""

OP12 = rf"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER_AZ}, '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS w FROM documents) x GROUP BY doc_id, w),
h AS (SELECT w, n, {crc32_of('b')} AS h FROM (SELECT w, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS b FROM d) x, crc),
v AS (SELECT w, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w, n FROM h) x WHERE length(w) >= 5 GROUP BY w HAVING sum(n) >= 3),
-- replaced: both words without the letter at one place are equal; deleted: the longer without a letter is the shorter
gap AS (SELECT w, n, i, substr(w, 1, i - 1) AS a, substr(w, i + 1) AS b FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM v) x),
near AS (
  SELECT x.w, y.w AS near, y.n AS near_n FROM gap x JOIN gap y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.w <> y.w
  UNION SELECT x.w, v.w, v.n FROM gap x JOIN v ON v.w = x.a || x.b
  UNION SELECT v.w, x.w, x.n FROM gap x JOIN v ON v.w = x.a || x.b),
k AS (SELECT w, count(*) AS n_near FROM near GROUP BY w),
f AS (SELECT w, near AS form, near_n AS form_n FROM (SELECT near.*, row_number() OVER (PARTITION BY w ORDER BY near_n DESC, near) AS r FROM near) x WHERE r = 1),
g AS (SELECT v.w, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * v.n THEN form END AS form, CASE WHEN form_n >= 2 * v.n THEN form_n END AS form_n FROM v LEFT JOIN k USING (w) LEFT JOIN f USING (w)),
walk AS (SELECT w, w AS stop FROM g UNION ALL SELECT walk.w, g.form FROM walk JOIN g ON g.w = walk.stop WHERE g.form IS NOT NULL),
e AS (SELECT walk.w, walk.stop FROM walk JOIN g ON g.w = walk.stop WHERE g.form IS NULL)
SELECT w AS word, form, stop AS root, n, n_near::BIGINT AS n_near, form_n FROM g JOIN e USING (w)
"""

LM_BASE = rf"""
WITH {CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, {crc32_of('b')} % 7 = 2 AS held_out, list_append(list_filter(regexp_split_to_array({_LOWER_AZ}, '[\x20\x09-\x0D]+'), lambda x: x <> ''), '') AS t
      FROM (SELECT doc_id, text, hex(encode(coalesce(doc_id::VARCHAR, ''))) AS b FROM documents) x, crc),
w AS (SELECT r, held_out, w, count(*) AS n FROM (SELECT r, held_out, unnest(t) AS w FROM d) x GROUP BY r, held_out, w),
c AS (SELECT w, sum(n)::BIGINT AS c FROM w WHERE NOT held_out GROUP BY w),
m AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM c),
s AS (SELECT r, sum(w.n)::BIGINT AS n_tokens, coalesce(sum(w.n) FILTER (c > 0), 0)::BIGINT AS n_known, sum(w.n * log10((coalesce(c, 0) + 1)::DOUBLE / (m.n + m.v + 1))) AS base FROM w LEFT JOIN c USING (w), m GROUP BY r)
SELECT doc_id, held_out, n_tokens, n_known, m.n AS train_tokens, round(base, 4) AS base_score FROM d JOIN s USING (r), m
"""

ORACLES = {"op1_mixing": OP1, "op3_near_dedup": OP3, "op4_suffix_dedup": OP4, "op6_licenses": OP6, "op8_urls": OP8, "op11_importance": OP11, "op12_spelling": OP12, "quality_counts": QUALITY_COUNTS, "secret_base_kinds": SECRET_BASE, "media_payloads": MEDIA_PAYLOADS, "lm_base_scores": LM_BASE}
