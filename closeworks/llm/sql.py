"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WARC = """
WITH pages_ AS (
  SELECT page_id, url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, upper(sha1(coalesce(html, ''))) AS hex
  FROM pages
), digests AS (
  SELECT DISTINCT hex, (
    SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT + 1, 1), '' ORDER BY i)
    FROM range(32) t(i)
  ) AS payload_digest FROM pages_
), first_ AS (SELECT hex, max(page_id) AS page_id FROM pages_ GROUP BY hex)
SELECT p.page_id, p.payload_bytes, d.payload_digest,
  CASE WHEN p.page_id = f.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id = f.page_id THEN NULL ELSE f.page_id END AS refers_to,
  p.url AS target_uri
FROM pages_ p JOIN digests d USING (hex) JOIN first_ f USING (hex)
"""

PERSPECTIVES = """
WITH turns AS (
  SELECT conv_id, turn // 64 AS part, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
), speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM turns WHERE role <> 'system'
), cuts AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id, part ORDER BY turn, role, text) - 1) // 1024 AS cut FROM turns
), pieces AS (
  SELECT t.conv_id, part, cut, turn, role, text, speaker, role = speaker AS own,
    CASE role WHEN 'system' THEN '<|system|>' WHEN speaker THEN '<|assistant|>'
      ELSE '<|user name=' || replace(replace(role, '<|', '< |'), chr(10), ' ') || '|>' END || chr(10) AS header,
    replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body
  FROM cuts t JOIN speakers s USING (conv_id)
), placed AS (
  SELECT *, coalesce(sum(length(header) + length(body)) OVER (
    PARTITION BY conv_id, part, cut, speaker ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM pieces
)
SELECT conv_id, part, cut, speaker, count(*)::INT AS n_turns, count(*) FILTER (own)::INT AS n_own,
  string_agg(header || body, '' ORDER BY turn, role, text) AS text,
  coalesce(string_agg((place + length(header))::BIGINT || ':' || (place + length(header) + length(body))::BIGINT, ','
    ORDER BY turn, role, text) FILTER (own), '') AS mask
FROM placed GROUP BY conv_id, part, cut, speaker
"""

REPEATS = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents
), starts AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM docs, unnest(range(greatest(n - 49, 0))) u(p)
), firsts AS (SELECT s, min(doc_id) AS least FROM starts GROUP BY s
), marked AS (SELECT doc_id, p FROM starts JOIN firsts USING (s) WHERE least < doc_id
), gone AS (SELECT DISTINCT doc_id, p + k AS b FROM marked, unnest(range(50)) u(k)
), bytes AS (
  SELECT d.doc_id, u.b, substr(h, 2 * u.b + 1, 2) AS x, g.b IS NOT NULL AS cut
  FROM docs d, unnest(range(n)) u(b) LEFT JOIN gone g ON g.doc_id = d.doc_id AND g.b = u.b
), runs AS (SELECT *, cut AND NOT coalesce(lag(cut) OVER (PARTITION BY doc_id ORDER BY b), false) AS head FROM bytes
), summed AS (
  SELECT doc_id, count(*) FILTER (cut) AS n_removed, count(*) FILTER (head) AS n_spans,
    string_agg(x, '' ORDER BY b) FILTER (NOT cut) AS kept
  FROM runs GROUP BY doc_id
)
SELECT d.doc_id, d.n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM docs d LEFT JOIN summed s USING (doc_id)
"""

CONTAMINATION = f"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k + 1:k + least(10, len(w))], ' ') AS s
  FROM items, unnest(range(len(w) - least(10, len(w)) + 1)) u(k) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, k, n, array_to_string(w[k + 1:k + n], ' ') AS s FROM docs, sizes, unnest(range(greatest(len(w) - n + 1, 0))) u(k)
), found AS (SELECT doc_id, k, n, item_id FROM places JOIN windows USING (n, s)
), hit AS (SELECT doc_id, count(DISTINCT k + j) AS n_hit FROM found, unnest(range(n)) u(j) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

SIMILAR = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, hash(w[k + 1:k + 4]) AS g FROM docs, unnest(range(greatest(len(w) - 3, least(len(w), 1)))) u(k)
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), least_ AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN least_ ON a = doc_id
"""

FILL_MIDDLE = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS s, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), dice AS (
  SELECT doc_id, s, u, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS x,
    ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS y,
    CASE WHEN s = '' OR contains(s, '<P>') OR contains(s, '<S>') OR contains(s, '<M>')
      OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
      WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM docs
), pieces AS (
  SELECT doc_id, s, n, form, array_to_string(u[1:least(x, y)], '') AS p,
    array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(u[greatest(x, y) + 1:], '') AS z
  FROM dice
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN s WHEN 'psm' THEN '<P>' || p || '<S>' || z || '<M>' || m
    ELSE '<S>' || z || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(s) AS restored_sha256
FROM pieces
"""

NEGATIVES = """
WITH valid AS MATERIALIZED (
  SELECT vec_id, label, embedding FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND coalesce(list_bool_and([coalesce(isfinite(x), false) for x in embedding]), true)
), scaled AS MATERIALIZED (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) for x in embedding] AS v
  FROM valid
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM scaled a JOIN scaled b ON a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same AND other_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INT AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

NEAR = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, hash(w[k + 1:k + 2]) AS g FROM docs, unnest(range(greatest(len(w) - 1, least(len(w), 1)))) u(k)
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a, b FROM edges UNION SELECT r.a, l.b FROM reach r JOIN edges l ON l.a = r.b
), least_ AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
  coalesce(doc_id <= b, true) AS kept
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN least_ ON a = doc_id
"""

SQL = {
    "op2_warc": WARC,
    "op3_perspectives": PERSPECTIVES,
    "op6_suffix_dedup": REPEATS,
    "op9_decontamination": CONTAMINATION,
    "op10_jaccard_join": SIMILAR,
    "op11_fill_middle": FILL_MIDDLE,
    "op12_hard_negatives": NEGATIVES,
    "op13_lsh_forest": NEAR,
}
