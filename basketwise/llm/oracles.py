"""DuckDB equivalents of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"

# links (u, v) with u < v and nodes (id) are given; the smallest id that links reach
_REACH = """
pairs AS (SELECT u AS a, v AS b FROM links UNION SELECT v, u FROM links),
reach AS (SELECT id AS a, id AS b FROM nodes UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a),
comp AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)
"""

OP1 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p
), m AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM d
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> least THEN least END AS refers_to
FROM m
"""

OP2 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM w
), g AS (SELECT doc_id, len(s) AS n, unnest(s) AS gram FROM s),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS nu, any_value(b.n) AS nv, count(*) AS both_have
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (SELECT u, v FROM shared WHERE 100 * both_have >= 75 * (nu + nv - both_have)),
nodes AS (SELECT doc_id AS id FROM documents),
{_REACH}
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM s JOIN comp ON comp.id = doc_id
"""

OP5 = f"""
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    AND len(list_filter(embedding, lambda v: v <> 0)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM e a JOIN e b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98
), nodes AS (SELECT vec_id AS id FROM embeddings),
{_REACH},
n AS (SELECT a AS id, count(*) AS n_links FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN comp ON comp.id = vec_id LEFT JOIN n ON n.id = vec_id
"""

OP6 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
byte AS (SELECT doc_id, h, n, unnest(range(0, n)) AS i FROM d),
w AS (SELECT doc_id, i, n, substr(h, 2 * i + 1, 100) AS s, substr(h, 2 * i + 1, 2) AS b FROM byte),
hit AS (
  SELECT doc_id, i, b, CASE WHEN i + 50 <= n AND min(CASE WHEN i + 50 <= n THEN doc_id END) OVER (PARTITION BY s) < doc_id THEN i END AS start
  FROM w
), cover AS (
  SELECT doc_id, i, b, max(start) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM hit
), edge AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM cover),
r AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
         coalesce(string_agg(b, '' ORDER BY i) FILTER (NOT gone), '') AS kept
  FROM edge GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""

OP7 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
each AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
win AS (SELECT doc_id, i, w[i] AS word, CASE WHEN i + 34 <= len(w) THEN array_to_string(w[i:i + 34], ' ') END AS s FROM each),
hit AS (SELECT doc_id, i, word, CASE WHEN s IS NOT NULL AND count(s) OVER (PARTITION BY s) > 1 THEN i END AS start FROM win),
cover AS (
  SELECT doc_id, i, word, max(start) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM hit
), r AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept
  FROM cover GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""

_TURNS = "list_transform({0}, lambda t: '<|im_start|>' || coalesce(t.r, '') || chr(10) || coalesce(t.x, '') || '<|im_end|>' || chr(10))"
_RUNS = (
    "list_transform({0}, lambda t: (length('<|im_start|>' || coalesce(t.r, '')) + 1) || ':0,' || (length(coalesce(t.x, '')) + 11) || ':' "
    "|| CASE WHEN t.r = 'assistant' THEN '1' ELSE '0' END)"
)

OP9 = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({{'r': role, 'x': text}} ORDER BY turn, role, text) AS l FROM t GROUP BY conv_id),
o AS (SELECT l[1] AS f, min(conv_id) AS chosen_id FROM c GROUP BY 1),
p AS (
  SELECT chosen_id, conv_id AS rejected_id FROM c JOIN o ON c.l[1] = o.f WHERE conv_id <> chosen_id
  UNION SELECT a.conv_id, b.conv_id FROM c a JOIN c b ON b.conv_id = a.conv_id + 1 WHERE a.conv_id % 2 = 0
), j AS (
  SELECT chosen_id, rejected_id, a.l AS a, b.l AS b,
    coalesce(list_min(list_filter(range(1, least(len(a.l), len(b.l)) + 1), lambda i: a.l[i] IS DISTINCT FROM b.l[i])),
             least(len(a.l), len(b.l)) + 1) - 1 AS n
  FROM p JOIN c a ON a.conv_id = chosen_id JOIN c b ON b.conv_id = rejected_id
), k AS (SELECT chosen_id, rejected_id, n, a[1:n] AS shared, a[n + 1:] AS a, b[n + 1:] AS b FROM j)
SELECT chosen_id, rejected_id, n::INTEGER AS prompt_turns,
  coalesce(array_to_string({_TURNS.format("shared")}, ''), '') AS prompt,
  coalesce(array_to_string({_TURNS.format("a")}, ''), '') AS chosen,
  coalesce(array_to_string({_TURNS.format("b")}, ''), '') AS rejected,
  coalesce(array_to_string({_RUNS.format("a")}, ','), '') AS chosen_mask,
  coalesce(array_to_string({_RUNS.format("b")}, ','), '') AS rejected_mask
FROM k
"""

# the crc32 of {0}, a string, by the 256 values of the table `crc(t)` that _CRC makes from the polynomial
_CRC = """
bits(i, k, v) AS (
  SELECT i::BIGINT, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE k < 8
), crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8)
"""
_CRC_OF = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode({0}))), "
    "lambda i: ('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::BIGINT)), "
    "lambda c, b: xor(c // 256, crc.t[xor(c % 256, b) + 1])))"
)

OP11 = f"""
WITH RECURSIVE {_CRC},
r AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), d AS (SELECT doc_id, run, count(*) AS c FROM r GROUP BY ALL),
h AS (SELECT run, c, {_CRC_OF.format("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM d, crc),
w AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(c)::BIGINT AS n
  FROM h GROUP BY 1
), words AS MATERIALIZED (SELECT * FROM w WHERE length(word) >= 6 AND n >= 5),
place AS (SELECT word, n, unnest(range(0, length(word))) AS i FROM words),
gap AS MATERIALIZED (SELECT word, n, left(word, i) AS a, substr(word, i + 2) AS b FROM place),
near AS (
  SELECT x.word, y.word AS near, y.n FROM gap x JOIN gap y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT gap.word, words.word, words.n FROM gap JOIN words ON words.word = gap.a || gap.b
  UNION SELECT words.word, gap.word, gap.n FROM gap JOIN words ON words.word = gap.a || gap.b
), best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-n, encode(near))) AS near, max(n) AS near_n FROM near GROUP BY word
), f AS MATERIALIZED (
  SELECT word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * words.n THEN near END AS form,
         CASE WHEN near_n >= 5 * words.n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), path(word, here, k) AS (
  SELECT word, word, 0 FROM f UNION ALL SELECT path.word, f.form, k + 1 FROM path JOIN f ON f.word = path.here WHERE f.form IS NOT NULL
), root AS (SELECT word, arg_max(here, k) AS root FROM path GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN root USING (word)
"""

OP12 = f"""
WITH RECURSIVE {_CRC},
own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (SELECT conv_id, l, ({_CRC_OF.format("conv_id::VARCHAR")} % 4)::BIGINT AS h FROM own, crc),
c AS (
  SELECT h.conv_id, list_concat(coalesce(head.l[1:h.h], []), h.l[h.h + 1:]) AS l
  FROM h LEFT JOIN own head ON head.conv_id = h.conv_id - h.conv_id % 20
), p AS (SELECT conv_id, d, l[1:d] AS s, d = len(l) AS ends FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM c)),
node AS (
  SELECT s, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
         (count(*) - 1) * coalesce(len(regexp_extract_all(any_value(s)[d].x, {_WORDS})), 0) AS saved
  FROM p GROUP BY s, d
), kids AS (SELECT s[1:d - 1] AS s, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
n AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (s)),
up AS (SELECT n.d, n.n_children, n.saved, unnest(range(0, n.d + 1)) AS top, n.s FROM n),
total AS (
  SELECT s[1:top] AS s, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM up GROUP BY 1
)
SELECT n.conv_id, n.d::BIGINT AS depth, parent.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
FROM n JOIN total USING (s) LEFT JOIN n parent ON parent.s = n.s[1:n.d - 1] AND parent.d = n.d - 1
"""

ORACLES: dict[str, str] = {
    "op1_warc": OP1,
    "op2_ngram_join": OP2,
    "op5_near_vectors": OP5,
    "op6_suffix": OP6,
    "op7_substring": OP7,
    "op9_preferences": OP9,
    "op11_spelling": OP11,
    "op12_prefix_trie": OP12,
}
