"""DuckDB statements with the results of the numbered queries, where SQL can express them.

They enumerate windows, shingles and pairs outright. There is none for tokens of a vocabulary
(op1), for estimates and iterations over the corpus (op3, op9, the pipeline), for markup (op7),
for voting over templates (op10) and for an approximate search (op11); ``tests/llm`` compares those with plain Python.
"""

from __future__ import annotations

SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PLAIN = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(LOWER.format("text"))

MIX = f"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len({SPACED.format("text")}) END AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS number, 3 * source_size AS cap FROM s),
w AS (SELECT *, (number - 1) % 3 + 1 AS weight, (SELECT sum(source_size) FROM s) AS budget FROM n),
o AS (
  SELECT *, sum(weight) OVER (ORDER BY cap / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS others,
    budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM w),
c AS (SELECT *, cap * others <= room * weight AS capped FROM o),
f AS (SELECT max(budget) - coalesce(sum(cap) FILTER (capped), 0) AS room, sum(weight) FILTER (NOT capped) AS weights FROM c),
t AS (
  SELECT c.*, CASE WHEN capped THEN cap::DOUBLE ELSE f.room::DOUBLE * weight / f.weights::DOUBLE END AS target FROM c, f),
k AS (SELECT d.doc_id, d.size, t.source_size, t.number, t.target, t.budget FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
turns AS (
  SELECT *, unnest(range(1, ceil(target / source_size)::BIGINT + 1)) AS turn FROM k WHERE size > 0 AND target > 0),
q AS (
  SELECT *, sum(size) OVER (PARTITION BY number ORDER BY turn, md5(turn::VARCHAR || ':' || doc_id::VARCHAR), doc_id) AS finish,
    round(target)::BIGINT AS goal FROM turns),
p AS (SELECT *, least(finish, goal) - (finish - size) AS part, least(finish, goal) / target AS time FROM q),
m AS (SELECT *, sum(part) OVER (ORDER BY time, number, turn, doc_id) AS mix_end FROM p WHERE part > 0),
taken AS (SELECT doc_id, sum(greatest(0, least(mix_end, budget) - (mix_end - part)))::BIGINT AS taken FROM m GROUP BY doc_id)
SELECT k.doc_id, k.size::BIGINT AS size, k.source_size, k.target, coalesce(taken.taken, 0) AS taken
FROM k LEFT JOIN taken USING (doc_id)"""

CONTAMINATION = f"""
WITH i AS (SELECT item_id, {PLAIN} AS w FROM benchmark),
items AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k,
    unnest(list_transform(range(1, greatest(len(w) - 13, 0) + 2), lambda x: array_to_string(list_slice(w, x, x + least(len(w), 13) - 1), ' '))) AS span
  FROM i WHERE len(w) > 0),
d AS (SELECT doc_id, coalesce({PLAIN}, []) AS w FROM documents),
places AS (
  SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS place, w FROM d, (SELECT DISTINCT k FROM items) WHERE len(w) >= k),
spans AS (SELECT doc_id, k, place, array_to_string(list_slice(w, place, place + k - 1), ' ') AS span FROM places),
hits AS (SELECT doc_id, spans.k, place, item_id FROM spans JOIN items USING (k, span)),
cover AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(place, place + k)) AS word FROM hits) GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id),
out AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(joined, '')) AS items_sha256
  FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN ids USING (doc_id))
SELECT *, n_hit > 0 AND 20 * n_hit >= n_words AS contaminated FROM out"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * g + 1}, 5))::INT >> {shift}) & 31) + 1, 1)"
    for g in range(8)
    for shift in (15, 10, 5, 0)
)
ARCHIVE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS keeper FROM p)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM keeper AND keeper IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM k"""

LINES = r"""
WITH l AS (SELECT doc_id, unnest(str_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(str_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
w AS (SELECT doc_id, i, regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+') AS w FROM l),
s AS (SELECT doc_id, i, list_distinct(w) AS s FROM w WHERE len(w) > 0),
t AS (SELECT doc_id, i, len(s) AS n, unnest(s) AS token FROM s),
pairs AS (
  SELECT x.doc_id, x.i, x.n, y.n AS m, count(*) AS common FROM t x JOIN t y ON x.token = y.token AND (y.doc_id, y.i) < (x.doc_id, x.i)
  GROUP BY x.doc_id, x.i, x.n, y.n, y.doc_id, y.i),
gone AS (SELECT DISTINCT doc_id, i FROM pairs WHERE 180 * common >= 80 * (n + m)),
r AS (SELECT doc_id, count(*) AS n_removed, string_agg(i::VARCHAR, ',' ORDER BY i) AS removed FROM gone GROUP BY doc_id)
SELECT doc_id, len(str_split(coalesce(text, ''), chr(10))) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed
FROM documents LEFT JOIN r USING (doc_id)"""

LINKED = f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce({SPACED.format(LOWER.format("text"))}, []) AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE
    list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda x: array_to_string(list_slice(w, x, x + 4), ' '))) END AS s FROM w),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS token FROM s),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, x.n, y.n AS m, count(*) AS common FROM t x JOIN t y ON x.token = y.token AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n),
links AS MATERIALIZED (SELECT a, b FROM pairs WHERE 100 * common >= 80 * (n + m - common)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT s.doc_id, len(s.s) AS n_shingles, min(reach.b) AS component_id FROM s JOIN reach ON s.doc_id = reach.a GROUP BY s.doc_id, len(s.s)"""

NEGATIVES = """
WITH e AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
  s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3"""

RANKED = f"""
WITH d AS (SELECT row_number() OVER () AS place, doc_id, {PLAIN} AS words FROM documents),
i AS (SELECT row_number() OVER () AS item, item_id, list_distinct({PLAIN}) AS words FROM benchmark),
c AS (SELECT count(*) AS documents, sum(len(words))::BIGINT AS terms FROM d WHERE len(words) > 0),
tf AS (SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(words) AS term FROM d) GROUP BY ALL),
w AS (
  SELECT term, floor(1000 * ln((2 * max(documents) + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, c GROUP BY term),
m AS (SELECT place, doc_id, 100 - 90 + ((90 * len(words) * documents) // terms) AS m FROM d, c),
s AS (
  SELECT item, item_id, place, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM (SELECT item, item_id, unnest(words) AS term FROM i) JOIN tf USING (term) JOIN w USING (term) JOIN m USING (place)
  GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0
QUALIFY rank <= 10"""

SQL: dict[str, str] = {
    "op2_weighted_mix": MIX,
    "op4_decontaminate": CONTAMINATION,
    "op5_warc_archive": ARCHIVE,
    "op6_line_dedup": LINES,
    "op8_ngram_join": LINKED,
    "op12_hard_negatives": NEGATIVES,
    "op13_lexical_search": RANKED,
}
