"""SQL counterparts of those corpus operators that SQL can express, over whole tables.

Tokenizers, trees, exponents found by bisection, decoded layers and singular vectors are beyond SQL; those
operators are tested against brute force, round trips or held-out labels in tests/llm.
"""

from __future__ import annotations

from lodestone.llm import quality_rules as Q
from lodestone.llm.queries import CENTROIDS, ROUNDS, SHARD_LIMIT, WIDTH

WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

OP4 = (
    rf"""WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, coalesce({WORDS}, []) AS ws FROM documents),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1), range(3) t(k) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
s AS (SELECT doc_id, lang, source, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, len(regexp_extract_all(text, '\p{{Lu}}')) AS n_capitals FROM w LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, coalesce(1000 * n_symbols // nullif(word_chars, 0), 0) AS symbol_rate, coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0) AS dup_line_rate, coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0) AS repeat_rate, coalesce(1000 * n_capitals // nullif(word_chars, 0), 0) AS capital_rate, coalesce(100 * word_chars // nullif(n_words, 0), 0) AS word_length FROM s),
u AS (UNPIVOT (SELECT doc_id, lang, source, base_failed, symbol_rate, dup_line_rate, repeat_rate, capital_rate, word_length FROM v WHERE n_words > 0) ON symbol_rate, dup_line_rate, repeat_rate, capital_rate, word_length INTO NAME rate VALUE x),
f AS (SELECT lang, source, rate, (x >> greatest(length(bin(x)) - 6, 0)) << greatest(length(bin(x)) - 6, 0) AS x FROM u WHERE NOT base_failed),
z AS (SELECT 1 AS level, lang, source, rate, x FROM f UNION ALL SELECT 2, lang, NULL, rate, x FROM f UNION ALL SELECT 3, NULL, NULL, rate, x FROM f),
c AS (SELECT level, lang, source, rate, x, count(*) AS n FROM z GROUP BY ALL),
k AS (SELECT rate, lower, upper FROM (VALUES """
    + ", ".join(f"('{r}', {low}, {high})" for r, (low, high) in Q.TAILS.items())
    + rf""") t(rate, lower, upper)),
d AS (SELECT c.*, lower, upper, sum(n) OVER (PARTITION BY level, lang, source, rate ORDER BY x) AS upto, sum(n) OVER (PARTITION BY level, lang, source, rate) AS docs FROM c JOIN k USING (rate)),
q AS (SELECT level, lang, source, rate, max(docs) AS docs, min(x) FILTER (WHERE upto * 100 >= docs * lower) AS q1, min(x) FILTER (WHERE upto * 100 >= docs * 50) AS q2, min(x) FILTER (WHERE upto * 100 >= docs * upper) AS q3 FROM d GROUP BY ALL),
e AS (SELECT q.*, CASE WHEN rate = 'word_length' THEN greatest(q1 - {Q.FENCE} * (q2 - q1), 0) ELSE 0 END AS low, q3 + {Q.FENCE} * (q3 - q2) AS high FROM q),
b AS (SELECT a.lang, a.source, a.rate, (a.docs * a.low + {Q.PRIOR_DOCS} * ((m.docs * m.low + {Q.PRIOR_DOCS} * t.low) // (m.docs + {Q.PRIOR_DOCS}))) // (a.docs + {Q.PRIOR_DOCS}) AS low, (a.docs * a.high + {Q.PRIOR_DOCS} * ((m.docs * m.high + {Q.PRIOR_DOCS} * t.high) // (m.docs + {Q.PRIOR_DOCS}))) // (a.docs + {Q.PRIOR_DOCS}) AS high
FROM e a JOIN e m ON m.level = 2 AND a.rate = m.rate AND a.lang IS NOT DISTINCT FROM m.lang JOIN e t ON t.level = 3 AND a.rate = t.rate WHERE a.level = 1),
o AS (SELECT u.doc_id FROM u JOIN b ON u.rate = b.rate AND u.lang IS NOT DISTINCT FROM b.lang AND u.source IS NOT DISTINCT FROM b.source WHERE u.x NOT BETWEEN low AND high)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM o) AS kept, symbol_rate, dup_line_rate, repeat_rate, capital_rate, word_length FROM v"""
)

OP5 = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i+4], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON d.doc_id = c.a"""

OP7 = rf"""WITH w AS (SELECT doc_id, coalesce({WORDS}, []) AS ws FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(ws[i:i+19], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 18, 1))) AS i FROM w)),
later AS (SELECT doc_id, i FROM g QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, range(20) t(k)),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""

OP8 = f"""WITH r AS (SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes, lpad(bin(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT), 60, '0') AS h FROM documents),
p AS (SELECT doc_id, n_bytes, d, substr(h, 1, d) AS shard FROM (SELECT *, unnest(range(61)) AS d FROM r)),
s AS (SELECT d, shard, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_docs FROM p GROUP BY ALL),
m AS (SELECT doc_id, min(d) AS d FROM p JOIN s USING (d, shard) WHERE shard_bytes <= {SHARD_LIMIT} OR shard_docs = 1 GROUP BY doc_id)
SELECT doc_id, shard, CAST(d AS INT) AS depth, n_bytes, shard_bytes, shard_docs FROM m JOIN p USING (doc_id, d) JOIN s USING (d, shard)"""


#: crc32 of an ASCII string k; the constant is the reflected polynomial.
CRC32 = "xor(list_reduce([4294967295] || list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, y: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295)"

OP11 = rf"""WITH RECURSIVE r0 AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
r1 AS (SELECT *, {CRC32} % 20 AS kind FROM r0),
r2 AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM r1),
r3 AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS last, substr(role, 1, 1) AS initial FROM r2),
r4 AS (SELECT *, last = '' AS blank, last <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM r3),
r5 AS (SELECT *, NOT blank AND NOT dup AND last NOT IN ('.', '!', '?') AS cut FROM r4),
facts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE dup) AS duplicate, count(*) FILTER (WHERE cut) AS truncated, count(*) FILTER (WHERE i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM r5 GROUP BY conv_id),
ins(q, k, p) AS (VALUES ('e', 0, 'e'), ('e', 1, 'u'), ('e', 2, 'a'), ('s', 0, 's'), ('s', 1, 'u'), ('s', 2, 'a'), ('u', 0, 'u'), ('u', 1, 'a'), ('a', 0, 'a'), ('a', 1, 'u')),
step(p, r) AS (VALUES ('e', 's'), ('e', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
d AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, 'e' AS q, CAST(0 AS BIGINT) AS cost, '' AS audit FROM facts
UNION ALL SELECT conv_id, i, q, cost, audit FROM (SELECT d.conv_id, d.i + 1 AS i, m.q, d.cost + 3 * k + m.c AS cost, d.audit || repeat('I', k) || m.e AS audit FROM d JOIN r5 ON d.conv_id IS NOT DISTINCT FROM r5.conv_id AND r5.i = d.i + 1 JOIN ins ON ins.q = d.q,
 LATERAL (SELECT p AS q, 4 AS c, 'D' AS e UNION ALL SELECT r, cut::INT * 3 + CASE WHEN r = initial THEN 0 ELSE 3 END, CASE WHEN r = initial THEN 'K' ELSE 'R' END FROM step WHERE step.p = ins.p AND NOT blank AND NOT dup AND (r = initial OR r <> 's')) m) t
 QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1),
best AS (SELECT d.conv_id, d.cost + 3 * k AS cost, d.audit || repeat('I', k) AS audit, facts.* EXCLUDE (conv_id) FROM d JOIN facts ON d.conv_id IS NOT DISTINCT FROM facts.conv_id AND d.i = facts.n JOIN ins ON ins.q = d.q WHERE p IN ('e', 'a') QUALIFY row_number() OVER (PARTITION BY d.conv_id ORDER BY d.cost + 3 * k, d.audit || repeat('I', k)) = 1),
e0 AS (SELECT conv_id, unnest(string_split(audit, '')) AS e, generate_subscripts(string_split(audit, ''), 1) AS j FROM best WHERE audit <> ''),
e1 AS (SELECT *, sum((e <> 'I')::INT) OVER w AS i, sum((e <> 'D')::INT) OVER w AS m, sum((e <> 'D')::INT) OVER (PARTITION BY conv_id) AS total FROM e0 WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
fixed AS (SELECT e1.conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (total - m) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS whole FROM e1 LEFT JOIN r5 ON e1.conv_id IS NOT DISTINCT FROM r5.conv_id AND e1.i = r5.i WHERE e <> 'D' GROUP BY e1.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN best ON o.conv_id IS NOT DISTINCT FROM best.conv_id LEFT JOIN fixed ON o.conv_id IS NOT DISTINCT FROM fixed.conv_id"""


def _lloyd(k: int, rounds: int, width: int) -> str:
    """Lloyd's rounds one after the other, as many tables each."""
    apart = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [
        f"v AS (SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x, row_number() OVER () AS r FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)",
        f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster, x FROM (SELECT * FROM v ORDER BY sha256('2:' || vec_id) LIMIT {k}))",
    ]
    for n in range(rounds + 1):
        parts.append(f"a{n} AS MATERIALIZED (SELECT v.r, v.vec_id, v.x, cluster, CAST({apart} AS BIGINT) AS distance FROM v, c{n} c QUALIFY row_number() OVER (PARTITION BY r ORDER BY CAST({apart} AS BIGINT), cluster) = 1)")
        if n < rounds:
            parts.append(f"m{n} AS (SELECT cluster, list(y ORDER BY j) AS x FROM (SELECT cluster, j, CAST(floor(sum(e) / count(*)) AS BIGINT) AS y FROM (SELECT cluster, unnest(x) AS e, generate_subscripts(x, 1) AS j FROM a{n}) GROUP BY ALL) GROUP BY cluster)")
            parts.append(f"c{n + 1} AS MATERIALIZED (SELECT cluster, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN m{n} m USING (cluster))")
    return "WITH " + ",\n".join(parts) + f"\nSELECT vec_id, CAST(cluster AS INT) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} c USING (cluster)"


OP12 = _lloyd(CENTROIDS, ROUNDS, WIDTH)


def oracle_sql() -> dict[str, str]:
    return {"op4_quality_rules": OP4, "op5_near_dedup": OP5, "op7_substring_dedup": OP7, "op8_sharding": OP8, "op11_conversation_repair": OP11, "op12_centroid_clustering": OP12}
