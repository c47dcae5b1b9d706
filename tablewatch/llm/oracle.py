"""DuckDB SQL for the queries that SQL can express.

The others are held against brute force in tests/llm: op2 (a trained model), op3
(gear hash), op7 and op9 (tokenizers), op8 (a trained model), op10 (XXH64), op13 (a
trained model), pipeline.
"""

from __future__ import annotations

from tablewatch.llm import line_dedup, quality

ORACLE: dict[str, str] = {}

ORACLE["op1_embedding_near_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
       AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
         WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN comp c ON c.a = v.vec_id LEFT JOIN deg d ON d.a = v.vec_id
"""

ORACLE["op4_warc_revisits"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS b, sha1(coalesce(html, '')) AS d FROM pages),
m AS (SELECT d, max(page_id) AS mx FROM p WHERE b >= 1000 GROUP BY d)
SELECT page_id, b AS payload_bytes, p.d AS payload_digest,
       CASE WHEN mx IS NOT NULL AND page_id <> mx THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> mx THEN mx END AS refers_to
FROM p LEFT JOIN m ON p.d = m.d AND p.b >= 1000
"""


def _agree(a: str, b: str) -> str:
    steps = " ".join(f"WHEN NOT coalesce({a}[{i + 1}] = {b}[{i + 1}], false) THEN {i}" for i in range(line_dedup.REACH))
    return f"CASE {steps} ELSE {line_dedup.REACH} END"


ORACLE["op5_line_dedup"] = f"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
every AS (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM d),
c AS (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos,
             ('0x' || substr(md5(l), 1, 15))::BIGINT AS h, length(l) - length(replace(l, ' ', '')) + 1 AS w
      FROM every WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
hs AS (SELECT doc_id, list(h ORDER BY pos) AS h FROM c GROUP BY doc_id),
g0 AS (SELECT doc_id, pos, h, w, lead(h) OVER o AS h2, lead(w) OVER o AS w2 FROM c WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
g AS (SELECT doc_id, pos, w + w2 AS words, ('0x' || substr(md5(h::VARCHAR || ':' || h2::VARCHAR), 1, 15))::BIGINT AS fp
      FROM g0 WHERE h2 IS NOT NULL),
gn AS (SELECT *, lead(fp) OVER o AS nx, lag(fp) OVER o AS pv FROM g WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
marks AS (SELECT fp, 2 AS size, doc_id, pos, words FROM gn
          WHERE (nx IS NOT NULL AND fp < nx) OR (pv IS NOT NULL AND fp <= pv) OR (nx IS NULL AND pv IS NULL)
          UNION ALL SELECT h, 1, doc_id, pos, w FROM c WHERE w >= {line_dedup.LONG}),
first AS (SELECT fp, size, min(row(doc_id, pos)) AS a FROM marks GROUP BY fp, size HAVING count(*) > 1),
met AS (SELECT m.*, f.a, x.h AS hd, y.h AS ha, struct_extract_at(f.a, 2) AS apos
        FROM marks m JOIN first f USING (fp, size) JOIN hs x ON x.doc_id = m.doc_id JOIN hs y ON y.doc_id = struct_extract_at(f.a, 1)
        WHERE row(m.doc_id, m.pos) > f.a),
ctx AS (SELECT doc_id, pos, size, words,
               list_reverse(hd[greatest(pos - {line_dedup.REACH - 1}, 1):pos]) AS b, list_reverse(ha[greatest(apos - {line_dedup.REACH - 1}, 1):apos]) AS ab,
               hd[pos + size + 1:pos + size + {line_dedup.REACH}] AS f, ha[apos + size + 1:apos + size + {line_dedup.REACH}] AS af FROM met),
runs AS (SELECT doc_id, words, pos - ({_agree('b', 'ab')}) AS s, pos + size + ({_agree('f', 'af')}) AS e FROM ctx),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, e)) AS pos FROM runs WHERE e - s >= {line_dedup.MIN_LINES} OR words >= {line_dedup.LONG}),
lost AS (SELECT c.doc_id, c.i FROM gone JOIN c USING (doc_id, pos)),
kept AS (SELECT e.doc_id, string_agg(e.l, chr(10) ORDER BY e.i) AS t FROM every e LEFT JOIN lost USING (doc_id, i) WHERE lost.i IS NULL GROUP BY e.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id),
r AS (SELECT doc_id, count(*) AS n FROM lost GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_lines, coalesce(r.n, 0)::BIGINT AS n_removed,
       CASE WHEN r.n IS NULL THEN d.text ELSE coalesce(kept.t, '') END AS text
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_FAILED = " + ".join(f"CASE WHEN {rule} THEN {quality.BITS[name]} ELSE 0 END" for name, rule in quality.RULES.items())
ORACLE["op6_quality_rules"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
win AS (SELECT doc_id, i, ws[i:i + 7] AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
twice AS (SELECT doc_id, k FROM win GROUP BY doc_id, k HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM win JOIN twice USING (doc_id, k)) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d),
dup AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dups FROM lines WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_lines,
             coalesce(dup.dups, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             length(regexp_replace(t, '[^A-ZÀ-Þ]', '', 'g'))::BIGINT AS n_upper,
             len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1]))::BIGINT AS n_echo_words,
             len(list_distinct(ws))::BIGINT AS n_distinct_words
      FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, ({_FAILED})::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & {quality.BASE.mask}) <> 0 AS base_failed,
       (failed & {quality.FULL.mask}) = 0 AS kept, failed AS failed_rules, '{quality.FULL.name}/{quality.FULL.version}' AS policy
FROM f
"""

_TERMS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")
ORACLE["op11_lexical_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
size AS (SELECT r, doc_id, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0),
world AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM size),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
w AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, world GROUP BY t, docs),
items AS (SELECT row_number() OVER () AS i, item_id, list_distinct({_TERMS}) AS ts FROM benchmark),
q AS (SELECT i, item_id, unnest(ts) AS t FROM items),
s AS (SELECT q.item_id, q.i, size.doc_id, size.r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))))::BIGINT AS score
      FROM q JOIN w USING (t) JOIN tf USING (t) JOIN size USING (r), world
      GROUP BY q.item_id, q.i, size.doc_id, size.r),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 10
"""

# two rounds; a codebook is a row per entry (p, k, list of components), members are parts of vectors
_ASSIGN = """(SELECT m.vec_id, m.p, m.x, min(row(list_sum(list_transform(range(1, len(m.x) + 1), lambda j: (m.x[j] - c.x[j]) * (m.x[j] - c.x[j])))::BIGINT, c.k)) AS near
    FROM m JOIN {book} c ON c.p = m.p GROUP BY m.vec_id, m.p, m.x)"""
_UPDATE = """(SELECT c.p, c.k, coalesce(u.x, c.x) AS x FROM {book} c LEFT JOIN (
    SELECT p, k, list(floor(s / n)::BIGINT ORDER BY j) AS x FROM (
        SELECT p, k, j, sum(v)::DOUBLE AS s, count(*) AS n FROM (
            SELECT p, struct_extract_at(near, 2) AS k, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM {a}) GROUP BY p, k, j)
    GROUP BY p, k) u ON u.p = c.p AND u.k = c.k)"""
ORACLE["op12_vector_codes"] = f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
m AS MATERIALIZED (SELECT vec_id, p, x[p * (len(x) // 16) + 1:(p + 1) * (len(x) // 16)] AS x FROM v, range(16) g(p)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM v QUALIFY k < 64),
b0 AS MATERIALIZED (SELECT m.p, f.k, m.x FROM m JOIN first f USING (vec_id)),
a0 AS MATERIALIZED {_ASSIGN.format(book='b0')},
b1 AS MATERIALIZED {_UPDATE.format(book='b0', a='a0')},
a1 AS MATERIALIZED {_ASSIGN.format(book='b1')},
b2 AS MATERIALIZED {_UPDATE.format(book='b1', a='a1')},
a2 AS MATERIALIZED {_ASSIGN.format(book='b2')},
code AS (SELECT vec_id, string_agg(printf('%02x', struct_extract_at(near, 2)), '' ORDER BY p) AS code, sum(struct_extract_at(near, 1))::BIGINT AS error
         FROM a2 GROUP BY vec_id),
books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, k)) AS h FROM b2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, books.h AS codebooks_sha256
FROM code JOIN v USING (vec_id), books
"""
