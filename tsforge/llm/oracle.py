"""DuckDB SQL for the queries of this subpackage that SQL can state."""

SQL: dict[str, str] = {}

SQL["op3_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM t
"""

SQL["op2_quality_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, i, concat(ws[i], ' ', ws[i + 1], ' ', ws[i + 2]) AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c >= 2),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY 1),
m AS (SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             coalesce(cov.n, 0) AS n_repeat_words, len(ls) AS n_lines, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_caps
      FROM w LEFT JOIN cov USING (doc_id)),
f AS (SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
              + CASE WHEN 20 * n_symbols > 3 * n_words THEN 4 ELSE 0 END + CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END
              + CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END + CASE WHEN n_lines > 1 AND 10 * n_dup_lines > 3 * n_lines THEN 32 ELSE 0 END
              + CASE WHEN 2 * n_caps > word_chars THEN 64 ELSE 0 END AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed & 31 = 0 AS kept,
       cast(failed AS bigint) AS failed
FROM f
"""

SQL["op6_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS sh
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b USING (sh) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 75 * (nx.n + ny.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.y FROM r JOIN e ON e.x = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.a = d.doc_id GROUP BY 1, 2
"""


def _crc32(expr: str) -> str:
    """Unsigned crc32 of an ASCII text, bit by bit over its bytes (lowest bit first)."""
    bits = f"flatten([[(ascii(ch) >> k) & 1 for k in range(8)] for ch in string_split({expr}, '')])"
    step = "xor(c >> 1, 3988292384 * (xor(c, b) & 1))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], [x::BIGINT for x in {bits}]), lambda c, b: {step}), 4294967295)"


# The words of a document and, for one in ten, their repeating tail.
_REPEATING = rf"""
h AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, {_crc32('doc_id::VARCHAR')} AS h FROM documents),
a AS (SELECT r, doc_id, ws, len(ws) AS n, h, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM h),
w AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
        [ws[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END + 1] for i in range(n)] ELSE ws END AS ws FROM a)"""

# Pairs of equal 6-word windows of a document give every diagonal of six matches or more.
SQL["op13_runs"] = rf"""
WITH {_REPEATING.strip()},
s AS (SELECT r, i, list_slice(ws, i + 1, i + 6) AS g FROM (SELECT r, ws, unnest(range(n - 5)) AS i FROM w WHERE n >= 6)),
p AS (SELECT x.r, y.i - x.i AS q, x.i FROM s x JOIN s y ON x.r = y.r AND x.g = y.g AND x.i < y.i),
d AS (SELECT r, q, min(i) AS s, max(i) + 6 + q AS e FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM p) GROUP BY r, q, island),
u AS (SELECT r, s, e, min(q) AS q FROM d WHERE e - s >= greatest(12, 2 * q) GROUP BY r, s, e),
t AS (SELECT r, count(*) AS n_runs, arg_min(s, (s - e, s, q)) AS s, arg_min(e - s, (s - e, s, q)) AS len, arg_min(q, (s - e, s, q)) AS q,
             string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM u GROUP BY r),
dropped AS (SELECT DISTINCT r, unnest(range(s + q, e)) AS i FROM u),
words AS (SELECT r, i, ws[i + 1] AS word FROM (SELECT r, ws, unnest(range(n)) AS i FROM w)),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS c FROM words ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, t.s AS start, len AS length, t.q AS period, 1000 * len // t.q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(c, '')) AS collapsed_sha256
FROM w LEFT JOIN t USING (r) LEFT JOIN kept USING (r)
"""

SQL["op12_trie"] = rf"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_crc32('conv_id::VARCHAR')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
x AS (SELECT c.conv_id, 0 AS own, t.pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.pos <= h
      UNION ALL SELECT conv_id, 1, pos, role, text FROM t JOIN c USING (conv_id) WHERE pos > h),
p AS (SELECT conv_id, coalesce(path, []) AS path FROM c LEFT JOIN
        (SELECT conv_id, list({{'r': role, 't': text}} ORDER BY own, pos) AS path FROM x GROUP BY 1) USING (conv_id)),
m AS (SELECT conv_id, d, path[1:d] AS k, len(path) = d AS ends FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM p)),
n AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ids,
             coalesce(len(regexp_extract_all(k[d].t, '[^\x20\x09-\x0D]+')), 0) AS words FROM m GROUP BY d, k),
ch AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (d, k)),
u AS (SELECT a AS d, k[1:a] AS k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
      FROM (SELECT *, unnest(range(d + 1)) AS a FROM f) GROUP BY 1, 2)
SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, sha256(coalesce(f.ids, '')) AS ends_sha256
FROM f JOIN u USING (d, k) LEFT JOIN n q ON q.d = f.d - 1 AND q.k = f.k[1:f.d - 1]
"""
