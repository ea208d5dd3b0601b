"""DuckDB twins of the queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP4_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
g AS (SELECT r, i, w[i:i + 4] AS g FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d)),
twice AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
again AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(generate_series(i, i + 4)) AS k FROM twice) GROUP BY r),
lines AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT l) AS dup
          FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, len(w) AS n_words, coalesce(length(array_to_string(w, '')), 0) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(lines.dup, 0) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words, coalesce(lines.n, 0) AS n_lines,
             length(t) - length(replace(t, '!!', '!')) AS n_shouts, length(t) - length(replace(t, '|', '')) AS n_bars
      FROM d LEFT JOIN again USING (r) LEFT JOIN lines USING (r)),
f AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
      + (CASE WHEN 4 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN 2 * n_shouts > n_words THEN 8 ELSE 0 END)
      + (CASE WHEN 2 * n_dup_lines > n_lines THEN 16 ELSE 0 END) + (CASE WHEN 4 * n_bars > n_words THEN 32 ELSE 0 END)
      + (CASE WHEN word_chars > 30 * n_words THEN 64 ELSE 0 END) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed,
       failed = 0 AS kept, failed::BIGINT AS failed FROM f
"""

OP8_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
           UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
             replace(replace(role, '\', '\\'), chr(10), '\n') AS r FROM t),
f AS (SELECT *, length('<|im_start|>' || regexp_replace(r, '<(\\*)\|', '<\\\1|', 'g') || chr(10)
                       || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10)) AS n FROM e)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(length(loss))::BIGINT AS loss_chars, sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""

OP10_SQL = r"""
WITH l AS (SELECT doc_id, i - 1 AS line, regexp_extract_all(ls[i], '[^\x20\x09-\x0D]+') AS w
           FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i
                 FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
m AS (SELECT *, len(w) AS n, array_to_string(w, ' ') AS s FROM l WHERE len(w) > 0),
first AS (SELECT s, any_value(w) AS w, any_value(n) AS n, min((doc_id, line)) AS place FROM m GROUP BY s),
long AS (SELECT * FROM first WHERE n >= 5),
v AS (SELECT s, n, place, j, array_to_string(w[1:j - 1], ' ') || '|' || array_to_string(w[j + 1:], ' ') AS gap,
             array_to_string(list_concat(w[1:j - 1], w[j + 1:]), ' ') AS closed
      FROM (SELECT *, unnest(generate_series(1, n)) AS j FROM long)),
near AS (SELECT s FROM v QUALIFY min(place) OVER (PARTITION BY n, j, gap) < place
         UNION SELECT v.s FROM v JOIN long AS b ON v.closed = b.s AND b.n = v.n - 1 WHERE b.place < v.place
         UNION SELECT b.s FROM v JOIN long AS b ON v.closed = b.s AND b.n = v.n - 1 WHERE v.place < b.place),
k AS (SELECT m.doc_id, m.line, first.place < (m.doc_id, m.line) AS equal, near.s IS NOT NULL AS near
      FROM m JOIN first USING (s) LEFT JOIN near USING (s)),
d AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE equal) AS n_equal, count(*) FILTER (WHERE near AND NOT equal) AS n_near,
             coalesce(string_agg(line::VARCHAR, ',' ORDER BY line) FILTER (WHERE equal OR near), '') AS dropped FROM k GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_equal, 0) AS n_equal, coalesce(n_near, 0) AS n_near, coalesce(dropped, '') AS dropped
FROM (SELECT doc_id FROM documents) LEFT JOIN d USING (doc_id)
"""


def _op11() -> str:
    """Four rounds of assignment and averaging, one group of subqueries each."""
    rounds = []
    for k in range(5):
        rounds.append(f"""
a{k} AS MATERIALIZED (
    SELECT r, vec_id, label, p, min(q) // 256 AS far, (min(q) % 256)::INTEGER AS e
    FROM (SELECT x.r, x.vec_id, x.label, x.p,
                 (list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, b.v) + list_inner_product(b.v, b.v))::HUGEINT * 256 + b.e AS q
          FROM x JOIN b{k} AS b USING (p)) GROUP BY ALL)""")
        if k < 4:
            rounds.append(f"""
b{k + 1} AS MATERIALIZED (
    SELECT p, e, coalesce(m.v, b.v) AS v
    FROM b{k} AS b LEFT JOIN (
        SELECT p, e, list(s ORDER BY i) AS v
        FROM (SELECT x.p, a.e, i, floor(sum(x.v[i]) / count(*)) AS s
              FROM x JOIN a{k} AS a USING (r, p), generate_series(1, 16) AS g(i) GROUP BY x.p, a.e, i) GROUP BY p, e) AS m USING (p, e))""")
    return f"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id, v) - 1 AS r, vec_id, label, v
    FROM (SELECT vec_id, label, list_transform(embedding, lambda y: floor(1024 * y::DOUBLE)) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0)),
x AS MATERIALIZED (SELECT r, vec_id, label, p, v[16 * p + 1:16 * p + 16] AS v FROM d, generate_series(0, 3) AS g(p)),
b0 AS MATERIALIZED (SELECT p, r::INTEGER AS e, v FROM x WHERE r < 256),{",".join(rounds)},
books AS (SELECT sha256(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
          FROM (SELECT p, e, unnest(v) AS y, generate_subscripts(v, 1) AS i FROM b4)),
c AS (SELECT r, vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(far)::BIGINT AS error FROM a4 GROUP BY ALL)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM c, books
"""


OP11_SQL = _op11()     # the tables' vectors have 64 numbers, 16 a part

OP12_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
                  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
h AS (SELECT *, len(w) AS n, ('0x' || d[1:8])::BIGINT % (len(w) + 1) AS c1, ('0x' || d[9:16])::BIGINT % (len(w) + 1) AS c2,
             ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM t),
f AS (SELECT doc_id, text, n, CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 90 THEN 'plain'
                                   WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
             array_to_string(w[1:least(c1, c2)], '') AS p, array_to_string(w[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
             array_to_string(w[greatest(c1, c2) + 1:], '') AS s FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM f
"""
