"""DuckDB SQL for the corpus queries whose rows SQL can express."""

from __future__ import annotations

WARC = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), f AS (SELECT hex, min(page_id) AS first_id, count(*) AS c FROM p GROUP BY hex)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((CAST('0x' || substr(hex, CAST((i // 4) * 5 + 1 AS INT), 5) AS BIGINT) // CAST(pow(32, 3 - i % 4) AS BIGINT)) % 32)::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN c > 1 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN c > 1 AND page_id <> first_id THEN first_id END AS refers_to,
  url AS target_uri
FROM p JOIN f USING (hex)
"""

LINES = r"""
WITH RECURSIVE occ AS (
  SELECT doc_id, i AS no, list_extract(l, i) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
), words AS (SELECT * FROM occ WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
lines AS (SELECT line, length(line) AS n, row_number() OVER (ORDER BY line) AS id, min(doc_id * 1000000 + no) AS place FROM words GROUP BY line),
edges AS (
  SELECT a.id AS u, b.id AS v FROM lines a JOIN lines b ON b.n BETWEEN a.n AND a.n + 2 AND a.id <> b.id AND b.n >= 10
  WHERE levenshtein(a.line, b.line) <= 2 AND levenshtein(a.line, b.line) <= 0.1 * b.n
), both_ways AS (SELECT u, v FROM edges UNION SELECT v, u FROM edges),
reach(a, b) AS (SELECT DISTINCT u, u FROM both_ways UNION SELECT r.a, e.v FROM reach r JOIN both_ways e ON r.b = e.u),
comp AS (SELECT a AS id, min(b) AS c FROM reach GROUP BY a),
labelled AS (SELECT line, place, coalesce(c, id) AS c FROM lines LEFT JOIN comp USING (id)),
heads AS (SELECT c, min(place) AS head FROM labelled GROUP BY c),
gone AS (SELECT doc_id, no FROM words JOIN labelled USING (line) JOIN heads USING (c) WHERE doc_id * 1000000 + no <> head),
joined AS (SELECT o.doc_id, string_agg(o.line, chr(10) ORDER BY o.no) AS text FROM occ o LEFT JOIN gone g ON o.doc_id = g.doc_id AND o.no = g.no WHERE g.no IS NULL GROUP BY o.doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
dropped AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n, 0) AS n_lines, coalesce(g.n, 0) AS n_removed,
  CASE WHEN d.text IS NOT NULL THEN length(coalesce(j.text, '')) END AS kept_chars,
  CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(j.text, '')) END AS kept_sha256
FROM documents d LEFT JOIN counts c USING (doc_id) LEFT JOIN dropped g USING (doc_id) LEFT JOIN joined j USING (doc_id)
"""

SUBSTRINGS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, s, md5(substr(h, CAST(2 * s + 1 AS INT), 200)) AS w FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS s FROM d)),
firsts AS (SELECT w, min(doc_id) AS fd, arg_min(s, doc_id * 1000000 + s) AS fs FROM windows GROUP BY w HAVING count(*) > 1),
later AS (SELECT doc_id, s FROM windows JOIN firsts USING (w) WHERE doc_id > fd OR s > fs),
steps AS (SELECT doc_id, s, coalesce(s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100, true) AS fresh FROM later),
runs AS (SELECT doc_id, s, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM steps),
spans AS (SELECT doc_id, r, min(s) AS a, max(s) + 100 AS b FROM runs GROUP BY doc_id, r),
gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM spans
), kept AS (
  SELECT g.doc_id, string_agg(substr(h, CAST(2 * p + 1 AS INT), CAST(2 * (a - p) AS INT)), '' ORDER BY a) || substr(max(h), CAST(2 * max(b) + 1 AS INT)) AS h,
    sum(b - a) AS removed, count(*) AS n FROM gaps g JOIN d USING (doc_id) GROUP BY g.doc_id
)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(k.removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(k.n, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id)
"""

NEAR = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM w
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM shared JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach(a, b) AS (SELECT DISTINCT u, u FROM both_ways UNION SELECT r.a, e.v FROM reach r JOIN both_ways e ON r.b = e.u),
comp AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id, coalesce(c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
"""

ANN = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]), lambda a, b: a + b) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

RULES = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), g AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
often AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, i + unnest([0, 1, 2]) AS p FROM often) GROUP BY 1),
f AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(regexp_extract_all(t, '[A-Z]')) AS BIGINT) AS up,
    CAST(len(regexp_extract_all(t, '[!?]')) AS BIGINT) AS marks, len(l) AS lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id)
), v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, [
    CASE WHEN 10 * n_symbols > n_words THEN 0 ELSE -1 END, CASE WHEN 20 * n_symbols > word_chars THEN 0 ELSE -1 END,
    CASE WHEN 10 * up > 3 * word_chars THEN 0 ELSE -1 END, CASE WHEN 5 * marks > n_words THEN 0 ELSE -1 END,
    CASE WHEN 10 * n_dup_lines > 3 * lines THEN 0 ELSE -1 END, CASE WHEN 10 * n_repeat_words > 4 * n_words THEN 0 ELSE -1 END,
    CASE WHEN word_chars < 3 * n_words OR word_chars > 12 * n_words THEN 0 ELSE -1 END,
    CASE WHEN n_words > 0 AND 50 * n_symbols <= n_words AND 5 * up <= word_chars AND 20 * marks <= n_words AND 2 * n_repeat_words <= n_words THEN 1 ELSE -1 END,
    CASE WHEN n_words > 0 AND 100 * n_symbols <= word_chars AND 10 * n_repeat_words <= 3 * n_words AND word_chars BETWEEN 3 * n_words AND 12 * n_words THEN 1 ELSE -1 END
  ] AS votes FROM f
), pats AS (SELECT votes, count(*)::DOUBLE AS n FROM v GROUP BY votes), r AS (SELECT list({'v': [0] || votes, 'n': n} ORDER BY votes) AS pats FROM pats),
em(k, a) AS (
  SELECT 0, list_transform(range(10), lambda i: CASE i WHEN 0 THEN 0.1::DOUBLE ELSE 0.9::DOUBLE END)
  UNION ALL
  SELECT k + 1, list_transform(range(1, 11), lambda j: coalesce((
      list_sum(list_transform(q, lambda x: CASE x.v[j] WHEN 0 THEN x.n * x.q WHEN 1 THEN x.n * (1 - x.q) ELSE 0 END))
      / nullif(list_sum(list_transform(q, lambda x: CASE WHEN x.v[j] <> -1 THEN x.n ELSE 0 END)), 0) + 0.01 * CASE j WHEN 1 THEN 0.1 ELSE 0.9 END) / 1.01,
      CASE j WHEN 1 THEN 0.1 ELSE 0.9 END))
  FROM (
    SELECT k, list_transform(pats, lambda x: {'v': x.v, 'n': x.n, 'q': 1 / (1 + exp(-ln(a[1] / (1 - a[1])) - list_sum(list_transform(range(2, 11), lambda i:
      CASE x.v[i] WHEN 0 THEN greatest(ln(a[i] / (1 - a[i])) - ln(a[1] / (1 - a[1])), 0) WHEN 1 THEN -greatest(ln(a[i] / (1 - a[i])) + ln(a[1] / (1 - a[1])), 0) ELSE 0 END))))}) AS q
    FROM em, r WHERE k < 25
  )
), model AS (SELECT a FROM em WHERE k = 25),
p AS (
  SELECT v.*, 1 - 1 / (1 + exp(-ln(a[1] / (1 - a[1])) - list_sum(list_transform(range(2, 11), lambda i:
    CASE votes[i - 1] WHEN 0 THEN greatest(ln(a[i] / (1 - a[i])) - ln(a[1] / (1 - a[1])), 0) WHEN 1 THEN -greatest(ln(a[i] / (1 - a[i])) + ln(a[1] / (1 - a[1])), 0) ELSE 0 END)))) AS good FROM v, model
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND good >= 0.5 AS kept, array_to_string(votes, ',') AS votes, round(good, 6) AS good_probability FROM p
"""

CHAT = """
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, text, coalesce(text, '') AS body, ((31 * conv_id + 7 * turn) % 16 + 16) % 16 AS flaw,
    conv_id IS NOT NULL AND turn IS NOT NULL AND role = 'user' AS asks, conv_id IS NOT NULL AND turn IS NOT NULL AND role = 'assistant' AS answers
  FROM conversations
), e AS (
  SELECT conv_id, CASE WHEN answers AND flaw = 4 THEN turn - 2 ELSE turn END AS turn, role, text, body, CASE flaw WHEN 1 THEN -1 ELSE turn END AS arg,
    CASE WHEN asks THEN 'call' WHEN answers THEN 'result' ELSE 'text' END AS kind,
    CASE WHEN asks THEN 'c' || conv_id || '-' || (turn - CASE flaw WHEN 5 THEN 2 ELSE 0 END)
      WHEN answers AND flaw = 2 THEN 'x' || conv_id || '-' || turn WHEN answers THEN 'c' || conv_id || '-' || (turn - 1) END AS call_id,
    CASE WHEN asks AND flaw = 3 THEN 'c' || conv_id || '-' || (turn + 2) WHEN asks AND flaw = 7 THEN 'c' || conv_id || '-' || turn END AS ref
  FROM m
), c AS (SELECT conv_id, call_id, min(turn) AS t FROM e WHERE kind = 'call' GROUP BY ALL),
r AS (SELECT conv_id, call_id, min(turn) AS t FROM e WHERE kind = 'result' GROUP BY ALL),
n AS (SELECT conv_id, count(*) AS n FROM e WHERE kind <> 'text' GROUP BY conv_id),
w AS (
  SELECT conv_id, 'result' AS k, call_id AS i, r.t AS t, 'call' AS bk, call_id AS bi, c.t AS bt FROM r JOIN c USING (conv_id, call_id)
  UNION ALL
  SELECT e.conv_id, 'call', e.call_id, e.turn, 'result', e.ref, r.t FROM e JOIN c ON c.conv_id = e.conv_id AND c.call_id = e.ref JOIN r ON r.conv_id = e.conv_id AND r.call_id = e.ref
), walk(conv_id, k, i, t, bk, bi, bt, steps) AS (
  SELECT *, 1 FROM w
  UNION
  SELECT a.conv_id, a.k, a.i, a.t, w.bk, w.bi, w.bt, a.steps + 1 FROM walk a JOIN w ON w.conv_id = a.conv_id AND w.k = a.bk AND w.i = a.bi AND w.t = a.bt JOIN n ON n.conv_id = a.conv_id WHERE a.steps < n.n
), p AS (
  SELECT conv_id, k AS kind, i AS call_id, t AS turn, max([bt, steps]) AS far, bool_or(steps >= n.n) AS cyclic FROM walk JOIN n USING (conv_id) GROUP BY ALL
), s AS (
  SELECT e.*, coalesce(p.cyclic, false) AS cyclic, CASE WHEN p.far IS NOT NULL AND NOT p.cyclic AND p.far > [e.turn, 0] THEN p.far ELSE [e.turn, 0] END AS place, c.t AS ct, r.t AS rt,
    list_filter([CASE WHEN kind = 'call' AND body = '' THEN '$.prompt: too short' END, CASE WHEN kind = 'call' AND arg < 0 THEN '$.turn: too small' END], lambda x: x IS NOT NULL) AS errors
  FROM e LEFT JOIN p USING (conv_id, kind, call_id, turn) LEFT JOIN c USING (conv_id, call_id) LEFT JOIN r USING (conv_id, call_id)
), f AS (
  SELECT *, CASE WHEN kind = 'text' THEN 'ok' WHEN kind = 'result' AND ct IS NULL THEN 'orphan' WHEN turn <> CASE kind WHEN 'call' THEN ct ELSE rt END THEN 'duplicate'
    WHEN cyclic THEN 'cyclic' WHEN len(errors) > 0 THEN 'invalid' WHEN kind = 'call' AND rt IS NULL THEN 'unanswered' ELSE 'ok' END AS status
  FROM s
)
SELECT conv_id, CAST(place[1] AS BIGINT) AS order_turn, CAST(place[2] AS INTEGER) AS order_depth, turn, CAST(0 AS INTEGER) AS part, kind, call_id, status,
  CASE kind WHEN 'text' THEN '{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || '}'
    WHEN 'call' THEN '{"arguments":{' || CASE WHEN ref IS NULL THEN '' ELSE '"after":{"$result":"' || ref || '"},' END || '"prompt":' || CAST(to_json(body) AS VARCHAR) || ',"turn":' || arg
      || '},"errors":' || CAST(to_json(errors) AS VARCHAR) || ',"id":"' || call_id || '","name":"reply","role":"assistant","status":"' || status || '"}'
    ELSE '{"content":' || CAST(to_json(body) AS VARCHAR) || ',"role":"tool","status":"' || status || '","tool_call_id":"' || call_id || '"}' END AS json
FROM f
"""

ORACLES = {
    "op1_warc": WARC,
    "op3_chat_format": CHAT,
    "op4_line_dedup": LINES,
    "op5_substring_dedup": SUBSTRINGS,
    "op6_near_dedup": NEAR,
    "op7_quality_rules": RULES,
    "op9_ann": ANN,
}
