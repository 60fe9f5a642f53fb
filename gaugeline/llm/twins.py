"""DuckDB SQL for the queries that SQL can state over whole tables.

No twin: Pareto draws in three rounds (op1), base32 (op4), CRC-32 (op5, op6), models and hashed
n-grams (op8, op9, op10) and the pipeline; these are tested against brute force instead.
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TEXT = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

OP2 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_TEXT}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)
),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
),
groups AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN groups g ON g.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""


def _escaped(column: str) -> str:
    """Length of a text once its backslashes and control strings are escaped."""
    return (rf"(length({column}) + length({column}) - length(replace({column}, '\', ''))"
            rf" + 2 * len(regexp_extract_all({column}, '</?s>|\[/?INST\]|\[/?ROLE\]')))")


OP3 = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
joined AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS learned,
         3 + sum(CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 4 ELSE 17 + {_escaped('role')} END + {_escaped('text')}) AS chars
  FROM turns GROUP BY 1
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
       chars::BIGINT AS formatted_chars FROM joined"""

_ITEM_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
OP7 = rf"""
WITH items AS (SELECT item_id, regexp_extract_all({_TEXT}, {_ITEM_WORDS}) AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
),
docs AS (SELECT doc_id, regexp_extract_all({_TEXT}, {_ITEM_WORDS}) AS w FROM documents),
met AS (
  SELECT d.doc_id, d.i, d.n, x.item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)) d
  JOIN windows x ON x.s = d.s AND x.n = d.n
),
hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM met) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM met) GROUP BY 1
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)"""

OP11 = """
WITH RECURSIVE usable AS (
  SELECT row_number() OVER () AS node, vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
edges AS (
  SELECT a.node AS a, b.node AS b FROM usable a JOIN usable b ON a.node <> b.node AND len(a.v) = len(b.v)
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= 0.9 END
),
reach AS (SELECT node AS a, node AS b FROM usable UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
groups AS (SELECT r.a AS node, min(u.vec_id) AS component_id FROM reach r JOIN usable u ON u.node = r.b GROUP BY 1),
counts AS (SELECT a AS node, count(*) AS n FROM edges GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM usable LEFT JOIN counts USING (node) JOIN groups USING (node)
UNION ALL
SELECT vec_id, 0, vec_id, true FROM embeddings
WHERE NOT (vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0)"""


def _add(value: str, cost: str, letter: str) -> str:
    """A state is its cost in nine digits, then the audit, so the least string is the cheapest and then ASCII-least."""
    return f"(lpad((left({value}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({value}, 10) || {letter})"


_INITIAL = "left(role, 1)"
_BLANKS = r"\x20\x09-\x0D"
_EDIT = {role: (f"5 * t + (k <> '{role}')::BIGINT", f"CASE k WHEN '{role}' THEN 'K' ELSE 'R' END") for role in "ua"}
OP12 = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
),
drawn AS (
  SELECT *, xor(4294967295, list_reduce(
    list_concat([4294967295::UBIGINT], list_transform(string_split(key, ''), lambda c: ascii(c)::UBIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
      lambda bits, step: xor(bits >> 1, 3988292384::UBIGINT * (bits & 1))))) % 20 AS c FROM keyed
),
damaged AS (
  SELECT conv, turn, CASE c WHEN 4 THEN 'user' ELSE role END AS role,
         CASE c WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE c WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM drawn
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again FROM (
    SELECT conv, turn, role, text, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged)
),
faults AS (
  SELECT *, {_INITIAL} AS k, lag({_INITIAL}) OVER (PARTITION BY conv ORDER BY i) AS before,
         CASE WHEN NOT regexp_matches(text, '[^{_BLANKS}]') THEN 'blank' WHEN again THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][{_BLANKS}]*\z') THEN 'truncated' ELSE 'none' END AS fault FROM placed
),
counted AS (
  SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND before || k NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv
),
steps AS (SELECT conv, i, k, fault IN ('blank', 'duplicate') AS gone, (fault = 'truncated')::BIGINT AS t FROM faults),
paths AS (
  SELECT conv, 0::BIGINT AS i, '000000000' AS v, '900000000' AS s, '000000005I' AS u, '000000010II' AS a FROM counted
  UNION ALL
  SELECT conv, i, v, s, u, least(a, {_add('u', '5', "'I'")}) FROM (
    SELECT conv, i, v, s, a, least(u, {_add('v', '5', "'I'")}, {_add('s', '5', "'I'")}, {_add('a', '5', "'I'")}) AS u FROM (
      SELECT p.conv, r.i, {_add('v', '2', "'D'")} AS v,
             CASE WHEN NOT gone AND k = 's' THEN least({_add('s', '2', "'D'")}, {_add('v', '5 * t', "'K'")}) ELSE {_add('s', '2', "'D'")} END AS s,
             CASE WHEN gone THEN {_add('u', '2', "'D'")}
                  ELSE least({_add('u', '2', "'D'")}, {_add('v', *_EDIT['u'])}, {_add('s', *_EDIT['u'])}, {_add('a', *_EDIT['u'])}) END AS u,
             CASE WHEN gone THEN {_add('a', '2', "'D'")} ELSE least({_add('a', '2', "'D'")}, {_add('u', *_EDIT['a'])}) END AS a
      FROM paths p JOIN steps r ON r.conv IS NOT DISTINCT FROM p.conv AND r.i = p.i + 1))
),
solved AS (
  SELECT c.*, least(v, a) AS best FROM paths p JOIN counted c ON c.conv IS NOT DISTINCT FROM p.conv AND c.n = p.i
),
edits AS (
  SELECT conv, j, substr(best, 9 + j, 1) AS e FROM (SELECT conv, best, unnest(range(1, length(best) - 8)) AS j FROM solved)
),
numbered AS (SELECT conv, j, e, count(*) FILTER (e <> 'I') OVER (PARTITION BY conv ORDER BY j) AS i FROM edits),
emitted AS (
  SELECT n.conv, j, e, role, text, row_number() OVER (PARTITION BY n.conv ORDER BY j) AS place,
         first(e = 'K' AND k = 's') OVER (PARTITION BY n.conv ORDER BY j) AS led
  FROM numbered n LEFT JOIN faults f ON f.conv IS NOT DISTINCT FROM n.conv AND f.i = n.i AND e <> 'I' WHERE e <> 'D'
),
written AS (
  SELECT conv, string_agg(CASE WHEN e = 'K' THEN role WHEN (place - led::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                          CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS body FROM emitted GROUP BY conv
)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(left(best, 9)::BIGINT, 0) AS cost,
       coalesce(substr(best, 10), '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN solved s ON s.conv IS NOT DISTINCT FROM d.conv_id
LEFT JOIN written w ON w.conv IS NOT DISTINCT FROM d.conv_id"""

OP13 = """
WITH hashed AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, length(t) AS n, ('0x' || h[1:8])::BIGINT % (length(t) + 1) AS x, ('0x' || h[9:16])::BIGINT % (length(t) + 1) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM hashed
),
cut AS (SELECT *, left(t, least(x, y)) AS p, substring(t, least(x, y) + 1, abs(x - y)) AS m, substring(t, greatest(x, y) + 1) AS s FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM cut"""

TWINS = {"op2_setsketch": OP2, "op3_token_chat": OP3, "op7_winnowing": OP7, "op11_pq_links": OP11, "op12_repair_turns": OP12, "op13_skip_list_fim": OP13}
