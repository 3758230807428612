"""DuckDB SQL for the corpus queries that SQL can express, written independently of the Spark code."""

from __future__ import annotations

from strata.llm.license_scan import TEMPLATES, THRESHOLD

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({_LOWER.format(text)}, '{_BREAK}'), lambda w: w <> '')"


DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_words("coalesce(text, '')")} AS ws FROM documents),
b AS (SELECT item_id, ws, least(10, len(ws)) AS s FROM (SELECT item_id, {_words("coalesce(text, '')")} AS ws FROM benchmark) WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item_id, s, array_to_string(ws[i:i + s - 1], ' ') AS w FROM (SELECT *, unnest(range(1, len(ws) - s + 2)) AS i FROM b)),
sizes AS (SELECT DISTINCT s FROM b),
dw AS (SELECT doc_id, s, i, array_to_string(ws[i:i + s - 1], ' ') AS w
       FROM (SELECT doc_id, ws, s, unnest(range(1, len(ws) - s + 2)) AS i FROM d, sizes)),
hit AS (SELECT doc_id, i, dw.s, item_id FROM dw JOIN bw USING (s, w)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + s)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

LINE_DEDUP = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS p FROM documents),
f AS (SELECT *, lead(line, 1) OVER o AS l2, lead(line, 2) OVER o AS l3, lead(p, 2) OVER o AS hi
      FROM l WHERE regexp_matches(line, '[^ \t\r]') WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
w AS (SELECT *, first_value(doc_id) OVER g AS d1, first_value(p) OVER g AS p1, first_value(hi) OVER g AS hi1
      FROM f WHERE hi IS NOT NULL WINDOW g AS (PARTITION BY line, l2, l3 ORDER BY doc_id, p)),
gone AS (SELECT DISTINCT doc_id, unnest(range(CASE WHEN d1 = doc_id THEN greatest(p, hi1 + 1) ELSE p END, hi + 1)) AS p
         FROM w WHERE NOT (d1 = doc_id AND p1 = p))
SELECT doc_id, count(gone.p) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY l.p) FILTER (WHERE gone.p IS NULL), '')) AS text_sha256
FROM l LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id
"""


def _license_sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in sorted(TEMPLATES.items()))
    pairs = "list_distinct([ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))])"
    return f"""
WITH t AS (SELECT license, {pairs} AS bs FROM (SELECT license, {_words('template')} AS ws FROM (VALUES {values}) v(license, template))),
u AS (SELECT doc_id, 0 AS u, text AS unit FROM documents
      UNION ALL SELECT doc_id, unnest(range(1, len(ls) + 1)), unnest(ls) FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents) WHERE len(ls) > 1),
b AS (SELECT doc_id, u, {pairs} AS bs FROM (SELECT doc_id, u, {_words('unit')} AS ws FROM u)),
s AS (SELECT doc_id, u, license, 2 * len(list_intersect(b.bs, t.bs))::DOUBLE / (len(b.bs) + len(t.bs)) AS dice FROM b, t WHERE len(b.bs) BETWEEN 1 AND 100),
m AS (SELECT doc_id, count(DISTINCT u) AS n_units, max(dice) AS dice, arg_min(license, (-dice, license)) AS license FROM s WHERE dice >= {THRESHOLD} GROUP BY doc_id)
SELECT doc_id, license, dice, coalesce(n_units, 0) AS n_units FROM documents LEFT JOIN m USING (doc_id)
"""


CHAT = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'))),
n AS (SELECT *, row_number() OVER o AS k, lag(role) OVER o IS NOT DISTINCT FROM role AS again,
             length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS chars
      FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars + CASE WHEN again THEN length('<|im_sep|>') ELSE length('<|im_start|>') + length(role) + 1 + length('<|im_end|>') + 1 END)::BIGINT AS formatted_chars
FROM n GROUP BY conv_id
"""

# unsigned CRC-32 of a decimal number's text, byte by byte and bit by bit
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({}::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)), lambda c, x:
  list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295)"""

_FINITE = "len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

HARD_NEGATIVES = f"""
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS lab,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w
           FROM embeddings WHERE label IS NOT NULL AND {_FINITE}),
s AS (SELECT a.id AS a, b.id AS b, a.lab = b.lab AS same, list_dot_product(a.w, b.w)::BIGINT AS s
      FROM v a JOIN v b ON a.id <> b.id AND len(a.w) = len(b.w) WHERE a.id % 100 = 0),
p AS (SELECT a, b AS p, s AS ps FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT a AS anchor_id, p AS positive_id, (row_number() OVER (PARTITION BY a, p ORDER BY s DESC, b))::INTEGER AS rank, b AS negative_id,
       ps AS positive_score, s AS negative_score
FROM p JOIN s USING (a) WHERE NOT same AND 30 * ps <= 100 * s AND 100 * s <= 90 * ps
QUALIFY row_number() OVER (PARTITION BY a, p ORDER BY s DESC, b) <= 10
"""

PREFIX_TRIE = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS head, {_CRC.format("conv_id")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = head WHERE pos < h
      UNION ALL SELECT c.conv_id, 1, pos, role, text FROM c JOIN t USING (conv_id) WHERE pos >= h),
q AS (SELECT conv_id, len(text) AS chars, row_number() OVER o AS depth,
             string_agg(md5(len(role)::VARCHAR || ':' || role || text), '/') OVER o AS path
      FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY part, pos)),
p AS (SELECT conv_id, depth, path, coalesce(lag(path) OVER (PARTITION BY conv_id ORDER BY depth), '') AS up, chars FROM q
      UNION ALL SELECT conv_id, 0, '', NULL, 0 FROM c),
n AS (SELECT depth, path, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM p GROUP BY ALL),
k AS (SELECT depth - 1 AS depth, up AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (depth, path)),
s AS (SELECT p.depth, p.path, count(*) FILTER (WHERE m.n_children = 0) AS n_leaves, sum((m.n_convs - 1) * m.chars) AS saved_tokens
      FROM m JOIN p ON p.conv_id = m.conv_id AND p.depth <= m.depth GROUP BY ALL),
e AS (SELECT depth, path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
      FROM p WHERE depth = (SELECT max(depth) FROM p x WHERE x.conv_id = p.conv_id) GROUP BY ALL)
SELECT m.conv_id, m.depth::BIGINT AS depth, o.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM m JOIN s USING (depth, path) LEFT JOIN e USING (depth, path) LEFT JOIN n o ON o.depth = m.depth - 1 AND o.path = m.up
"""

EMBEDDING_DEDUP = f"""
WITH RECURSIVE v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS w FROM embeddings
                     WHERE label IS NOT NULL AND {_FINITE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS (SELECT a.id AS a, b.id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.w) = len(b.w) AND a.id <> b.id
      WHERE list_cosine_similarity(a.w, b.w) >= 0.93),
r(id, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, e.b FROM r JOIN e ON r.c = e.a),
k AS (SELECT id, min(c) AS component_id FROM r GROUP BY id),
l AS (SELECT a AS id, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN k ON k.id = vec_id LEFT JOIN l ON l.id = vec_id
"""

ORACLE = {
    "op2_decontamination": DECONTAMINATION,
    "op5_line_dedup": LINE_DEDUP,
    "op6_license_scan": _license_sql(),
    "op10_chat": CHAT,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_embedding_dedup": EMBEDDING_DEDUP,
}
