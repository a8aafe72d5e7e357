"""The results of operators as DuckDB SQL, where SQL can say them."""

from __future__ import annotations

# The table of the CRC-32 polynomial, one entry per byte.
CRC_TABLE = """
crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS crc
)"""


def crc32(text: str) -> str:
    """The CRC-32 of the UTF-8 bytes of a text; ``crc`` of crc_table must be in reach."""
    code = f"hex(encode({text}))"
    bytes_ = f"list_transform(range(len({code}) // 2), lambda i: ('0x' || substr({code}, 2 * i + 1, 2))::BIGINT)"
    return (
        f"xor(list_reduce({bytes_}, lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT),"
        " 4294967295)"
    )


def _record(n_chars: str) -> str:
    parts = ["doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text"]
    return "sha256(" + " || ".join(
        f"CASE WHEN {p} IS NULL THEN '-' ELSE octet_length(encode({p})) || ':' || {p} END" for p in parts
    ) + ")"


MERKLE = f"""
WITH RECURSIVE {CRC_TABLE},
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_record('n_chars')} AS leaf,
    CASE WHEN {crc32('doc_id::VARCHAR')} % 7 = 0 THEN {_record('n_chars + 1')} ELSE {_record('n_chars')} END AS now
  FROM documents, crc_table
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY g) AS n
  FROM leaves
),
tree(g, h, i, d, m) AS (
  SELECT g, 0::BIGINT, pos, leaf, n FROM placed
  UNION ALL
  SELECT g, h + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (m + 1) // 2
  FROM tree WHERE m > 1 GROUP BY g, h, m, i // 2
),
subroots AS (
  SELECT g, d AS subroot, row_number() OVER (ORDER BY g) - 1 AS spot, count(*) OVER () AS groups
  FROM tree WHERE m = 1
),
top(h, i, d, m) AS (
  SELECT 0::BIGINT, spot, subroot, groups FROM subroots
  UNION ALL
  SELECT h + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (m + 1) // 2
  FROM top WHERE m > 1 GROUP BY h, m, i // 2
),
steps AS (
  SELECT p.g, p.pos, t.h, t.i & 1 AS own, s.d AS other
  FROM placed p JOIN tree t ON t.g = p.g AND t.i = p.pos >> t.h AND t.m > 1
  LEFT JOIN tree s ON s.g = t.g AND s.h = t.h AND s.i = xor(t.i, 1)
  UNION ALL
  SELECT p.g, p.pos, 1000 + t.h, t.i & 1, s.d
  FROM placed p JOIN subroots r ON r.g = p.g JOIN top t ON t.i = r.spot >> t.h AND t.m > 1
  LEFT JOIN top s ON s.h = t.h AND s.i = xor(t.i, 1)
),
proofs AS (
  SELECT g, pos, sha256(coalesce(string_agg(other, '' ORDER BY h), '')) AS proof,
    list(CASE WHEN other IS NULL THEN '-' WHEN own = 1 THEN '<' || other ELSE '>' || other END ORDER BY h) AS steps
  FROM steps GROUP BY g, pos
),
folded AS (
  SELECT p.doc_id, p.leaf, r.subroot, (SELECT d FROM top WHERE m = 1) AS root,
    coalesce(f.proof, sha256('')) AS proof_sha256,
    list_reduce(coalesce(f.steps, []), lambda d, s: sha256(CASE s[1] WHEN '<' THEN s[2:] || d
      WHEN '>' THEN d || s[2:] ELSE d END), p.now) AS folded_root
  FROM placed p JOIN subroots r USING (g) LEFT JOIN proofs f USING (g, pos)
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""

SPELLING = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents
),
each AS (SELECT id, run, count(*) AS c FROM runs WHERE length(run) >= 7 GROUP BY id, run),
hashed AS (SELECT run, c, {crc32("(id || ':' || run)")} AS h FROM each, crc_table),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
    ELSE run END AS word, sum(c)::BIGINT AS n
  FROM hashed GROUP BY word HAVING length(word) >= 7 AND sum(c) >= 2
),
holes AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS hole
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
),
near AS (
  SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b USING (i, hole) WHERE a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON w.word = h.hole
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = h.hole
),
best AS (
  SELECT word, count(*) AS n_near, max(n) AS most, min(struct_pack(m := -n, o := other)).o AS other
  FROM near GROUP BY word
),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * w.n THEN b.other END AS form,
    CASE WHEN most >= 10 * w.n THEN most END AS form_n
  FROM words w LEFT JOIN best b USING (word)
),
chain(word, reached, form) AS (
  SELECT word, word, form FROM formed
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.form
)
SELECT f.word, f.form, c.reached AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word AND c.form IS NULL
"""

# The smallest id that each node reaches by links (u, v), which stand in both directions.
REACHED = """
reached(id, r) AS (
  SELECT id, id FROM nodes UNION SELECT reached.id, links.v FROM reached JOIN links ON links.u = reached.r
)"""

EMBEDDINGS = f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS e FROM embeddings),
good AS (
  SELECT * FROM nodes WHERE label IS NOT NULL
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0
),
links AS (
  SELECT a.id AS u, b.id AS v FROM good a JOIN good b ON a.label = b.label AND a.id <> b.id
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.98 ELSE false END
),
{REACHED}
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE links.u = reached.id) AS n_links, min(r) AS component_id,
  id = min(r) AS kept
FROM reached GROUP BY id
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id AS id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS w
  FROM documents
),
nodes AS (
  SELECT id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(greatest(1, len(w) - 3)),
    lambda i: array_to_string(w[i + 1:i + 4], ' '))) END AS s
  FROM worded
),
each AS (SELECT id, len(s) AS n, unnest(s) AS s FROM nodes),
shared AS (
  SELECT a.id AS u, b.id AS v, a.n AS m, b.n AS n, count(*) AS c FROM each a JOIN each b
    ON a.s = b.s AND a.id <> b.id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY ALL
),
links AS (SELECT u, v FROM shared WHERE 100 * c >= 80 * (m + n - c)),
{REACHED}
SELECT id AS doc_id, any_value(len(s)) AS n_shingles, min(r) AS component_id, id = min(r) AS kept
FROM reached JOIN nodes USING (id) GROUP BY id
"""

_CONTROLS = (
    r"<\\*\|turn\|>|<\\*\|end\|>|<\\*\|endoftext\|>|<\\*s>|<\\*/s>|\[\\*INST\]|\[\\*/INST\]|<\\*<SYS>>|<\\*</SYS>>"
)

# A turn is <|turn|>role, a line break, the text, <|end|> and a line break; each control string
# in role and text has one backslash more.
CHATS = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
marked AS (SELECT *, replace(replace(role, '\\', '\\\\'), chr(10), '\\n') AS mark FROM turns),
sized AS (
  SELECT *, 17 + length(mark) + length(text) + len(regexp_extract_all(mark, '{_CONTROLS}'))
    + len(regexp_extract_all(text, '{_CONTROLS}')) AS size
  FROM marked
),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learned,
    sum(size)::BIGINT AS size, string_agg(role || ',', '' ORDER BY turn, role, text) AS roles
  FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
  size AS formatted_chars, regexp_full_match(roles, '(system,)?(user,assistant,)+') AS valid_order
FROM whole
"""


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_SECRETS = (
    (0, f"(?:{_either_case('password|passwd|secret|token|api_?key')})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 1, 8),
    (1, "AKIA[A-Z0-9]+", 0, 16), (2, "[0-9a-f]{32,}", 0, 32), (3, "[A-Za-z0-9+/_-]{24,}", 0, 24),
)
_MATCHES = " UNION ALL ".join(
    f"SELECT doc_id, source, lang, {number} AS kind, {least} AS least, regexp_extract_all(t, '{p}') AS m,"
    f" regexp_extract_all(t, '{p}', {group}) AS v, string_split_regex(t, '{p}') AS s FROM docs"
    for number, p, group, least in _SECRETS
)

# A long mixed token is a candidate; a value of one owner in up to four repositories is live.
SECRETS = f"""
WITH docs AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
matches AS ({_MATCHES}),
listed AS (
  SELECT doc_id, source, lang, kind, least, unnest(range(len(m))) AS i, unnest(m) AS m, unnest(v) AS v, unnest(s[:len(m)]) AS s
  FROM matches
),
placed AS (
  SELECT *, (sum(length(s) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i))::BIGINT AS e FROM listed
),
spans AS (
  SELECT doc_id, source, lang, kind, e - length(m) AS a, e, v FROM placed
  WHERE length(v) >= least AND (kind < 3 OR regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[0-9]'))
),
found AS (
  SELECT * FROM spans c WHERE kind < 3
    OR NOT EXISTS (SELECT 1 FROM spans b WHERE b.kind < 3 AND b.doc_id = c.doc_id AND b.a < c.e AND c.a < b.e)
),
judged AS (
  SELECT v, count(DISTINCT coalesce('=' || source, '')) <= 1
    AND count(DISTINCT (coalesce('=' || source, ''), doc_id // 100)) <= 4 AS live
  FROM found GROUP BY v
),
named AS (
  SELECT doc_id, kind, a, live, ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || a || ':' || e AS told
  FROM found JOIN judged USING (v) WHERE kind < 3 OR live
),
whole AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
    count(*) FILTER (kind = 2) AS n_hex, string_agg(told, ',' ORDER BY a, kind) FILTER (kind < 3) AS base,
    string_agg(told, ',' ORDER BY a, kind) AS spans, count(*) FILTER (kind < 3 AND live) AS n_live,
    count(*) FILTER (kind < 3 AND NOT live) AS n_copied
  FROM named GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
  coalesce(n_copied, 0) AS n_copied
FROM docs LEFT JOIN whole USING (doc_id)
"""
