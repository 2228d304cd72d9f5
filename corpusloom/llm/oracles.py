"""DuckDB SQL for the queries whose results SQL can express; written from the meaning, not from the method."""

from math import log2

from corpusloom.llm.secret_scan import ALLOWED, ALLOWED_INSIDE, CANDIDATE, CLASSES, KINDS, PATTERNS, RUNS as PIECES, SYMBOLS, WINDOW

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
RUNS = "list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')))"

SIMILAR = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 5 THEN {RUNS}
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS runs FROM w),
e AS (SELECT doc_id, len(runs) AS n, unnest(runs) AS x FROM s),
p AS (SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
r AS (SELECT u, v FROM p UNION SELECT r.u, p.v FROM r JOIN p ON r.v = p.u),
c AS (SELECT u, min(v) AS least FROM r GROUP BY u),
l AS (SELECT u, count(*) AS n FROM p GROUP BY u)
SELECT doc_id, least(doc_id, coalesce(least, doc_id)) AS class_id, coalesce(n, 0)::BIGINT AS n_links
FROM documents LEFT JOIN c ON c.u = doc_id LEFT JOIN l ON l.u = doc_id
"""

LEAKS = rf"""
WITH b AS (SELECT item_id, {WORDS} AS ws FROM benchmark),
bs AS (SELECT item_id, {RUNS} AS runs FROM b WHERE len(ws) >= 5),
bx AS (SELECT item_id, len(runs) AS size, unnest(runs) AS x FROM bs),
d AS (SELECT doc_id, {WORDS} AS ws FROM documents),
dx AS (SELECT doc_id, unnest({RUNS}) AS x FROM d WHERE len(ws) >= 5)
SELECT doc_id, item_id, count(DISTINCT x) AS shared, size::BIGINT AS size, count(DISTINCT x) / size AS containment
FROM dx JOIN bx USING (x) GROUP BY doc_id, item_id, size HAVING count(DISTINCT x) >= ceil(0.8 * size - 1e-9)
"""


def _pieces(kind: int, pattern: str, group: int, least: int, source: str) -> str:
    found = pattern.replace("'", "''")
    return f"""
SELECT doc_id, base, {kind} AS kind, t, unnest(range(1, len(ms) + 1)) AS i, ms, gs, lens FROM (
  SELECT doc_id, base, t, regexp_extract_all(t, '{found}', 0) AS ms, string_split_regex(t, '{found}') AS gs,
    list_transform(regexp_extract_all(t, '{found}', {group}), lambda x: length(x) >= {least}) AS lens FROM {source})"""


def _at(pieces: str) -> str:
    before = "list_sum(list_transform(gs[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda g: length(g))), 0)"
    return f"SELECT doc_id, kind, ms[i] AS m, lens[i] AS fits, (base + {before})::BIGINT AS s FROM {pieces}"


def _secrets() -> str:
    entropy = len(PATTERNS)
    parts = [_pieces(k, p, g, n, "d") for k, (_, p, g, n) in enumerate(PATTERNS)]
    parts.append(_pieces(entropy, CANDIDATE, 0, 0, "d"))
    runs = [_pieces(k, p, 0, 0, "b") for k, (p, _) in enumerate(PIECES)]
    allowed = " OR ".join(f"regexp_matches(m, '{p}')" for p in ALLOWED)
    # The library of patterns here has no back-references; the one that is used means a symbol eight times.
    eight, blanked = "|".join(f"[{c}]{{8}}" for c in SYMBOLS), "m"
    for pattern, length in ALLOWED_INSIDE:
        blanked = f"regexp_replace({blanked}, '{eight if chr(92) in pattern else pattern}', '{' ' * length}', 'g')"
    bits = " ".join(
        f"WHEN regexp_matches(m, '{p}') THEN {'NULL' if b is None else f'CAST({b} AS DOUBLE)'}" for p, b in CLASSES
    )
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    written = f"{names}[kind + 1] || ':' || s || ':' || e"
    return f"""
WITH d AS (SELECT doc_id, 0 AS base, coalesce(text, '') AS t FROM documents),
p AS ({' UNION ALL '.join(parts)}),
x AS ({_at("p")}),
b AS (SELECT doc_id, s AS base, {blanked} AS t FROM x WHERE kind = {entropy} AND NOT ({allowed})),
r AS ({' UNION ALL '.join(runs)}),
c AS (SELECT doc_id, s, m, CASE {bits} END AS bits FROM ({_at("r")})),
v AS (SELECT DISTINCT doc_id, s + i AS i FROM (SELECT doc_id, s, m, bits, unnest(range(0, length(m) - {WINDOW - 1})) AS i FROM c WHERE bits IS NOT NULL)
  WHERE list_sum(list_transform(map_values(list_aggregate(string_split(m[i+1:i+{WINDOW}], ''), 'histogram')),
    lambda n: round(n * log2(n) * 1e6))) <= floor(({log2(WINDOW)!r} - bits) * {WINDOW} * 1e6)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
  SELECT *, (i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -{WINDOW} - 1) + {WINDOW})::INT AS fresh FROM v)),
a AS (SELECT doc_id, kind, s, s + length(m) AS e FROM x WHERE kind < {entropy} AND fits
  UNION ALL SELECT doc_id, {entropy}, min(i), max(i) + {WINDOW} FROM g GROUP BY doc_id, run)
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce(string_agg({written}, ',' ORDER BY s, kind) FILTER (kind < {entropy}), '')) AS base_sha256,
  coalesce(string_agg({written}, ',' ORDER BY s, kind) FILTER (kind IS NOT NULL), '') AS spans
FROM d LEFT JOIN a USING (doc_id) GROUP BY doc_id
"""


CHATS = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) = role, false) AS joined FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(text) + length(regexp_replace(text, '[^\\<#]', '', 'g')) + CASE WHEN joined THEN 7
    ELSE 14 + length(role) + length(regexp_replace(role, '[^\\<#:\n]', '', 'g')) END)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""

TERMS = (
    r"list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), "
    "lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"
)

RANKED = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS ws FROM documents),
n AS (SELECT r, doc_id, len(ws) AS n, ws FROM d WHERE len(ws) > 0),
a AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM n),
t AS (SELECT r, x, count(*) AS tf FROM (SELECT r, unnest(ws) AS x FROM n) GROUP BY r, x),
w AS (SELECT x, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM t, a GROUP BY x, docs),
q AS (SELECT DISTINCT item_id, x FROM (SELECT item_id, unnest({TERMS}) AS x FROM benchmark)),
s AS (SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::BIGINT AS score
  FROM q JOIN w USING (x) JOIN t USING (x) JOIN n USING (r), a GROUP BY item_id, doc_id, r)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""

ORACLES = {
    "op2_ngram_jaccard_join": SIMILAR,
    "op3_secret_scans": _secrets(),
    "op6_chat_formatting": CHATS,
    "op7_benchmark_decontamination": LEAKS,
    "op12_lexical_search": RANKED,
}
