"""The catalogue's queries in plain SQL (DuckDB), for checking results.

Written from the meaning of each operator, not from the Spark code: chunks by
recursion, sentence removal by a list fold, groups by ordered aggregates.
"""

from __future__ import annotations

from corpusloom import fixed_values as fixed
from corpusloom.functions.text import WHITESPACE
from corpusloom.plans.catalog import FILE_WORDS, GATE_HEADINGS, HEADINGS

_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"trim({x}, {_text(WHITESPACE)})"


def _clean(x: str) -> str:
    unified = rf"regexp_replace({x}, '\r\n?', chr(10), 'g')"
    squeezed = rf"regexp_replace({unified}, '\n{_WS}+\n+', chr(10) || chr(10), 'g')"
    return f"coalesce({_strip(rf'''regexp_replace({squeezed}, '[ \t]+', ' ', 'g')''')}, '')"


def _plain(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]+>', '', 'g')"


def _visible(x: str) -> str:
    """Text nodes of markup joined by newlines, for the tags and entities these pages have."""
    hidden = "(?s)<style.*?</style>|<script.*?</script>|<!--.*?-->|<[^>]*>"
    text = "v"
    for entity, char in (("&quot;", '"'), ("&middot;", "\N{MIDDLE DOT}"), ("&copy;", "\N{COPYRIGHT SIGN}"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    blank = rf"CASE WHEN NOT regexp_full_match(v, '[\t\n\f\r ]*') THEN {text} WHEN contains(v, chr(10)) THEN chr(10) ELSE ' ' END"
    nodes = f"list_filter(string_split(regexp_replace({x}, '{hidden}', chr(1), 'g'), chr(1)), lambda v: v <> '')"
    return f"array_to_string(list_transform({nodes}, lambda v: {blank}), chr(10))"


def _record_documents(drop) -> str:
    return f"""SELECT 'pages.json' AS file, page_id AS row_index, url AS title, text FROM (
        SELECT *, CASE WHEN html_ok AND (NOT url_ok OR length(page) > length(address)) THEN {_clean("page")}
          WHEN url_ok THEN {_clean("address")} ELSE '' END AS text
        FROM (SELECT *, length(address) > 40 AND length({_strip("url")}) > 40 AS url_ok,
            length(page) > 40 AND length({_strip("html")}) > 40 AS html_ok
          FROM (SELECT *, {_strip(drop("url"))} AS address, {_strip(drop("html"))} AS page FROM pages)))
      WHERE length(text) > 20"""


def _title(x: str) -> str:
    line = _strip("v")
    for mark in ("#", "-", r"\*"):
        line = rf"regexp_replace({line}, '^{mark}+{_WS}*', '')"
    lines = f"list_transform(string_split({x}, chr(10))[1:3], lambda v: {_strip(_plain(line))})"
    fits = f"length(v) BETWEEN {fixed.TITLE_MIN} AND {fixed.TITLE_MAX}"
    good = rf"list_filter({lines}, lambda v: {fits} AND NOT ends_with(v, '.') AND NOT regexp_matches(v, 'https?://|www\.|[@<>{{}}]'))"
    sentence = _strip(f"string_split({x}, '.')[1]")
    return f"""CASE WHEN len({good}) > 0 THEN ({good})[1]
        WHEN length({sentence}) BETWEEN {fixed.TITLE_MIN} AND {fixed.TITLE_MAX} THEN {sentence}
        WHEN length({x}) > {fixed.TITLE_MAX} THEN {_strip(f"substr({x}, 1, {fixed.TITLE_MAX})")} || '...' ELSE {x} END"""


def _file() -> str:
    words = "[" + ", ".join(map(_text, FILE_WORDS)) + "]"
    number = r"regexp_extract(source, '(\d+)', 1)::INT"
    return f"source || '_' || ({words})[{number} % {len(FILE_WORDS)} + 1] || '.csv'"


def _kind(file: str, rules, unknown: str = fixed.UNKNOWN_SOURCE_TYPE) -> str:
    cases = []
    for words, label in rules:
        test = " OR ".join(f"contains(lower({file}), '{word}')" for word in words)
        cases.append(f"WHEN {test} THEN '{label}'")
    return f"CASE {' '.join(cases)} ELSE '{unknown}' END"


def _instruction(kind: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {_text(v)}" for k, v in fixed.INSTRUCTION_BY_SOURCE_TYPE.items())
    return f"CASE {kind} {cases} END"


def _walk(source: str, size: int, overlap: int, sentence_aware: bool = True, cap: bool = True) -> str:
    """CTEs ending in ``pieces(id, total_chunks, chunk_index, chunk_text)`` of ``source(id, tx)``."""
    quarter = size // 4
    if sentence_aware:
        cut = f"""(SELECT CASE WHEN b > 0 THEN CASE WHEN b >= {quarter} THEN b ELSE {size} END
            WHEN nn > {quarter} THEN nn + 2 WHEN n1 > {quarter} THEN n1 + 1 ELSE {size} END
            FROM (SELECT length(regexp_extract(w, '(?s)^(.*[.!?]{_WS}+)', 1)) AS b,
                         length(regexp_extract(w, '(?s)^(.*)\\n\\n', 1)) AS nn,
                         length(regexp_extract(w, '(?s)^(.*)\\n', 1)) AS n1))"""
        advance = f"CASE WHEN stop - {overlap} > pos THEN stop - {overlap} ELSE pos + {max(1, size // 2)} END"
        bound = f"AND it < n // {max(1, quarter)}" if cap else ""
        empty = "WHERE chunk <> '' OR n <= " + str(size)
    else:
        cut = f"""(SELECT CASE WHEN n1 > {quarter} THEN n1 ELSE {size} END
            FROM (SELECT length(regexp_extract(w, '(?s)^(.*)\\n', 1)) AS n1))"""
        advance, bound, empty = f"greatest(stop - {overlap}, pos + 1)", "", ""
    return f"""src AS (SELECT id, tx, length(tx) AS n FROM ({source})),
    walk AS (
      SELECT id, tx, n, 0 AS pos, 1 AS it,
        CASE WHEN n <= {size} THEN n ELSE (SELECT {cut} FROM (SELECT substr(tx, 1, {size}) AS w)) END AS stop
      FROM src
      UNION ALL
      SELECT id, tx, n, pos, it,
        CASE WHEN pos + {size} >= n THEN n ELSE pos + (SELECT {cut} FROM (SELECT substr(tx, pos + 1, {size}) AS w)) END
      FROM (SELECT id, tx, n, it + 1 AS it, {advance} AS pos FROM walk WHERE stop < n {bound})),
    cuts AS (SELECT id, n, pos, {_strip("substr(tx, pos + 1, stop - pos)")} AS chunk FROM walk),
    pieces AS (SELECT id, count(*) OVER (PARTITION BY id)::INT AS total_chunks,
        (row_number() OVER (PARTITION BY id ORDER BY pos) - 1)::INT AS chunk_index, chunk AS chunk_text
      FROM cuts {empty})"""


def _chunks(size: int, overlap: int, sentence_aware: bool = True, cap: bool = True) -> str:
    source = f"SELECT doc_id AS id, {_strip('text')} AS tx FROM documents"
    return f"""WITH RECURSIVE {_walk(source, size, overlap, sentence_aware, cap)}
    SELECT id AS doc_id, total_chunks, chunk_index, chunk_text FROM pieces"""


def _prompt(title: str, source: str, chunk: str) -> str:
    return f"""{_text(fixed.DEFAULT_INSTRUCTION)} || chr(10) || chr(10)
      || CASE WHEN {title} <> '' THEN 'Title: ' || {title} || chr(10) || chr(10) ELSE '' END
      || 'Source: ' || {source} || chr(10) || chr(10) || {_text(fixed.CHUNK_LABEL)} || chr(10) || {chunk}"""


# --- sentence removal ---------------------------------------------------------------


def _sentence_list(x: str) -> str:
    """Structs (s, w) of the sentences of a text that are long enough."""
    squeezed = _strip(f"regexp_replace({x}, '{_WS}+', ' ', 'g')")
    parts = f"list_transform(string_split_regex({squeezed}, '[.!?]+'), lambda p: {_strip('p')})"
    kept = f"list_filter({parts}, lambda p: length(lower(p)) >= {fixed.SENTENCE_MIN_CHARS})"
    return f"list_transform({kept}, lambda p: {{'s': p, 'w': list_distinct(string_split(lower(p), ' '))}})"


# shared / (a + b - shared) > 7/10, in whole numbers; sets of too different size are not compared.
_SIMILAR = """CASE WHEN 10 * len(k.w) > 7 * len(x[1].w) AND 10 * len(x[1].w) > 7 * len(k.w)
    THEN 17 * len(list_intersect(k.w, x[1].w)) > 7 * (len(k.w) + len(x[1].w)) ELSE false END"""


def _fold(sentences: str) -> str:
    """First distinct of a list of structs with words ``w``."""
    singles = f"list_transform({sentences}, lambda v: [v])"
    return f"""CASE WHEN len({sentences}) = 0 THEN [] ELSE list_reduce({singles}, lambda acc, x:
        CASE WHEN len(list_filter(acc, lambda k: {_SIMILAR})) > 0 THEN acc ELSE list_concat(acc, x) END) END"""


def _rejoin(kept: str) -> str:
    return f"CASE WHEN len({kept}) > 0 THEN array_to_string(list_transform({kept}, lambda v: v.s), '. ') || '.' ELSE '' END"


# --- conversations as generation results --------------------------------------------

_TURNS = """turns AS (SELECT conv_id::VARCHAR AS source_id, turn::INT AS chunk_index, turn AS ordinal, role,
    CASE WHEN length(text) < 80 THEN 'Error: ' || text ELSE text END AS summary,
    'Conversation ' || conv_id AS title, CASE WHEN turn > 0 THEN 'chat.csv' ELSE '' END AS file FROM conversations)"""

# Per chunk, its own kept sentences; then one fold over the sentences of all usable chunks of a source.
_MERGE = f"""{_TURNS},
  finals AS (SELECT source_id, arg_max(CASE WHEN length(summary) > 150 THEN summary ELSE '' END, ordinal) AS final_summary,
      arg_max(title, ordinal) AS title FROM turns WHERE role = 'system' GROUP BY 1),
  chunk AS (SELECT source_id, chunk_index, summary, role, count(*) OVER (PARTITION BY source_id) AS n,
      {_sentence_list("summary")} AS own FROM turns WHERE role <> 'system'),
  cleaned AS (SELECT *, CASE WHEN n = 1 OR NOT starts_with(summary, 'Error:') THEN {_fold("own")} ELSE [] END AS kept FROM chunk),
  flat AS (SELECT source_id, chunk_index, s.s AS s, s.w AS w, i FROM (
      SELECT source_id, chunk_index, unnest(kept) AS s, generate_subscripts(kept, 1) AS i FROM cleaned)),
  folded AS (SELECT source_id, {_fold("sentences")} AS kept FROM (
      SELECT source_id, list({{'s': s, 'w': w, 'c': chunk_index, 'i': i}} ORDER BY chunk_index, i) AS sentences FROM flat GROUP BY 1)),
  rebuilt AS (SELECT source_id, count(*)::INT AS n, string_agg(summary, '|' ORDER BY chunk_index) AS summaries,
      arg_min(role, chunk_index) AS role FROM chunk GROUP BY 1),
  final_text AS (SELECT source_id, final_summary, title, {_sentence_list("final_summary")} AS own FROM finals),
  final_clean AS (SELECT source_id, final_summary, title, {_fold("own")} AS kept FROM final_text)"""

_MERGED = f"""WITH {_MERGE}
  SELECT source_id,
    CASE WHEN coalesce(f.final_summary, '') = '' AND r.n > 0 THEN r.n ELSE 99 END AS total_chunks,
    CASE WHEN coalesce(f.final_summary, '') = '' AND r.n > 0
      THEN {_rejoin("coalesce(g.kept, [])")} ELSE {_rejoin("f.kept")} END AS final_summary,
    CASE WHEN coalesce(f.final_summary, '') = '' AND r.n > 0 THEN r.summaries ELSE source_id || '|' || f.title END AS chunk_summaries,
    CASE WHEN coalesce(f.final_summary, '') = '' AND r.n > 0 THEN r.role ELSE 'system' END AS role,
    'merged' AS processing_step
  FROM final_clean f FULL JOIN rebuilt r USING (source_id) LEFT JOIN folded g USING (source_id)"""

_MERGED_LARGE = f"""WITH {_MERGE},
  whole AS ({_MERGED.replace(f"WITH {_MERGE}", "")}),
  parts AS (SELECT c.source_id, c.chunk_index, c.summary,
      CASE WHEN c.chunk_index = min(c.chunk_index) OVER (PARTITION BY c.source_id) THEN r.role ELSE '' END AS role,
      list_filter(coalesce(g.kept, []), lambda v: v.c = c.chunk_index) AS kept
    FROM chunk c JOIN rebuilt r USING (source_id) LEFT JOIN folded g USING (source_id)
      LEFT JOIN finals f USING (source_id) WHERE coalesce(f.final_summary, '') = '')
  SELECT source_id, 1 AS total_chunks, {_rejoin("kept")} AS final_summary, summary AS chunk_summaries, role,
    'merged' AS processing_step FROM parts
  UNION ALL SELECT * FROM whole WHERE source_id NOT IN (SELECT source_id FROM parts)"""

_SECTIONS = f"""{_TURNS}, usable AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY chunk_index) AS k
    FROM turns WHERE NOT starts_with(summary, 'Error:')),
  heads AS (SELECT source_id, count(*) AS n,
    {_text(chr(10).join(fixed.FINAL_OPENING))} || chr(10) || chr(10) || 'Document Title: ' || arg_min(title, k) || chr(10) || chr(10)
    || CASE WHEN arg_min(file, k) <> '' THEN 'Source: chat.csv' || chr(10) || chr(10) ELSE '' END
    || {_text(fixed.FINAL_LABEL)} AS opening FROM usable GROUP BY 1)"""

# --- review, export, tokens ---------------------------------------------------------

_EXAMPLES = """examples AS (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx, role AS instruction,
    'Turn ' || turn || chr(10) || text AS input, CASE WHEN role = 'assistant' THEN text END AS output,
    'conv' || conv_id AS generated_by FROM conversations)"""


def _missing(x: str, headings: list[str]) -> str:
    names = "[" + ", ".join(map(_text, headings)) + "]"
    return f"array_to_string(list_filter({names}, lambda h: NOT contains(lower(coalesce({x}, '')), lower(h))), ';')"


def _review(where: str = "") -> str:
    return f"""WITH {_EXAMPLES} SELECT idx, substr(instruction, 1, 2000) AS instruction, substr(input, 1, 2000) AS input,
      replace(substr(coalesce(output, ''), 1, 500), chr(10), '\\n') AS output_preview,
      {_missing("output", HEADINGS)} AS missing_headings, '' AS embedding_similarity, generated_by,
      '' AS generated_at, '' AS note_review_status FROM examples {where}"""


def _tokens(x: str) -> str:
    words = f"list_filter(string_split_regex({_strip(x)}, '{_WS}+'), lambda w: w <> '')"
    return f"list_transform({words}, lambda w: ('0x' || substr(md5(w), 1, {fixed.WHITESPACE_TOKEN_BITS // 4}))::INT)"


def _tokenized(cut: int, response_max: int | None = None) -> str:
    frame = "'### Instruction:' || chr(10) || instruction || chr(10) || chr(10) || '### Input:' || chr(10) || input || chr(10) || chr(10) || '### Response:' || chr(10)"
    first = "0" if response_max is None else f"len(ids) - {response_max}"
    return f"""{_EXAMPLES},
      tok AS (SELECT idx, ({_tokens(f"{frame} || coalesce(output, '')")})[1:{cut}] AS ids, len(({_tokens(frame)})[1:{cut}]) AS plen FROM examples),
      masked AS (SELECT idx, ids, list_transform(ids, lambda v, i: CASE WHEN i <= plen OR i <= {first} THEN {fixed.LABEL_IGNORE} ELSE v END) AS labels FROM tok)"""


def _token_output(cut: int, response_max: int | None = None) -> str:
    return f"""WITH {_tokenized(cut, response_max)} SELECT idx, array_to_string(ids, ' ') AS input_ids,
      array_to_string(list_transform(ids, lambda v: 1), ' ') AS attention_mask, array_to_string(labels, ' ') AS labels FROM masked"""


_EVENTS = r"""ev AS (SELECT event_id, event_id::VARCHAR AS id, event_type AS t, user_id, 'user ' || user_id AS u,
    regexp_extract(props, '(\d+)', 1) AS k FROM events)"""

_SIMILARITY = """neighbours AS (SELECT a.vec_id, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS similarity
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"""

_ROW_TEXT = _clean(_plain("text"))


def _row_examples(where: str = "") -> str:
    title = f"CASE WHEN lang = 'en' THEN source ELSE {_title('body')} END"
    return f"""WITH base AS (SELECT doc_id, source, lang, {_ROW_TEXT} AS body,
        CASE quality WHEN 1 THEN 'good text' WHEN 0 THEN 'poor text' ELSE '' END AS output
      FROM documents LEFT JOIN labels USING (doc_id)),
      titled AS (SELECT *, {title} AS title FROM base WHERE length(body) >= 10)
    SELECT doc_id, {_text(fixed.DEFAULT_INSTRUCTION)} AS instruction,
      CASE WHEN title <> '' THEN 'Title: ' || title || chr(10) || chr(10) ELSE '' END || 'Text: ' || body AS input, output
    FROM titled {where}"""


def _document_rows() -> str:
    return f"""SELECT {_file()} AS file, doc_id, lang, {_title(_strip("text"))} AS title, {_ROW_TEXT} AS tx, text AS raw FROM documents"""


def _pick(n: str = "") -> str:
    return f"""CASE WHEN lang = 'en' AND length({_ROW_TEXT}) > 10 THEN {_ROW_TEXT}
      WHEN lang = 'de' AND length({_ROW_TEXT}) > 10 THEN {_ROW_TEXT}
      WHEN lang <> 'fr' AND length({_ROW_TEXT}) > 10 THEN {_ROW_TEXT}
      WHEN length({_ROW_TEXT}) > 10 THEN {_ROW_TEXT} ELSE '' END"""


def _words(x: str, count: int) -> str:
    """First words of a text."""
    words = f"list_filter(string_split_regex({x}, '{_WS}+'), lambda w: w <> '')"
    return f"array_to_string(({words})[1:{count}], ' ')"


def _hierarchy() -> str:
    source = f"SELECT doc_id AS id, {_ROW_TEXT} AS tx FROM documents WHERE length({_ROW_TEXT}) > 10"
    return f"""WITH RECURSIVE {_walk(source, 2000, 200)},
    chunk AS (SELECT source || '_' || id AS source_id, total_chunks, chunk_index, {_words("chunk_text", 30)} AS summary
      FROM pieces JOIN documents ON doc_id = id),
    usable AS (SELECT source_id, chunk_index, summary, row_number() OVER (PARTITION BY source_id ORDER BY chunk_index) AS k
      FROM chunk WHERE NOT starts_with(summary, 'Error:')),
    final AS (SELECT source_id, string_agg('Section ' || k || ': ' || summary, chr(10) || chr(10) ORDER BY chunk_index)
      || chr(10) || chr(10) || {_text(fixed.FINAL_CLOSING)} AS body FROM usable GROUP BY 1),
    results AS (
      SELECT source_id, 'final_summary' AS generation_step, -1 AS chunk_index, n AS total_chunks, {_words("body", 60)} AS summary
        FROM final JOIN (SELECT source_id, count(*)::INT AS n FROM chunk GROUP BY 1) USING (source_id)
      UNION ALL SELECT source_id, 'chunk_summary', chunk_index, total_chunks, summary FROM chunk)"""


ORACLES: dict[str, str] = {
    "clean_documents": f"SELECT doc_id, {_clean('text')} AS clean FROM documents",
    "page_text_regex": f"SELECT page_id, {_plain('html')} AS plain, {_clean(_plain('html'))} AS clean FROM pages",
    "page_text_dom": f"SELECT page_id, {_clean(_visible('html'))} AS clean FROM pages",
    "document_titles": f"SELECT doc_id, {_title('tx')} AS title FROM (SELECT doc_id, {_strip('text')} AS tx FROM documents)",
    "source_types": f"""SELECT doc_id, file, {_kind("file", fixed.SOURCE_TYPE_RULES)} AS source_type,
        {_kind("file", fixed.PROFILE_SOURCE_TYPE_RULES)} AS profile_type,
        {_instruction(_kind("file", fixed.SOURCE_TYPE_RULES))} AS instruction
      FROM (SELECT doc_id, {_file()} AS file FROM documents UNION ALL SELECT page_id, url FROM pages)""",
    "turn_word_overlap": """SELECT a.conv_id, a.turn, round(len(list_intersect(a.w, b.w))::DOUBLE
        / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))), 6) AS overlap
      FROM (SELECT conv_id, turn, list_distinct(string_split(lower(text), ' ')) AS w FROM conversations) a
      JOIN (SELECT conv_id, turn, list_distinct(string_split(lower(text), ' ')) AS w FROM conversations) b
      ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""",
    "chunks_2000_200": _chunks(2000, 200),
    "chunks_500_200": _chunks(500, 200),
    "chunks_250_200_capped": _chunks(250, 200),
    "chunks_250_200_uncapped": _chunks(250, 200, cap=False),
    "chunks_by_line_2000_200": _chunks(2000, 200, sentence_aware=False),
    "chunk_records": f"""WITH RECURSIVE rows AS ({_document_rows()}),
        {_walk("SELECT doc_id AS id, tx FROM rows WHERE length(tx) > 10", 2000, 200)}
      SELECT replace(file, '.csv', '') || '_' || id AS source_id, chunk_index, total_chunks,
        {_prompt("title", "file", "chunk_text")} AS prompt, chunk_text,
        title AS row_title, lang AS row_lang, md5(raw) AS row_text_md5 FROM pieces JOIN rows ON doc_id = id""",
    "whole_text_records": f"""SELECT replace(file, '.csv', '') || '_' || doc_id AS source_id, 0 AS chunk_index,
        1 AS total_chunks, {_prompt("title", "file", "tx")} AS prompt, lang FROM ({_document_rows()}) WHERE length(tx) > 10""",
    "fallback_text_columns": f"SELECT doc_id, {_pick()} AS text FROM documents",
    "examples_from_rows": _row_examples(),
    "labelled_examples_only": _row_examples("WHERE output <> ''"),
    "examples_from_texts": f"""WITH RECURSIVE rows AS (SELECT doc_id, {_file()} AS file,
          {_title(_strip("text"))} AS title, {_clean("text")} AS tx FROM documents),
        {_walk("SELECT doc_id AS id, tx FROM rows", 2000, 200)}
      SELECT id AS doc_id, {_instruction(_kind("file", fixed.SOURCE_TYPE_RULES))} AS instruction,
        'Source file: ' || file || chr(10) || 'Title: ' || title || chr(10) || chr(10) || 'Document:' || chr(10) || chunk_text AS input,
        '' AS output, {_kind("file", fixed.SOURCE_TYPE_RULES)} AS source_type, file AS source_filename, title,
        chunk_index, length(chunk_text)::INT AS chunk_chars FROM pieces JOIN rows ON doc_id = id""",
    "record_documents": _record_documents(_plain),
    "record_documents_dom": _record_documents(_visible),
    "nested_section_documents": f"""SELECT * FROM (SELECT conv_id::VARCHAR AS file, turn AS row_index, '' AS title,
        CASE role WHEN 'user' THEN {_clean("plain || chr(10) || chr(10) || role || chr(10) || chr(10) || role")}
          WHEN 'assistant' THEN {_clean("plain || chr(10) || chr(10) || role || chr(10) || chr(10) || role || chr(10) || chr(10) || 'x'")}
          ELSE {_clean(f"'[not json ' || {_plain('text')}")} END AS text
        FROM (SELECT *, {_strip(_plain("text"))} AS plain FROM conversations)) WHERE length(text) > 20""",
    "table_row_documents": f"""SELECT source AS file, doc_id AS row_index, source AS title, tx AS text FROM (
        SELECT *, CASE WHEN lang = 'en' AND length({_strip("text")}) > 20 THEN {_ROW_TEXT}
          WHEN length({_strip("text")}) > 40 AND length({_strip(_plain("text"))}) > 40 THEN {_clean(_strip(_plain("text")))} ELSE '' END AS tx
        FROM documents) WHERE length(tx) > 20""",
    "ordered_turns": f"""WITH {_TURNS} SELECT source_id, count(*)::INT AS n,
        string_agg(summary, chr(10) ORDER BY chunk_index) AS texts FROM turns GROUP BY 1""",
    "ordered_turns_large": f"WITH {_TURNS} SELECT source_id, chunk_index AS part, summary AS texts FROM turns",
    "final_prompt_per_source": f"""WITH {_SECTIONS} SELECT source_id, opening || chr(10)
        || string_agg('Section ' || k || ': ' || summary, chr(10) || chr(10) ORDER BY k) || chr(10) || chr(10)
        || {_text(fixed.FINAL_CLOSING)} AS prompt FROM usable JOIN heads USING (source_id) GROUP BY source_id, opening""",
    "final_prompt_lines": f"""WITH {_SECTIONS}
        SELECT source_id, k AS part, 'Section ' || k || ': ' || summary AS prompt FROM usable
        UNION ALL SELECT source_id, 0, opening FROM heads
        UNION ALL SELECT source_id, n + 1, chr(10) || {_text(fixed.FINAL_CLOSING)} FROM heads""",
    "sentence_dedup": f"""SELECT doc_id, {_rejoin("kept")} AS text FROM (
        SELECT doc_id, {_fold("own")} AS kept FROM (SELECT doc_id, {_sentence_list("text")} AS own FROM documents))""",
    "merged_results": _MERGED,
    "merged_records_streamed": _MERGED,
    "merged_results_large": _MERGED_LARGE,
    "merged_totals": f"""SELECT sum(total_chunks)::BIGINT AS total_chunks, count(*) AS sources,
        count(*) FILTER (WHERE final_summary <> '' AND NOT starts_with(final_summary, 'Error:')) AS successful FROM ({_MERGED})""",
    "last_event_per_user": """SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id,
        arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2""",
    "hierarchical_summaries": f"{_hierarchy()} SELECT * FROM results",
    "generation_totals": f"""{_hierarchy()} SELECT count(*) FILTER (WHERE generation_step = 'final_summary') AS final_summaries,
        count(*) FILTER (WHERE generation_step = 'chunk_summary') AS chunk_summaries FROM results""",
    "heading_check": f"SELECT doc_id, {_missing('text', HEADINGS)} AS missing FROM documents",
    "review_table_rows": _review(),
    "review_table_sample": _review("WHERE idx < 100"),
    "embedding_similarity": f"WITH {_SIMILARITY} SELECT vec_id, round(similarity, 4) AS similarity FROM neighbours",
    "training_gate": f"""WITH {_SIMILARITY} SELECT 'Summarize.' AS instruction, source AS input, text AS output, doc_id
      FROM documents LEFT JOIN neighbours ON vec_id = doc_id
      WHERE text <> '' AND {_missing("text", GATE_HEADINGS)} = '' AND (similarity IS NULL OR similarity >= {fixed.SIMILARITY_THRESHOLD})""",
    "word_similarity": f"""WITH {_EXAMPLES}, sides AS (
          SELECT idx, 0 AS side, substr(input, 1, 2000) AS body FROM examples UNION ALL SELECT idx, 1, output FROM examples),
        buckets AS (SELECT idx, side, substr(md5(word), 1, 2) AS bucket, count(*) AS n FROM (
          SELECT idx, side, unnest(list_filter(string_split_regex(lower(body), '{_WS}+'), lambda w: w <> '')) AS word FROM sides)
          GROUP BY ALL),
        norms AS (SELECT idx, side, sqrt(sum(n * n)) AS norm FROM buckets GROUP BY ALL),
        dots AS (SELECT a.idx, sum(a.n * b.n) AS dot FROM buckets a JOIN buckets b USING (idx, bucket)
          WHERE a.side = 0 AND b.side = 1 GROUP BY ALL)
      SELECT e.idx, round(coalesce(dot, 0) / (a.norm * b.norm), 4) AS similarity FROM examples e
        LEFT JOIN dots d ON d.idx = e.idx LEFT JOIN norms a ON a.idx = e.idx AND a.side = 0
        LEFT JOIN norms b ON b.idx = e.idx AND b.side = 1""",
    "output_fields": f"""WITH {_EVENTS} SELECT event_id,
        CASE t WHEN 'view' THEN 'output' WHEN 'click' THEN 'label' WHEN 'purchase' THEN 'generated'
          WHEN 'signup' THEN 'final_summary' ELSE '' END AS field,
        CASE t WHEN 'view' THEN 'output' WHEN 'click' THEN 'label' WHEN 'purchase' THEN 'generated'
          WHEN 'signup' THEN 'processing_step' ELSE '' END AS strict_field FROM ev""",
    "export_table": f"""WITH {_EVENTS} SELECT CASE t WHEN 'click' THEN 'x' ELSE id END AS source_id,
        CASE WHEN t IN ('view', 'click') THEN u ELSE '' END AS merged_output,
        CASE t WHEN 'purchase' THEN 'raw row' WHEN 'signup' THEN '7' ELSE '' END AS original_row,
        CASE WHEN t = 'error' THEN 'true' ELSE '' END AS flag,
        CASE WHEN t IN ('view', 'error') THEN k ELSE '' END AS k,
        CASE WHEN t = 'click' THEN '[{{"k":' || k || '}}]' ELSE '' END AS list,
        CASE WHEN t = 'signup' THEN 'merged' ELSE '' END AS processing_step FROM ev""",
    "export_headers": """SELECT DISTINCT unnest(CASE event_type WHEN 'click' THEN ['source_id', 'merged_output', 'list']
        WHEN 'view' THEN ['source_id', 'merged_output', 'k'] WHEN 'purchase' THEN ['source_id', 'merged_output', 'original_row']
        WHEN 'signup' THEN ['source_id', 'merged_output', 'original_row', 'processing_step']
        ELSE ['source_id', 'merged_output', 'k', 'flag'] END) AS header FROM events""",
    "response_texts": f"""SELECT conv_id, turn, CASE WHEN turn IN (4, 7) THEN NULL ELSE nullif({_strip("text")}, '') END AS text
      FROM conversations""",
    "chat_pairs": """SELECT a.conv_id, a.turn, '### Instruction:' || chr(10) || 'Answer the user.' || chr(10) || chr(10)
        || '### Input:' || chr(10) || a.text || chr(10) || chr(10) || '### Response:' || chr(10) AS prompt, coalesce(b.text, '') AS output
      FROM conversations a LEFT JOIN conversations b
        ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 AND b.role = 'assistant' WHERE a.role = 'user'""",
    "outputs_missing": "SELECT count(*) FILTER (WHERE role <> 'assistant' OR text = '') AS empty_outputs FROM conversations",
    "masked_tokens": _token_output(128),
    "masked_tokens_tail": _token_output(256, 32),
    "gated_tokens": f"""SELECT t.*, (SELECT count(*) FILTER (WHERE role <> 'assistant' OR text = '') FROM conversations) AS refused
FROM ({_token_output(128)}) t JOIN (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx, role, text FROM conversations) c USING (idx)
WHERE role = 'assistant' AND text <> ''""",
    "padded_batches": f"""WITH {_tokenized(64)}, batched AS (SELECT *, idx // 8 AS batch_id,
          max(len(ids)) OVER (PARTITION BY idx // 8) AS m FROM masked)
      SELECT idx, batch_id, array_to_string(list_resize(ids, m, 0), ' ') AS input_ids,
        array_to_string(list_resize(list_transform(ids, lambda v: 1), m, 0), ' ') AS attention_mask,
        array_to_string(list_resize(labels, m, {fixed.LABEL_IGNORE}), ' ') AS labels FROM batched""",
    "token_budgets": f"""WITH sized AS (SELECT doc_id, CASE lang WHEN 'en' THEN 256 WHEN 'de' THEN 64 WHEN 'fr' THEN 0 END AS m,
          len({_tokens("text")})::INT AS words FROM documents),
        kept AS (SELECT *, CASE WHEN m > 0 AND words >= m THEN least(words, greatest(m - 100, greatest(1, m // 2)))
          ELSE words END AS kept FROM sized)
      SELECT doc_id, words, kept AS prompt_tokens, CASE WHEN m > 0 THEN least(100, greatest(1, m - kept)) ELSE 100 END AS new_tokens FROM kept""",
    "failures_by_user": r"""SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS failures,
        count(*) FILTER (WHERE event_type = 'error' AND regexp_extract(props, '(\d+)', 1)::INT < 60) AS transient,
        bool_or(event_type <> 'error') AS any_success FROM events GROUP BY 1""",
    "corpus_profile": f"""WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r,
          count(*) OVER (PARTITION BY source) AS n FROM documents)
      SELECT source, n AS count, string_agg(CASE WHEN lang = 'en' THEN lang
          WHEN length(text) > {fixed.PROFILE_PIECE_MIN} THEN substr('note: ' || substr(text, 1, 200), 1, 800) ELSE '' END, '|' ORDER BY r) AS samples
      FROM ranked WHERE r <= 5 GROUP BY source, n""",
    "jsonl_round_trip": "SELECT doc_id, text, CASE WHEN lang <> 'de' THEN lang END AS lang, source FROM documents",
    "jsonl_lenient_read": "SELECT CASE WHEN lang = 'fr' THEN 'rejected' ELSE lang END AS lang, count(*) AS n FROM documents GROUP BY 1",
    "csv_round_trip": f"SELECT doc_id, lang, {_strip('text')} AS text FROM documents",
    "csv_chunk_records": f"""WITH RECURSIVE
        {_walk(f"SELECT doc_id AS id, {_ROW_TEXT} AS tx FROM documents WHERE length({_ROW_TEXT}) > 10", 2000, 200)}
      SELECT id AS doc_id, chunk_index, total_chunks, chunk_text FROM pieces""",
    "folder_documents": f"""SELECT title, text FROM (SELECT CASE WHEN lang = 'en' THEN source ELSE coalesce(lang, '') END AS title,
        CASE WHEN lang = 'en' AND length({_strip("text")}) > 20 THEN {_ROW_TEXT}
          WHEN length({_strip("text")}) > 40 AND length({_strip(_plain("text"))}) > 40 THEN {_clean(_strip(_plain("text")))} ELSE '' END AS text
        FROM documents) WHERE length(text) > 20""",
    "mixed_folder_documents": f"""SELECT source AS title, {_ROW_TEXT} AS text FROM documents
        WHERE coalesce(doc_id % 4, 0) <> 2 AND length({_strip("text")}) > 20 AND length({_ROW_TEXT}) > 20
      UNION ALL SELECT '', {_clean("tx")} FROM (SELECT string_agg(coalesce(text, ''), chr(10) ORDER BY doc_id) AS tx
        FROM documents WHERE doc_id % 4 = 2 GROUP BY doc_id // 200) WHERE length(tx) > 20
      UNION ALL SELECT 'rejected', unnest(['JSON parse error', 'not valid UTF-8']) FROM (SELECT DISTINCT page_id // 50 FROM pages)""",
    "folder_profile": """SELECT count(*) AS records, 0::BIGINT AS oversampled, 0::BIGINT AS failed, 0::BIGINT AS typed FROM documents""",
    "csv_row_numbers": """SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS number, md5(coalesce(text, '')) AS text_md5 FROM documents""",
}
