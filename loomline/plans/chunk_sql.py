"""SQL of the sequential chunkers and of the token bucket, as recursive queries for DuckDB.

Both recursions go one step in every document (or host) at once: `walk` finds
where the next chunk starts, `fold` joins small chunks to their predecessors.
"""

from __future__ import annotations

_ENDS = {"en": "[.!?]+", "mixed": "[.!?。！？]+"}
_COUNT = r"len(list_filter(regexp_split_to_array({}, '\s+'), lambda w: w <> ''))"


def _strip(s: str) -> str:
    return rf"regexp_replace({s}, '^\s+|\s+$', '', 'g')"


def _sentences(text: str, ends: str = "en", collapse: bool = True) -> str:
    one = r"regexp_replace(s, '\s+', ' ', 'g')" if collapse else "s"
    return f"list_filter(list_transform(regexp_split_to_array({text}, '{_ENDS[ends]}'), lambda s: {_strip(one)}), lambda s: s <> '')"


def _sums(lengths: str) -> str:
    """Sums of the first 0, 1, ... items of a list."""
    return f"list_transform(range(0, len({lengths}) + 1), lambda k: coalesce(list_sum(list_slice({lengths}, 1, k)), 0))"


def _filled(count: int, size: int) -> str:
    """End of the run from `start` that grows while it has less than `count` items and less than `size` in total."""
    return f"start + len(list_filter(range(start, least(start + {count}, n)), lambda e: sums[e + 1] - sums[start + 1] < {size}))"


def _fold(columns: dict[str, str], least: int = 100, most: int = 1500) -> str:
    """CTE `fold` and the final SELECT over `chunks`(doc_id, i, content, whole, columns).

    A value that the later chunk lacks stays that of the earlier one; `whole` texts are not folded."""
    small = f"NOT c.whole AND length(c.content) < {least} AND length(f.content) + length(c.content) <= {most}"
    kept = "".join(f", CASE WHEN {small} THEN coalesce(c.{k}, f.{k}) ELSE c.{k} END" for k in columns)
    shown = "".join(f", arg_max({k}, i) FILTER ({k} IS NOT NULL) AS {k}" for k in columns)
    names = "".join(f", {k}" for k in columns)
    return f"""fold AS (
      SELECT doc_id, i, i AS first, content, length(content) AS stop{names} FROM chunks WHERE i = 0
      UNION ALL
      SELECT c.doc_id, c.i, CASE WHEN {small} THEN f.first ELSE c.i END, CASE WHEN {small} THEN f.content || ' ' || c.content ELSE c.content END, length(c.content){kept}
      FROM fold f JOIN chunks c ON c.doc_id = f.doc_id AND c.i = f.i + 1)
    SELECT doc_id, first::INT AS chunk_index, arg_max(content, i) AS content, 0 AS start_pos, arg_max(stop, i)::INT AS end_pos{shown} FROM fold GROUP BY doc_id, first"""


_RUN = {"chunk_method": "VARCHAR", "sentence_count": "BIGINT", "word_count": "BIGINT", "sentence_start_index": "BIGINT", "sentence_end_index": "BIGINT"}

#: Columns that the queries show of a chunk's metadata, by chunker.
SENTENCE_COLUMNS = _RUN | {"is_complete_text": "BOOLEAN", "has_overlap": "BOOLEAN", "overlap_sentences": "BIGINT"}
SLIDING_COLUMNS = _RUN | {"overlap_with_previous": "BOOLEAN", "overlap_with_next": "BOOLEAN"}
PARAGRAPH_COLUMNS = _RUN | {
    "paragraph_index": "BIGINT", "is_complete_paragraph": "BOOLEAN", "is_paragraph_part": "BOOLEAN",
    "paragraph_count": "BIGINT", "paragraph_start_index": "BIGINT", "paragraph_end_index": "BIGINT",
}


def _nulls(columns: dict[str, str], **given: str) -> str:
    return ", ".join(f"{given.get(k, f'NULL::{t}')} AS {k}" for k, t in columns.items())


SENTENCE_SQL = f"""WITH RECURSIVE s AS (SELECT doc_id, text, {_sentences("text")} AS s FROM documents WHERE text IS NOT NULL),
    d AS MATERIALIZED (SELECT doc_id, text, s, len(s) AS n, {_sums("list_transform(s, lambda x: length(x))")} AS sums FROM s WHERE len(s) > 0),
    walk AS (
      SELECT doc_id, 0 AS i, 0::BIGINT AS start, greatest({_filled(10, 1000)}, least(n, start + 2)) AS stop FROM (SELECT *, 0::BIGINT AS start FROM d WHERE n > 10)
      UNION ALL
      SELECT doc_id, i, start, greatest({_filled(10, 1000)}, least(n, start + 2)) FROM (SELECT d.*, w.i + 1 AS i, w.stop - least(CASE WHEN w.i > 0 THEN 1 ELSE 0 END, w.stop - w.start - 1) AS start FROM walk w JOIN d USING (doc_id)) WHERE start < n),
    cut AS (SELECT doc_id, i, start, stop, array_to_string(list_slice(s, start + 1, stop), ' ') AS content FROM walk JOIN d USING (doc_id)),
    chunks AS MATERIALIZED (
      SELECT doc_id, i, content, false AS whole, {_nulls(SENTENCE_COLUMNS, chunk_method="'sentence_based'", sentence_count="stop - start", word_count=_COUNT.format("content"), sentence_start_index="start", sentence_end_index="stop", has_overlap="i > 0", overlap_sentences="(i > 0)::BIGINT")} FROM cut
      UNION ALL
      SELECT doc_id, 0, text, true, {_nulls(SENTENCE_COLUMNS, chunk_method="'sentence_complete'", sentence_count="n", is_complete_text="true")} FROM d WHERE n <= 10),
    {_fold(SENTENCE_COLUMNS)}"""

_FOLLOW = "CASE WHEN w.i > 0 AND 50 < w.stop - w.start THEN w.start + 50 ELSE w.stop END"
SLIDING_SQL = f"""WITH RECURSIVE s AS (SELECT doc_id, {_sentences("text", "mixed", False)} AS s FROM documents WHERE text IS NOT NULL),
    d AS MATERIALIZED (SELECT doc_id, s, len(s) AS n, {_sums("list_transform(s, lambda x: " + _COUNT.format("x") + ")")} AS sums FROM s WHERE len(s) > 0),
    walk AS (
      SELECT doc_id, 0 AS i, 0::BIGINT AS start, {_filled(100, 100)} AS stop FROM (SELECT *, 0::BIGINT AS start FROM d)
      UNION ALL
      SELECT doc_id, i, start, {_filled(100, 100)} FROM (SELECT d.*, w.i + 1 AS i, {_FOLLOW} AS start FROM walk w JOIN d USING (doc_id)) WHERE start < n),
    cut AS (SELECT doc_id, i, start, stop, n, {_FOLLOW} AS follow, sums[stop + 1] - sums[start + 1] AS words, array_to_string(list_slice(s, start + 1, stop), '. ') AS content FROM walk w JOIN d USING (doc_id)),
    chunks AS MATERIALIZED (SELECT doc_id, i, CASE WHEN content LIKE '%.' THEN content ELSE content || '.' END AS content, false AS whole,
      {_nulls(SLIDING_COLUMNS, chunk_method="'sliding_window_sentences'", sentence_count="stop - start", word_count="words::BIGINT", sentence_start_index="start", sentence_end_index="stop", overlap_with_previous="i > 0", overlap_with_next="follow < n")} FROM cut),
    {_fold(SLIDING_COLUMNS)}"""

#: The tables have no blank lines, so a paragraph is made to begin before some capitals.
PARAGRAPH_START = (r"([.!?]) ([A-M])", "\n\n")
_PARAGRAPHED = rf"regexp_replace(text, '{PARAGRAPH_START[0]}', '\1' || chr(10) || chr(10) || '\2', 'g')"

_PARAGRAPH_CHUNKS = rf"""WITH RECURSIVE t AS (SELECT doc_id, list_filter(list_transform(string_split(THE_TEXT, chr(10) || chr(10)), lambda s: {_strip("s")}), lambda s: s <> '') AS t FROM documents WHERE text IS NOT NULL),
    d AS MATERIALIZED (SELECT doc_id, t, list_transform(t, lambda p: {_sentences("p")}) AS parts FROM t),
    p AS (SELECT doc_id, t, parts, {_sums("list_transform(parts, lambda q: len(q))")} AS sums, unnest(range(0, len(t))) AS i FROM d),
    e AS (SELECT *, t[i + 1] AS own, parts[i + 1] AS q, len(parts[i + 1]) AS n, i + 1 + len(list_filter(range(i + 1, len(t)), lambda x: sums[x + 2] - sums[i + 1] <= 10)) AS stop FROM p),
    g AS (SELECT *, sums[stop + 1] - sums[i + 1] AS total, n < 2 AND sums[stop + 1] - sums[i + 1] >= 2 AS joined FROM e WHERE n > 0),
    cut AS (
      SELECT doc_id, i, 0 AS a, array_to_string(list_slice(t, i + 1, stop), chr(10) || chr(10)) AS content, {_nulls(PARAGRAPH_COLUMNS, chunk_method="'paragraph_combined'", sentence_count="total::BIGINT", paragraph_count="stop - i", paragraph_start_index="i", paragraph_end_index="stop")} FROM g WHERE joined
      UNION ALL
      SELECT doc_id, i, 0, own, {_nulls(PARAGRAPH_COLUMNS, chunk_method="'paragraph_complete'", sentence_count="n", paragraph_index="i", is_complete_paragraph="true")} FROM g WHERE NOT joined AND n <= 10
      UNION ALL
      SELECT doc_id, i, a, array_to_string(list_slice(q, a + 1, a + 10), ' '), {_nulls(PARAGRAPH_COLUMNS, chunk_method="'paragraph_sentence_split'", sentence_count="least(10, n - a)", sentence_start_index="a", sentence_end_index="least(n, a + 10)", paragraph_index="i", is_paragraph_part="true")}
      FROM (SELECT *, unnest(range(0, n, 9)) AS a FROM g WHERE NOT joined AND n > 10)),
    chunks AS MATERIALIZED (SELECT * REPLACE (row_number() OVER (PARTITION BY doc_id ORDER BY i, a) - 1 AS i, {_COUNT.format("content")} AS word_count), false AS whole FROM cut),
    {_fold(PARAGRAPH_COLUMNS)}"""

PARAGRAPH_SQL = _PARAGRAPH_CHUNKS.replace("THE_TEXT", _PARAGRAPHED)
_EMBEDDED = "sha256(doc_id || '/' || chunk_index) AS id, doc_id AS article_id, content, md5(content) AS content_hash, chunk_index, length(content)::INT AS chunk_size, 64 AS dimensions"
#: Chunks of documents as they are, with what stands beside their vectors.
EMBEDDED_SQL = f"SELECT {_EMBEDDED} FROM ({_PARAGRAPH_CHUNKS.replace('THE_TEXT', 'text')})"
#: The same by windows of sentences, of documents that no embedding row names.
NEW_SQL = f"""SELECT {_EMBEDDED} FROM ({SLIDING_SQL}) WHERE doc_id NOT IN (SELECT CASE WHEN vec_id % 50 = 49 THEN vec_id + 1000000000 ELSE vec_id % (SELECT count(*) FROM documents) END FROM embeddings)"""

_SET = "list_distinct(string_split(s, ' '))"
_STATE = "{{'seen': {}, 'size': {}, 'members': {}, 'full': false}}"
_JOINS = "NOT a.full AND len(list_intersect(a.seen, x.seen)) >= 0.2::DOUBLE * (len(a.seen) + len(x.seen) - len(list_intersect(a.seen, x.seen)))"
_NEXT = (
    f"list_reduce(free, lambda a, x: CASE WHEN {_JOINS} THEN "
    "{'seen': list_distinct(a.seen || x.seen), 'size': a.size + x.size, 'members': a.members || x.members, 'full': a.size + x.size > 1000} ELSE a END)"
)
_LEFT = "list_filter(free, lambda x: NOT list_contains(found.members, x.members[1]))"
SEMANTIC_COLUMNS = {"chunk_method": "VARCHAR", "sentence_count": "BIGINT", "word_count": "BIGINT", "sentence_indices": "VARCHAR", "avg_similarity": "DOUBLE", "similarity_threshold": "DOUBLE", "similarity_score": "DOUBLE"}
SEMANTIC_SQL = f"""WITH RECURSIVE s AS (SELECT doc_id, text, {_sentences("text")} AS s FROM documents WHERE text IS NOT NULL),
    d AS MATERIALIZED (SELECT doc_id, text, s, len(s) AS n FROM s),
    walk AS (
      SELECT doc_id, -1 AS i, list_transform(range(0, n), lambda j: {_STATE.format(_SET.replace("(s,", "(s[j + 1],"), "length(s[j + 1])", "[j]")}) AS free, []::BIGINT[] AS members FROM d WHERE n > 3
      UNION ALL
      SELECT doc_id, i, {_LEFT}, found.members FROM (SELECT doc_id, i + 1 AS i, free, {_NEXT} AS found FROM walk WHERE len(free) > 0)),
    cut AS (SELECT doc_id, i, list_sort(members) AS g, s, array_to_string(list_transform(list_sort(members), lambda j: s[j + 1]), ' ') AS content FROM walk JOIN d USING (doc_id) WHERE i >= 0),
    chunks AS MATERIALIZED (
      SELECT doc_id, i, content, false AS whole, {_nulls(SEMANTIC_COLUMNS, chunk_method="'semantic_similarity'", sentence_count="len(g)", word_count=_COUNT.format("content"), sentence_indices="g::VARCHAR", avg_similarity="greatest(0.5::DOUBLE, 1 - (len(g) - 1) * 0.1::DOUBLE)", similarity_threshold="0.2::DOUBLE")} FROM cut
      UNION ALL
      SELECT doc_id, 0, text, true, {_nulls(SEMANTIC_COLUMNS, chunk_method="'semantic_complete'", sentence_count="n", similarity_score="1::DOUBLE")} FROM d WHERE n <= 3 AND text ~ '\\S'),
    {_fold(SEMANTIC_COLUMNS)}"""

TOKEN_SQL = """WITH RECURSIVE e AS MATERIALIZED (SELECT CAST(user_id AS VARCHAR) AS host, event_id AS request_id, epoch(ts) AS asked, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events WHERE user_id IS NOT NULL),
    walk AS (
      SELECT host, request_id, i, asked, 4.0::DOUBLE AS tokens, asked AS last, 0.0::DOUBLE AS wait FROM e WHERE i = 1
      UNION ALL
      SELECT host, request_id, i, asked, CASE WHEN have < 1 THEN have ELSE have - 1 END, CASE WHEN have >= 1 AND asked - last >= 1 THEN asked ELSE last END,
        CASE WHEN have < 1 THEN least(greatest(1 - have, 0.5), 10) WHEN asked - last < 1 THEN 1 - (asked - last) ELSE 0 END
      FROM (SELECT e.host, e.request_id, e.i, e.asked, w.last, least(5, w.tokens + (e.asked - w.asked)) AS have FROM walk w JOIN e ON e.host = w.host AND e.i = w.i + 1))
    SELECT host, request_id, round(wait, 6) AS wait FROM walk"""
