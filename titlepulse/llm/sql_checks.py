"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

from titlepulse.llm import chat_format, lexical_search, mixing, quality_rules, topk

CHECKS: dict[str, str] = {}

CHECKS["op1_substring_dedup"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT row, doc_id, unnest(range(1, len(w) - 11)) AS i, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS s
  FROM texts WHERE len(w) >= 13
), gone AS (
  SELECT DISTINCT row, unnest(range(i, i + 13)) AS i
  FROM (SELECT row, i, doc_id, min(doc_id) OVER (PARTITION BY s) AS smallest FROM windows WHERE doc_id IS NOT NULL) WHERE smallest < doc_id
), listed AS (
  SELECT row, list(i) AS g FROM gone GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: g IS NULL OR NOT list_contains(g, i)), ' ')) AS kept_sha256
FROM texts LEFT JOIN listed USING (row)
"""

CHECKS["op3_source_mixing"] = f"""
WITH RECURSIVE counted AS (
  SELECT coalesce('=' || source, 'null') AS k, count(*) AS n FROM documents GROUP BY 1
), sized AS (
  SELECT k, n, CAST(floor(sqrt(n) * 1000) AS BIGINT) AS size, CAST(sum(floor(sqrt(n) * 1000)) OVER () AS BIGINT) AS total FROM counted
), parts AS (
  SELECT k, n, CASE WHEN total <= {mixing.MOST_PARTS} THEN size ELSE greatest(1, size * {mixing.MOST_PARTS} // total) END AS parts, row_number() OVER (ORDER BY k) AS i FROM sized
), whole AS (
  SELECT list(parts ORDER BY i) AS p, CAST(sum(parts) AS BIGINT) AS w,
         max(CAST(ceil(least(parts, (n + {mixing.BLOCK_DOCS} - 1) // {mixing.BLOCK_DOCS}) * (SELECT sum(parts) FROM parts) / parts) AS BIGINT)) AS last FROM parts
), steps AS (
  SELECT CAST(-1 AS BIGINT) AS t, list_transform(p, lambda x: CAST(0 AS BIGINT)) AS c, CAST(NULL AS BIGINT) AS pick, p, w, last FROM whole
  UNION ALL
  SELECT t, list_transform(c, lambda v, i: CASE WHEN i = best THEN v + 1 ELSE v END), best, p, w, last FROM (
    SELECT t + 1 AS t, c, p, w, last, list_aggregate(list_filter(list_transform(p, lambda x, i:
        CASE WHEN (c[i] * w) // x <= t + 1 THEN ((c[i] + 1) * w + x - 1) // x * 1000000 + i END), lambda y: y IS NOT NULL), 'min') % 1000000 AS best
    FROM steps WHERE t < least(w, last))
), template AS (
  SELECT parts.k, parts.parts, s.w, s.t, row_number() OVER (PARTITION BY s.pick ORDER BY s.t) - 1 AS j
  FROM steps AS s JOIN parts ON parts.i = s.pick
), ranked AS (
  SELECT doc_id, source, coalesce('=' || source, 'null') AS k,
         row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), ''))) - 1 AS r
  FROM documents
), blocks AS (
  SELECT *, r // {mixing.BLOCK_DOCS} AS block, r % {mixing.BLOCK_DOCS} AS slot_offset FROM ranked JOIN parts USING (k)
)
SELECT doc_id, source, block, (block * w) // b.parts AS release, ((block + 1) * w + b.parts - 1) // b.parts AS due,
       (block // b.parts) * w + t AS slot, slot_offset
FROM blocks AS b JOIN template AS m ON m.k = b.k AND m.j = block % b.parts
"""

CHECKS["op4_ngram_jaccard_join"] = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM texts
), flat AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM flat AS a JOIN flat AS b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a AS doc_id, a AS m FROM both_ways
  UNION
  SELECT e.b, r.m FROM reach AS r JOIN both_ways AS e ON e.a = r.doc_id AND r.m < e.b
), least AS (
  SELECT doc_id, min(m) AS m FROM reach GROUP BY doc_id
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(m, doc_id) AS component_id FROM sets LEFT JOIN least USING (doc_id)
"""

CHECKS["op5_exact_topk"] = f"""
WITH usable AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({topk.SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable AS q JOIN usable AS c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % {topk.EVERY} = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= {topk.K}
"""

CHECKS["op9_quality_rules"] = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT *, CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: [w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]]) ELSE [] END AS r,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM texts
), starts AS (
  SELECT row_number() OVER () AS row, * FROM windows
), flat AS (
  SELECT row, unnest(r) AS g, unnest(range(1, len(r) + 1)) AS i FROM starts
), counted AS (
  SELECT row, i, count(*) OVER (PARTITION BY row, g) AS n FROM flat
), gaps AS (
  SELECT row, least(5, i - coalesce(lag(i) OVER (PARTITION BY row ORDER BY i), -5)) AS gap FROM counted WHERE n > 1
), covered AS (
  SELECT row, CAST(sum(gap) AS BIGINT) AS n FROM gaps GROUP BY row
), measured AS (
  SELECT doc_id, t, w, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM starts LEFT JOIN covered AS c USING (row)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
            OR 2 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > word_chars
            OR 5 * (length(t) - length(translate(t, '!', ''))) > n_words
            OR 5 * len(list_filter(w, lambda x: NOT regexp_matches(x, '\\p{L}'))) > n_words) AS kept
FROM judged
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

CHECKS["op12_lexical_search"] = f"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS w FROM documents
), asked AS (
  SELECT row_number() OVER () AS item, item_id, {_TERMS} AS w FROM benchmark
), wanted AS (
  SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(w) AS term FROM asked) GROUP BY ALL
), held AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM texts) GROUP BY ALL
), total AS (
  SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM texts WHERE len(w) > 0
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) AS weight FROM (SELECT term, count(*) AS df FROM held GROUP BY term), total
), scored AS (
  SELECT item, item_id, row, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(texts.w) * n) // l)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN held USING (term) JOIN texts USING (row), total GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
) WHERE rank <= {lexical_search.K}
"""


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _escaped(column: str) -> str:
    out = f"replace({column}, chr(92), repeat(chr(92), 2))"
    for c in chat_format.INSTRUCTIONS.control:
        out = f"replace({out}, {_sql_text(c)}, {_sql_text(c[0])} || chr(92) || {_sql_text(c[1:])})"
    return out


_MARK_CHARS = "CASE role " + " ".join(f"WHEN {_sql_text(role)} THEN {len(m.before) + len(m.after)}" for role, m in chat_format.INSTRUCTIONS.roles.items())

CHECKS["op13_chat_format"] = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), stepped AS (
  SELECT *, row_number() OVER o AS position, coalesce(lag(role) OVER o, '-') || '>' || role AS step,
         length({_escaped("text")}) + {_MARK_CHARS} ELSE {sum(map(len, chat_format.INSTRUCTIONS.other))} + length({_escaped("role")}) END AS chars
  FROM rows WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), gathered AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY position) AS turns,
         coalesce(string_agg(text, '' ORDER BY position) FILTER (role = 'assistant'), '') AS loss, CAST(sum(chars) AS BIGINT) AS formatted_chars,
         min(position) FILTER (step NOT IN ('->system', '->user', 'system>user', 'user>assistant', 'assistant>user')) AS first_bad,
         arg_max(role, position) = 'assistant' AS complete
  FROM stepped GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars,
       first_bad IS NULL AS valid, first_bad, complete FROM gathered
"""
