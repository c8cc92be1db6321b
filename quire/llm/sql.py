"""DuckDB SQL for the operators that SQL can express."""

ORACLES: dict[str, str] = {}

#: The white space that parts words, as a class and as a list for translate().
_GAP = r"[\x20\x09-\x0D]+"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES["op6_rules"] = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), f AS (
    SELECT r, doc_id, t, [x FOR x IN regexp_split_to_array(t, '{_GAP}') IF x <> ''] AS w,
           [x FOR x IN string_split(t, chr(10)) IF translate(x, {_SPACES}, '') <> ''] AS l
    FROM d
), windows AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n
    FROM (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM f WHERE len(w) >= 3))
), repeats AS (
    SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY r
), m AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, length(translate(t, {_SPACES}, ''))::BIGINT AS word_chars,
           (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
           length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM f LEFT JOIN repeats USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 10 * n_upper > 3 * word_chars
            OR word_chars < 2 * n_words OR word_chars > 12 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM m
"""

ORACLES["op2_urls"] = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), judged AS (
    SELECT *, CASE
        WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/'
    END AS rule FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM judged
"""

ORACLES["op7_chat"] = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), lengths AS (
    SELECT *, length(text) + length(text) - length(replace(text, chr(92), '')) AS plain,
           len(regexp_extract_all(text, '<\|im_start\|>|<\|im_end\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>')) AS broken
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>') + length(role) + 1 + plain + broken + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM lengths GROUP BY conv_id
"""
