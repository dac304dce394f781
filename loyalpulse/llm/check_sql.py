"""DuckDB SQL for the rows of the registered queries."""

from __future__ import annotations

SEPARATORS = r"\x20\x09-\x0D"

QUALITY = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^{SEPARATORS}]+') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)),
            lambda l: regexp_matches(l, '[^{SEPARATORS}]')) AS lines
    FROM documents
), places AS (
    SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM d WHERE len(words) >= 3
), grouped AS (
    SELECT r, list(i) AS found FROM places
    GROUP BY r, words[i], words[i + 1], words[i + 2] HAVING count(*) > 1
), starts AS (
    SELECT r, unnest(found) AS i FROM grouped
), repeated AS (
    SELECT r, count(DISTINCT i + k) AS n FROM starts, (VALUES (0), (1), (2)) AS step(k) GROUP BY r
), measured AS (
    SELECT doc_id, text, len(words)::BIGINT AS n_words,
        length(array_to_string(words, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        len(lines) AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM d LEFT JOIN repeated USING (r)
), based AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed
        OR 10 * n_symbols > 2 * n_words
        OR (n_lines >= 6 AND 100 * n_dup_lines > 60 * n_lines)
        OR word_chars > 20 * n_words
        OR 10 * length(regexp_replace(text, '\P{{Lu}}+', '', 'g')) > 5 * word_chars
        OR 10 * length(regexp_replace(text, '[^0-9]+', '', 'g')) > 3 * word_chars) AS kept
FROM based
"""
