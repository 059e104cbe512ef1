"""DuckDB SQL of the corpus operators that SQL expresses over whole tables.

The others rest on 64-bit XXH64 values, fitted models, connected components,
shortest paths or eigenvectors; tests/llm holds them against brute force instead.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_SUBSTRING_DEDUP = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
word AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM doc),
win AS (SELECT r, p, string_agg(w, ' ') OVER f AS g, count(*) OVER f AS c FROM word
        WINDOW f AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
often AS (SELECT g FROM win WHERE c = 35 GROUP BY g HAVING count(*) > 1),
hit AS (SELECT r, p, 1 AS h FROM win JOIN often USING (g) WHERE c = 35),
marked AS (SELECT r, p, w, coalesce(max(h) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) AS gone
           FROM word LEFT JOIN hit USING (r, p)),
kept AS (SELECT r, count(*) AS n, sum(gone) AS g, string_agg(w, ' ' ORDER BY p) FILTER (WHERE gone = 0) AS t FROM marked GROUP BY r)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_words, CAST(coalesce(g, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""

_BLANKS = r"E' \t\n\x0B\f\r'"
_QUALITY_RULES = rf"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
word AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM doc),
win AS (SELECT r, p, string_agg(w, ' ') OVER f AS g, count(*) OVER f AS c FROM word
        WINDOW f AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
twice AS (SELECT r, p, 1 AS h FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS k FROM win WHERE c = 5) WHERE k > 1),
repeated AS (SELECT r, sum(h) AS n_repeat_words FROM (
    SELECT r, coalesce(max(h) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 0) AS h
    FROM word LEFT JOIN twice USING (r, p)) GROUP BY r),
line AS (SELECT r, raw, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n,
                len(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) AS chars,
                len(x) - len(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS symbols,
                len(x) - len(regexp_replace(x, '[|»›•]', '', 'g')) AS pieces
         FROM (SELECT r, raw, trim(raw, {_BLANKS}) AS x FROM (SELECT r, unnest(string_split(t, E'\n')) AS raw FROM doc)) WHERE x <> ''),
judged AS (SELECT *, (regexp_matches(x, '[.!?:;…。！？]["''”’»)\]]*$') OR n >= 20) AND symbols * 20 <= chars
                  AND NOT regexp_matches(x, '(?:[!?]{{2,}}.*){{3,}}')
                  AND NOT (pieces >= 2 AND n <= 5 * (pieces + 1))
                  AND NOT regexp_matches(x, '(?i)^(?:home|menu|back|next|previous|top|login|log in|sign in|sign up|search|contact|about|sitemap|share)(?:\W+\w+){{0,4}}\W*$')
                  AND NOT regexp_matches(x, '(?i)all rights reserved|copyright \(c\)|©|\blicen[sc]ed under\b|terms of (?:use|service)|privacy policy|cookie (?:policy|settings)|uses? cookies|enable javascript|subscribe to our newsletter|click here to|powered by ') AS ok
           FROM line),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT raw) AS n_dup_lines,
                 count(*) FILTER (WHERE ok) AS n_passing_lines, coalesce(sum(chars) FILTER (WHERE ok), 0) AS kept_chars
          FROM judged GROUP BY r),
stats AS (SELECT doc_id, len(ws) AS n_words, len(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                 len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
                 coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
                 coalesce(n_passing_lines, 0) AS n_passing_lines, coalesce(kept_chars, 0) AS kept_chars
          FROM doc LEFT JOIN repeated USING (r) LEFT JOIN lines USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 2 * kept_chars >= word_chars AS kept,
       CAST(n_lines AS BIGINT) AS n_lines, CAST(n_passing_lines AS BIGINT) AS n_passing_lines, CAST(kept_chars AS BIGINT) AS kept_chars
FROM stats
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_COLLOCATIONS = rf"""
WITH piece AS (SELECT row_number() OVER () AS r, lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws
               FROM (SELECT coalesce(lang, 'und') AS lang,
                            unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS p
                     FROM documents)),
word AS (SELECT r, lang, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM piece),
run AS (SELECT lang, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM word WINDOW o AS (PARTITION BY r ORDER BY p)),
phrase AS (SELECT lang, 1 AS k, w AS phrase, count(*) AS f FROM run GROUP BY ALL
           UNION ALL SELECT lang, 2, w || ' ' || w2, count(*) FROM run WHERE w2 IS NOT NULL GROUP BY ALL
           UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3, count(*) FROM run WHERE w3 IS NOT NULL GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM phrase WHERE k = 1 GROUP BY lang),
good AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS ws FROM phrase WHERE k > 1 AND f >= 10),
halves AS (SELECT g.lang, g.phrase, g.f AS a, c.c, l.f AS l, r.f AS r,
                  CAST(1000000 * CAST(g.f AS HUGEINT) * g.f // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
           FROM good g JOIN (VALUES (1), (2)) AS c(c) ON c.c < g.k
           JOIN phrase l ON l.lang = g.lang AND l.phrase = array_to_string(g.ws[1:c.c], ' ')
           JOIN phrase r ON r.lang = g.lang AND r.phrase = array_to_string(g.ws[c.c + 1:], ' ')),
scored AS (SELECT lang, phrase, a, l, r, score FROM halves QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_of AS (SELECT lang, array_to_string(ws[j:j + 1], ' ') AS phrase, max(f) AS f
             FROM good, (VALUES (1), (2)) AS starts(j) WHERE k = 3 GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM scored JOIN total USING (lang) LEFT JOIN inner_of USING (lang, phrase)
WHERE inner_of.f IS NULL OR 100 * inner_of.f < 50 * a
QUALIFY rank <= 2000
"""

_BARE = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_DECONTAMINATION = f"""
WITH item AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_BARE} AS ws FROM benchmark),
win AS (SELECT DISTINCT item, k, array_to_string(ws[i:i + k - 1], ' ') AS g
        FROM (SELECT item, ws, least(len(ws), 10) AS k, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM item WHERE len(ws) > 0)),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_BARE} AS ws FROM documents),
word AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM doc),
run AS (SELECT r, i, list(w) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS ten FROM word),
found AS (SELECT DISTINCT r, i, k, g FROM (SELECT r, i, k, array_to_string(ten[1:k], ' ') AS g
          FROM run, (SELECT DISTINCT k FROM win) WHERE len(ten) >= k) WHERE g IN (SELECT g FROM win)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM found) GROUP BY r),
of AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT r, item FROM found JOIN win USING (g)) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN of USING (r)
"""

SQL: dict[str, str] = {"op6_substring_dedup": _SUBSTRING_DEDUP, "op8_quality_rules": _QUALITY_RULES,
                       "op11_collocations": _COLLOCATIONS, "op12_decontamination": _DECONTAMINATION}
