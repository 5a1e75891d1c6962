"""SQL twins of the operators that SQL can express."""

from __future__ import annotations

from plenum.llm.licenses import NOTICES, notice_bigrams, notice_words

SPACES = r"[^\x20\x09-\x0D]+"
UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP1 = rf"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(text, {UPPER_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, {UPPER_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, sizes WHERE len(w) >= n)),
found AS (SELECT d.doc_id, d.i, d.n, t.item_id FROM doc_windows d JOIN item_windows t ON d.n = t.n AND d.g = t.g),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
met AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id),
aligned AS (
  SELECT doc_id, i, n, g, item_id, i - row_number() OVER (PARTITION BY doc_id, item_id, k ORDER BY i) AS run, k
  FROM (SELECT DISTINCT d.doc_id, d.i, d.n, d.g, t.item_id, d.i - t.i AS k
        FROM doc_windows d JOIN (
          SELECT item_id, i, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
          FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
        ) t ON d.n = t.n AND d.g = t.g)),
longest AS (
  SELECT doc_id, max(size) AS longest_match
  FROM (SELECT doc_id, max(n) + count(*) - 1 AS size FROM aligned GROUP BY doc_id, item_id, k, run) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(longest_match, 0) AS BIGINT) AS longest_match
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN met USING (doc_id) LEFT JOIN longest USING (doc_id)
"""

OP3 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, {UPPER_LOWER}), '{SPACES}') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes s ON s.doc_id = a.doc_id JOIN sizes t ON t.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, s.n, t.n HAVING 100 * count(*) >= 80 * (s.n + t.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM words UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
roots AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a),
degrees AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
SELECT roots.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM roots LEFT JOIN sizes USING (doc_id) LEFT JOIN degrees USING (doc_id)
"""

OP4 = rf"""
WITH rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
parts AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN
      translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'), {UPPER_LOWER}) ELSE '' END AS host,
    CASE WHEN strpos(url, '://') > 0 THEN
      regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
best AS (
  SELECT p.page_id, p.host, p.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
    max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT * FROM parts) p
  JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY ALL)
SELECT parts.page_id, parts.host, parts.path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best ON parts.page_id = best.page_id AND parts.host = best.host AND parts.path = best.path
"""

OP5 = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, host, doc_id, text, regexp_extract_all(text, '{SPACES}') AS w FROM texts),
lines AS (
  SELECT r, host, text, line, len(regexp_extract_all(line, '{SPACES}')) AS n,
    array_to_string(regexp_extract_all(translate(line, {UPPER_LOWER}), '{SPACES}'), ' ') AS norm
  FROM (SELECT r, host, text, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE len(regexp_extract_all(line, '{SPACES}')) > 0),
hosts AS (SELECT host, count(DISTINCT text) AS docs FROM texts GROUP BY host),
often AS (
  SELECT host, norm FROM (SELECT host, norm, count(DISTINCT text) AS met FROM lines GROUP BY host, norm) JOIN hosts USING (host)
  WHERE met >= 10 AND met * 100 > docs * 8),
lost AS (SELECT r, sum(n) AS lost FROM lines JOIN often USING (host, norm) GROUP BY r),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r),
grams AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)),
twice AS (SELECT r, g FROM grams GROUP BY r, g HAVING count(*) > 1),
again AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest(range(i, i + 3)) AS p FROM grams JOIN twice USING (r, g)) GROUP BY r),
counts AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols FROM words),
judged AS (
  SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed,
    CAST(n_words - coalesce(lost, 0) AS BIGINT) AS left_words
  FROM counts LEFT JOIN dup USING (r) LEFT JOIN again USING (r) LEFT JOIN lost USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND left_words * 100 >= n_words * 30 AS kept, left_words
FROM judged
"""

OP6 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
sized AS (
  SELECT *, length(role || text) + length(regexp_replace(role || text, '[^\\<>]', '', 'g')) + 15 AS size FROM rows)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


OP9 = rf"""
WITH notices AS (
  SELECT name, g, count(*) OVER (PARTITION BY notice) AS size, notice
  FROM (SELECT notice, name, unnest(grams) AS g FROM (VALUES {", ".join(
      "(%d, '%s', [%s])" % (i, name, ", ".join("'" + g.replace("'", "''") + "'" for g in notice_bigrams(text)))
      for i, (name, text) in enumerate(NOTICES))}) AS v(notice, name, grams))),
texts AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
units AS (
  SELECT r, 0 AS u, text AS unit FROM texts WHERE text IS NOT NULL AND contains(text, chr(10))
  UNION ALL
  SELECT r, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u, unnest(string_split(text, chr(10))) AS unit
  FROM texts WHERE text IS NOT NULL),
told AS (SELECT r, u, regexp_extract_all(translate(unit, {UPPER_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM units),
lines AS (
  SELECT r, w, row_number() OVER along AS l, count(*) OVER (PARTITION BY r) AS n_lines,
    sum(len(w)) OVER along AS upto, sum(len(w)) OVER along - len(w) AS before
  FROM told WHERE u > 0 AND len(w) > 0 WINDOW along AS (PARTITION BY r ORDER BY u)),
lengths AS (SELECT unnest([{", ".join(map(str, sorted({len(notice_words(text)) for _, text in NOTICES})))}]) AS n),
reach AS (  -- the last line of the longest run with fewer words, and of the one with a line more
  SELECT a.r, a.l AS a, a.n_lines, max(b.l) FILTER (b.upto - a.before < n) AS fewer, max(b.l) AS more
  FROM lines a JOIN lines b ON a.r = b.r AND b.l >= a.l JOIN lengths ON b.before - a.before < n GROUP BY a.r, a.l, a.n_lines, n),
runs AS (
  SELECT DISTINCT r, a, z FROM (SELECT r, a, n_lines, fewer AS z FROM reach UNION ALL SELECT r, a, n_lines, more FROM reach)
  WHERE z > a AND z - a + 1 < n_lines),
words AS (
  SELECT r, '' || u AS u, w FROM told
  UNION ALL
  SELECT r, a || '-' || z, flatten(list(w ORDER BY l)) FROM runs JOIN lines USING (r) WHERE l BETWEEN a AND z GROUP BY r, a, z),
grams AS (
  SELECT DISTINCT r, u, w[i] || ' ' || w[i + 1] AS g
  FROM (SELECT r, u, w, unnest(range(1, len(w))) AS i FROM words WHERE len(w) > 1)),
sizes AS (SELECT r, u, count(*) AS n FROM grams GROUP BY r, u),
scored AS (
  SELECT r, u, name, count(*) * 2.0 / (min(sizes.n) + min(notices.size)) AS dice
  FROM grams JOIN notices USING (g) JOIN sizes USING (r, u) GROUP BY r, u, name, notice
  HAVING count(*) * 200 >= 80 * (min(sizes.n) + min(notices.size))),
best AS (
  SELECT r, max(dice) AS dice, count(DISTINCT u) AS n_matches, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses
  FROM scored GROUP BY r),
named AS (SELECT r, min(name) AS license FROM scored JOIN best USING (r) WHERE scored.dice = best.dice GROUP BY r)
SELECT doc_id, license, round(CAST(dice AS DOUBLE), 6) AS dice, coalesce(licenses, '') AS licenses,
  CAST(coalesce(n_matches, 0) AS BIGINT) AS n_matches
FROM texts LEFT JOIN best USING (r) LEFT JOIN named USING (r)
"""


OP11 = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, t, len(t) AS n,
    CAST('0x' || h[1:8] AS BIGINT) % (len(t) + 1) AS p1, CAST('0x' || h[9:16] AS BIGINT) % (len(t) + 1) AS p2,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(t[1:least(p1, p2)], '') AS a,
    array_to_string(t[least(p1, p2) + 1:greatest(p1, p2)], '') AS b, array_to_string(t[greatest(p1, p2) + 1:], '') AS c
  FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
    ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

OP12 = rf"""
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(translate(text, {UPPER_LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, coalesce(text, '') AS text FROM documents)),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
counts AS (
  SELECT lang, m, phrase, count(*) AS f
  FROM (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
        FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
              FROM words, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m))
  GROUP BY lang, m, phrase HAVING count(*) >= 100),
split AS (SELECT lang, m, phrase, f, string_split(phrase, ' ') AS w FROM counts),
inside AS (
  SELECT DISTINCT lang, part, f
  FROM (SELECT lang, f, array_to_string(w[:m - 1], ' ') AS part FROM split WHERE m > 2
        UNION ALL SELECT lang, f, array_to_string(w[2:], ' ') FROM split WHERE m > 2)),
cuts AS (
  SELECT s.lang, s.phrase, s.f AS a, k, a.f AS l, b.f AS r, n,
    (1000::HUGEINT * s.f * n) // (a.f::HUGEINT * b.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM split WHERE m > 1) s
  JOIN counts a ON a.lang = s.lang AND a.phrase = array_to_string(s.w[:k], ' ')
  JOIN counts b ON b.lang = s.lang AND b.phrase = array_to_string(s.w[k + 1:], ' ')
  JOIN totals ON totals.lang = s.lang),
weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, encode(w.phrase)) AS rank
  FROM weakest w LEFT JOIN inside i ON i.lang = w.lang AND i.part = w.phrase AND i.f >= w.a WHERE i.part IS NULL)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""

# The test pages hold their article in one element of plain paragraphs; for those SQL can read it by pattern.
OP13 = r"""
WITH lines AS (
  SELECT page_id, url, unnest(list_append(regexp_split_to_array(
    regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '</?(?:p|h1)>'), '')) AS line,
    generate_subscripts(list_append(regexp_split_to_array(
    regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '</?(?:p|h1)>'), ''), 1) AS i
  FROM pages),
plain AS (
  SELECT page_id, url, i, trim(regexp_replace(regexp_replace(replace(replace(replace(
    regexp_replace(replace(line, '<br>', ' '), '<[^>]*>', '', 'g'),
    '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS line
  FROM lines),
joined AS (
  SELECT page_id, url, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (line <> ''), '') AS text
  FROM plain GROUP BY page_id, url)
SELECT page_id, url, text, length(text) AS n_chars FROM joined
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_suffix_array_decontamination": OP1,
        "op3_ngram_jaccard_join": OP3,
        "op4_url_rules": OP4,
        "op5_line_frequency": OP5,
        "op6_chat_format": OP6,
        "op9_license_dice": OP9,
        "op11_fill_in_middle": OP11,
        "op12_phrase_collocations": OP12,
        "op13_html_main_text": OP13,
    }
