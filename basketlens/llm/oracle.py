"""DuckDB SQL for the operators whose results SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"
_SPACE = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))

QUALITY = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, regexp_extract_all(t, '{_WORD}') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM d),
windows AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
again AS (SELECT doc_id, a, b, c FROM windows GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n
            FROM windows JOIN again USING (doc_id, a, b, c), range(3) AS r(k) GROUP BY doc_id),
counts AS (
  SELECT doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         len(lines) AS n_lines
  FROM w LEFT JOIN covered USING (doc_id)),
flags AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_symbols > greatest(n_words, 1) OR (n_dup_lines > 0.6 * greatest(n_lines, 1) AND n_dup_lines >= 5)
           OR word_chars > 25 * greatest(n_words, 1) AS severe,
         n_symbols > 0.1 * greatest(n_words, 1) OR (n_dup_lines > 0.4 * greatest(n_lines, 1) AND n_dup_lines >= 5)
           OR word_chars > 15 * greatest(n_words, 1) AS weak
  FROM counts),
hosts AS (
  SELECT source, count(*)::DOUBLE AS n,
         count(*) FILTER (WHERE severe OR weak)::DOUBLE AS f FROM flags GROUP BY source),
moments AS (SELECT m, greatest(s - m * m, 0) AS v
            FROM (SELECT sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) AS s FROM hosts)),
prior AS (SELECT m, CASE WHEN v > 1e-12 THEN greatest(m * (1 - m) / v - 1, 1) ELSE 1e9 END AS strength FROM moments),
rates AS (SELECT source, (f + strength * m) / (n + strength)
                 > m + greatest(0.5 * sqrt(m * (1 - m) / (strength + 1)), 1e-6) AS bad FROM hosts, prior)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT severe AND weak AS by_host,
       NOT base_failed AND NOT (severe OR (weak AND bad)) AS kept
FROM flags f JOIN rates r ON f.source IS NOT DISTINCT FROM r.source
"""

LINES = f"""
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line FROM l),
keyed AS (SELECT *, translate(trim(line, {_SPACE}), '{_UPPER}', '{_LOWER}') AS key FROM lines),
frequent AS (SELECT key FROM (SELECT DISTINCT doc_id, key FROM keyed WHERE key <> '')
             GROUP BY key HAVING count(*) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key GROUP BY doc_id
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM w
  UNION SELECT r.doc_id, e.b FROM reach r JOIN sides e ON e.a = r.other)
SELECT w.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id,
       w.doc_id = min(other) AS kept
FROM w LEFT JOIN sizes USING (doc_id) JOIN reach USING (doc_id) GROUP BY w.doc_id
"""

# one table entry per byte value, by the rule of the reversed polynomial 0xEDB88320
SPELLING = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_concat([b], range(8)),
                          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS t
  FROM range(256) r(b)),
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run
        FROM documents)
  GROUP BY ALL HAVING length(run) >= 6),
bytes AS (
  SELECT doc_id, run, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
    lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c)::BIGINT - 64] END)) AS b
  FROM runs),
hashes AS (
  SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], b),
    lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]))) AS h
  FROM bytes, crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT)
                      || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM hashes)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
masked AS (SELECT word, n, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS m FROM places),
shorter AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS m FROM places),
near AS (
  SELECT a.word, b.word AS near, b.n FROM masked a JOIN masked b ON a.m = b.m AND a.word <> b.word
  UNION ALL SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.m = w.word
  UNION ALL SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.m = w.word),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS r,
                  count(*) OVER (PARTITION BY word) AS n_near FROM near),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN r.n >= 5 * w.n THEN near END AS form,
         CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM ranked WHERE r = 1) r ON r.word = w.word),
ways(word, place, form) AS (
  SELECT word, word, form FROM forms
  UNION ALL SELECT y.word, y.form, f.form FROM ways y JOIN forms f ON f.word = y.form)
SELECT f.word, f.form, place AS root, n, n_near, form_n FROM forms f JOIN ways y ON y.word = f.word AND y.form IS NULL
"""

DIVERGENCE = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t, coalesce(lang, '') AS lang,
         coalesce(source, '') AS source FROM documents),
found AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM found GROUP BY ALL HAVING count(DISTINCT id) >= 10),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY ALL),
shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(n, 0) + 2) // (coalesce(total, 0) + 2 * v) AS p,
         1 + 1000000000::HUGEINT * (lang_n + 2) // (lang_total + 2 * v) AS q
  FROM groups JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN totals USING (lang, source)
       LEFT JOIN counts USING (lang, source, term)),
gaps AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source),
terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT lang, source, 'pair' AS part, item, value FROM pairs
        UNION ALL SELECT lang, source, 'term', item, value FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLE_SQL = {"op2_near_duplicates": NEAR_DUPLICATES, "op5_quality_rules": QUALITY, "op8_line_dedup": LINES,
              "op12_spelling_variants": SPELLING, "op13_source_divergence": DIVERGENCE}
