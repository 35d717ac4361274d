"""DuckDB SQL for the queries of this subpackage that SQL can express, written from the definitions, not from the operators."""

OP11_SOURCE_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
groups AS (SELECT DISTINCT lang, source FROM docs),
tokens AS (SELECT r, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM tokens GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
cnt AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM tokens t JOIN kept k ON t.lang = k.lang AND t.term = k.term GROUP BY ALL),
lang_size AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
size AS (SELECT g.lang, g.source, coalesce(max(l.v), 0) AS v, coalesce(sum(c.n), 0) AS n
         FROM groups g LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source LEFT JOIN lang_size l ON l.lang = g.lang GROUP BY ALL),
dense AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, k.total,
                 (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.n + s.v))::HUGEINT AS p
          FROM size s JOIN kept k ON k.lang = s.lang LEFT JOIN cnt c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
         FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every_pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(p.value, 0) AS value
               FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
term AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value
         FROM (SELECT d.*, (1 + (1000000000::HUGEINT * (d.total + 1)) // (l.n + l.v))::HUGEINT AS q FROM dense d JOIN lang_size l ON l.lang = d.lang WHERE d.n > 0)
         WHERE p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM every_pair
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM term
  QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= 200)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
"""

OP12_QUALITY_RULES = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM docs),
size AS (SELECT r, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars FROM words),
word AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM words),
runs AS (SELECT r, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS run
         FROM word WINDOW o AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i FROM runs WHERE run IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, run) >= 2),
inside AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS j FROM again) GROUP BY r),
line AS (SELECT r, source, text, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n,
                array_to_string(regexp_extract_all(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' ') AS norm
         FROM (SELECT r, source, text, unnest(string_split(text, chr(10))) AS x FROM docs)
         WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
hosts AS (SELECT source, count(DISTINCT text) AS docs FROM line GROUP BY source),
common AS (SELECT l.source, l.norm FROM line l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
           GROUP BY l.source, l.norm, h.docs
           HAVING count(DISTINCT l.text) > 10 AND 10000 * count(DISTINCT l.text) > 5 * h.docs),
lost AS (SELECT l.r, count(*) AS n_removed_lines, sum(l.n) AS n_removed_words
         FROM line l JOIN common c ON l.source IS NOT DISTINCT FROM c.source AND l.norm = c.norm GROUP BY l.r),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines FROM line GROUP BY r),
every AS (SELECT d.doc_id, s.n_words, s.word_chars, len(regexp_extract_all(d.text, '[#*$%&|<>]')) AS n_symbols, coalesce(l.n_dup_lines, 0) AS n_dup_lines,
                 coalesce(i.n_repeat_words, 0) AS n_repeat_words, coalesce(l.n_lines, 0) AS n_lines,
                 coalesce(x.n_removed_lines, 0) AS n_removed_lines, coalesce(x.n_removed_words, 0) AS n_removed_words
          FROM docs d JOIN size s USING (r) LEFT JOIN lines l USING (r) LEFT JOIN inside i USING (r) LEFT JOIN lost x USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, n_lines::BIGINT AS n_lines, n_removed_lines::BIGINT AS n_removed_lines, n_removed_words::BIGINT AS n_removed_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
       AND NOT (100 * (n_words - n_removed_words) < 50 * n_words OR n_words - n_removed_words < 10) AS kept
FROM every
"""

OP13_SPELLING_VARIANTS = r"""
WITH crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS i)),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[a-z\x{C0}-\x{FF}]+')) AS run
  FROM documents),
each AS (SELECT id, run, count(*) AS times FROM runs GROUP BY ALL),
hexed AS (SELECT id, run, times, hex(encode(id || ':' || run)) AS x FROM each),
bytes AS (SELECT id, run, times, list_prepend(4294967295::BIGINT, list_transform(range(len(x) // 2), lambda k: ('0x' || substr(x, 2 * k + 1, 2))::BIGINT)) AS b FROM hexed),
crc AS (SELECT id, run, times, xor(list_reduce(b, lambda c, y: xor(t[xor(c % 256, y) + 1], c // 256)), 4294967295) AS h FROM bytes, crc_table),
noisy AS (SELECT times, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM crc),
words AS (SELECT word, sum(times)::BIGINT AS n, length(word) AS l FROM noisy GROUP BY word HAVING length(word) >= 5 AND sum(times) >= 3),
cut AS (SELECT word, n, l, unnest(range(1, l + 1)) AS k FROM words),
less AS (SELECT word, n, l, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest FROM cut),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.k = b.k AND a.rest = b.rest AND a.l = b.l AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS top FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.top >= 2 * w.n THEN (SELECT min(x.other) FROM near x WHERE x.word = w.word AND x.other_n = b.top) END AS form,
         CASE WHEN b.top >= 2 * w.n THEN b.top END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (
  WITH RECURSIVE c(word, last, next) AS (
    SELECT word, word, form FROM formed
    UNION ALL SELECT c.word, f.word, f.form FROM c JOIN formed f ON f.word = c.next)
  SELECT word, last AS root FROM c WHERE next IS NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n FROM formed f JOIN chain c ON c.word = f.word
"""
