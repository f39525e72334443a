"""DuckDB SQL for the queries that SQL can express."""

EXACT_DEDUP = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept,
       text_sha256
FROM n WINDOW best AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY run) AS least FROM win)
  WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, (SELECT unnest(range(0, 13)) AS k)),
word AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word FROM w),
kept AS (
  SELECT word.doc_id, string_agg(word.word, ' ' ORDER BY word.i) AS kept, count(*) AS n
  FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i GROUP BY word.doc_id)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, (len(w.words) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

NGRAM_JOIN = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM s AS x JOIN s AS y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
link AS (
  SELECT a, b FROM pair JOIN n AS p ON p.doc_id = a JOIN n AS q ON q.doc_id = b
  WHERE 100 * common >= 75 * (p.n + q.n - common)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(doc_id, other) AS (
  SELECT DISTINCT a, a FROM edge
  UNION SELECT reach.doc_id, edge.b FROM reach JOIN edge ON edge.a = reach.other)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       coalesce(c.least, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id) AS c USING (doc_id)
"""

LINE_DEDUP = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(0, len(string_split(text, chr(10))))) AS i
  FROM documents WHERE text <> ''),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM line),
hit AS (
  SELECT *, (h + 31 * coalesce(lag(h) OVER w, 0)) % 4 = 0 AS hit, count(*) OVER (PARTITION BY doc_id) AS n
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
run AS (  -- where the run of neighbouring hits begins
  SELECT *, max(i) FILTER (hit AND NOT before) OVER (PARTITION BY doc_id ORDER BY i) AS s
  FROM (SELECT *, coalesce(lag(hit) OVER (PARTITION BY doc_id ORDER BY i), false) AS before FROM hit)),
cut AS (  -- chunks of two lines at least: every other hit of a run ends one, of a text's first lines from the second on
  SELECT *, hit AND (i - s) % 2 = (s = 0)::INT AND i <> n - 2 AS ends FROM run),
placed AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM cut),
chunk AS (
  SELECT doc_id, place, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body FROM placed GROUP BY doc_id, place),
judged AS (
  SELECT *, n > 1 AND row_number() OVER (PARTITION BY body, n > 1 ORDER BY doc_id, place) > 1 AS gone FROM chunk),
kept AS (
  SELECT doc_id, sum(n)::BIGINT AS n_lines, coalesce(sum(n) FILTER (gone), 0)::BIGINT AS n_removed,
         coalesce(string_agg(body, chr(10) ORDER BY place) FILTER (NOT gone), '') AS body
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM documents AS d LEFT JOIN kept USING (doc_id)
"""

WARC = r"""
WITH page AS (
  SELECT page_id, regexp_replace(url, '[\r\n]+', ' ', 'g') AS url, coalesce(html, '') AS html FROM pages),
source AS (
  SELECT *, md5('response' || chr(10) || page_id::VARCHAR || coalesce(chr(10) || url, '')) AS m FROM page),
named AS (
  SELECT *, '<urn:uuid:' || substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' ||
         substr(m, 17, 4) || '-' || substr(m, 21, 12) || '>' AS source_id FROM source),
plain AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(html,
           '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'),
           '(?i)\s*</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|'
           || 'head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)'
           || '\b[^>]*>\s*', chr(10), 'g'),
           '<[a-zA-Z/!?][^>]*>', '', 'g') AS body FROM named),
resolved AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(body,
           '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&apos;', chr(39)),
           '&copy;', '©'), '&middot;', '·'), '&mdash;', '—'), '&ndash;', '–'), '&hellip;', '…'), '&amp;', '&') AS words
  FROM plain),
block AS (
  SELECT page_id, url, html, source_id, 'conversion' AS record_type, 'text/plain; charset=utf-8' AS content_type,
         regexp_replace(regexp_replace(words, '[ \t\r\f]*\n\s*', chr(10), 'g'), '\A\s+|\s+\z', '', 'g') AS block
  FROM resolved
  UNION ALL
  SELECT page_id, url, html, source_id, 'metadata', 'application/warc-fields',
         concat_ws(chr(13) || chr(10), 'http-status: 200', 'http-header-Content-Type: text/html; charset=utf-8',
           'http-header-Content-Length: ' || strlen(html),
           'title: ' || trim(regexp_extract(html, '(?is)<title[^>]*>([^<]*)', 1), ' '),
           CASE WHEN len(links) > 0
                THEN array_to_string(list_transform(links, lambda x: 'outlink: ' || x), chr(13) || chr(10)) END)
  FROM (SELECT *, regexp_extract_all(html, '(?i)<a\b[^>]*?\bhref="([^"]*)"', 1) AS links FROM named)),
made AS (SELECT *, md5(record_type || chr(10) || source_id) AS d FROM block)
SELECT page_id, record_type,
       '<urn:uuid:' || substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-' || substr(d, 13, 4) || '-' ||
       substr(d, 17, 4) || '-' || substr(d, 21, 12) || '>' AS record_id,
       source_id AS refers_to, url AS target_uri, '2024-01-01T00:00:00Z' AS date, content_type,
       strlen(block) AS content_length, 'sha256:' || sha256(block) AS block_digest,
       'sha256:' || sha256(html) AS payload_digest, block
FROM made
"""

HARD_NEGATIVES = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.vec, b.vec)::BIGINT AS score
  FROM v AS a JOIN v AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN pair USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""

COLLOCATIONS = r"""
WITH piece AS (
  SELECT lang, i, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS i,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents)),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM piece),
gram AS (
  SELECT lang, m AS size, array_to_string(words[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i
        FROM w, (SELECT unnest([1, 2, 3]) AS m) WHERE len(words) >= m)),
f AS (SELECT lang, size, phrase, count(*) AS n FROM gram GROUP BY lang, size, phrase),
found AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND n >= 10),
cut AS (
  SELECT c.lang, c.phrase, c.a, c.k, h.n AS l, t.n AS r,
         (1000000::HUGEINT * c.a * c.a) // (h.n::HUGEINT * t.n) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM found) AS c
  JOIN f AS h ON h.lang = c.lang AND h.phrase = array_to_string(c.words[1:c.k], ' ')
  JOIN f AS t ON t.lang = c.lang AND t.phrase = array_to_string(c.words[c.k + 1:], ' ')),
least AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (
  SELECT lang, array_to_string(words[i:i + 1], ' ') AS phrase, max(a) AS longer
  FROM found, (SELECT unnest([1, 2]) AS i) WHERE size = 3 GROUP BY ALL),
kept AS (
  SELECT least.* FROM least LEFT JOIN around USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       score::BIGINT AS score
FROM kept JOIN total USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""

ORACLE = {
    "op2_ngram_join": NGRAM_JOIN,
    "op4_exact_dedup": EXACT_DEDUP,
    "op6_warc_derivatives": WARC,
    "op7_line_dedup": LINE_DEDUP,
    "op9_substring_dedup": SUBSTRING_DEDUP,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_collocations": COLLOCATIONS,
}
