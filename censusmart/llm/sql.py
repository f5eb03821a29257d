"""DuckDB statements with the same results as the queries, where SQL can express them."""

from __future__ import annotations

from censusmart.llm.licenses import TEMPLATES

MIXING = r"""
WITH items AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5('mix#' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15))::BIGINT AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS no
  FROM items GROUP BY source),
weighted AS (SELECT *, no % 3 + 1 AS weight, 3 * source_size AS most FROM sources),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS budget,
         CAST(sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY most / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighted),
targets AS (
  SELECT *, CASE WHEN most / weight <= level THEN CAST(most AS DOUBLE)
                 ELSE weight * (SELECT arg_min(level, most / weight) FROM levels WHERE NOT most / weight <= level) END AS target
  FROM levels),
queued AS (
  SELECT i.doc_id, i.size, i.key, t.no, t.source_size, t.target, t.budget,
         sum(i.size) OVER (PARTITION BY t.no ORDER BY i.key, i.doc_id ROWS UNBOUNDED PRECEDING) AS sent
  FROM items i JOIN targets t ON i.source IS NOT DISTINCT FROM t.source),
passes AS (
  SELECT *, CASE WHEN target > 0 THEN CAST(p * source_size + sent AS DOUBLE) / target ELSE 0 END AS finish
  FROM queued, (VALUES (0), (1), (2)) v(p)
  WHERE p <= CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END),
running AS (SELECT *, sum(size) OVER (ORDER BY finish, key, doc_id ROWS UNBOUNDED PRECEDING) AS total FROM passes),
taken AS (SELECT doc_id, count(*) AS n FROM running WHERE total <= budget GROUP BY doc_id)
SELECT q.doc_id, CAST(q.size AS BIGINT) AS size, q.source_size, q.target, CAST(q.size * coalesce(t.n, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN taken t ON q.doc_id IS NOT DISTINCT FROM t.doc_id
"""

WARC = """
WITH own AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
marked AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS response FROM own)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM marked
"""

CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
            + len(regexp_extract_all(text, '<s>|</s>|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|\[ANSWER\]|\[ROLE\]|\[SAYS\]|\[/ROLE\]')) AS inside
  FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(inside + CASE role WHEN 'system' THEN 7 + 8 + 2 WHEN 'user' THEN 6 + 7 + 2 WHEN 'assistant' THEN 8 + 4 + 2 ELSE NULL END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def licenses_sql(templates) -> str:
    """The scan of all blocks by all templates, by list intersection."""
    def texts(words) -> str:
        return "[" + ", ".join("'" + w.decode() + "'" for w in words) + "]"

    values = ",\n         ".join(f"('{t.label}', {t.exact}, {t.width}, {t.needed}, {texts(t.words)})" for t in templates)
    return rf"""
WITH templates AS (
  SELECT *, list_distinct(words) AS members FROM (VALUES
         {values}) v(label, exact, width, needed, words)),
docs AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
blocks AS (
  SELECT row, width, block * width // 2 AS start, words[block * width // 2 + 1 : block * width // 2 + width] AS block
  FROM (SELECT row, words, width, unnest(range((len(words) + width // 2 - 1) // (width // 2))) AS block
        FROM docs, (SELECT DISTINCT width FROM templates))),
shared AS (
  SELECT b.row, b.start, t.label, t.exact, t.needed, len(list_intersect(b.block, t.members)) AS shared, len(t.members) AS size,
         CASE WHEN t.exact THEN list_filter(range(t.width // 2), lambda i: b.block[i + 1 : i + len(t.words)] = t.words) ELSE [] END AS places
  FROM blocks b JOIN templates t USING (width)),
found AS (
  SELECT *, list_transform(places, lambda p: p + start) AS spots FROM shared WHERE shared >= needed AND (NOT exact OR len(places) > 0)),
per_row AS (
  SELECT row, sum(len(spots)) AS n_base, min(list_min(spots)) AS first_word, max(list_max(spots)) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
         max(shared / size) AS score
  FROM found GROUP BY row)
SELECT doc_id, len(words) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM docs LEFT JOIN per_row USING (row)
"""


SPELLING = r"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') AS id, unnest(regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
  FROM documents),
distinct_runs AS (SELECT id, run, count(*) AS n FROM runs GROUP BY id, run),
crc_table AS (
  SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS crc FROM range(256) r(i)),
crc_list AS (SELECT list(crc ORDER BY i) AS crcs FROM crc_table),
hashed AS (
  SELECT id, run, n, xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(id || ':' || run, ''),
         lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END))),
         lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]))) AS h
  FROM distinct_runs, crc_list),
dropped AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM dropped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
deletions AS (
  SELECT word, length(word) AS size, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM deletions a JOIN deletions b ON a.rest = b.rest AND a.i = b.i AND a.size = b.size AND a.word <> b.word
  UNION SELECT d.word, w.word FROM deletions d JOIN words w ON d.rest = w.word
  UNION SELECT w.word, d.word FROM deletions d JOIN words w ON d.rest = w.word),
best AS (
  SELECT word, other, n, row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS nth, count(*) OVER (PARTITION BY word) AS n_near
  FROM (SELECT near.word, other, words.n FROM near JOIN words ON words.word = near.other)),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.n >= 2 * w.n THEN b.other END AS form, CASE WHEN b.n >= 2 * w.n THEN b.n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND b.nth = 1),
ways AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT ways.word, forms.form FROM ways JOIN forms ON forms.word = ways.at WHERE forms.form IS NOT NULL),
roots AS (SELECT ways.word, ways.at AS root FROM ways JOIN forms ON forms.word = ways.at WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM worded GROUP BY lang),
counted AS (
  SELECT lang, phrase, count(*) AS a FROM (
    SELECT lang, words[i : i + size - 1] AS phrase FROM (
      SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM worded, range(1, 5) s(size))) GROUP BY lang, phrase),
frequent AS (SELECT * FROM counted WHERE a >= 30),
candidates AS (SELECT * FROM frequent WHERE len(phrase) > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, CAST(2000000::HUGEINT * c.a // (l.a + r.a) AS BIGINT) AS score
  FROM (SELECT lang, phrase, a, unnest(range(1, len(phrase))) AS k FROM candidates) c
  JOIN frequent l ON l.lang = c.lang AND l.phrase = c.phrase[1 : c.k] JOIN frequent r ON r.lang = c.lang AND r.phrase = c.phrase[c.k + 1 :]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, a, phrase[i : i + size - 1] AS part FROM (
    SELECT lang, a, phrase, size, unnest(range(1, len(phrase) - size + 2)) AS i FROM candidates, range(2, 4) s(size) WHERE size < len(phrase))),
around AS (SELECT lang, part, max(a) AS more FROM inner_parts GROUP BY lang, part),
ranked AS (
  SELECT c.lang, array_to_string(c.phrase, ' ') AS phrase, c.a, l, r, score,
         row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, c.a DESC, array_to_string(c.phrase, ' ')) AS rank
  FROM lowest c LEFT JOIN around o ON o.lang = c.lang AND o.part = c.phrase
  WHERE o.more IS NULL OR 100 * o.more < 80 * c.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

SQL = {"op1_mixing": MIXING, "op4_warc": WARC, "op5_chat": CHAT, "op11_licenses": licenses_sql(TEMPLATES), "op12_spelling": SPELLING,
       "op13_collocations": COLLOCATIONS}
