"""SQL twins of the registered queries that SQL can express, for small tables."""

from __future__ import annotations

from rimline.llm.near import WORDS

SPACE = r"[ \t\n\r\f\v]"

NEAR = f"""
WITH RECURSIVE parted AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r\\f\\v]+') AS words
  FROM documents WHERE doc_id IS NOT NULL),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + least({WORDS}, len(words)) - 1], ' ') AS gram
  FROM parted, unnest(range(1, greatest(len(words) - {WORDS - 1}, 1) + 1)) AS places(i) WHERE len(words) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y, c = sx.n AND c = sy.n AS same
  FROM common JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y
  WHERE 5 * c >= 4 * (sx.n + sy.n - c)),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM parted UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other),
classes AS (SELECT doc_id, min(other) AS class_id FROM reached GROUP BY doc_id)
SELECT p.doc_id, least(p.doc_id, coalesce(min(y) FILTER (same), p.doc_id)) AS rep_id, 1 + count(y) FILTER (same) AS copies,
       any_value(class_id) AS class_id, count(y) AS n_links
FROM parted p JOIN classes USING (doc_id) LEFT JOIN links ON x = p.doc_id GROUP BY p.doc_id"""

# A line is cut after words that end in a full stop, question or exclamation mark; the pieces make up the line.
PIECE = r"[ \t\r\f\v]*(?:[.!?](?:[ \t\r\f\v]+|$)|[^ \t\r\f\v].*?(?:[.!?](?:[ \t\r\f\v]+|$)|$))"

LINES = f"""
WITH listed AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
each_line AS (
  SELECT doc_id, i, lines[i] AS line, regexp_extract_all(lines[i], '{PIECE}') AS pieces
  FROM listed, unnest(range(1, len(lines) + 1)) AS places(i)),
pieces AS (
  SELECT doc_id, i, p, pieces[p] AS piece, len(regexp_extract_all(pieces[p], '[^ \\t\\n\\r\\f\\v]+')) AS words
  FROM each_line, unnest(range(1, len(pieces) + 1)) AS places(p)),
units AS (
  SELECT *, row_number() OVER before AS k, sum(words) OVER before AS ends, sum(words) OVER before - words AS starts,
         regexp_replace(piece, '^{SPACE}+|{SPACE}+$', '', 'g') AS trimmed
  FROM pieces WINDOW before AS (PARTITION BY doc_id ORDER BY i, p)),
reaching AS (
  SELECT a.doc_id, a.k AS f, b.k AS l FROM units a JOIN units b
  ON a.doc_id = b.doc_id AND b.k >= a.k AND b.k < a.k + 30 AND b.ends - a.starts >= 30),
spans AS (
  SELECT doc_id, f, min(l) AS l, false AS short FROM reaching GROUP BY doc_id, f
  UNION
  SELECT doc_id, max(f), l, false FROM reaching GROUP BY doc_id, l
  UNION
  SELECT doc_id, min(k), max(k), true FROM units GROUP BY doc_id, i HAVING sum(words) BETWEEN 5 AND 29),
whole AS (SELECT doc_id, list(trimmed ORDER BY k) AS texts FROM units GROUP BY doc_id),
runs AS (
  SELECT doc_id, f, l, short, array_to_string(texts[f:l], chr(10)) AS run FROM spans JOIN whole USING (doc_id)),
earliest AS (SELECT run, min((doc_id, f, l)) AS e, max(doc_id) AS most FROM runs GROUP BY run),
later AS (
  SELECT doc_id, f, l FROM runs JOIN earliest USING (run)
  WHERE (NOT short OR e[1] < most) AND (doc_id <> e[1] OR f > e[3])),
gone AS (SELECT DISTINCT doc_id, unnest(range(f, l + 1)) AS k FROM later),
left_lines AS (
  SELECT u.doc_id, i, string_agg(piece, '' ORDER BY p) FILTER (g.k IS NULL) AS line,
         coalesce(sum(words) FILTER (g.k IS NOT NULL), 0) AS cut
  FROM units u LEFT JOIN gone g ON g.doc_id = u.doc_id AND g.k = u.k GROUP BY u.doc_id, i),
judged AS (
  SELECT doc_id, i, CASE WHEN len(pieces) = 0 THEN e.line ELSE l.line END AS line, coalesce(cut, 0) AS cut
  FROM each_line e LEFT JOIN left_lines l USING (doc_id, i))
SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(string_agg(line, chr(10) ORDER BY i), '') END AS text,
       count(i) AS n_lines, count(i) - count(line) AS n_cut_lines, CAST(coalesce(sum(cut), 0) AS BIGINT) AS n_cut_words
FROM documents t LEFT JOIN judged USING (doc_id) GROUP BY doc_id, t.text"""

ORACLE = {
    "op2_winnowed_lines": LINES,
    "op10_ngram_jaccard_join": NEAR,
}
