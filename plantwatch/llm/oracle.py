"""SQL the numbered queries have to agree with, where SQL can express them."""

from __future__ import annotations

SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

LINES = f"""
WITH lines AS (
  SELECT doc_id, i, line, translate(trim(line, {SPACES}), {UPPER}, {LOWER}) AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
repeated AS (
  SELECT key, max(doc_id) AS holder FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT l.doc_id, l.i, l.line, r.key IS NOT NULL AND l.doc_id <> r.holder AS gone
  FROM lines l LEFT JOIN repeated r ON l.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


LEAKS = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i : i + m - 1], ' ') AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS m, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i
        FROM item_words WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT m FROM windows),
positions AS (
  SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS win
  FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM words, lengths WHERE len(w) >= m)),
met AS (SELECT a.doc_id, a.m, a.i, x.item_id FROM positions a JOIN windows x ON a.m = x.m AND a.win = x.win),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS p FROM (SELECT DISTINCT doc_id, m, i FROM met)) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
       sha256(coalesce(n.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit h ON w.doc_id = h.doc_id LEFT JOIN named n ON w.doc_id = n.doc_id
"""


REVISITS = """
WITH payloads AS (
  SELECT page_id, url, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) || '00' AS h FROM pages),
digested AS (
  SELECT page_id, url, html, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((CAST('0x' || substr(h, CAST(i * 5 // 4 + 1 AS BIGINT), 3) AS BIGINT) >> CAST(7 - i * 5 % 4 AS BIGINT)) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest
  FROM payloads),
holders AS (SELECT html, max(page_id) AS holder FROM digested GROUP BY html)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> holder THEN holder END AS refers_to, url, TRUE AS sound
FROM digested JOIN holders USING (html)
"""

LINKS = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(3, len(w)) - 1], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * n_both >= 90 * (x.n + y.n - n_both)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS met FROM documents UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON e.a = r.met)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, min(r.met)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reached r ON r.doc_id = d.doc_id GROUP BY d.doc_id, s.n
"""


def _turn_moves() -> str:
    """What can be done up to one row from each state: edits, roles reached, cost, next state."""
    due = {0: 2, 1: 2, 2: 3, 3: 2}
    kept = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
    rows = []
    for start in range(4):
        state, edits, reached = start, "", ""
        for inserts in range(3):
            for letter in range(4):
                for fault in range(3):
                    rows.append((start, letter, fault, edits + "D", reached + "-", 3 * inserts + 4, state))
                    if fault < 2:
                        rows.append((start, letter, fault, edits + "R", f"{reached}{due[state]}",
                                     3 * inserts + 3 + 3 * fault, due[state]))
                        if (state, letter) in kept:
                            after = kept[state, letter]
                            rows.append((start, letter, fault, edits + "K", f"{reached}{after}",
                                         3 * inserts + 3 * fault, after))
            state, edits, reached = due[state], edits + "I", f"{reached}{due[state]}"
    return ", ".join(str(r) for r in rows)


TURNS = rf"""
WITH RECURSIVE
crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
original AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
marked AS (
  SELECT o.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda ch: CAST(unicode(ch) AS BIGINT))),
                              lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS hit
  FROM original o, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN hit = 1 THEN '' WHEN hit = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(generate_series(1, CASE WHEN hit = 3 THEN 2 ELSE 1 END)) AS copy
  FROM marked WHERE hit <> 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) - 1 AS i FROM damaged),
faults AS (
  SELECT *, NOT regexp_matches(text, '[^ 	-
]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
         NOT regexp_matches(text, '[.!?][ 	-
]*\z') AS cut,
         lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM ordered),
judged AS (
  SELECT *, CASE WHEN blank OR seen THEN 2 WHEN cut THEN 1 ELSE 0 END AS fault,
         CASE left(role, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END AS letter FROM faults),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE seen AND NOT blank) AS duplicate,
         count(*) FILTER (WHERE cut AND NOT seen AND NOT blank) AS truncated,
         count(*) FILTER (WHERE i > 0 AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal,
         count(*) AS n FROM judged GROUP BY conv_id),
moves(q, letter, fault, edits, reached, cost, after) AS (VALUES {_turn_moves()}),
paths AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, CAST(0 AS BIGINT) AS cost, '' AS audit, '' AS reached FROM counted
  UNION ALL
  SELECT conv_id, i, q, cost, audit, reached FROM (
    SELECT p.conv_id, p.i + 1 AS i, m.after AS q, CAST(p.cost + m.cost AS BIGINT) AS cost, p.audit || m.edits AS audit,
           p.reached || m.reached AS reached,
           row_number() OVER (PARTITION BY p.conv_id, m.after ORDER BY p.cost + m.cost, p.audit || m.edits) AS place
    FROM paths p JOIN judged j ON p.conv_id IS NOT DISTINCT FROM j.conv_id AND p.i = j.i
    JOIN moves m ON m.q = p.q AND m.letter = j.letter AND m.fault = j.fault) WHERE place = 1),
ended AS (
  SELECT p.conv_id, p.cost + e.cost AS cost, p.audit || e.edits AS audit, p.reached || e.reached AS reached
  FROM paths p JOIN counted c ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.i = c.n
  JOIN (VALUES (0, 0, '', ''), (1, 6, 'II', '23'), (2, 3, 'I', '3'), (3, 0, '', '')) e(q, cost, edits, reached) ON e.q = p.q),
best AS (SELECT * FROM ended QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1),
steps AS (
  SELECT conv_id, audit, reached, unnest(generate_series(1, length(audit))) AS p FROM best),
repaired AS (
  SELECT s.conv_id, s.p, CASE WHEN substr(s.audit, s.p, 1) = 'K' THEN j.role WHEN substr(s.reached, s.p, 1) = '2' THEN 'user' ELSE 'assistant' END
         || ':' || CASE WHEN substr(s.audit, s.p, 1) = 'I' THEN '' ELSE j.text END AS line
  FROM steps s LEFT JOIN judged j ON s.conv_id IS NOT DISTINCT FROM j.conv_id AND substr(s.audit, s.p, 1) <> 'I'
       AND j.i = length(replace(left(s.audit, s.p - 1), 'I', ''))
  WHERE substr(s.audit, s.p, 1) <> 'D'),
texts AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY p) AS whole FROM repaired GROUP BY conv_id)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(b.cost, 0) AS cost,
       coalesce(b.audit, '') AS audit, sha256(coalesce(t.whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN texts t ON o.conv_id IS NOT DISTINCT FROM t.conv_id
"""


def llm_oracle() -> dict[str, str]:
    return {"op1_warc_revisits": REVISITS, "op10_ngram_join": LINKS, "op3_wu_manber": LEAKS, "op8_line_runs": LINES, "op12_astar_repair": TURNS}
