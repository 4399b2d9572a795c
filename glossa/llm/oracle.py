"""DuckDB SQL for the queries that SQL can express, written from their contracts.

The others are tested against brute-force versions in tests/llm.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"

#: Every shingle of every text, likeness of all pairs of different sets that share one, and the closure of the links.
_OP1 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
s AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) >= 5 THEN [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]
                                              WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS sh FROM w),
shown AS (SELECT sh, min(doc_id) AS rep, len(sh) AS n FROM s WHERE len(sh) > 0 GROUP BY sh),
each AS (SELECT rep, n, unnest(sh) AS x FROM shown),
near AS (
  SELECT a.rep AS a, b.rep AS b FROM each a JOIN each b ON a.x = b.x AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
link AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach(a, b) AS (SELECT rep, rep FROM shown UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
least AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(least.component_id, s.doc_id) AS component_id,
  s.doc_id = coalesce(least.component_id, s.doc_id) AS kept
FROM s LEFT JOIN shown ON shown.sh = s.sh LEFT JOIN least ON least.rep = shown.rep"""

#: Every window of every text with the least document that holds it, and the words under the repeated ones.
_OP9 = f"""
WITH w AS (SELECT doc_id, {_WORDS.format(text="text")} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
source AS (SELECT k, min(doc_id) AS least FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM win JOIN source USING (k), range(13) t(j) WHERE least < doc_id),
word AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


_BREAKS = ("address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h1|h2|h3|h4|h5|h6|header|hr|html|li|main"
           "|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul")

_OP7 = rf"""
WITH page AS (
  SELECT row_number() OVER () AS rid, page_id,
    lower(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '')) AS host,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '<!--.*?-->', chr(10), 'gs'),
      '<script\b.*?</script\s*>', chr(10), 'gsi'), '<style\b.*?</style\s*>', chr(10), 'gsi'), '<head\b.*?</head\s*>', chr(10), 'gsi') AS shown
  FROM pages),
line AS (
  SELECT rid, host, pos, trim(regexp_replace(piece, '[\x20\x09\x0B\x0C\x0D]+', ' ', 'g'), ' ') AS line
  FROM (SELECT rid, host, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS pos
        FROM (SELECT rid, host, string_split(regexp_replace(regexp_replace(shown, '</?({_BREAKS})\b[^>]*>', chr(10), 'gi'), '<[^>]*>', '', 'g'), chr(10)) AS pieces FROM page))),
shown_line AS (SELECT * FROM line WHERE line <> ''),
boiler AS (
  SELECT host, line FROM shown_line JOIN (SELECT host, count(*) AS total FROM page GROUP BY host) USING (host)
  GROUP BY host, line, total HAVING count(DISTINCT rid) >= 3 AND count(DISTINCT rid) > 0.3 * total),
marked AS (
  SELECT l.*, EXISTS (SELECT 1 FROM boiler b WHERE b.host = l.host AND b.line = l.line) AS gone FROM shown_line l)
SELECT any_value(p.page_id) AS page_id, any_value(p.host) AS host, count(m.line) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  coalesce(string_agg(m.line, chr(10) ORDER BY m.pos) FILTER (NOT gone), '') AS text
FROM page p LEFT JOIN marked m ON m.rid = p.rid GROUP BY p.rid"""

#: Counts of every text, its words under windows found twice in it, and whether a window of 50 words is.
_OP11 = rf"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS.format(text="text")} AS ws FROM documents),
win AS (SELECT rid, m, i, array_to_string(ws[i:i + m - 1], ' ') AS k
        FROM (SELECT rid, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, (VALUES (3), (5), (50)) v(m))),
again AS (SELECT rid, m, k FROM win GROUP BY rid, m, k HAVING count(*) > 1),
under AS (SELECT rid, m, count(DISTINCT i + j) AS n FROM win JOIN again USING (rid, m, k), range(50) t(j) WHERE j < m GROUP BY rid, m),
line AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM w),
dup AS (SELECT rid, sum(n - 1) AS n FROM (SELECT rid, line, count(*) AS n FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid, line) GROUP BY rid),
c AS (SELECT w.rid, doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
        coalesce(max(under.n) FILTER (m = 3), 0) AS n_repeat_words, coalesce(max(under.n) FILTER (m = 5), 0) AS covered_words,
        count(*) FILTER (m = 50) > 0 AS long_repeat
      FROM w LEFT JOIN dup USING (rid) LEFT JOIN under USING (rid) GROUP BY w.rid, doc_id, ws, text, dup.n),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words, base_failed,
  NOT base_failed AND 100 * covered_words <= 30 * n_words AND NOT long_repeat AS kept FROM j"""

_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

#: Every document that holds a term of an item is scored.
_OP12 = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
p AS (SELECT doc_id, t, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS t FROM d) GROUP BY doc_id, t),
s AS (SELECT count(*) AS big_n, CAST(sum(len(ts)) AS BIGINT) AS l FROM d WHERE len(ts) > 0),
w AS (SELECT t, CAST(floor(1000 * ln((2 * (SELECT big_n FROM s) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p GROUP BY t),
q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY item_id, t),
scored AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // l)))) AS BIGINT) AS score
           FROM q JOIN w USING (t) JOIN p USING (t), s GROUP BY item_id, doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""

ORACLE_SQL: dict[str, str] = {"op1_minhash_dedup": _OP1, "op7_site_lines": _OP7, "op9_substring_dedup": _OP9, "op11_quality_rules": _OP11,
                              "op12_lexical_search": _OP12}
