"""DuckDB SQL of the operators' queries, where SQL can express them on whole tables."""

from __future__ import annotations

SPACED = r"[^\x20\x09-\x0D]+"
ALPHANUMERIC = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text: str) -> str:
    """A-Z only."""
    upper = "".join(map(chr, range(65, 91)))
    return f"translate({text}, '{upper}', '{upper.lower()}')"


def words(table: str, id: str, text: str, pattern: str) -> str:
    """A row for each word of each text: id, place i from 1 on, word, number of words n."""
    return f"""SELECT {id}, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word, len(w) AS n
FROM (SELECT {id}, regexp_extract_all(coalesce({text}, ''), '{pattern}') AS w FROM {table})"""


def frames(source: str, id: str, size: int) -> str:
    """A row for each window of ``size`` words: id, first place i, its words."""
    return f"""SELECT {id}, i, words FROM (SELECT {id}, i, n, string_agg(word, ' ') OVER (PARTITION BY {id} ORDER BY i
    ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING) AS words FROM {source}) WHERE i + {size - 1} <= n"""


OP2 = f"""WITH w AS ({words('documents', 'doc_id', 'text', SPACED)}),
f AS ({frames('w', 'doc_id', 35)}),
again AS (SELECT doc_id, i FROM f WHERE words IN (SELECT words FROM f GROUP BY words HAVING count(*) > 1)),
marked AS (SELECT w.doc_id, w.i, w.word, max(again.i) OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
           FROM w LEFT JOIN again ON again.doc_id = w.doc_id AND again.i = w.i)
SELECT d.doc_id, count(m.i) AS n_words, count(m.i) FILTER (m.gone) AS n_removed,
  sha256(coalesce(string_agg(m.word, ' ' ORDER BY m.i) FILTER (NOT m.gone), '')) AS kept_sha256
FROM documents d LEFT JOIN marked m ON m.doc_id = d.doc_id GROUP BY d.doc_id"""

OP6 = f"""WITH w AS ({words('documents', 'doc_id', 'text', SPACED)}),
f AS ({frames('w', 'doc_id', 5)}),
again AS (SELECT f.doc_id, f.i FROM f JOIN (SELECT doc_id, words FROM f GROUP BY ALL HAVING count(*) > 1) g ON g.doc_id = f.doc_id AND g.words = f.words),
marked AS (SELECT w.*, max(again.i) OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) IS NOT NULL AS twice
           FROM w LEFT JOIN again ON again.doc_id = w.doc_id AND again.i = w.i),
byword AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars, sum(strlen(word)) AS word_bytes, count(*) FILTER (twice) AS n_repeat_words,
             count(*) FILTER (regexp_matches(word, '[A-Za-z\\x{{80}}-\\x{{10FFFF}}]')) AS lettered FROM marked GROUP BY doc_id),
common AS (SELECT doc_id, max(c) AS most FROM (SELECT doc_id, word, count(*) AS c FROM w GROUP BY ALL) GROUP BY doc_id),
lines AS (SELECT doc_id, sum(c) AS n_lines, sum(c - 1) AS n_dup_lines FROM (
            SELECT doc_id, line, count(*) AS c FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
            WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY ALL) GROUP BY doc_id),
base AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(lettered, 0) AS lettered,
           coalesce(word_bytes, 0) AS word_bytes, coalesce(most, 0) AS most,
           length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS upper, length(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) AS ascii
         FROM documents d LEFT JOIN byword USING (doc_id) LEFT JOIN common USING (doc_id) LEFT JOIN lines USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR 2 * lettered < n_words
       OR 2 * upper > ascii OR word_bytes > 30 * n_words OR 2 * word_bytes < 3 * n_words OR 3 * most > n_words) AS kept
FROM base"""

OP7 = f"""WITH RECURSIVE w AS ({words('documents', 'doc_id', lower('text'), SPACED)}),
s AS (SELECT DISTINCT doc_id, words FROM ({frames('w', 'doc_id', 5)})
      UNION ALL SELECT doc_id, string_agg(word, ' ' ORDER BY i) FROM w WHERE n < 5 GROUP BY doc_id),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.words = y.words AND x.doc_id <> y.doc_id GROUP BY ALL)
         JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, link.b FROM reach r JOIN link ON link.a = r.other)
SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles, least.component_id FROM documents d LEFT JOIN size ON size.doc_id = d.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) least ON least.doc_id = d.doc_id"""

_SHORT = " UNION ALL ".join(f"SELECT doc_id, i, {k} AS size, words FROM ({frames('w', 'doc_id', k)}) WHERE {k} IN (SELECT size FROM item)" for k in range(1, 11))
OP9 = f"""WITH w AS MATERIALIZED ({words('documents', 'doc_id', lower('text'), ALPHANUMERIC)}),
b AS ({words('benchmark', 'item_id', lower('text'), ALPHANUMERIC)}),
item AS (SELECT DISTINCT item_id, 10 AS size, words FROM ({frames('b', 'item_id', 10)})
         UNION ALL SELECT item_id, any_value(n) AS size, string_agg(word, ' ' ORDER BY i) FROM b WHERE n < 10 GROUP BY item_id),
hit AS (SELECT f.doc_id, f.i, f.size, item.item_id FROM ({_SHORT}) f JOIN item ON item.words = f.words),
covered AS (SELECT hit.doc_id, count(DISTINCT w.i) AS n_hit FROM hit JOIN w ON w.doc_id = hit.doc_id AND w.i BETWEEN hit.i AND hit.i + hit.size - 1 GROUP BY hit.doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hit) GROUP BY doc_id),
sized AS (SELECT doc_id, count(*) AS n_words FROM w GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM documents d LEFT JOIN sized USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""

# five hexadecimal digits, 20 bits, make four letters of base32
_BITS = "CAST('0x' || substr(hex, {at}, 5) AS BIGINT)"
_LETTERS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(({_BITS.format(at=at)} >> {k}) & 31 AS INTEGER) + 1, 1)"
                       for at in range(1, 41, 5) for k in (15, 10, 5, 0))
OP4 = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {_LETTERS} AS payload_digest,
  if(page_id = first, 'response', 'revisit') AS record_type, if(page_id = first, NULL, first) AS refers_to FROM m"""

# The first four groups of eight hexadecimal digits as numbers
_DRAWS = ", ".join(f"CAST('0x' || substr(hex, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))
OP11 = f"""WITH d AS (SELECT doc_id, text, length(text) AS n, {_DRAWS}
           FROM (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents)),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
o AS (SELECT *, CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || substring(text, 1, a) || '<S>' || substring(text, b + 1) || '<M>' || substring(text, a + 1, b - a)
        ELSE '<S>' || substring(text, b + 1) || '<P>' || substring(text, 1, a) || '<M>' || substring(text, a + 1, b - a) END AS output FROM c),
p AS (SELECT *, string_split_regex(output, '<[PSM]>') AS part FROM o)
SELECT doc_id, n, form, if(form = 'plain', NULL, a) AS prefix_chars, if(form = 'plain', NULL, b - a) AS middle_chars, sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output WHEN 'psm' THEN part[2] || part[4] || part[3] ELSE part[3] || part[4] || part[2] END) AS restored_sha256
FROM p"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OP12 = f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
b AS MATERIALIZED (SELECT row_number() OVER () AS item, item_id, text FROM benchmark),
tf AS MATERIALIZED (SELECT row, word, count(*) AS tf, any_value(n) AS n FROM ({words('d', 'row', lower('text'), _TERM)}) GROUP BY ALL),
q AS (SELECT item, word, count(*) AS q FROM ({words('b', 'item', lower('text'), _TERM)}) GROUP BY ALL),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM (SELECT row, any_value(n) AS n FROM tf GROUP BY row)),
w AS (SELECT word, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT word, count(*) AS df FROM tf GROUP BY word), total),
s AS (SELECT item, row, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words)))) AS BIGINT) AS score
      FROM tf JOIN q ON q.word = tf.word JOIN w ON w.word = tf.word, total GROUP BY ALL),
r AS (SELECT item, doc_id, score, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank
      FROM s JOIN d ON d.row = s.row WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r JOIN b ON b.item = r.item WHERE rank <= 10"""

_SPACES = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))
OP13 = f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(doc_id, -9223372036854775808) AS id,
             string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT row, doc_id, id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line FROM d),
k AS (SELECT *, {lower(f"trim(line, {_SPACES})")} AS key FROM l),
common AS (SELECT key, max(id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT id) >= 3),
m AS (SELECT k.*, coalesce(keeper <> id, false) AS gone FROM k LEFT JOIN common ON common.key = k.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY row"""

# Operator 8 in SQL takes a window for every byte (a minute on a hundredth of the data), so its query is tested by brute force.
ORACLE = {"op2_substring_dedup": OP2, "op4_warc_revisits": OP4, "op6_quality_rules": OP6, "op7_ngram_join": OP7, "op9_decontaminate": OP9, "op11_fill_middle": OP11, "op12_lexical_search": OP12,
          "op13_line_dedup": OP13}
