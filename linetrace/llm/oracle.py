"""SQL for DuckDB with the results of the queries that SQL can express.

SimHash, sharding and training order rest on XXH64 or keyed permutations, toxicity and
added personal data on fitted models, URL verdicts on a tree that grows by tests: those
queries have none and are tested against plain loops.
"""

from __future__ import annotations

STATEMENTS: dict[str, str] = {}

_BLANK = r"[\x20\x09-\x0D]+"
_ROWS = "SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _item_words(column: str) -> str:
    lowered = f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"
    return f"list_filter(regexp_split_to_array({lowered}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"


STATEMENTS["op4_decontaminate"] = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_item_words('text')} AS words FROM documents),
items AS (SELECT item_id, {_item_words('text')} AS words FROM benchmark),
sized AS (SELECT item_id, words, least(13, len(words)) AS size FROM items WHERE len(words) > 0),
spans AS (SELECT DISTINCT item_id, size, words[s + 1 : s + size] AS win
          FROM (SELECT *, unnest(range(len(words) - size + 1)) AS s FROM sized)),
sizes AS (SELECT DISTINCT size FROM spans),
places AS (SELECT rid, size, s, words[s + 1 : s + size] AS win
           FROM (SELECT rid, words, size, unnest(range(len(words) - size + 1)) AS s
                 FROM docs, sizes WHERE len(words) >= size)),
hits AS (SELECT rid, p.size, s, item_id FROM places p JOIN spans USING (size, win)),
counted AS (SELECT rid, count(DISTINCT w) AS n_hit FROM (SELECT rid, unnest(range(s, s + size)) AS w FROM hits) GROUP BY rid),
listed AS (SELECT rid, count(DISTINCT item_id) AS n_items,
                  string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
           FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN counted USING (rid) LEFT JOIN listed USING (rid)"""

STATEMENTS["op7_quality"] = f"""
WITH docs AS ({_ROWS}),
cut AS (SELECT rid, doc_id, text,
               list_filter(regexp_split_to_array(text, '{_BLANK}'), lambda w: w <> '') AS words,
               list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
        FROM docs),
grams AS (SELECT rid, i, words[i : i + 2] AS gram FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM cut)),
twice AS (SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
covered AS (SELECT rid, count(DISTINCT w) AS n FROM (SELECT rid, unnest(range(i, i + 3)) AS w FROM twice) GROUP BY rid),
counts AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
                  CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                  CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
                  length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper
           FROM cut LEFT JOIN covered USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 4 * n_words
            OR 2 * n_upper > word_chars OR 5 * n_dup_lines > n_words
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM counts"""

STATEMENTS["op8_mixing"] = f"""
WITH docs AS ({_ROWS}),
sized AS (SELECT rid, doc_id, source, CAST(len(list_filter(regexp_split_to_array(text, '{_BLANK}'), lambda w: w <> '')) AS BIGINT) AS size,
                 md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(text)) AS key
          FROM docs),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no
            FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][no % 3 + 1] AS weight, 2.0::DOUBLE * source_size AS lim,
                   2.0::DOUBLE * source_size / [5, 2, 1][no % 3 + 1] AS ratio FROM sources),
levels AS (SELECT *, row_number() OVER (ORDER BY ratio, no) AS place,
                  (1.5::DOUBLE * sum(source_size) OVER ()
                   - coalesce(sum(lim) OVER (ORDER BY ratio, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(weight) OVER (ORDER BY ratio, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
           FROM weighed),
chosen AS (SELECT arg_min(level, place) AS level FROM levels WHERE level < ratio),
targets AS (SELECT l.source, l.source_size, coalesce(least(l.lim, c.level * l.weight), l.lim) AS target FROM levels l, chosen c),
placed AS (SELECT s.*, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
                  coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.size, s.rid
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
           FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
dealt AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM placed)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM dealt"""

#: CRC-32 of ASCII text, eight bits at a time by a table made from its polynomial.
_CRC_TABLE = """SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS crc FROM range(256) t(i)"""
_GAPS = """(VALUES (0, 0, 0, '', ''), (0, 2, 5, 'I', 'user:\n'), (0, 3, 10, 'II', 'user:\nassistant:\n'),
    (1, 1, 0, '', ''), (1, 2, 5, 'I', 'user:\n'), (1, 3, 10, 'II', 'user:\nassistant:\n'),
    (2, 2, 0, '', ''), (2, 3, 5, 'I', 'assistant:\n'), (2, 2, 10, 'II', 'assistant:\nuser:\n'),
    (3, 3, 0, '', ''), (3, 2, 5, 'I', 'user:\n'), (3, 3, 10, 'II', 'user:\nassistant:\n'))"""
#: State before, state after, letter of a role that is kept (null: any row), edit, cost, role given.
_EDITS = """(VALUES (0, 1, 's', 'K', 0, NULL), (0, 2, 'u', 'K', 0, NULL), (1, 2, 'u', 'K', 0, NULL),
    (3, 2, 'u', 'K', 0, NULL), (2, 3, 'a', 'K', 0, NULL), (0, 2, NULL, 'R', 1, 'user'), (1, 2, NULL, 'R', 1, 'user'),
    (3, 2, NULL, 'R', 1, 'user'), (2, 3, NULL, 'R', 1, 'assistant'), (0, 0, NULL, 'D', 2, NULL),
    (1, 1, NULL, 'D', 2, NULL), (2, 2, NULL, 'D', 2, NULL), (3, 3, NULL, 'D', 2, NULL))"""
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

STATEMENTS["op12_conversation_repair"] = f"""
WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
       coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
diced AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))),
                 lambda c, b: xor(c // 256, crc[xor(c % 256, b) + 1]))) % 20 AS dice FROM keyed, ({_CRC_TABLE})),
damaged AS (SELECT conv_id, turn, CASE WHEN dice = 4 THEN 'user' ELSE role END AS role,
                   CASE dice WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM (SELECT *, unnest(range(CASE WHEN dice = 3 THEN 2 ELSE 1 END)) FROM diced WHERE dice <> 0)),
places AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
                  rtrim(text, {_WHITE}) AS seen, left(role, 1) AS letter FROM damaged),
faults AS (SELECT *, CASE WHEN seen = '' THEN 'blank'
                          WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
                          WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                  lag(letter) OVER (PARTITION BY conv_id ORDER BY n) || letter AS follows FROM places),
moves AS (SELECT g.p, e.q, e.letter, e.edit, g.cost + e.cost AS cost, g.edits || e.edit AS edits, g.added, e.role
          FROM {_GAPS} g(p, m, cost, edits, added), {_EDITS} e(m, q, letter, edit, cost, role) WHERE g.m = e.m),
walk AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS n, 0 AS state, 0 AS cost, '' AS audit, '' AS said FROM damaged
         UNION ALL
         SELECT conv_id, n, q, least['cost'], least['audit'], least['said'] FROM (
             SELECT f.conv_id, f.n, m.q, min({{'cost': w.cost + m.cost + CASE WHEN f.fault = 'truncated' AND m.edit <> 'D' THEN 5 ELSE 0 END,
                    'audit': w.audit || m.edits, 'said': w.said || m.added
                     || CASE WHEN m.edit = 'D' THEN '' ELSE coalesce(m.role, f.role) || ':' || f.text || chr(10) END}}) AS least
             FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1
             JOIN moves m ON m.p = w.state AND (m.letter IS NULL OR m.letter = f.letter)
                          AND (m.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
             GROUP BY f.conv_id, f.n, m.q)),
counts AS (SELECT conv_id, max(n) AS n, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
                  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                  count(*) FILTER (fault = 'truncated') AS truncated,
                  count(*) FILTER (follows NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
ends AS (SELECT w.conv_id, min({{'cost': w.cost + e.cost, 'audit': w.audit || e.edits, 'said': w.said || e.added}}) AS least
         FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.n
         JOIN (VALUES (0, 0, '', ''), (3, 0, '', ''), (2, 5, 'I', 'assistant:\n'), (1, 10, 'II', 'user:\nassistant:\n'))
              e(state, cost, edits, added) ON e.state = w.state GROUP BY w.conv_id),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT v.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, CAST(coalesce(least['cost'], 0) AS BIGINT) AS cost,
       coalesce(least['audit'], '') AS audit,
       sha256(coalesce(left(least['said'], greatest(length(least['said']) - 1, 0)), '')) AS repaired_sha256
FROM every v LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM v.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM v.conv_id"""

STATEMENTS["op13_lexical_search"] = f"""
WITH docs AS (SELECT rid, doc_id, words, CAST(len(words) AS BIGINT) AS n
              FROM (SELECT row_number() OVER () AS rid, doc_id, {_item_words('text')} AS words FROM documents) WHERE len(words) > 0),
norm AS (SELECT CAST(count(*) AS BIGINT) AS total, CAST(sum(n) AS BIGINT) AS length FROM docs),
items AS (SELECT row_number() OVER () AS item, item_id, list_distinct({_item_words('text')}) AS words FROM benchmark),
wanted AS (SELECT item, item_id, unnest(words) AS term FROM items),
counts AS (SELECT rid, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT rid, unnest(words) AS term FROM docs)
           WHERE term IN (SELECT term FROM wanted) GROUP BY rid, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * total + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts, norm GROUP BY term, total),
scored AS (SELECT item, item_id, doc_id, rid,
                  CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * total) // length)))) AS BIGINT) AS score
           FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN docs USING (rid), norm GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
WINDOW best AS (PARTITION BY item ORDER BY score DESC, doc_id, rid) QUALIFY row_number() OVER best <= 10"""
