"""SQL statements that DuckDB runs on the same tables to check the queries.

Each statement is written from the meaning of its query, as common table
expressions that build on each other.
"""

from __future__ import annotations

from linetrace.functions.text import KEYWORDS, PUNCTUATION

WHITE = r"[\s\x0b\x1c-\x1f\x{85}\pZ]+"
# DuckDB measures edits in bytes: the non-ASCII letters of the tables (fixed list)
# are swapped for unused control characters, one byte each.
LETTERS = "éóèñçüêäößíÉÈÑÓÇÄÊÜÖÍ"
_CODES = "||".join(f"chr({c})" for c in [*range(1, 9), *range(14, 27)])


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def one_byte(column: str) -> str:
    return f"translate({column}, '{LETTERS}', {_CODES})"


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, uses: str, body: str, recursive_columns: str = "") -> None:
    CTES[name] = (uses.split(), f"{name}{recursive_columns} AS ({body})")


def _with(names: list[str]) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for used in CTES[name][0]:
            add(used)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH RECURSIVE " + ",\n".join(CTES[name][1] for name in ordered)


def statement(uses: str, select: str) -> str:
    return f"{_with(uses.split())}\n{select}"


cte("line_votes", "", r"""
    SELECT doc_id, prev AS old_id, count(*) AS votes
    FROM (SELECT doc_id, lag(doc_id) OVER (PARTITION BY line ORDER BY doc_id) AS prev
          FROM (SELECT DISTINCT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL)
          WHERE regexp_matches(line, '[^\x09-\x0D\x20]'))
    WHERE prev IS NOT NULL GROUP BY doc_id, prev""")
cte("chained", "line_votes", """
    SELECT d.doc_id, d.text, v.old_id AS prev
    FROM documents d
    LEFT JOIN (SELECT * FROM line_votes
               QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY votes DESC, old_id DESC) = 1) v USING (doc_id)
    WHERE d.text IS NOT NULL""")
cte("versions", "chained", """
    SELECT CAST(doc_id AS VARCHAR) AS pair_id, 'new' AS side, text FROM chained WHERE prev IS NOT NULL
    UNION ALL
    SELECT CAST(a.doc_id AS VARCHAR), 'old', b.text FROM chained a JOIN chained b ON b.doc_id = a.prev""")


def lines_body(source: str) -> str:
    return f"""
    SELECT pair_id, side, CAST(k AS INTEGER) AS line_no, parts[k] AS text,
           (k < len(parts)) AS has_eol
    FROM (SELECT pair_id, side, parts,
                 unnest(range(1, len(parts) + CASE WHEN parts[len(parts)] = '' THEN 0 ELSE 1 END)) AS k
          FROM (SELECT pair_id, side,
                       string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)) AS parts
                FROM {source}))"""


SENTENCES = "replace(text, '. ', '.' || chr(10) || chr(10))"


def shaped(sql: str, new: str, old: str = "") -> str:
    """The statement over changed texts of the new and the old versions."""
    old = old or new.replace("text", "b.text")
    return sql.replace("'new' AS side, text FROM chained", f"'new' AS side, {new} AS text FROM chained").replace(
        "'old', b.text FROM chained", f"'old', {old} FROM chained"
    )


cte("lines", "versions", lines_body("versions"))
cte("unicode_rows", "versions", r"""
    SELECT pair_id, side, CAST(k AS INTEGER) AS line_no, parts[k] AS text, (k < len(parts)) AS has_eol
    FROM (SELECT pair_id, side, parts,
                 unnest(range(1, len(parts) + CASE WHEN parts[len(parts)] = '' THEN 0 ELSE 1 END)) AS k
          FROM (SELECT pair_id, side,
                       regexp_split_to_array(text, '\r\n|[\r\n\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]') AS parts
                FROM versions))""")
cte("files", "", """
    SELECT CAST(doc_id // 1000 AS VARCHAR) AS pair_id, 'new' AS side,
           string_agg(coalesce(text, ''), chr(10) ORDER BY doc_id, text) || chr(10) AS text
    FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id // 1000""")
cte("file_lines", "files", lines_body("files"))
cte("turns", "", """
    SELECT conv_id, role, turn, text,
           lag(turn) OVER (PARTITION BY conv_id, role ORDER BY turn) AS prev
    FROM conversations WHERE text IS NOT NULL""")
cte("turn_versions", "turns", """
    SELECT concat_ws(':', conv_id, role, turn) AS pair_id, 'new' AS side, text FROM turns WHERE prev IS NOT NULL
    UNION ALL
    SELECT concat_ws(':', a.conv_id, a.role, a.turn), 'old', b.text
    FROM turns a JOIN turns b ON b.conv_id = a.conv_id AND b.role = a.role AND b.turn = a.prev""")
cte("turn_lines", "turn_versions", lines_body("turn_versions"))


def compared_body(source: str) -> str:
    return f"""
    SELECT pair_id, line_no,
           CASE WHEN o.text IS NULL THEN 'added' WHEN n.text IS NULL THEN 'removed'
                WHEN o.text = n.text THEN 'same' ELSE 'changed' END AS status,
           o.text AS old_text, n.text AS new_text
    FROM (SELECT pair_id, line_no, text FROM {source} WHERE side = 'old') o
    FULL JOIN (SELECT pair_id, line_no, text FROM {source} WHERE side = 'new') n USING (pair_id, line_no)"""


cte("compared", "lines", compared_body("lines"))
cte("turns_compared", "turn_lines", compared_body("turn_lines"))
cte("normal", "lines", f"""
    SELECT pair_id, side, line_no,
           trim(regexp_replace(translate(lower(text), {_quoted(PUNCTUATION)}, ''), '{WHITE}', ' ', 'g')) AS pre
    FROM lines""")
cte("structured", "normal", f"""
    SELECT *, list_transform(
             list_filter(regexp_split_to_array(pre, '[^a-z0-9_]+'), lambda w: w <> ''),
             lambda w: CASE WHEN w IN ({", ".join(_quoted(k) for k in KEYWORDS)}) THEN w
                            WHEN regexp_full_match(w, '[0-9]+') THEN 'NUM' ELSE 'ID' END) AS tokens
    FROM normal""")
cte("structs", "structured", """
    SELECT DISTINCT tokens FROM structured WHERE len(tokens) > 0""")
cte("votes", "structs", """
    SELECT tokens, b, sum(CASE WHEN (CASE WHEN b < 32 THEN lo >> b ELSE hi >> (b - 32) END) & 1 = 1
                               THEN 1 ELSE -1 END) AS total
    FROM (SELECT tokens, ('0x' || substr(md5(t), 1, 8))::BIGINT AS hi, ('0x' || substr(md5(t), 9, 8))::BIGINT AS lo
          FROM (SELECT tokens, unnest(tokens) AS t FROM structs)),
         (SELECT unnest(range(64))::INTEGER AS b)
    GROUP BY tokens, b""")
cte("prints", "votes", """
    SELECT tokens, CAST(sum(CASE WHEN total <= 0 THEN 0::HUGEINT
                                 WHEN b = 63 THEN -(2::HUGEINT ** 63)::HUGEINT
                                 ELSE (1::HUGEINT << b) END) AS BIGINT) AS simhash
    FROM votes GROUP BY tokens""")
cte("hashed", "structured prints", """
    SELECT s.*, array_to_string(s.tokens, ' ') AS struct_str, coalesce(p.simhash, 0::BIGINT) AS simhash
    FROM structured s LEFT JOIN prints p ON p.tokens = s.tokens""")
cte("contexts", "normal", """
    SELECT pair_id, side, line_no, array_to_string(
             list_concat(list_reverse(coalesce(list(pre) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), [])),
                         coalesce(list(pre) OVER (w ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING), [])), ' ') AS ctx
    FROM normal WHERE pre <> ''
    WINDOW w AS (PARTITION BY pair_id, side ORDER BY line_no)""")


def alignment(p: str, source: str, key: str, popular: bool) -> None:
    """Tables ``{p}_blocks`` and ``{p}_hunks``: recursive longest common blocks.

    A row of the recursion is a block with the two regions it leaves. Every equal
    line pair knows how far its run of equal lines reaches on its diagonal; clipped
    to a region, the longest run wins. Popular lines cannot start a block, but one
    at the very start of a region may, and they lengthen any block they touch.
    """
    popular_if = "nn >= 200 AND copies > nn // 100 + 1" if popular else "false"
    cte(f"{p}_old", source, f"SELECT pair_id, line_no - 1 AS i, {key} AS key FROM {source} WHERE side = 'old'")
    cte(f"{p}_new", source, f"""
        SELECT pair_id, j, key, ({popular_if}) AS popular
        FROM (SELECT pair_id, line_no - 1 AS j, {key} AS key,
                     count(*) OVER (PARTITION BY pair_id, {key}) AS copies,
                     count(*) OVER (PARTITION BY pair_id) AS nn
              FROM {source} WHERE side = 'new')""")
    cte(f"{p}_sizes", source, f"""
        SELECT pair_id, CAST(count(*) FILTER (side = 'old') AS INTEGER) AS n_old,
               CAST(count(*) FILTER (side = 'new') AS INTEGER) AS n_new
        FROM {source} GROUP BY pair_id""")
    cte(f"{p}_equal", f"{p}_old {p}_new", f"""
        SELECT pair_id, i, j, popular,
               i - row_number() OVER (PARTITION BY pair_id, j - i ORDER BY i) AS run,
               i - row_number() OVER (PARTITION BY pair_id, j - i, popular ORDER BY i) AS rare_run
        FROM {p}_old JOIN {p}_new USING (pair_id, key)""")
    cte(f"{p}_reach", f"{p}_equal", f"""
        SELECT pair_id, i, j, popular,
               min(i) OVER (PARTITION BY pair_id, j - i, run) AS first,
               max(i) OVER (PARTITION BY pair_id, j - i, run) + 1 AS last,
               CASE WHEN popular THEN 0
                    ELSE max(i) OVER (PARTITION BY pair_id, j - i, popular, rare_run) + 1 - i END AS rare
        FROM {p}_equal""")
    cte(f"{p}_cut", f"{p}_reach {p}_sizes", f"""
        SELECT pair_id, 0 AS i, 0 AS j, 0 AS n,
               [{{'alo': 0, 'ahi': n_old, 'blo': 0, 'bhi': n_new}}] AS regions
        FROM {p}_sizes
        UNION ALL
        SELECT pair_id, CAST(bi AS INTEGER), CAST(bj AS INTEGER), CAST(e - bi AS INTEGER),
               [{{'alo': r.alo, 'ahi': CAST(bi AS INTEGER), 'blo': r.blo, 'bhi': CAST(bj AS INTEGER)}},
                {{'alo': CAST(e AS INTEGER), 'ahi': r.ahi, 'blo': CAST(bj + e - bi AS INTEGER), 'bhi': r.bhi}}]
        FROM (SELECT pair_id, r, greatest(b.first, r.alo, b.i - (b.j - r.blo)) AS bi,
                     b.j - b.i + greatest(b.first, r.alo, b.i - (b.j - r.blo)) AS bj,
                     least(b.last, r.ahi, b.i + (r.bhi - b.j)) AS e
              FROM (SELECT c.pair_id, c.r,
                           min({{'m': -least(m.rare, c.r.ahi - m.i, c.r.bhi - m.j), 'i': m.i, 'j': m.j,
                                'first': m.first, 'last': m.last}}) AS b
                    FROM (SELECT pair_id, unnest(regions) AS r FROM {p}_cut) c
                    JOIN {p}_reach m ON m.pair_id = c.pair_id
                     AND m.i >= c.r.alo AND m.i < c.r.ahi AND m.j >= c.r.blo AND m.j < c.r.bhi
                    WHERE m.rare > 0 OR (m.i = c.r.alo AND m.j = c.r.blo)
                    GROUP BY c.pair_id, c.r))""")
    cte(f"{p}_ends", f"{p}_cut {p}_sizes", f"""
        SELECT pair_id, i, j, n FROM {p}_cut WHERE n > 0
        UNION ALL SELECT pair_id, n_old, n_new, 0 FROM {p}_sizes""")
    cte(f"{p}_touch", f"{p}_ends", f"""
        SELECT *, CASE WHEN lag(i + n) OVER w = i AND lag(j + n) OVER w = j THEN 0 ELSE 1 END AS step
        FROM {p}_ends WINDOW w AS (PARTITION BY pair_id ORDER BY i, j)""")
    cte(f"{p}_runs", f"{p}_touch", f"""
        SELECT pair_id, run, CAST(min(i) AS INTEGER) AS i, CAST(min(j) AS INTEGER) AS j, CAST(sum(n) AS INTEGER) AS n
        FROM (SELECT *, sum(step) OVER (PARTITION BY pair_id ORDER BY i, j) AS run FROM {p}_touch)
        GROUP BY pair_id, run""")
    cte(f"{p}_gaps", f"{p}_runs", f"""
        SELECT *, coalesce(lag(i + n) OVER w, 0) AS i0, coalesce(lag(j + n) OVER w, 0) AS j0
        FROM {p}_runs WINDOW w AS (PARTITION BY pair_id ORDER BY run)""")
    cte(f"{p}_hunks", f"{p}_gaps", f"""
        SELECT pair_id, CAST(row_number() OVER (PARTITION BY pair_id ORDER BY run, part) AS INTEGER) AS hunk_no,
               tag, CAST(i1 AS INTEGER) AS i1, CAST(i2 AS INTEGER) AS i2, CAST(j1 AS INTEGER) AS j1, CAST(j2 AS INTEGER) AS j2
        FROM (SELECT pair_id, run, 0 AS part,
                     CASE WHEN i0 < i AND j0 < j THEN 'replace' WHEN i0 < i THEN 'delete' ELSE 'insert' END AS tag,
                     i0 AS i1, i AS i2, j0 AS j1, j AS j2
              FROM {p}_gaps WHERE i0 < i OR j0 < j
              UNION ALL
              SELECT pair_id, run, 1, 'equal', i, i + n, j, j + n FROM {p}_gaps WHERE n > 0)""")
    cte(f"{p}_edges", f"{p}_hunks", f"""
        SELECT pair_id, CAST(i1 + k AS INTEGER) AS old_line, CAST(j1 + k AS INTEGER) AS new_line
        FROM (SELECT *, unnest(range(1, i2 - i1 + 1)) AS k FROM {p}_hunks WHERE tag = 'equal')""")


alignment("exact", "normal", "pre", popular=False)
alignment("plain", "lines", "text", popular=True)
alignment("ended", "lines", "text || CASE WHEN has_eol THEN chr(10) ELSE '' END", popular=True)
cte("exact_map", "exact_edges normal", """
    SELECT e.* FROM exact_edges e
    JOIN normal o ON o.pair_id = e.pair_id AND o.side = 'old' AND o.line_no = e.old_line
    WHERE o.pre <> ''""")


def unmatched_sql(lines: str, edges: str) -> str:
    return f"""
    SELECT l.pair_id, l.side, l.line_no FROM {lines} l
    WHERE NOT EXISTS (SELECT 1 FROM {edges} e WHERE e.pair_id = l.pair_id
                      AND l.line_no = CASE l.side WHEN 'old' THEN e.old_line ELSE e.new_line END)"""


cte("filled", "normal", "SELECT * FROM normal WHERE pre <> ''")
cte("ended_sizes_of", "ended_hunks", """
    SELECT *, i2 - i1 AS left_lines, j2 - j1 AS right_lines, greatest(i2 - i1, j2 - j1) AS rows FROM ended_hunks""")


def side_by_side_sql(half: int, where: str) -> str:
    return f"""
    SELECT s.pair_id, s.hunk_no, s.row_no,
           rpad(coalesce(o.text, ''), {half}, ' ')
           || CASE s.tag WHEN 'equal' THEN '   ' WHEN 'replace' THEN ' | ' WHEN 'delete' THEN ' < ' ELSE ' > ' END
           || left(coalesce(n.text, ''), {half}) AS row
    FROM (SELECT *, CAST(unnest(range(1, rows + 1)) AS INTEGER) AS row_no FROM ended_sizes_of WHERE {where}) s
    LEFT JOIN lines o ON o.pair_id = s.pair_id AND o.side = 'old' AND o.line_no = s.i1 + s.row_no AND s.row_no <= s.left_lines
    LEFT JOIN lines n ON n.pair_id = s.pair_id AND n.side = 'new' AND n.line_no = s.j1 + s.row_no AND s.row_no <= s.right_lines"""


cte("hunk_texts", "ended_hunks lines", """
    SELECT h.pair_id, h.hunk_no, h.tag, h.i1, h.i2, h.j1, h.j2,
           coalesce(string_agg(l.text || CASE WHEN l.has_eol THEN chr(10) ELSE '' END, '' ORDER BY l.line_no) FILTER (l.side = 'old'), '') AS old_raw,
           coalesce(string_agg(l.text || chr(10), '' ORDER BY l.line_no) FILTER (l.side = 'old'), '') AS old_full,
           coalesce(string_agg(l.text || CASE WHEN l.has_eol THEN chr(10) ELSE '' END, '' ORDER BY l.line_no) FILTER (l.side = 'new'), '') AS new_raw,
           coalesce(string_agg(l.text || chr(10), '' ORDER BY l.line_no) FILTER (l.side = 'new'), '') AS new_full
    FROM ended_hunks h JOIN lines l ON l.pair_id = h.pair_id
     AND ((l.side = 'old' AND l.line_no > h.i1 AND l.line_no <= h.i2)
       OR (l.side = 'new' AND l.line_no > h.j1 AND l.line_no <= h.j2))
    GROUP BY ALL""")


def header_sql(mark: str, name: str, start: str, end: str) -> str:
    return (
        f"CASE WHEN {start} + 1 > {end} THEN '' WHEN {start} + 1 = {end}"
        f" THEN '{mark} {name} line ' || ({start} + 1) || chr(10)"
        f" ELSE '{mark} {name} lines ' || ({start} + 1) || '-' || {end} || chr(10) END"
    )


cte("pieces", "hunk_texts", f"""
    SELECT pair_id, hunk_no, CASE
      WHEN tag = 'equal' THEN old_raw
      ELSE CASE hunk_no % 7
        WHEN 0 THEN old_raw WHEN 1 THEN new_raw WHEN 2 THEN old_full WHEN 3 THEN new_full
        WHEN 4 THEN old_full || new_full
        WHEN 5 THEN {header_sql("---", "old", "i1", "i2")} || old_full || {header_sql("+++", "new", "j1", "j2")} || new_full
        ELSE '' END END AS piece
    FROM hunk_texts""")


cte("cancelled_pieces", "hunk_texts", f"""
    SELECT pair_id, hunk_no, CASE
      WHEN tag = 'equal' THEN old_raw
      ELSE CASE hunk_no % 9
        WHEN 0 THEN old_raw WHEN 1 THEN new_raw WHEN 2 THEN 'edited' || chr(10) WHEN 3 THEN new_full
        WHEN 4 THEN old_full || new_full
        WHEN 5 THEN {header_sql("---", "old", "i1", "i2")} || old_full || {header_sql("+++", "new", "j1", "j2")} || new_full
        WHEN 6 THEN '' END END AS piece
    FROM hunk_texts""")


def foreign(p: str, source: str, key: str) -> None:
    cte(f"foreign_{p}", source, f"""
        SELECT * FROM {source} l WHERE NOT EXISTS (
            SELECT 1 FROM {source} o WHERE o.pair_id = l.pair_id AND o.side <> l.side AND o.{key} = l.{key})""")


foreign("lines", "lines", "text")
cte("frange", "foreign_lines", """
    SELECT pair_id, side, CAST(row_number() OVER (PARTITION BY pair_id, side ORDER BY min(line_no)) AS INTEGER) AS range_no,
           min(line_no) - 1 AS start, max(line_no) AS "end"
    FROM (SELECT *, line_no - row_number() OVER (PARTITION BY pair_id, side ORDER BY line_no) AS run FROM foreign_lines)
    GROUP BY pair_id, side, run""")


def similarity_tables(p: str, ranges: str) -> None:
    """Term weights and cosines of the ranges in ``ranges``."""
    cte(f"{p}_members", f"lines {ranges}", f"""
        SELECT r.pair_id, r.side, r.range_no, l.line_no, l.text
        FROM {ranges} r JOIN lines l ON l.pair_id = r.pair_id AND l.side = r.side
         AND l.line_no > r.start AND l.line_no <= r."end" """)
    cte(f"{p}_tf", f"{p}_members", rf"""
        SELECT pair_id, side, range_no, token, count(*) AS tf
        FROM (SELECT pair_id, side, range_no, unnest(regexp_extract_all(text, '[\pL\pN_]+')) AS token FROM {p}_members)
        GROUP BY ALL""")
    cte(f"{p}_weights", f"{p}_tf {ranges}", f"""
        SELECT t.*, d.df, n.n_ranges, t.tf * (ln((n.n_ranges + 1) / (d.df + 1)) + 1) AS weight
        FROM {p}_tf t
        JOIN (SELECT pair_id, side, token, count(*) AS df FROM {p}_tf GROUP BY ALL) d USING (pair_id, side, token)
        JOIN (SELECT pair_id, side, count(*) AS n_ranges FROM {ranges} GROUP BY ALL) n USING (pair_id, side)""")
    cte(f"{p}_cosine", f"{p}_weights", f"""
        SELECT pair_id, old_range, new_range, dot / (a.norm * b.norm) AS sim
        FROM (SELECT o.pair_id, o.range_no AS old_range, n.range_no AS new_range, sum(o.weight * n.weight) AS dot
              FROM {p}_weights o JOIN {p}_weights n ON n.pair_id = o.pair_id AND n.token = o.token
              WHERE o.side = 'old' AND n.side = 'new' GROUP BY ALL)
        JOIN (SELECT pair_id, range_no AS old_range, sqrt(sum(weight * weight)) AS norm
              FROM {p}_weights WHERE side = 'old' GROUP BY ALL) a USING (pair_id, old_range)
        JOIN (SELECT pair_id, range_no AS new_range, sqrt(sum(weight * weight)) AS norm
              FROM {p}_weights WHERE side = 'new' GROUP BY ALL) b USING (pair_id, new_range)""")
    a, b = one_byte("o.text"), one_byte("n.text")
    cte(f"{p}_near", f"{p}_cosine {p}_members", f"""
        SELECT *, CASE WHEN l = r THEN 0.0 WHEN l = '' OR r = '' THEN 1.0
                       ELSE levenshtein(l, r) / greatest(length(l), length(r)) END AS d
        FROM (SELECT c.pair_id, c.old_range, c.new_range, o.line_no AS old_line, n.line_no AS new_line, {a} AS l, {b} AS r
              FROM {p}_cosine c
              JOIN {p}_members o ON o.pair_id = c.pair_id AND o.side = 'old' AND o.range_no = c.old_range
              JOIN {p}_members n ON n.pair_id = c.pair_id AND n.side = 'new' AND n.range_no = c.new_range
              WHERE c.sim > 0)
        WHERE l = r OR (l <> '' AND r <> '' AND abs(length(l) - length(r)) / greatest(length(l), length(r)) < 0.4)""")
    cte(f"{p}_picked", f"{p}_near", f"""
        SELECT pair_id, old_range, new_range, list_reduce(
                 list([{{'l': old_line, 'r': new_line, 'd': d}}] ORDER BY d, old_line + new_line, old_line, new_line),
                 lambda taken, e: CASE WHEN e[1].l > taken[-1].l AND e[1].r > taken[-1].r THEN taken || e ELSE taken END) AS taken
        FROM {p}_near WHERE d < 0.4 GROUP BY pair_id, old_range, new_range""")
    cte(f"{p}_thin", f"{p}_picked", f"""
        SELECT pair_id, old_line, arg_max(new_line, new_range) AS new_line, 1.0 - arg_max(d, new_range) AS score
        FROM (SELECT pair_id, new_range, t.l AS old_line, t.r AS new_line, t.d AS d
              FROM (SELECT pair_id, new_range, unnest(taken) AS t FROM {p}_picked))
        GROUP BY pair_id, old_line""")


similarity_tables("foreign", "frange")
cte("plain_ranges", "plain_hunks", """
    SELECT pair_id, side, CAST(row_number() OVER (PARTITION BY pair_id, side ORDER BY start) AS INTEGER) AS range_no, start, "end"
    FROM (SELECT pair_id, 'old' AS side, i1 AS start, i2 AS "end" FROM plain_hunks WHERE tag <> 'equal'
          UNION ALL SELECT pair_id, 'new', j1, j2 FROM plain_hunks WHERE tag <> 'equal')
    WHERE start < "end" """)
similarity_tables("plain", "plain_ranges")
cte("range_mapping", "plain_edges plain_thin", """
    SELECT pair_id, old_line, new_line, 'exact' AS kind, 1.0::DOUBLE AS score FROM plain_edges
    UNION ALL SELECT pair_id, old_line, new_line, 'thin', score FROM plain_thin""")

cte("features", "hashed contexts", f"""
    SELECT h.pair_id, h.side, h.line_no, h.simhash, h.struct_str, {one_byte("h.pre")} AS pre,
           list_filter(string_split(c.ctx, ' '), lambda w: w <> '') AS words
    FROM hashed h JOIN contexts c USING (pair_id, side, line_no)""")
foreign("normal", "filled", "pre")


def ratio_sql(a: str, b: str) -> str:
    return (
        f"CASE WHEN {a} = '' AND {b} = '' THEN 1.0 WHEN {a} = '' OR {b} = '' THEN 0.0"
        f" ELSE 1.0 - levenshtein({a}, {b}) / greatest(length({a}), length({b})) END"
    )


def scoring_tables(p: str, pairs: str) -> None:
    """``{p}_scores``: combined score of the line pairs in ``pairs``."""
    cte(f"{p}_counts", f"features {pairs}", f"""
        SELECT pair_id, side, line_no, w, count(*) AS n
        FROM (SELECT f.pair_id, f.side, f.line_no, unnest(words) AS w FROM features f
              WHERE (f.pair_id, f.side, f.line_no) IN (
                SELECT (pair_id, 'old', old_line) FROM {pairs} UNION SELECT (pair_id, 'new', new_line) FROM {pairs}))
        GROUP BY ALL""")
    cte(f"{p}_norms", f"{p}_counts", f"""
        SELECT pair_id, side, line_no, sqrt(sum(n * n)) AS norm FROM {p}_counts GROUP BY ALL""")
    cte(f"{p}_dots", f"{p}_counts {pairs}", f"""
        SELECT c.pair_id, c.old_line, c.new_line, sum(a.n * b.n) AS dot
        FROM {pairs} c
        JOIN {p}_counts a ON a.pair_id = c.pair_id AND a.side = 'old' AND a.line_no = c.old_line
        JOIN {p}_counts b ON b.pair_id = c.pair_id AND b.side = 'new' AND b.line_no = c.new_line AND b.w = a.w
        GROUP BY ALL""")
    cte(f"{p}_context", f"{p}_dots {p}_norms {pairs}", f"""
        SELECT c.pair_id, c.old_line, c.new_line,
               CASE WHEN a.norm IS NULL AND b.norm IS NULL THEN 1.0 WHEN a.norm IS NULL OR b.norm IS NULL THEN 0.0
                    ELSE coalesce(d.dot, 0) / (a.norm * b.norm) END AS ctx_sim
        FROM {pairs} c
        LEFT JOIN {p}_norms a ON a.pair_id = c.pair_id AND a.side = 'old' AND a.line_no = c.old_line
        LEFT JOIN {p}_norms b ON b.pair_id = c.pair_id AND b.side = 'new' AND b.line_no = c.new_line
        LEFT JOIN {p}_dots d ON d.pair_id = c.pair_id AND d.old_line = c.old_line AND d.new_line = c.new_line""")
    cte(f"{p}_scores", f"{p}_context features", f"""
        SELECT c.pair_id, c.old_line, c.new_line,
               0.5::DOUBLE * {ratio_sql("o.pre", "n.pre")} + 0.3::DOUBLE * {ratio_sql("o.struct_str", "n.struct_str")}
               + 0.2::DOUBLE * c.ctx_sim AS score
        FROM {p}_context c
        JOIN features o ON o.pair_id = c.pair_id AND o.side = 'old' AND o.line_no = c.old_line
        JOIN features n ON n.pair_id = c.pair_id AND n.side = 'new' AND n.line_no = c.new_line""")


def candidate_tables(p: str, open_lines: str, match: float) -> None:
    """Top 15 by equal bits among ``open_lines``, their scores and the greedy choice."""
    cte(f"{p}_candidates", f"features {open_lines}", f"""
        SELECT pair_id, old_line, new_line, hsim, CAST(rn AS INTEGER) AS rn
        FROM (SELECT o.pair_id, o.line_no AS old_line, n.line_no AS new_line,
                     1.0::DOUBLE - bit_count(xor(o.simhash, n.simhash)) / 64 AS hsim,
                     row_number() OVER (PARTITION BY o.pair_id, o.line_no
                                        ORDER BY bit_count(xor(o.simhash, n.simhash)), n.line_no DESC) AS rn
              FROM features o JOIN features n ON n.pair_id = o.pair_id AND n.side = 'new' AND o.side = 'old'
              WHERE (o.pair_id, o.side, o.line_no) IN (SELECT (pair_id, side, line_no) FROM {open_lines})
                AND (n.pair_id, n.side, n.line_no) IN (SELECT (pair_id, side, line_no) FROM {open_lines}))
        WHERE rn <= 15""")
    scoring_tables(p, f"{p}_candidates")
    cte(f"{p}_taken", f"{p}_scores", f"""
        SELECT pair_id, list_reduce(
                 list({{'o': [old_line], 'n': [new_line], 's': [score]}} ORDER BY score DESC, old_line DESC, new_line DESC),
                 lambda t, e: CASE WHEN list_contains(t.o, e.o[1]) OR list_contains(t.n, e.n[1]) THEN t
                              ELSE {{'o': t.o || e.o, 'n': t.n || e.n, 's': t.s || e.s}} END) AS t
        FROM {p}_scores WHERE score >= {match} GROUP BY pair_id""")
    cte(f"{p}_greedy", f"{p}_taken", f"""
        SELECT pair_id, unnest(t.o) AS old_line, unnest(t.n) AS new_line, unnest(t.s) AS score FROM {p}_taken""")


candidate_tables("foreign", "foreign_normal", 0.35)
cte("open_normal", "filled exact_map", unmatched_sql("filled", "exact_map"))
candidate_tables("open", "open_normal", 0.35)
cte("primary_map", "exact_map open_greedy", """
    SELECT pair_id, old_line, new_line, 'exact' AS kind, 1.0::DOUBLE AS score FROM exact_map
    UNION ALL SELECT pair_id, old_line, new_line, 'greedy', score FROM open_greedy""")
cte("beside", "primary_map filled", """
    SELECT p.pair_id, p.old_line, n.line_no AS new_line FROM primary_map p
    JOIN filled n ON n.pair_id = p.pair_id AND n.side = 'new' AND n.line_no IN (p.new_line - 1, p.new_line + 1)""")
scoring_tables("beside", "beside")
cte("split_map", "primary_map beside_scores", """
    SELECT * FROM primary_map
    UNION ALL SELECT pair_id, old_line, new_line, 'split', score FROM beside_scores WHERE score >= 0.65""")
cte("targets", "split_map", "SELECT pair_id, old_line, min(new_line) AS new_line FROM split_map GROUP BY ALL")
cte("free_old", "filled targets", """
    SELECT pair_id, old_line, min(old_line) OVER w AS first, max(old_line) OVER w AS last
    FROM (SELECT pair_id, line_no AS old_line,
                 line_no - row_number() OVER (PARTITION BY pair_id ORDER BY line_no) AS run
          FROM filled f WHERE side = 'old' AND NOT EXISTS (
            SELECT 1 FROM targets t WHERE t.pair_id = f.pair_id AND t.old_line = f.line_no))
    WINDOW w AS (PARTITION BY pair_id, run)""")
cte("above", "free_old targets", """
    SELECT f.pair_id, f.old_line, t.new_line FROM free_old f
    JOIN targets t ON t.pair_id = f.pair_id AND t.old_line = f.first - 1""")
scoring_tables("above", "above")
cte("forward", "free_old above_scores", """
    SELECT pair_id, old_line, new_line, score
    FROM (SELECT s.*, bool_and(s.score >= 0.65) OVER (PARTITION BY f.pair_id, f.first ORDER BY f.old_line) AS reached
          FROM above_scores s JOIN free_old f USING (pair_id, old_line))
    WHERE reached""")
cte("below", "free_old targets forward", """
    SELECT f.pair_id, f.old_line, t.new_line FROM free_old f
    JOIN targets t ON t.pair_id = f.pair_id AND t.old_line = f.last + 1
    WHERE f.old_line = f.last AND NOT EXISTS (
      SELECT 1 FROM forward w WHERE w.pair_id = f.pair_id AND w.old_line = f.old_line)""")
scoring_tables("below", "below")
cte("hybrid_mapping", "split_map forward below_scores", """
    SELECT * FROM split_map
    UNION ALL SELECT pair_id, old_line, new_line, 'merge', score FROM forward
    UNION ALL SELECT pair_id, old_line, new_line, 'merge', score FROM below_scores WHERE score >= 0.65""")


def report_tables(p: str, mapping: str, lines: str, none: bool) -> None:
    """``{p}_report``: mapping rows, then unmatched old and new lines under headings."""
    cte(f"{p}_left", f"{lines} {mapping}", f"""
        SELECT pair_id, side, CASE side WHEN 'old' THEN 2 ELSE 3 END AS section, line_no
        FROM ({unmatched_sql(lines, mapping)})""")
    heading = f"""
        SELECT DISTINCT pair_id, section FROM (SELECT pair_id, unnest([2, 3]) AS section FROM versions)""" if none else f"""
        SELECT DISTINCT pair_id, section FROM {p}_left"""
    cte(f"{p}_sections", f"{p}_left {lines} versions", heading)
    nothing = f"""
        UNION ALL SELECT pair_id, section, 1, '(none)' FROM {p}_sections s
        WHERE NOT EXISTS (SELECT 1 FROM {p}_left l WHERE l.pair_id = s.pair_id AND l.section = s.section)""" if none else ""
    cte(f"{p}_report", f"{p}_sections {p}_left {mapping}", f"""
        SELECT pair_id, 1 AS section, old_line AS line,
               old_line || ' -> ' || string_agg(new_line, ', ' ORDER BY new_line) AS value
        FROM (SELECT DISTINCT pair_id, old_line, new_line FROM {mapping}) GROUP BY pair_id, old_line
        UNION ALL SELECT pair_id, section, line_no, CASE section WHEN 2 THEN 'OLD ' ELSE 'NEW ' END || line_no FROM {p}_left
        UNION ALL SELECT pair_id, section, -1, '' FROM {p}_sections
        UNION ALL SELECT pair_id, section, 0, CASE section
                    WHEN 2 THEN '# Unmatched deletions (only in OLD file):'
                    ELSE '# Unmatched additions (only in NEW file):' END FROM {p}_sections
        {nothing}""")


report_tables("hybrid", "hybrid_mapping", "filled", none=True)
report_tables("range", "range_mapping", "lines", none=False)


def statements() -> dict[str, str]:
    return {
        "version_lines": statement("lines", "SELECT pair_id, side, line_no, text, has_eol FROM lines"),
        "block_lines": statement(
            "file_lines", "SELECT pair_id, side, CAST(line_no AS BIGINT) AS line_no, text, has_eol FROM file_lines"
        ),
        "unicode_lines": shaped(statement("unicode_rows", "SELECT * FROM unicode_rows"), "replace(text, ', ', chr(8232))"),
        "long_blank_lines": shaped(
            statement("normal", "SELECT pair_id, side, line_no FROM normal WHERE pre = ''"), SENTENCES
        ),
        "long_hunks": shaped(statement("ended_hunks", "SELECT * FROM ended_hunks"), SENTENCES),
        "long_range_map": shaped(
            statement("range_mapping", """
            SELECT pair_id, old_line, new_line, kind, round(score, 6) AS score FROM range_mapping"""),
            SENTENCES,
        ),
        "doubled_hybrid_map": shaped(
            statement("hybrid_mapping", """
            SELECT pair_id, old_line, new_line, kind, round(score, 6) AS score FROM hybrid_mapping"""),
            "text",
            r"regexp_replace(b.text, '([^\n]+)', '\1' || chr(10) || '\1', 'g')",
        ),
        "replaced_bytes": r"SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', chr(65533), 'g') AS text FROM documents",
        "merge_cancelled": statement("cancelled_pieces", """
            SELECT pair_id, CASE WHEN bool_and(piece IS NOT NULL) THEN string_agg(piece, '' ORDER BY hunk_no) END AS merged
            FROM cancelled_pieces GROUP BY pair_id"""),
        "positional_compare": statement("compared", "SELECT * FROM compared"),
        "conversation_compare": statement("turns_compared", "SELECT * FROM turns_compared"),
        "positional_report": statement("compared", """
            SELECT pair_id, 1 AS section, line_no AS line, CASE status
              WHEN 'same' THEN '  Line ' || line_no || ': same    -> ' || old_text
              WHEN 'added' THEN '+ Line ' || line_no || ': added   -> ' || new_text
              WHEN 'removed' THEN '- Line ' || line_no || ': removed -> ' || old_text
              ELSE '~ Line ' || line_no || ': changed from ''' || old_text || ''' to ''' || new_text || '''' END AS value
            FROM compared"""),
        "pair_votes": statement("line_votes", "SELECT doc_id, old_id, votes FROM line_votes"),
        "ordered_report": statement("ended_hunks", """
            SELECT pair_id, 1 AS section, CAST(i1 + k AS INTEGER) AS line, (i1 + k) || ' -> ' || (j1 + k) AS value,
                   CAST(row_number() OVER (PARTITION BY pair_id ORDER BY i1 + k) AS INTEGER) AS row_no
            FROM (SELECT *, unnest(range(1, least(i2 - i1, j2 - j1) + 1)) AS k
                  FROM ended_hunks WHERE tag IN ('equal', 'replace'))"""),
        "pair_status": statement("versions", """
            SELECT o.pair_id, CAST(o.text <> n.text AS INTEGER) AS status
            FROM versions o JOIN versions n USING (pair_id) WHERE o.side = 'old' AND n.side = 'new'"""),
        "normalised_lines": statement("normal", "SELECT pair_id, side, line_no, pre FROM normal"),
        "folded_lines": statement("lines", f"""
            SELECT pair_id, side, line_no, trim(regexp_replace(lower(text), '{WHITE}', ' ', 'g')) AS folded FROM lines"""),
        "blank_lines": statement("normal", "SELECT pair_id, side, line_no FROM normal WHERE pre = ''"),
        "struct_tokens": statement("structured", """
            SELECT pair_id, side, line_no, array_to_string(tokens, ' ') AS struct_str FROM structured"""),
        "simhash_lines": statement("hashed", "SELECT pair_id, side, line_no, simhash FROM hashed"),
        "context_lines": statement("contexts", "SELECT pair_id, side, line_no, ctx FROM contexts"),
        "range_words": statement("lines", r"""
            SELECT pair_id, side, line_no, word, count(*) AS n
            FROM (SELECT pair_id, side, line_no, unnest(regexp_extract_all(text, '[\pL\pN_]+')) AS word FROM lines)
            GROUP BY ALL"""),
        "exact_blocks": statement("exact_edges", "SELECT * FROM exact_edges"),
        "hunks": statement("ended_hunks", "SELECT * FROM ended_hunks"),
        "hunk_sizes": statement(
            "ended_sizes_of", "SELECT pair_id, hunk_no, tag, left_lines, right_lines, rows FROM ended_sizes_of"
        ),
        "change_ranges": statement("plain_ranges", "SELECT * FROM plain_ranges"),
        "unmatched_lines": statement("filled exact_map", unmatched_sql("filled", "exact_map")),
        "side_by_side": statement("ended_sizes_of lines", side_by_side_sql(63, "true")),
        "side_by_side_changes": statement("ended_sizes_of lines", side_by_side_sql(38, "tag <> 'equal'")),
        "merged_text": statement(
            "pieces", "SELECT pair_id, string_agg(piece, '' ORDER BY hunk_no) AS merged FROM pieces GROUP BY pair_id"
        ),
        "dash_mapping": statement("ended_hunks", """
            SELECT pair_id, 1 AS section, CAST(i1 + k AS INTEGER) AS line, (i1 + k) || '-' || (j1 + k) AS value
            FROM (SELECT *, unnest(range(1, least(i2 - i1, j2 - j1) + 1)) AS k
                  FROM ended_hunks WHERE tag IN ('equal', 'replace'))"""),
        "range_tfidf": statement("foreign_weights", """
            SELECT pair_id, side, range_no, token, tf, df, n_ranges, round(weight, 6) AS weight FROM foreign_weights"""),
        "range_cosine": statement("foreign_cosine", """
            SELECT pair_id, old_range, new_range, round(sim, 6) AS sim FROM foreign_cosine WHERE sim > 0"""),
        "thin_map": statement("foreign_thin", """
            SELECT pair_id, old_line, new_line, round(score, 6) AS score FROM foreign_thin"""),
        "range_map": statement("range_mapping", """
            SELECT pair_id, old_line, new_line, kind, round(score, 6) AS score FROM range_mapping"""),
        "range_report": statement("range_report", "SELECT * FROM range_report"),
        "candidate_topk": statement("foreign_candidates", "SELECT * FROM foreign_candidates"),
        "context_cosine": statement("foreign_context", """
            SELECT pair_id, old_line, new_line, round(ctx_sim, 6) AS ctx_sim FROM foreign_context"""),
        "candidate_scores": statement("foreign_scores", """
            SELECT pair_id, old_line, new_line, round(score, 6) AS score FROM foreign_scores"""),
        "greedy_map": statement("foreign_greedy", """
            SELECT pair_id, old_line, new_line, round(score, 6) AS score FROM foreign_greedy"""),
        "hybrid_map": statement("hybrid_mapping", """
            SELECT pair_id, old_line, new_line, kind, round(score, 6) AS score FROM hybrid_mapping"""),
        "hybrid_report": statement("hybrid_report", "SELECT * FROM hybrid_report"),
    }
