"""SQL checks. They derive the answers from the base tables and the hand-written expectations of the templates.

Only fixed, small lists (template sizes, expectations, extensions) are written into the SQL as VALUES.
"""

from __future__ import annotations

import re

from codequarry.functions.lexicon import HTML_TILE, LEXICONS, plain_regex
from codequarry.operators.tokens import VOID_TAGS
from codequarry.plans.corpus import FILE_STEP, PARTS_PER_FILE, template_nodes, template_sizes
from codequarry.plans.templates import TEMPLATES, text_of
from codequarry.sources.languages import EXTENSIONS, LANGUAGE_OF, languages_with


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def values(name: str, columns: str, rows) -> str:
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def _expected(kind: str):
    return [
        (language, variant, i, *entry)
        for language, templates in TEMPLATES.items()
        for variant, template in enumerate(templates)
        for i, entry in enumerate(getattr(template, kind))
    ]


def _fill(text: str) -> str:
    return (
        f"replace(replace(replace({text}, '{{name}}', 'n_' || lpad(CAST(coalesce(l_partkey, 0) AS VARCHAR), 12, '0')), "
        "'{callee}', 'price_' || lpad(CAST(p_size AS VARCHAR), 2, '0')), "
        "'{module}', 'mod_' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0'))"
    )


_LANGS = list(TEMPLATES)
_LANGUAGE = f"([{', '.join(literal(x) for x in _LANGS)}])[CAST(l_suppkey % {len(_LANGS)} AS INT) + 1]"
_VARIANTS = "CASE language " + " ".join(f"WHEN '{k}' THEN {len(v) - 1}" for k, v in TEMPLATES.items()) + " END"
_EXT = "CASE language " + " ".join(f"WHEN '{k}' THEN '{EXTENSIONS[k][0]}'" for k in TEMPLATES) + " END"

# Files, and blocks with their places. Every block of a file comes after its header.
PLACED = ", ".join([
    values("sizes", "language, variant, n_nodes, n_top, n_rows, n_chars", template_sizes()),
    f"""pairs AS (SELECT DISTINCT l_suppkey, l_partkey, {_LANGUAGE} AS language,
          l_suppkey * {FILE_STEP} + l_partkey // {PARTS_PER_FILE} AS file_id
          FROM lineitem)""",
    f"""files AS (SELECT f.*, s_nationkey, 'pkg_' || s_nationkey || '/supp_' || l_suppkey || '_' || chunk || '.' || {_EXT} AS path
          FROM (SELECT DISTINCT file_id, l_suppkey, l_partkey // {PARTS_PER_FILE} AS chunk, language FROM pairs
                UNION ALL SELECT s_suppkey * {FILE_STEP} + {FILE_STEP - 1}, s_suppkey, {FILE_STEP - 1}, {_LANGUAGE.replace('l_suppkey', 's_suppkey')}
                FROM supplier WHERE s_suppkey % 10 = 9) f JOIN supplier ON s_suppkey = l_suppkey)""",
    f"""blocks AS (SELECT file_id, p.l_suppkey, l_partkey, p_size, language, 1 + l_partkey % {_VARIANTS} AS variant, s_nationkey
          FROM pairs p JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = p.l_suppkey
          UNION ALL SELECT DISTINCT file_id, p.l_suppkey, CAST(NULL AS BIGINT), 0, language, 0, s_nationkey
          FROM pairs p JOIN supplier ON s_suppkey = p.l_suppkey)""",
    """placed AS (SELECT b.*, n_nodes, n_top, n_rows, n_chars,
          1 + CAST(coalesce(sum(n_nodes) OVER w, 0) AS BIGINT) AS base_pre, CAST(coalesce(sum(n_top) OVER w, 0) AS BIGINT) AS base_top,
          CAST(coalesce(sum(n_rows) OVER w, 0) AS BIGINT) AS base_row, CAST(coalesce(sum(n_chars) OVER w, 0) AS BIGINT) AS base_idx
          FROM blocks b JOIN sizes USING (language, variant)
          WINDOW w AS (PARTITION BY file_id ORDER BY l_partkey NULLS FIRST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
])

NODES = values(
    "shape", "language, variant, ix, last_ix, parent_ix, t_depth, t_child_ix, type, field, named, is_error, is_missing, "
    "t_start_idx, t_start_row, start_col, t_end_idx, t_end_row, end_col, t_text", template_nodes(),
) + f""", nodes AS (SELECT file_id, language, base_pre + ix AS pre, base_pre + last_ix AS last_desc,
      coalesce(base_pre + parent_ix, 0) AS parent, t_depth AS depth,
      t_child_ix + CASE WHEN parent_ix IS NULL THEN base_top ELSE 0 END AS child_ix, type, field, named, is_error, is_missing,
      base_idx + t_start_idx AS start_idx, base_idx + t_end_idx AS end_idx, base_row + t_start_row AS start_row, start_col,
      base_row + t_end_row AS end_row, end_col, {_fill('t_text')} AS leaf_text
    FROM placed JOIN shape USING (language, variant)
    UNION ALL SELECT file_id, f.language, 0, coalesce(n, 0), NULL, 0, 0, 'program', NULL, true, false, false, 0, coalesce(c, 0),
      0, 0, coalesce(r, 0), 0, NULL
    FROM files f LEFT JOIN (SELECT file_id, CAST(sum(n_nodes) AS BIGINT) AS n, CAST(sum(n_rows) AS BIGINT) AS r, CAST(sum(n_chars) AS BIGINT) AS c FROM placed GROUP BY 1)
      USING (file_id))"""

STORED_NODES = NODES.replace(", nodes AS (", ", nodes AS MATERIALIZED (", 1)

SOURCES = values(
    "texts", "language, variant, t_text",
    [(k, v, text_of(x)) for k, xs in TEMPLATES.items() for v, x in enumerate(xs)],
) + f""", sources AS (SELECT file_id, path, f.language, coalesce(code, '') AS code FROM files f LEFT JOIN (
      SELECT file_id, string_agg({_fill('t_text')}, '' ORDER BY base_idx) AS code
      FROM placed JOIN texts USING (language, variant) GROUP BY 1) USING (file_id)),
    lines AS (SELECT file_id, regexp_split_to_array(code, '\\r?\\n') AS lines FROM sources)"""

DEFS = values("expect", "language, variant, ix, kind, d_name, d_start, d_end, d_row", _expected("defs")) + f""",
    defs AS (SELECT file_id, language, kind, {_fill('d_name')} AS name, base_row + d_start + 1 AS start_line,
      base_row + d_end + 1 AS end_line, base_row + d_row AS name_row, base_idx, ix FROM placed JOIN expect USING (language, variant))"""

CALLS = values("expect_calls", "language, variant, ix, d_name, d_row", _expected("calls")) + f""",
    calls AS (SELECT file_id, language, {_fill('d_name')} AS name, base_row + d_row + 1 AS line, base_idx, ix
      FROM placed JOIN expect_calls USING (language, variant))"""

IMPORTS = values("expect_imports", "language, variant, ix, d_module, d_row, d_raw", _expected("imports")) + f""",
    imports AS (SELECT file_id, language, {_fill('d_module')} AS module, base_row + d_row + 1 AS line,
      {_fill('d_raw')} AS raw FROM placed JOIN expect_imports USING (language, variant))"""


def sql(*ctes: str, select: str) -> str:
    return "WITH " + ", ".join(ctes) + " " + select


_ORDERED = "row_number() OVER (PARTITION BY file_id ORDER BY start_line, base_idx, ix)"
_SIGNATURE = "left(trim(lines[name_row + 1], E' \\t\\r\\n'), 200)"


def _slice(before: int, after: int, cap: int = 5000) -> str:
    first, last = f"greatest(start_line - {before}, 1)", f"least(end_line + {after}, len(lines))"
    return f"array_to_string(lines[{first}:least({last}, {first} + {cap - 1})], chr(10))"


def node_checks() -> dict[str, str]:
    """Checks of the operators on the node table."""
    return {
        "definitions_by_kind": sql(PLACED, DEFS, select=
            "SELECT language, kind, count(*) AS n_definitions FROM defs GROUP BY ALL"),
        "definitions_dedupe": sql(PLACED, DEFS, select=
            f"SELECT file_id, language, kind, name, start_line, end_line, {_ORDERED} AS place FROM defs"),
        "count_by_kind": sql(PLACED, DEFS, select="SELECT file_id, kind, count(*) AS n FROM defs GROUP BY ALL"),
        "file_results": sql(PLACED, DEFS, select="""
            SELECT file_id, 0 AS part, coalesce(total, 0) AS total, coalesce(kinds, '') AS kinds, coalesce(listed, '') AS listed
            FROM files LEFT JOIN (SELECT file_id, count(*) AS total,
              string_agg(kind || ' ' || name || ' ' || start_line || '-' || end_line, ';' ORDER BY start_line, base_idx, ix)
                AS listed FROM defs GROUP BY 1) USING (file_id)
            LEFT JOIN (SELECT file_id, string_agg(kind || '=' || n, ',' ORDER BY kind) AS kinds
              FROM (SELECT file_id, kind, count(*) AS n FROM defs GROUP BY 1, 2) GROUP BY 1) USING (file_id)"""),
        "by_language": sql(PLACED, DEFS, select="""
            SELECT language, count(d.kind) AS n_definitions FROM files LEFT JOIN defs d USING (file_id, language) GROUP BY 1"""),
        "by_kind": sql(PLACED, DEFS, select="SELECT kind, count(*) AS n_definitions FROM defs GROUP BY 1"),
        "scan_rollup": sql(PLACED, DEFS, select="""
            SELECT coalesce(language, '*') AS language, coalesce(kind, '*') AS kind, count(*) AS n_definitions,
              CAST(grouping(language, kind) AS INT) AS level FROM defs GROUP BY ROLLUP (language, kind)"""),
        "file_reports": sql(PLACED, DEFS, SOURCES, select=f"""
            SELECT path, language, total, coalesce(kind, '') AS kind, coalesce(name, '') AS name, coalesce(line, 0) AS line,
              coalesce(signature, '') AS signature
            FROM (SELECT file_id, path, language, (SELECT count(*) FROM defs d WHERE d.file_id = f.file_id) AS total
                  FROM files f ORDER BY path LIMIT 200) LEFT JOIN (
              SELECT file_id, kind, name, start_line AS line, {_SIGNATURE} AS signature, {_ORDERED} AS place
              FROM defs JOIN lines USING (file_id) QUALIFY place <= 20) USING (file_id)"""),
        "file_reports_all": sql(PLACED, DEFS, SOURCES, select=f"""
            SELECT path, language, coalesce(total, 0) AS total, coalesce(kind, '') AS kind, coalesce(name, '') AS name,
              coalesce(line, 0) AS line, coalesce(signature, '') AS signature
            FROM files LEFT JOIN (SELECT file_id, count(*) AS total FROM defs GROUP BY 1) USING (file_id)
            LEFT JOIN (SELECT file_id, kind, name, start_line AS line, {_SIGNATURE} AS signature
              FROM defs JOIN lines USING (file_id)) USING (file_id)"""),
        "listed_calls_all": sql(PLACED, CALLS, select="""
            SELECT file_id, name, line, row_number() OVER (PARTITION BY file_id ORDER BY base_idx, ix) AS place,
              count(*) OVER (PARTITION BY file_id) AS total FROM calls"""),
        "calls": sql(PLACED, CALLS, select="SELECT file_id, language, name, line FROM calls"),
        "listed_calls": sql(PLACED, CALLS, select="""
            SELECT file_id, name, line, place, total FROM (SELECT file_id, name, line,
              row_number() OVER (PARTITION BY file_id ORDER BY base_idx, ix) AS place,
              count(*) OVER (PARTITION BY file_id) AS total FROM calls) WHERE place <= 50"""),
        "top_callees": sql(PLACED, CALLS, select="""
            SELECT file_id, name, n, place FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY n DESC, f) AS place
              FROM (SELECT file_id, name, count(*) AS n, min((base_idx, ix)) AS f FROM calls GROUP BY 1, 2)) WHERE place <= 30"""),
        "corpus_top_callees": sql(PLACED, CALLS, select=
            "SELECT name, count(*) AS n FROM calls GROUP BY 1 ORDER BY n DESC, name LIMIT 30"),
        "language_top_callees": sql(PLACED, CALLS, select="""
            SELECT language, name, n, place FROM (SELECT language, name, count(*) AS n,
              row_number() OVER (PARTITION BY language ORDER BY count(*) DESC, name) AS place FROM calls GROUP BY 1, 2)
            WHERE place <= 10"""),
        "imports": sql(PLACED, IMPORTS, select="SELECT file_id, language, module, line, raw FROM imports"),
        "import_edges": sql(PLACED, IMPORTS, select=
            "SELECT file_id, module, count(*) AS n_imports FROM imports GROUP BY 1, 2"),
        "module_degrees": sql(PLACED, IMPORTS, select=
            "SELECT module, count(DISTINCT file_id) AS in_degree, count(*) AS n_imports FROM imports GROUP BY 1"),
        "file_degrees": sql(PLACED, IMPORTS, select="""
            SELECT file_id, count(DISTINCT module) AS out_degree FROM files LEFT JOIN imports USING (file_id) GROUP BY 1"""),
        "references": sql(PLACED, NODES, SOURCES, select="""
            , asked AS (SELECT 'n_' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS name FROM part
                        UNION SELECT 'price_' || lpad(CAST(p_size AS VARCHAR), 2, '0') FROM part)
            SELECT DISTINCT n.file_id, name, start_row + 1 AS line, start_col + 1 AS col,
              left(trim(lines[start_row + 1], E' \\t\\r\\n'), 200) AS context
            FROM nodes n JOIN asked ON nfc_normalize(leaf_text) = name JOIN lines USING (file_id)
            WHERE type IN ('identifier', 'type_identifier', 'property_identifier', 'field_identifier',
                'shorthand_property_identifier', 'name', 'constant', 'word', 'command_name')
              AND NOT EXISTS (SELECT 1 FROM nodes s WHERE s.file_id = n.file_id AND s.pre < n.pre AND n.pre <= s.last_desc
                AND s.type IN ('comment', 'string', 'template_string', 'string_fragment', 'interpreted_string_literal',
                  'raw_string_literal'))"""),
        "references_limited": sql(PLACED, NODES, select="""
            SELECT file_id, name, line, total, truncated FROM (
              SELECT file_id, name, line, count(*) OVER (PARTITION BY file_id, name) AS total,
                count(*) OVER (PARTITION BY file_id, name) > 3 AS truncated,
                row_number() OVER (PARTITION BY file_id, name ORDER BY pre) AS place
              FROM (SELECT file_id, leaf_text AS name, start_row + 1 AS line, start_col, min(pre) AS pre
                FROM nodes n WHERE leaf_text IN (SELECT 'price_' || lpad(CAST(p_size AS VARCHAR), 2, '0') FROM part)
                  AND type IN ('identifier', 'property_identifier', 'field_identifier', 'name', 'word')
                GROUP BY ALL)) WHERE place <= 3"""),
        "node_at": sql(PLACED, NODES, SOURCES, select="""
            , asked AS (SELECT DISTINCT l_suppkey * 1000000000 + l_partkey // 256 AS file_id,
                CAST(floor(l_partkey % 256 + l_discount) AS BIGINT) AS "row",
                CAST(greatest(0, floor(l_quantity / 2 - 3)) AS BIGINT) AS col FROM lineitem),
            hit AS (SELECT a.file_id, "row", col, max(pre) AS pre FROM asked a JOIN nodes n ON a.file_id = n.file_id
              AND named AND (start_row, start_col) <= ("row", col) AND ("row", col) < (end_row, end_col) GROUP BY ALL)
            SELECT a.file_id, a."row", a.col, coalesce(n.type, '') AS type, coalesce(n.start_row, -1) AS start_row,
              coalesce(n.end_col, -1) AS end_col, coalesce(substr(code, start_idx + 1, least(end_idx - start_idx, 200)), '') AS text
            FROM asked a LEFT JOIN hit h USING (file_id, "row", col)
            LEFT JOIN nodes n ON n.file_id = a.file_id AND n.pre = coalesce(h.pre, 0)
            LEFT JOIN sources s ON s.file_id = a.file_id"""),
        "references_composed": r"""
            WITH cut AS (SELECT doc_id AS file_id, regexp_extract_all(text, '[^ \t\r\n]+') AS w FROM documents),
            words AS MATERIALIZED (SELECT file_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS col FROM cut),
            names AS (SELECT DISTINCT word AS name FROM words WHERE regexp_matches(word, '[^\x00-\x7F]'))
            SELECT file_id, name, 1 AS line, col FROM words JOIN names ON nfc_normalize(word) = nfc_normalize(name)""",
        "position_errors": sql(PLACED, select="""
            SELECT l_suppkey * 1000000000 + l_partkey // 256 AS file_id, 'row and col must be finite numbers' AS error, count(*) AS n_positions
            FROM lineitem WHERE CAST(floor(l_partkey % 256 + l_discount) AS BIGINT) % 3 <> 0 GROUP BY 1"""),
        "node_at_ancestors": sql(PLACED, STORED_NODES, select="""
            , asked AS MATERIALIZED (SELECT DISTINCT l_suppkey * 1000000000 + l_partkey // 256 AS file_id,
                CAST(floor(l_partkey % 256 + l_discount) AS BIGINT) AS "row",
                CAST(greatest(0, floor(l_quantity / 2 - 3)) AS BIGINT) AS col FROM lineitem),
            inside AS MATERIALIZED (SELECT a.file_id, "row", col, coalesce(max(pre), 0) AS pre FROM asked a LEFT JOIN nodes n ON a.file_id = n.file_id
              AND named AND (start_row, start_col) <= ("row", col) AND ("row", col) < (end_row, end_col) GROUP BY ALL),
            found AS MATERIALIZED (SELECT DISTINCT file_id, pre FROM inside),
            above AS MATERIALIZED (SELECT f.file_id, f.pre, string_agg(a.type, ' ' ORDER BY a.pre DESC) AS above FROM found f
              JOIN nodes a ON a.file_id = f.file_id AND a.pre < f.pre AND f.pre <= a.last_desc GROUP BY 1, 2)
            SELECT i.file_id, i."row", i.col, coalesce(n.type, '') AS type, CASE WHEN n.pre IS NOT NULL THEN coalesce(above, '') END AS above
            FROM inside i LEFT JOIN nodes n ON n.file_id = i.file_id AND n.pre = i.pre LEFT JOIN above u ON u.file_id = i.file_id AND u.pre = i.pre"""),
        "ancestors": sql(PLACED, NODES, select="""
            SELECT n.file_id, n.pre, a.pre AS ancestor_pre, a.type AS ancestor_type, a.start_row AS ancestor_start_row,
              a.end_row AS ancestor_end_row, row_number() OVER (PARTITION BY n.file_id, n.pre ORDER BY a.pre DESC) AS rank
            FROM nodes n JOIN nodes a ON a.file_id = n.file_id AND a.pre < n.pre AND n.pre <= a.last_desc
            WHERE n.leaf_text LIKE 'price_%' QUALIFY rank <= 33"""),
        "ancestors_all": sql(PLACED, NODES, select="""
            SELECT n.file_id, n.pre, a.pre AS ancestor_pre, a.type AS ancestor_type, a.start_row AS ancestor_start_row,
              a.end_row AS ancestor_end_row, row_number() OVER (PARTITION BY n.file_id, n.pre ORDER BY a.pre DESC) AS rank
            FROM nodes n JOIN nodes a ON a.file_id = n.file_id AND a.pre < n.pre AND n.pre <= a.last_desc
            WHERE n.leaf_text LIKE 'price_%'"""),
        "tree_view_all": sql(PLACED, NODES, SOURCES, select="""
            , kids AS (SELECT file_id, parent AS pre, count(*) AS kids FROM nodes WHERE named AND parent IS NOT NULL GROUP BY 1, 2)
            SELECT n.file_id, n.pre, depth, type, CASE WHEN is_error THEN 'syntax_error' WHEN is_missing THEN 'missing' ELSE '' END AS error,
              false AS truncated, CASE WHEN kids IS NULL THEN substr(code, start_idx + 1, least(end_idx - start_idx, 80)) ELSE '' END AS text
            FROM nodes n LEFT JOIN kids USING (file_id, pre) JOIN sources USING (file_id) WHERE named"""),
        "diagnostic_summary_all": sql(PLACED, NODES, select="""
            SELECT file_id, count(*) FILTER (is_error OR is_missing) > 0 AS has_errors, count(*) FILTER (is_error OR is_missing) AS error_count,
              count(*) FILTER (is_error OR is_missing) AS listed, false AS errors_truncated FROM nodes GROUP BY 1"""),
        "tree_view": sql(PLACED, NODES, SOURCES, select="""
            , kids AS (SELECT file_id, parent AS pre, count(*) AS kids FROM nodes WHERE named AND parent IS NOT NULL GROUP BY 1, 2)
            SELECT n.file_id, n.pre, depth, type, start_row, start_col, end_row, end_col,
              CASE WHEN is_error THEN 'syntax_error' WHEN is_missing THEN 'missing' ELSE '' END AS error,
              coalesce(kids > 0 AND depth >= 3, false) AS truncated, CASE WHEN kids > 0 AND depth >= 3 THEN kids ELSE 0 END AS child_count,
              CASE WHEN kids IS NULL THEN substr(code, start_idx + 1, least(end_idx - start_idx, 80)) ELSE '' END AS text,
              kids IS NULL AND end_idx - start_idx > 80 AS text_truncated
            FROM nodes n LEFT JOIN kids USING (file_id, pre) JOIN sources USING (file_id) WHERE named AND depth <= 3"""),
        "tree_sexp": sql(PLACED, NODES, select="""
            , events AS (
              SELECT file_id, pre AS place, 0 AS side, pre AS o, CASE WHEN parent IS NULL THEN '' ELSE ' ' END
                || CASE WHEN field IS NULL THEN '' ELSE field || ': ' END
                || CASE WHEN is_missing AND named THEN '(MISSING ' || type WHEN is_missing THEN '(MISSING "' || type || '"'
                   ELSE '(' || type END AS piece FROM nodes WHERE named OR is_missing
              UNION ALL SELECT file_id, last_desc, 1, -pre, ')' FROM nodes WHERE named OR is_missing)
            SELECT file_id, string_agg(piece, '' ORDER BY place, side, o) AS sexp FROM events GROUP BY 1"""),
        "diagnostics": sql(PLACED, NODES, select="""
            SELECT file_id, pre, type, CASE WHEN is_error THEN 'error' ELSE 'missing' END AS kind, start_row, start_col, end_row,
              end_col FROM nodes WHERE is_error OR is_missing"""),
        "diagnostic_summary": sql(PLACED, NODES, select="""
            SELECT file_id, count(*) FILTER (is_error OR is_missing) > 0 AS has_errors,
              count(*) FILTER (is_error OR is_missing) AS error_count,
              least(count(*) FILTER (is_error OR is_missing), 20) AS listed,
              count(*) FILTER (is_error OR is_missing) > 20 AS errors_truncated FROM nodes GROUP BY 1"""),
        "outline": sql(PLACED, DEFS, select="""
            SELECT d.file_id, d.start_line, d.name, d.kind, count(e.kind) AS level FROM defs d
            LEFT JOIN defs e ON e.file_id = d.file_id AND e.base_idx = d.base_idx AND e.ix < d.ix AND e.end_line >= d.start_line
            GROUP BY d.file_id, d.start_line, d.name, d.kind, d.base_idx, d.ix"""),
        "outline_text": sql(PLACED, DEFS, select="""
            , leveled AS (SELECT d.file_id, d.start_line, d.base_idx, d.ix, d.name, d.kind, count(e.kind) AS level FROM defs d
              LEFT JOIN defs e ON e.file_id = d.file_id AND e.base_idx = d.base_idx AND e.ix < d.ix AND e.end_line >= d.start_line
              GROUP BY ALL)
            SELECT file_id, 0 AS part, '# ' || path || ' [' || language || ']' || chr(10) || '# ' || coalesce(n, 0) || ' definitions'
              || coalesce(chr(10) || body, '') AS outline
            FROM files LEFT JOIN (SELECT file_id, count(*) AS n, string_agg(repeat('  ', CAST(level AS INT)) || 'L' || start_line
              || ': ' || kind || ' ' || name, chr(10) ORDER BY start_line, base_idx, ix) AS body FROM leveled GROUP BY 1)
            USING (file_id)"""),
        "signature": sql(PLACED, DEFS, SOURCES, select=
            f"SELECT file_id, name, kind, start_line, {_SIGNATURE} AS signature FROM defs JOIN lines USING (file_id)"),
        "body": sql(PLACED, DEFS, SOURCES, select=
            f"SELECT file_id, name, kind, start_line, {_slice(1, 2)} AS body FROM defs JOIN lines USING (file_id)"),
        "context": sql(PLACED, DEFS, SOURCES, select=
            f"SELECT file_id, name, kind, start_line, {_slice(2, 0)} AS context FROM defs JOIN lines USING (file_id)"),
        "structural_query": sql(PLACED, STORED_NODES, select="""
            , called AS MATERIALIZED (SELECT file_id, pre FROM nodes WHERE type IN ('call', 'call_expression') AND named),
            named_by AS MATERIALIZED (SELECT file_id, pre, parent, type, leaf_text FROM nodes WHERE field = 'function' AND type = 'identifier'),
            given AS MATERIALIZED (SELECT file_id, pre, parent FROM nodes WHERE field = 'arguments' AND named),
            numbers AS MATERIALIZED (SELECT file_id, parent, count(*) AS n FROM nodes WHERE type = 'number' AND named GROUP BY 1, 2)
            SELECT c.file_id, c.pre AS match_pre, f.pre AS capture_pre, 'callee' AS name, f.type, left(f.leaf_text, 200) AS text
            FROM called c JOIN named_by f ON f.file_id = c.file_id AND f.parent = c.pre
            JOIN given a ON a.file_id = c.file_id AND a.parent = c.pre
            JOIN (SELECT file_id, parent, unnest(range(n)) AS k FROM numbers) k ON k.file_id = a.file_id AND k.parent = a.pre"""),
        "structural_query_text": sql(PLACED, NODES, select="""
            SELECT file_id, 0 AS pattern_index, pre AS match_pre, pre AS capture_pre, 'cheap' AS name, leaf_text AS text FROM nodes
            WHERE type IN ('identifier', 'property_identifier') AND regexp_matches(leaf_text, '^price_[0-3]')
            UNION ALL SELECT c.file_id, 1, c.pre, f.pre, 'named', f.leaf_text FROM nodes c JOIN nodes f ON f.file_id = c.file_id
              AND f.parent = c.pre AND f.field = 'function' WHERE c.type = 'call' AND f.named AND f.leaf_text IN ('price_01', 'price_02')
            UNION ALL SELECT c.file_id, 2, c.pre, f.pre, 'member', f.leaf_text FROM nodes c JOIN nodes f ON f.file_id = c.file_id
              AND f.parent = c.pre WHERE c.type = 'attribute' AND f.type = 'identifier' AND f.leaf_text <> 'self'"""),
        "structural_query_quantifiers": sql(PLACED, NODES, select="""
            SELECT file_id, 0 AS pattern_index, a.pre AS match_pre, count(k.pre) AS n_captures FROM nodes a LEFT JOIN (SELECT file_id, pre,
                parent FROM nodes WHERE type IN ('number', 'int_literal', 'integer')) k USING (file_id)
              WHERE a.type IN ('argument_list', 'arguments') AND k.parent = a.pre GROUP BY 1, 3
            UNION ALL SELECT file_id, 0, pre, 0 FROM nodes a WHERE type IN ('argument_list', 'arguments') AND NOT EXISTS (SELECT 1 FROM nodes k
              WHERE k.file_id = a.file_id AND k.parent = a.pre AND k.type IN ('number', 'int_literal', 'integer'))
            UNION ALL SELECT c.file_id, 1, c.pre, 1 + count(b.pre) FROM nodes c JOIN nodes n ON n.file_id = c.file_id AND n.parent = c.pre
                AND n.field = 'name' AND n.named
              LEFT JOIN (SELECT * FROM nodes x WHERE field = 'body' AND named AND NOT EXISTS (SELECT 1 FROM nodes y WHERE y.file_id = x.file_id
                AND y.parent = x.parent AND y.named AND y.child_ix > x.child_ix)) b ON b.file_id = c.file_id AND b.parent = c.pre
              WHERE c.type IN ('class_declaration', 'class_specifier', 'class_definition', 'class') AND NOT EXISTS (SELECT 1 FROM nodes y
                WHERE y.file_id = n.file_id AND y.parent = n.parent AND y.named AND y.child_ix < n.child_ix) AND c.named
              GROUP BY c.file_id, c.pre"""),
        "structural_query_captures": sql(PLACED, NODES, SOURCES, select="""
            SELECT file_id, pre AS capture_pre, type, start_row, start_col, end_row, end_col,
              substr(code, start_idx + 1, least(end_idx - start_idx, 200)) AS text
            FROM nodes JOIN sources USING (file_id) WHERE type IN ('class_body', 'declaration_list', 'compound_statement', 'block')"""),
        "structural_query_alternatives": sql(PLACED, CALLS, select=
            "SELECT file_id, 0 AS pattern_index, name AS callee, line FROM calls"),
        "structural_query_compared": sql(PLACED, STORED_NODES, SOURCES, select="""
            , passed AS MATERIALIZED (SELECT f.file_id, f.pre AS match_pre, p.pre AS left_pre, a.pre AS right_pre,
                substr(code, p.start_idx + 1, p.end_idx - p.start_idx) AS x, substr(code, a.start_idx + 1, a.end_idx - a.start_idx) AS y
              FROM nodes f JOIN nodes p ON p.file_id = f.file_id AND p.parent = f.pre AND p.field = 'parameters' AND p.named
              JOIN nodes b ON b.file_id = f.file_id AND b.parent = f.pre AND b.field = 'body' AND b.named
              JOIN nodes s ON s.file_id = f.file_id AND s.parent = b.pre AND s.named
              JOIN nodes c ON c.file_id = f.file_id AND c.parent = s.pre AND c.named AND c.type IN ('call', 'call_expression')
              JOIN nodes a ON a.file_id = f.file_id AND a.parent = c.pre AND a.field = 'arguments' AND a.named
              JOIN sources z ON z.file_id = f.file_id WHERE f.named),
            beside AS MATERIALIZED (SELECT file_id, parent AS match_pre, pre AS left_pre, lead(pre) OVER w AS right_pre, type AS t,
                lead(type) OVER w AS u, leaf_text AS x, lead(leaf_text) OVER w AS y
              FROM nodes WHERE named AND parent IS NOT NULL WINDOW w AS (PARTITION BY file_id, parent ORDER BY child_ix))
            SELECT file_id, CASE WHEN x = y THEN 0 ELSE 1 END AS pattern_index, match_pre, left_pre, right_pre, left(y, 200) AS text FROM passed
            UNION ALL SELECT file_id, 2, match_pre, left_pre, right_pre, left(y, 200) FROM beside WHERE x <> y
              AND t IN ('identifier', 'type_identifier', 'property_identifier') AND u IN ('identifier', 'type_identifier', 'property_identifier')"""),
        "user_rules": sql(PLACED, NODES, select="""
            SELECT DISTINCT n.file_id, CASE p.type WHEN 'parameters' THEN 'module' WHEN 'decorator' THEN 'type' ELSE 'function' END AS kind,
              n.leaf_text AS name, CASE WHEN p.type = 'function_definition' THEN g.start_row ELSE p.start_row END + 1 AS start_line,
              CASE WHEN p.type = 'function_definition' THEN g.end_row ELSE p.end_row END + 1 AS end_line
            FROM nodes n JOIN nodes p ON p.file_id = n.file_id AND p.pre = n.parent JOIN nodes g ON g.file_id = p.file_id AND g.pre = p.parent
            WHERE n.type = 'identifier' AND n.language = 'python' AND (p.type IN ('parameters', 'decorator')
              OR (p.type = 'function_definition' AND n.field = 'name' AND g.type = 'decorated_definition'))"""),
        "structural_query_limited": sql(PLACED, NODES, select="""
            SELECT * FROM (SELECT file_id, pre AS match_pre, count(*) OVER (PARTITION BY file_id) AS total,
              count(*) OVER (PARTITION BY file_id) > 5 AS truncated, row_number() OVER (PARTITION BY file_id ORDER BY pre) AS rank
              FROM nodes WHERE type IN ('call', 'call_expression', 'method_invocation')) WHERE rank <= 5"""),
        "structural_query_absent": sql(PLACED, STORED_NODES, select="""
            , held AS MATERIALIZED (SELECT file_id, pre FROM nodes WHERE named
              AND type IN ('struct_item', 'enum_item', 'class_declaration', 'type_alias_declaration')),
            names AS MATERIALIZED (SELECT file_id, parent, leaf_text FROM nodes WHERE field = 'name' AND named),
            bodies AS MATERIALIZED (SELECT DISTINCT file_id, parent FROM nodes WHERE field = 'body')
            SELECT c.file_id, c.pre AS match_pre, n.leaf_text AS text FROM held c
            JOIN names n ON n.file_id = c.file_id AND n.parent = c.pre
            LEFT JOIN bodies b ON b.file_id = c.file_id AND b.parent = c.pre WHERE b.parent IS NULL"""),
        "structural_query_siblings": sql(PLACED, NODES, select="""
            SELECT a.file_id, a.parent AS match_pre, a.leaf_text AS left_text, b.leaf_text AS right_text
            FROM nodes a JOIN nodes b ON b.file_id = a.file_id AND b.parent = a.parent AND b.child_ix > a.child_ix
            WHERE a.type IN ('type_identifier', 'primitive_type') AND b.named AND b.type IN ('identifier', 'type_identifier')
              AND NOT EXISTS (SELECT 1 FROM nodes m WHERE m.file_id = a.file_id AND m.parent = a.parent AND m.named
                AND m.child_ix > a.child_ix AND m.child_ix < b.child_ix)"""),
    }


# ---------------------------------------------------------------- pages
PAGE_TOKENS = f"""
    cut AS (SELECT page_id AS file_id, regexp_extract_all(html, {literal(plain_regex(HTML_TILE))}) AS tiles FROM pages),
    tiles AS (SELECT file_id, unnest(range(len(tiles))) AS pos, unnest(tiles) AS text FROM cut),
    placed_tiles AS (SELECT *, CAST(coalesce(sum(length(text)) OVER w, 0) AS BIGINT) AS start_idx,
        CAST(coalesce(sum(length(text) - length(replace(text, chr(10), ''))) OVER w, 0) AS BIGINT) AS "row",
        coalesce(string_agg(text, '') OVER w, '') AS before FROM tiles
        WINDOW w AS (PARTITION BY file_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    tagged AS (SELECT file_id, pos, text, start_idx, "row",
        CASE WHEN contains(before, chr(10)) THEN strpos(reverse(before), chr(10)) - 1 ELSE length(before) END AS col,
        lower(regexp_extract(text, '^</?([A-Za-z][^\\s/>]*)', 1)) AS tag FROM placed_tiles),
    toks AS (SELECT *, CASE WHEN text NOT LIKE '<%' OR text = '<' THEN 'text' WHEN text LIKE '<!--%-->' THEN 'comment'
        WHEN regexp_matches(text, '^(?i:<script\\b[^>]*>[\\s\\S]*</script)') THEN tag || '_element'
        WHEN regexp_matches(text, '^(?i:<style\\b[^>]*>[\\s\\S]*</style)') THEN tag || '_element'
        WHEN text LIKE '<!%' THEN 'doctype' WHEN text LIKE '</%' THEN 'close'
        WHEN tag IN ({', '.join(literal(t) for t in VOID_TAGS)}) THEN 'void' WHEN text LIKE '%/>' THEN 'self_closing'
        ELSE 'open' END AS kind FROM tagged)"""

PAGE_PAIRS = """
    sides AS (SELECT *, CASE kind WHEN 'open' THEN 1 ELSE -1 END AS side FROM toks WHERE kind IN ('open', 'close')),
    leveled AS (SELECT *, sum(side) OVER (PARTITION BY file_id, tag ORDER BY pos) + CASE side WHEN 1 THEN 0 ELSE 1 END AS level
        FROM sides),
    linked AS (SELECT *, lead(side) OVER v AS next_side, lead(pos) OVER v AS next_pos, lag(side) OVER v AS last_side FROM leveled
        WINDOW v AS (PARTITION BY file_id, tag, level ORDER BY pos)),
    pairs AS (SELECT file_id, tag AS pair_kind, pos, CASE WHEN side = 1 AND next_side = -1 THEN 'paired' WHEN side = 1 THEN 'missing'
        ELSE 'error' END AS status, CASE WHEN side = 1 AND next_side = -1 THEN next_pos ELSE -1 END AS close_pos,
        CAST(level - 1 AS BIGINT) AS depth FROM linked WHERE side = 1 OR coalesce(last_side, -1) <> 1)"""

# Crossing pairs are found pair by pair here, unlike in the operator: each is compared with all others.
PAGE_NODES = """
    paired AS (SELECT file_id, pos, close_pos FROM pairs WHERE status = 'paired'),
    nested AS (SELECT * FROM paired p WHERE NOT EXISTS (SELECT 1 FROM paired q WHERE q.file_id = p.file_id
        AND ((q.pos < p.pos AND p.pos < q.close_pos AND q.close_pos < p.close_pos)
          OR (p.pos < q.pos AND q.pos < p.close_pos AND p.close_pos < q.close_pos)))),
    kept AS (SELECT t.*, o.close_pos, c.pos AS open_pos FROM toks t LEFT JOIN nested o ON o.file_id = t.file_id AND o.pos = t.pos
        LEFT JOIN nested c ON c.file_id = t.file_id AND c.close_pos = t.pos
        WHERE kind <> 'text' OR regexp_matches(text, '[^ \\t\\r\\n\\f]')),
    ends AS (SELECT *, "row" + length(text) - length(replace(text, chr(10), '')) AS end_row,
        CASE WHEN contains(text, chr(10)) THEN strpos(reverse(text), chr(10)) - 1 ELSE col + length(text) END AS end_col,
        CAST(sum(CASE WHEN close_pos IS NULL THEN 1 ELSE 2 END) OVER (PARTITION BY file_id ORDER BY pos) AS BIGINT) AS pre FROM kept),
    flat AS (
      SELECT file_id, pos, pre, pre AS last_desc, CASE WHEN close_pos IS NOT NULL OR kind = 'open' THEN 'start_tag'
          WHEN open_pos IS NOT NULL THEN 'end_tag' WHEN kind = 'close' THEN 'erroneous_end_tag' WHEN kind = 'void' THEN 'element'
          WHEN kind = 'self_closing' THEN 'self_closing_tag' ELSE kind END AS type,
        kind = 'close' AND open_pos IS NULL AS is_error, kind = 'open' AND close_pos IS NULL AS is_missing,
        start_idx, start_idx + length(text) AS end_idx, "row" AS start_row, col AS start_col, end_row, end_col, text AS leaf_text FROM ends
      UNION ALL SELECT o.file_id, o.pos, o.pre - 1, c.pre, 'element', false, false, o.start_idx, c.start_idx + length(c.text),
        o."row", o.col, c.end_row, c.end_col, '' FROM ends o JOIN ends c ON c.file_id = o.file_id AND c.pos = o.close_pos),
    boxes AS (SELECT file_id, pre, last_desc FROM flat WHERE type = 'element' AND leaf_text = ''),
    owned AS (SELECT f.file_id, f.pre, coalesce(max(b.pre), 0) AS parent, count(b.pre) + 1 AS depth FROM flat f LEFT JOIN boxes b
        ON b.file_id = f.file_id AND b.pre < f.pre AND f.pre <= b.last_desc GROUP BY 1, 2),
    nodes AS (SELECT flat.* EXCLUDE (pos), parent, depth,
        row_number() OVER (PARTITION BY file_id, parent ORDER BY pre) - 1 AS child_ix FROM flat JOIN owned USING (file_id, pre)
      UNION ALL BY NAME SELECT page_id AS file_id, 0 AS pre, coalesce((SELECT max(last_desc) FROM flat WHERE file_id = page_id), 0) AS last_desc,
        'document' AS type, false AS is_error, false AS is_missing, 0 AS start_idx, length(html) AS end_idx, 0 AS start_row, 0 AS start_col,
        length(html) - length(replace(html, chr(10), '')) AS end_row,
        CASE WHEN contains(html, chr(10)) THEN strpos(reverse(html), chr(10)) - 1 ELSE length(html) END AS end_col, '' AS leaf_text,
        -1 AS parent, 0 AS depth, 0 AS child_ix FROM pages)"""


def page_checks() -> dict[str, str]:
    """Checks of tokens, pairs and tree views on markup pages."""
    # stored, or each use of the nodes would run the whole chain again
    chain = tuple(re.sub(r"\b(toks|sides|pairs|nested|kept|nodes) AS \(", r"\1 AS MATERIALIZED (", x) for x in (PAGE_TOKENS, PAGE_PAIRS, PAGE_NODES))
    kids = "kids AS (SELECT file_id, parent AS pre, count(*) AS kids FROM nodes WHERE parent >= 0 GROUP BY 1, 2)"
    return {
        "page_tokens": sql(PAGE_TOKENS, select="SELECT file_id, pos, kind, tag, text, start_idx, \"row\", col FROM toks"),
        "page_pairs": sql(PAGE_TOKENS, PAGE_PAIRS, select="SELECT file_id, pair_kind, pos, status, close_pos, depth FROM pairs"),
        "element_nodes": sql(*chain, select="""SELECT file_id, pre, last_desc, parent, depth, child_ix, type, is_error, is_missing,
            start_idx, end_idx, start_row, start_col, end_row, end_col, leaf_text FROM nodes"""),
        "page_tree_view": sql(*chain, kids, select="""
            SELECT n.file_id, n.pre, depth, type, CASE WHEN is_error THEN 'syntax_error' WHEN is_missing THEN 'missing' ELSE '' END AS error,
              coalesce(kids > 0 AND depth >= 4, false) AS truncated, CASE WHEN kids > 0 AND depth >= 4 THEN kids ELSE 0 END AS child_count,
              CASE WHEN kids IS NULL THEN left(leaf_text, 80) ELSE '' END AS text
            FROM nodes n LEFT JOIN kids USING (file_id, pre) WHERE depth <= 4"""),
        "page_tree_view_all": sql(*chain, kids, select="""
            SELECT n.file_id, n.pre, depth, type, CASE WHEN is_error THEN 'syntax_error' WHEN is_missing THEN 'missing' ELSE '' END AS error,
              false AS truncated, CASE WHEN kids IS NULL THEN left(leaf_text, 80) ELSE '' END AS text
            FROM nodes n LEFT JOIN kids USING (file_id, pre)"""),
        "page_diagnostic_summary_all": sql(*chain, select="""
            SELECT file_id, count(*) FILTER (is_error OR is_missing) > 0 AS has_errors, count(*) FILTER (is_error OR is_missing) AS error_count,
              count(*) FILTER (is_error OR is_missing) AS listed, false AS errors_truncated FROM nodes GROUP BY 1"""),
        "page_tree_sexp": sql(*chain, select="""
            , events AS (SELECT file_id, pre AS place, 0 AS side, pre AS o, CASE WHEN pre = 0 THEN '' ELSE ' ' END
                || CASE WHEN is_missing THEN '(MISSING ' ELSE '(' END || type AS piece FROM nodes
              UNION ALL SELECT file_id, last_desc, 1, -pre, ')' FROM nodes)
            SELECT file_id, string_agg(piece, '' ORDER BY place, side, o) AS sexp FROM events GROUP BY 1"""),
        "page_diagnostics": sql(*chain, select="""
            SELECT file_id, pre, type, CASE WHEN is_error THEN 'error' ELSE 'missing' END AS kind, start_row, start_col, end_row,
              end_col FROM nodes WHERE is_error OR is_missing"""),
        "page_diagnostic_summary": sql(*chain, select="""
            SELECT file_id, count(*) FILTER (is_error OR is_missing) > 0 AS has_errors,
              count(*) FILTER (is_error OR is_missing) AS error_count,
              least(count(*) FILTER (is_error OR is_missing), 2) AS listed,
              count(*) FILTER (is_error OR is_missing) > 2 AS errors_truncated FROM nodes GROUP BY 1"""),
    }


# ---------------------------------------------------------------- raw text
def _per_language(choose) -> str:
    return "CASE language " + " ".join(
        f"WHEN {literal(k)} THEN {literal(choose(v))}" for k, v in LEXICONS.items()) + " END"


def _code_tokens() -> str:
    # One regular expression per language, hence one branch per language.
    branches = " UNION ALL ".join(
        f"SELECT file_id, language, regexp_extract_all(code, {literal(plain_regex(x.tile))}) AS tiles FROM sources "
        f"WHERE language = {literal(k)}" for k, x in LEXICONS.items())
    hashes = ", ".join(literal(k) for k, v in LEXICONS.items() if any(c.startswith("#") for c in v.comments))
    return f"""
    cut AS ({branches}),
    tiles AS (SELECT file_id, language, unnest(range(len(tiles))) AS pos, unnest(tiles) AS text FROM cut),
    spread AS (SELECT *, CAST(coalesce(sum(length(text)) OVER w, 0) AS BIGINT) AS start_idx,
        CAST(coalesce(sum(length(text) - length(replace(text, chr(10), ''))) OVER w, 0) AS BIGINT) AS "row" FROM tiles
        WINDOW w AS (PARTITION BY file_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    starts AS (SELECT file_id, unnest(range(len(lines))) AS "row", unnest(lines) AS line FROM
        (SELECT file_id, string_split(code, chr(10)) AS lines FROM sources)),
    begins AS (SELECT file_id, "row", CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY file_id ORDER BY "row"
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begin FROM starts),
    toks AS (SELECT t.file_id, language, pos, text, start_idx, t."row", start_idx - begin AS col,
        CASE WHEN regexp_matches(text, '^[ \\t\\r\\n\\f]') THEN 'space'
          WHEN length(text) > 1 AND left(text, 1) IN ('"', chr(39), '`') THEN 'string'
          WHEN length(text) > 1 AND left(text, 1) = '/' THEN 'comment'
          WHEN left(text, 1) = '#' AND language IN ({hashes}) THEN 'comment'
          WHEN regexp_matches(text, '^[\\p{{L}}\\p{{M}}\\p{{N}}_]') OR (left(text, 1) = '$' AND length(text) > 1) THEN 'word'
          ELSE 'other' END AS kind
        FROM spread t JOIN begins b ON b.file_id = t.file_id AND b."row" = t."row")"""


def text_checks() -> dict[str, str]:
    """Checks of the operators on raw text; the lexical ones must find what the templates promise."""
    nodes = node_checks()
    tokens = (PLACED, SOURCES, _code_tokens())
    return {
        "lexical_definitions": sql(PLACED, DEFS, select="SELECT file_id, language, kind, name, start_line, end_line FROM defs"),
        "lexical_calls": nodes["calls"],
        "lexical_imports": nodes["imports"],
        "lexical_references": nodes["references"],
        "source_tokens": sql(*tokens, select=
            "SELECT file_id, pos, kind, text, start_idx, \"row\", col FROM toks WHERE kind <> 'space'"),
        "source_bracket_pairs": sql(*tokens, select="""
            , sides AS (SELECT file_id, start_idx, translate(text, ')]}', '([{') AS pair_kind,
                CASE WHEN text IN ('(', '[', '{') THEN 1 ELSE -1 END AS side FROM toks
                WHERE kind = 'other' AND text IN ('(', '[', '{', ')', ']', '}')),
            leveled AS (SELECT *, sum(side) OVER (PARTITION BY file_id, pair_kind ORDER BY start_idx)
                + CASE side WHEN 1 THEN 0 ELSE 1 END AS level FROM sides),
            linked AS (SELECT *, lead(side) OVER v AS next_side, lead(start_idx) OVER v AS next_idx, lag(side) OVER v AS last_side
                FROM leveled WINDOW v AS (PARTITION BY file_id, pair_kind, level ORDER BY start_idx))
            SELECT file_id, pair_kind, start_idx, CASE WHEN side = 1 AND next_side = -1 THEN 'paired' WHEN side = 1 THEN 'missing'
              ELSE 'error' END AS status, CASE WHEN side = 1 AND next_side = -1 THEN next_idx ELSE -1 END AS close_idx
            FROM linked WHERE side = 1 OR coalesce(last_side, -1) <> 1"""),
        "page_script_calls": r"""
            WITH scripts AS (SELECT page_id, unnest(regexp_extract_all(html, '<script[^>]*>([\s\S]*?)</script>', 1)) AS code,
                unnest(range(len(regexp_extract_all(html, '<script[^>]*>([\s\S]*?)</script>')))) AS n FROM pages),
            bare AS (SELECT page_id, n, regexp_replace(code, '"[^"]*"', '""', 'g') AS code FROM scripts)
            SELECT page_id || ':' || n AS file_id, unnest(regexp_extract_all(code, '([A-Za-z_]+)\(', 1)) AS name, 1 AS line,
              (SELECT strpos(s.code, 'track(') - 1 FROM scripts s WHERE s.page_id = b.page_id AND s.n = b.n) AS col FROM bare b""",
    }


# ---------------------------------------------------------------- lines, files, languages
_EXT_LIST = "[" + ", ".join(literal(x) for x in sorted(LANGUAGE_OF)) + "]"
_FOLDERS = ["", "src/", "node_modules/", "build/", "builds/", "outer/", "out/", "a/.git/", ".hid/", "x/venv/y/", "dist."]
_STEMS = ["f", "_f", ".f", "lib.min", "g.map", "build"]
PATHS = values("languages", "ext, language", LANGUAGE_OF.items()) + f""",
    keys AS (SELECT DISTINCT l_suppkey AS k, l_partkey % 64 AS p FROM lineitem),
    named AS (SELECT k, p, CASE WHEN k % 13 = 0 THEN 'xyz' ELSE ({_EXT_LIST})[CAST((k + p) % {len(LANGUAGE_OF)} AS INT) + 1] END AS e,
      ([{', '.join(literal(x) for x in _FOLDERS)}])[CAST(p % {len(_FOLDERS)} AS INT) + 1] AS folder,
      ([{', '.join(literal(x) for x in _STEMS)}])[CAST(k % {len(_STEMS)} AS INT) + 1] AS stem FROM keys),
    paths AS (SELECT k, p, 'pkg_' || k || '/' || folder || stem || p || '.' || CASE WHEN k % 11 = 0 THEN upper(e) ELSE e END AS path,
      folder, stem, CASE WHEN k % 17 = 0 THEN 10485760 + p % 2 ELSE k * 10 END AS length, k % 19 = 0 AS has_nul,
      CASE WHEN k % 5 = 0 THEN CASE p % 3 WHEN 0 THEN 'PY' WHEN 1 THEN 'rust' ELSE 'cobol' END END AS given, e,
      CASE WHEN k % 11 = 0 THEN upper(e) ELSE e END AS shown FROM named),
    included AS (SELECT * FROM paths WHERE folder NOT IN ('a/.git/', '.hid/') AND (stem NOT LIKE '.%' OR folder = 'dist.')
      AND shown IN (SELECT ext FROM languages)),
    selected AS (SELECT * FROM included WHERE folder NOT IN ('node_modules/', 'build/', 'out/', 'x/venv/y/')),
    judged AS (SELECT s.*, language, CASE WHEN length > 10485760 THEN 'file too large: ' || length WHEN has_nul
      THEN 'binary file: NUL byte' END AS error FROM selected s JOIN languages ON ext = e
      WHERE language NOT IN ('json', 'yaml', 'html', 'css'))"""


# The corpus as files: odd places, types, sizes and bytes by the key.
SCANNED = """scan AS (SELECT file_id, path || CASE WHEN file_id % 23 = 3 THEN '.json' ELSE '' END AS path,
      CASE WHEN file_id % 23 = 3 THEN 'json' ELSE language END AS language, file_id % 23 <> 3 AS asked,
      CASE WHEN file_id % 31 = 1 THEN 'file too large: 10485761' WHEN file_id % 29 = 1 THEN 'binary file: NUL byte' END AS fault
    FROM files WHERE file_id % 23 NOT IN (1, 2, 4))"""


def file_checks() -> dict[str, str]:
    """Checks of line operators on documents, and of path, size and language rules."""
    docs = "docs AS (SELECT doc_id, n_chars, regexp_split_to_array(text, '\\r?\\n') AS lines, text FROM documents)"
    cap = {"definition": set(languages_with("definition")), "call": set(languages_with("call")),
           "import": set(languages_with("import"))}
    able = values("able", "language, has_definition_rules, has_call_rules, has_import_rules, extensions", [
        (k, k in cap["definition"], k in cap["call"], k in cap["import"], " ".join(sorted(v))) for k, v in EXTENSIONS.items()])
    return {
        "source_lines": f"WITH {docs} SELECT doc_id AS file_id, unnest(range(len(lines))) + 1 AS line_no, unnest(lines) AS text FROM docs",
        "line_at": f"""WITH {docs} SELECT doc_id AS file_id, n_chars % 7 AS "row", coalesce(lines[n_chars % 7 + 1], '') AS text FROM docs""",
        "line_slice": f"""WITH {docs}, asked AS (SELECT *, n_chars % 5 - 1 AS f, n_chars % 5 + doc_id % 4 AS l FROM docs),
            cut AS (SELECT *, lines[greatest(f, 1):least(l, len(lines))] AS got FROM asked)
            SELECT doc_id AS file_id, f AS first, l AS last, coalesce(array_to_string(got[1:2], chr(10)), '') AS text, len(got) > 2 AS truncated
            FROM cut""",
        "line_slice_all": f"""WITH {docs}, asked AS (SELECT *, n_chars % 5 - 1 AS f, n_chars % 5 + doc_id % 4 AS l FROM docs)
            SELECT doc_id AS file_id, f AS first, l AS last, coalesce(array_to_string(lines[greatest(f, 1):least(l, len(lines))], chr(10)), '')
              AS text, false AS truncated FROM asked""",
        "include_paths": sql(PATHS, select="SELECT path FROM included"),
        "include_language": sql(PATHS, select="SELECT path FROM included WHERE shown IN ('cc', 'cpp', 'cxx', 'hpp', 'hxx', 'hh')"),
        "include_patterns": sql(PATHS, select="""SELECT path FROM paths WHERE folder NOT IN ('a/.git/', '.hid/')
            AND (stem NOT LIKE '.%' OR folder = 'dist.') AND ((folder = 'src/' AND shown IN ('py', 'js'))
            OR (k BETWEEN 10 AND 19 AND folder = '' AND stem = 'f' AND shown = 'go'))"""),
        "exclude_paths": sql(PATHS, select="""SELECT path FROM paths WHERE folder NOT IN ('node_modules/', 'build/', 'out/', 'a/.git/',
            'x/venv/y/', 'outer/')"""),
        "cap_files": sql(PATHS, select="SELECT path FROM selected ORDER BY path LIMIT 500"),
        "detect_language": sql(PATHS, select="""SELECT path, coalesce(CASE given WHEN 'PY' THEN 'python' WHEN 'rust' THEN 'rust'
            WHEN 'cobol' THEN NULL ELSE language END, '') AS language, CASE WHEN given = 'cobol' THEN 'unknown language: cobol'
            WHEN given IS NULL AND language IS NULL THEN 'no language for extension: ' || lower(shown) ELSE '' END AS language_error
            FROM paths LEFT JOIN languages ON ext = lower(shown)"""),
        "language_filter": sql(PATHS, select="""SELECT path FROM paths JOIN languages ON ext = lower(shown)
            WHERE language NOT IN ('json', 'yaml', 'html', 'css')"""),
        "admit": sql(PATHS, select="SELECT path, length FROM paths WHERE length <= 10485760 AND NOT has_nul"),
        "scan_errors": sql(PATHS, select=
            "SELECT path, 'admit' AS stage, error FROM judged WHERE error IS NOT NULL ORDER BY path LIMIT 200"),
        "scan_errors_all": sql(PATHS, select="SELECT path, 'admit' AS stage, error FROM judged WHERE error IS NOT NULL"),
        "scan_summary": sql(PATHS, PLACED, DEFS, select="""
            SELECT (SELECT count(*) FROM selected) AS files_matched, (SELECT count(*) FROM judged WHERE error IS NULL) AS files_scanned,
              (SELECT count(*) > 200 FROM judged WHERE error IS NULL) AS files_truncated, (SELECT count(*) FROM defs) AS total_definitions,
              (SELECT count(error) FROM judged) AS n_errors, (SELECT count(error) > 200 FROM judged) AS errors_truncated"""),
        "scan_files": sql(PLACED, DEFS, SCANNED, select="""
            SELECT path, language, asked AND fault IS NULL AS scanned, CASE WHEN asked THEN coalesce(fault, '') ELSE '' END AS error,
              CASE WHEN asked AND fault IS NULL THEN coalesce(total, 0) ELSE -1 END AS total
            FROM scan LEFT JOIN (SELECT file_id, count(*) AS total FROM defs GROUP BY 1) USING (file_id)"""),
        "scan_reports": sql(PLACED, DEFS, SOURCES, SCANNED, select=f"""
            SELECT scan.path, scan.language, coalesce(total, 0) AS total, coalesce(kind, '') AS kind, coalesce(name, '') AS name,
              coalesce(line, 0) AS line, coalesce(signature, '') AS signature
            FROM scan LEFT JOIN (SELECT file_id, count(*) AS total FROM defs GROUP BY 1) USING (file_id)
            LEFT JOIN (SELECT file_id, kind, name, start_line AS line, {_SIGNATURE} AS signature
              FROM defs JOIN lines USING (file_id)) USING (file_id) WHERE asked AND fault IS NULL"""),
        "scan_totals": sql(PLACED, DEFS, SCANNED, select="""
            SELECT count(*) AS files_matched, count(*) FILTER (asked AND fault IS NULL) AS files_scanned,
              count(*) FILTER (asked AND fault IS NULL) > 200 AS files_truncated,
              (SELECT count(*) FROM defs JOIN scan USING (file_id) WHERE asked AND fault IS NULL) AS total_definitions,
              count(*) FILTER (asked AND fault IS NOT NULL) AS n_errors, count(*) FILTER (asked AND fault IS NOT NULL) > 200 AS errors_truncated
            FROM scan"""),
        "scan_definitions": sql(PLACED, DEFS, SCANNED, select="""
            SELECT scan.language, count(defs.name) AS n_definitions FROM scan LEFT JOIN defs USING (file_id)
            WHERE asked AND fault IS NULL GROUP BY 1"""),
        "scanned_languages": sql(PATHS, select="SELECT language, count(*) AS n_files FROM judged WHERE error IS NULL GROUP BY 1"),
        "capabilities": sql(PLACED, able, select="""SELECT a.*, count(f.file_id) AS n_files FROM able a LEFT JOIN files f USING (language)
            GROUP BY ALL"""),
        "unsupported_files": sql(PATHS, values("gaps", "family, language", [
            (f, k) for f in ("definition", "call", "import") for k in EXTENSIONS if k not in cap[f]]),
            """found AS (SELECT path, CASE given WHEN 'PY' THEN 'python' WHEN 'rust' THEN 'rust' WHEN 'cobol' THEN NULL ELSE language END
              AS language FROM paths LEFT JOIN languages ON ext = lower(shown))""",
            select="SELECT path AS file_id, 'no ' || family || ' rules for ' || language AS error FROM found JOIN gaps USING (language)"),
        "decode_text": "SELECT doc_id, text || chr(65533) AS code FROM documents",
    }


CHECKS: dict[str, str] = {**node_checks(), **page_checks(), **text_checks(), **file_checks()}
