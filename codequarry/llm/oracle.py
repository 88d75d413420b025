"""DuckDB SQL for the queries that SQL can express. Values that a query fixes come in as parameters; the ways differ."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def url_filters(rules: list[tuple[str, str, str]]) -> str:
    listed = ", ".join(f"({_quoted(h)}, {_quoted(p)}, {_quoted(v)})" for h, p, v in rules)
    return f"""
WITH parts AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(rule_host, rule_path, rule_verdict) AS (VALUES {listed}),
best AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(rule_verdict, length(rule_host || rule_path)) AS verdict
  FROM split, rules
  WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT s.page_id, s.host, s.path, b.rule, coalesce(b.verdict, 'allow') AS verdict FROM split s LEFT JOIN best b ON s.page_id = b.page_id
"""


def sharding(limit: int) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT AS h FROM documents
), levels AS (
  SELECT doc_id, n_bytes, bits, substr(lpad(bin(h), 60, '0'), 1, bits) AS shard FROM d, range(0, 25) AS r(bits)
), sized AS (
  SELECT *, sum(n_bytes) OVER (PARTITION BY bits, shard) AS shard_bytes, count(*) OVER (PARTITION BY bits, shard) AS n FROM levels
)
SELECT doc_id, min(n_bytes)::BIGINT AS n_bytes, arg_min(shard, bits) AS shard, arg_min(shard_bytes, bits)::BIGINT AS shard_bytes
FROM sized WHERE shard_bytes <= {limit} OR n = 1 GROUP BY doc_id
"""


EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), good AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, l.component_id, v.vec_id = l.component_id AS kept
FROM v JOIN lowest l ON v.vec_id = l.a LEFT JOIN counts c ON v.vec_id = c.a
"""


def line_dedup(documents: str = "documents", min_words: int = 50) -> str:
    """All pairs of equal lines, joined to runs along their diagonals; what a run of enough words repeats goes."""
    return f"""
WITH every AS (
  SELECT doc_id, i, line, len(regexp_extract_all(line, '{_WORD}')) AS w FROM (
    SELECT doc_id, generate_subscripts(lines, 1) AS i, unnest(lines) AS line FROM (
      SELECT doc_id, string_split(text, chr(10)) AS lines FROM {documents}))
), l AS MATERIALIZED (
  SELECT doc_id, i, line, w, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS r FROM every WHERE w > 0
), pairs AS (
  SELECT b.doc_id AS d, b.r, b.i, b.w, a.doc_id AS e, b.r - a.r AS diagonal
  FROM l a JOIN l b ON a.line = b.line AND (a.doc_id < b.doc_id OR (a.doc_id = b.doc_id AND a.r < b.r))
), islands AS (
  SELECT *, r - row_number() OVER (PARTITION BY d, e, diagonal ORDER BY r) AS island FROM pairs
), sized AS (
  SELECT d, i, sum(w) OVER (PARTITION BY d, e, diagonal, island) AS words FROM islands
), gone AS (SELECT DISTINCT d, i FROM sized WHERE words >= {min_words}),
left_over AS (
  SELECT x.doc_id, count(*) AS n_lines, count(g.d) AS n_removed,
    coalesce(string_agg(x.line, chr(10) ORDER BY x.i) FILTER (WHERE g.d IS NULL), '') AS clean
  FROM every x LEFT JOIN gone g ON x.doc_id = g.d AND x.i = g.i GROUP BY x.doc_id
)
SELECT t.doc_id, coalesce(o.n_lines, 0)::BIGINT AS n_lines, coalesce(o.n_removed, 0)::BIGINT AS n_removed, o.clean AS text
FROM {documents} t LEFT JOIN left_over o ON t.doc_id = o.doc_id
"""


def secret_scan() -> str:
    assign = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    kinds = [("assign", assign), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+"), ("entropy", "[A-Za-z0-9+/_=-]{20,}")]
    scans = " UNION ALL ".join(
        f"SELECT doc_id, {rank} AS rank, '{name}' AS kind, {_quoted(pattern)} AS pattern, "
        f"string_split_regex(text, {_quoted(pattern)}) AS gaps, regexp_extract_all(text, {_quoted(pattern)}, 0) AS found FROM t"
        for rank, (name, pattern) in enumerate(kinds))
    # bits a window must reach: hex 2.9; upper and lower case with digits 3.6; letters and digits 3.3; letters 3.6
    has = lambda pattern: f"regexp_matches(match, '{pattern}')"
    most = lambda bits: f"floor((log2(20) - {bits}) * 20 * 1000000)::BIGINT"
    limit = f"""CASE WHEN {has("^[0-9A-Fa-f]+$")} AND {has("[0-9]")} AND {has("[A-Fa-f]")} THEN {most("2.9")}
    WHEN {has("[0-9]")} AND {has("[a-z]")} AND {has("[A-Z]")} THEN {most("3.6")}
    WHEN {has("[0-9]")} AND {has("[A-Za-z]")} THEN {most("3.3")} WHEN {has("[A-Za-z]")} THEN {most("3.6")} END"""
    word, name = "([A-Z]{0,4}[a-z]{1,19}([A-Z][a-z]{1,19})*|[A-Z]{1,19}|[0-9]+)", "([A-Za-z]{1,19}[0-9]{0,4}|[0-9]+)"
    allowed = " OR ".join(map(has, [
        "(?i)example|sample|placeholder|your[-_]", "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", "(?i)abcdefghij|0123456789",
        f"^/?{word}([/_=-]+{word})*/?$", f"^/?{name}([/_=-]+{name})+/?$"]))
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
scans AS ({scans}),
matches AS (
  SELECT doc_id, rank, kind, unnest(found) AS match, unnest(gaps[1:len(found)]) AS gap, generate_subscripts(found, 1) AS n FROM scans
), placed AS (
  SELECT doc_id, rank, kind, match, sum(length(gap) + length(match)) OVER (PARTITION BY doc_id, rank ORDER BY n) AS stop FROM matches
), spans AS (
  SELECT doc_id, rank, kind, match, (stop - length(match))::BIGINT AS start, stop::BIGINT AS stop FROM placed
), base AS (
  SELECT * FROM spans WHERE (rank = 0 AND length(regexp_extract(match, {_quoted(assign)}, 2)) >= 8)
    OR (rank = 1 AND length(match) >= 16) OR (rank = 2 AND length(match) >= 32)
), candidates AS MATERIALIZED (
  SELECT *, {limit} AS most FROM spans WHERE rank = 3 AND NOT ({allowed})
), windows AS (
  SELECT doc_id, start, stop, most, substr(match, pos, 20) AS part
  FROM (SELECT *, unnest(range(1, length(match) - 18)) AS pos FROM candidates WHERE most IS NOT NULL)
), high AS (
  SELECT DISTINCT doc_id, start, stop FROM windows
  WHERE list_sum(list_transform(map_values(list_aggregate(string_split(part, ''), 'histogram')), lambda n: round(n * log2(n) * 1000000)::BIGINT)) <= most
), added AS (
  SELECT h.doc_id, 3 AS rank, 'entropy' AS kind, '' AS match, h.start, h.stop FROM high h
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = h.doc_id AND b.start < h.stop AND h.start < b.stop)
), kept AS (SELECT * FROM base UNION ALL SELECT * FROM added)
SELECT t.doc_id, count(*) FILTER (WHERE rank = 0)::BIGINT AS n_assign, count(*) FILTER (WHERE rank = 1)::BIGINT AS n_access,
  count(*) FILTER (WHERE rank = 2)::BIGINT AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (WHERE rank < 3), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank), '') AS spans
FROM t LEFT JOIN kept k ON t.doc_id = k.doc_id GROUP BY t.doc_id
"""


def resampling(percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = 10_000) -> str:
    """CRC-32 bit by bit for its table, then byte by byte over the distinct features."""
    return f"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i::BIGINT FROM range(256) AS r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
), crc_table AS MATERIALIZED (SELECT i::BIGINT AS i, v FROM bits WHERE k = 8),
texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark
), split AS MATERIALIZED (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts
), features AS MATERIALIZED (
  SELECT side, id, unnest(w) AS f FROM split
  UNION ALL
  SELECT side, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM split
), counted AS MATERIALIZED (SELECT side, id, f, count(*) AS n FROM features GROUP BY ALL),
steps(f, h, pos, c) AS (
  SELECT f, hex(encode(f)), 1, 4294967295::BIGINT FROM (SELECT DISTINCT f FROM counted)
  UNION ALL
  SELECT s.f, s.h, s.pos + 2, xor(s.c >> 8, t.v) FROM steps s
  JOIN crc_table t ON t.i = xor(s.c & 255, ('0x' || substr(s.h, s.pos, 2))::BIGINT) WHERE s.pos < length(s.h)
), bucketed AS MATERIALIZED (
  SELECT side, id, bucket, sum(n)::BIGINT AS n FROM counted
  JOIN (SELECT f, xor(c, 4294967295) % {buckets} AS bucket FROM steps WHERE pos > length(h)) USING (f) GROUP BY ALL
), totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE side = 't'), 0)::DOUBLE AS t
  FROM bucketed GROUP BY bucket
), whole AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM totals),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (all_s + {buckets}) / ((s + 1) * (all_t + {buckets}))))::BIGINT AS gain FROM totals, whole
), weights AS (
  SELECT id, sum(n)::BIGINT AS n, sum(n * gain)::BIGINT AS total FROM bucketed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
), scored AS (
  SELECT d.id AS doc_id, len(d.w) AS words, coalesce(w.n, 0)::BIGINT AS n_features,
    coalesce((w.total - ((w.total % w.n) + w.n) % w.n) // w.n, 0)::BIGINT AS weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || d.id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise
  FROM split d LEFT JOIN weights w ON d.id = w.id WHERE d.side = 'd'
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY weight + noise DESC, doc_id) AS place, count(*) OVER () AS able FROM scored WHERE words >= {least_words}
)
SELECT s.doc_id, s.n_features, s.weight, s.weight + s.noise AS score, r.place AS rank
FROM scored s LEFT JOIN (SELECT * FROM ranked WHERE place <= able * {percent} // 100) r ON s.doc_id = r.doc_id
"""


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Rounds written out one after another; every part against every entry."""
    nearest = lambda r: f"""a{r} AS MATERIALIZED (
  SELECT vec_id, p, y, min({{'far': far, 'e': e}}) AS best FROM (
    SELECT v.vec_id, v.p, v.y, b.e, list_sum(list_transform(list_zip(v.y, b.y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS far
    FROM parts v JOIN b{r} b ON v.p = b.p) GROUP BY vec_id, p, y
)"""  # noqa: E731
    moved = lambda r: f"""b{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.y, b.y) AS y FROM b{r} b LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS y FROM (
      SELECT p, e, i, sum(x)::BIGINT AS s, count(*) AS n FROM (
        SELECT p, best.e AS e, unnest(y) AS x, generate_subscripts(y, 1) AS i FROM a{r}) GROUP BY p, e, i) GROUP BY p, e
  ) m ON b.p = m.p AND b.e = m.e
)"""  # noqa: E731
    steps = ",\n".join(nearest(r) + ",\n" + moved(r) for r in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, p, x[p * len(x) // {parts} + 1 : (p + 1) * len(x) // {parts}] AS y FROM kept, range({parts}) AS r(p)
), b0 AS MATERIALIZED (
  SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS e, y FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries})
),
{steps},
{nearest(rounds)},
digest AS (SELECT sha256(string_agg(x, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM (
  SELECT p, e, unnest(y)::VARCHAR AS x, generate_subscripts(y, 1) AS i FROM b{rounds})),
coded AS (
  SELECT vec_id, string_agg(printf('%02x', best.e::INTEGER), '' ORDER BY p) AS code, sum(best.far)::BIGINT AS error FROM a{rounds} GROUP BY vec_id
)
SELECT c.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, d.codebooks_sha256
FROM coded c JOIN kept k ON c.vec_id = k.vec_id, digest d
"""


def checks(rules: list[tuple[str, str, str]], shard_bytes: int) -> dict[str, str]:
    return {"op1_url_filters": url_filters(rules), "op2_sharding": sharding(shard_bytes), "op3_embedding_near_dedup": EMBEDDINGS,
            "op6_line_dedup": line_dedup(), "op9_secret_scan": secret_scan(),
            "op11_importance_resampling": resampling(), "op13_vector_codes": vector_codes()}
