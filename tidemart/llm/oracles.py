"""SQL that gives the rows of the queries, where SQL can express them."""

from __future__ import annotations

from tidemart.llm import secrets
from tidemart.llm.mixing import SCHEDULES

WORDS = r"coalesce(len(regexp_extract_all({}, '[^\x20\x09-\x0D]+')), 0)"


def number(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def time_sql(part: str, knots) -> str:
    """Inverse of an integrated schedule, term by term as the query has it."""
    areas = [(b - a) * (v + w) / 2 for (a, v), (b, w) in zip(knots, knots[1:])]
    total, before, out = sum(areas), 0.0, None
    for area, ((a, v), (b, w)) in zip(areas, zip(knots, knots[1:])):
        rest = f"({part} * {number(total)} - {number(before)})"
        root = f"sqrt(greatest({number(v * v)} + {rest} * {number(2 * (w - v) / (b - a))}, {number(0.0)}))"
        time = f"({number(a)} + {rest} * 2 / greatest({root} + {number(v)}, {number(1e-12)}))"
        out = time if out is None else f"CASE WHEN {part} >= {number(before / total)} THEN {time} ELSE {out} END"
        before += area
    return out


def place_sql(copy: int) -> str:
    part = f"((o + source_size * {copy}) / target)"
    cases = " ".join(f"WHEN (rank - 1) % {len(SCHEDULES)} = {k} THEN {time_sql(part, s)}" for k, s in enumerate(SCHEDULES))
    return f"CASE WHEN t{copy} > 0 THEN CASE {cases} END END"


MIX = f"""
WITH d AS (
  SELECT doc_id, coalesce('0' || source, '1') AS src, CAST({WORDS.format('text')} AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place, md5(coalesce(text, '')) AS tie
  FROM documents
), s AS (
  SELECT src, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY src) AS rank FROM d GROUP BY src
), w AS (
  SELECT *, CAST([5, 2, 1][(rank - 1) % 3 + 1] AS DOUBLE) AS weight, source_size * CAST(2 AS DOUBLE) AS cap FROM s
), l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS BIGINT) * CAST(1.5 AS DOUBLE)
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), g AS (
  SELECT src, source_size, rank, CASE WHEN cap / weight > level
         THEN weight * max(CASE WHEN cap / weight > level THEN level END) OVER () ELSE cap END AS target
  FROM l
), o AS (
  SELECT doc_id, size, source_size, target, rank, CAST(floor(target + 0.5) AS BIGINT) AS lim,
         CAST(sum(size) OVER (PARTITION BY src ORDER BY place, doc_id, size, tie ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS o
  FROM d JOIN g USING (src)
), t AS (
  SELECT *, least(greatest(lim - o, 0), size) AS t0, least(greatest(lim - o - source_size, 0), size) AS t1 FROM o
)
SELECT doc_id, size, source_size, target, CAST(t0 + t1 AS BIGINT) AS taken,
       {place_sql(0)} AS first_position, {place_sql(1)} AS second_position
FROM t
"""

# Links of all pairs by their cosine, and the smallest id that each vector reaches.
VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), fine AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM fine a JOIN fine b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS u, vec_id AS v FROM v UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
)
SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN (SELECT u, min(v) AS component_id FROM reach GROUP BY u) r ON v.vec_id = r.u
LEFT JOIN (SELECT u, count(*) AS n FROM links GROUP BY u) l ON v.vec_id = l.u
"""

BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(sha, {10 * i + 1}, 10) AS BIGINT) >> {35 - 5 * j}) & 31 AS BIGINT) + 1, 1)"
    for i in range(4) for j in range(8)
)
ARCHIVE = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
q AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS sha FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS first FROM q)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""



def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def found_sql(rank: int, pattern: str, group: int) -> str:
    """Matches of a pattern: places from the lengths of matches and of what stands between them."""
    return f"""
  SELECT doc_id, {rank} AS rank, i, start, start + length(found) AS stop, found, part FROM (
    SELECT doc_id, i, every[i] AS found, parts[i] AS part, CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g)))
           + coalesce(list_sum(list_transform(every[1:i - 1], lambda m: length(m))), 0) AS BIGINT) AS start
    FROM (SELECT *, unnest(range(1, len(every) + 1)) AS i FROM (
      SELECT doc_id, regexp_extract_all(t, {quoted(pattern)}) AS every, regexp_extract_all(t, {quoted(pattern)}, {group}) AS parts,
             string_split_regex(t, {quoted(pattern)}) AS gaps FROM d)))"""


def allowed_sql(run: str) -> str:
    """Whether a run has one of the shapes of the allow-list."""
    shapes = []
    for shape in secrets.ALLOW.shapes:
        has = [f"regexp_matches({run}, {quoted(p)})" for p in shape.has]
        lacks = [f"NOT regexp_matches({run}, {quoted(p)})" for p in shape.lacks]
        shapes.append("(" + " AND ".join(has + lacks) + ")")
    return " OR ".join(shapes)


def random_sql(rank: int, kind: secrets.RunClass) -> str:
    """Runs of a class of which some window has the entropy and overlaps no listed part."""
    table = ", ".join(str(secrets.plogp(c)) for c in range(1, kind.window + 1))
    most = secrets.plogp(kind.window) - round(kind.bits * kind.window * secrets.SCALE)
    return f"""
  SELECT doc_id, rank, start, stop FROM (
    SELECT doc_id, rank, start, stop, r, w, CAST(sum([{table}][c]) AS BIGINT) AS total FROM (
      SELECT doc_id, rank, start, stop, r, w, char, count(*) AS c FROM (
        SELECT *, unnest(string_split(substr(rests[r], w, {kind.window}), '')) AS char FROM (
          SELECT *, unnest(range(1, length(rests[r]) - {kind.window} + 2)) AS w FROM (
            SELECT *, unnest(range(1, len(rests) + 1)) AS r FROM (
              SELECT *, string_split_regex(found, {quoted(secrets.ALLOW.parts)}) AS rests
              FROM ({found_sql(rank, f"[{kind.chars}]{{{kind.window},}}", 0)}) WHERE NOT ({allowed_sql("found")})))))
      GROUP BY doc_id, rank, start, stop, r, w, char)
    GROUP BY doc_id, rank, start, stop, r, w)
  GROUP BY doc_id, rank, start, stop HAVING min(total) <= {most}"""


def spans_sql() -> str:
    parts = [
        f"SELECT doc_id, rank, start, stop FROM ({found_sql(0, secrets.ASSIGN, 2)}) WHERE length(part) >= {secrets.ASSIGN_LEAST}",
        *(f"SELECT doc_id, rank, start, stop FROM ({found_sql(i, p, 0)})" for i, p in ((1, secrets.ACCESS), (2, secrets.HEX))),
        *(random_sql(3 + i, k) for i, k in enumerate(secrets.CLASSES)),
    ]
    return "\n  UNION ALL ".join(parts)


NAMES = "[" + ", ".join(quoted(k) for k in secrets.KINDS) + "]"
JOINED = f"string_agg({NAMES}[rank + 1] || ':' || start || ':' || stop, ',' ORDER BY start, rank)"
SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({spans_sql()}),
g AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n0, count(*) FILTER (rank = 1) AS n1, count(*) FILTER (rank = 2) AS n2,
             {JOINED} FILTER (rank < 3) AS base, {JOINED} AS spans FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""

def whole_sql(scale: int) -> str:
    """Vectors of finite components as whole numbers."""
    return f"""
  SELECT vec_id, label, list_transform(e, lambda c: CAST(floor({scale} * c) AS BIGINT)) AS x FROM (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
  WHERE len(e) > 0 AND len(list_filter(e, lambda c: c IS NULL OR NOT isfinite(c))) = 0"""


SEARCH = f"""
WITH w AS ({whole_sql(64)}),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) AS score
  FROM w q JOIN w c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 20
"""


def codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Codebooks round by round, as rows (part, entry, numbers), for vectors of one length."""
    steps = [
        f"w AS MATERIALIZED ({whole_sql(4096)})",
        f"p AS MATERIALIZED (SELECT vec_id, label, part, x[part * len(x) // {parts} + 1:(part + 1) * len(x) // {parts}] AS v FROM w, range({parts}) AS t(part))",
        f"b0 AS MATERIALIZED (SELECT part, rank - 1 AS entry, v FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) AS rank FROM p) WHERE rank <= {entries})",
    ]
    far = "list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i])))"
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, label, part, v, entry, far FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id, part ORDER BY far, entry) AS rank FROM (
      SELECT p.vec_id, p.label, p.part, p.v, b.entry, {far} AS far FROM p JOIN b{r} b ON p.part = b.part)) WHERE rank = 1)""")
        if r < rounds:
            steps.append(f"""b{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY place) AS v FROM (
      SELECT part, entry, place, CAST(sum(n) // count(*) - CASE WHEN sum(n) % count(*) < 0 THEN 1 ELSE 0 END AS BIGINT) AS mean FROM (
        SELECT part, entry, unnest(v) AS n, unnest(range(1, len(v) + 1)) AS place FROM a{r}) GROUP BY part, entry, place)
    GROUP BY part, entry) m ON b.part = m.part AND b.entry = m.entry)""")
    steps.append(f"d AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})")
    steps.append(f"c AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id, label)")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c, d"""


ORACLES: dict[str, str] = {
    "op4_curriculum_mix": MIX, "op7_cross_polytope": VECTORS, "op9_warc_bundles": ARCHIVE, "op10_secret_scan": SECRETS,
    "op12_histogram_top_k": SEARCH, "op13_cell_codes": codes_sql(),
}
