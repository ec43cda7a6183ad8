"""DuckDB SQL for the rows of those queries that SQL can express."""

from __future__ import annotations

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP10 = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line FROM docs),
keyed AS (SELECT *, translate(trim(line, {_BLANK}), '{_UP}', '{_LOW}') AS key FROM lines),
held AS (
  SELECT key, count(DISTINCT doc_id) AS n, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key
),
marked AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(h.n >= 5 AND k.doc_id < h.last, false) AS gone
  FROM keyed k LEFT JOIN held h ON k.key = h.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_SOUND = "len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0"

OP11 = f"""
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND {_SOUND}
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""


def _vector_codes(rounds: int = 2) -> str:
    """Plain Lloyd's rounds, each a few common table expressions."""
    apart = "list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)"
    parts = [
        f"""kept AS (
  SELECT vec_id, label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v, len(embedding) // 16 AS w
  FROM embeddings WHERE embedding IS NOT NULL AND {_SOUND}
)""",
        "cut AS (SELECT vec_id, label, p, v[p * w + 1 : (p + 1) * w] AS x FROM kept, range(16) t(p))",
        """book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM cut
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 64
)""",
    ]
    for n in range(rounds + 1):
        parts.append(f"""near{n} AS MATERIALIZED (
  SELECT vec_id, label, p, any_value(x) AS x, min(struct_pack(d := {apart}, e := e)) AS best
  FROM cut JOIN book{n} USING (p) GROUP BY vec_id, label, p
)""")
        if n < rounds:
            parts.append(f"""mean{n} AS (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, best.e AS e, i, floor(sum(x[i]) / count(*)) AS m
    FROM near{n}, range(1, 1 + (SELECT max(w) FROM kept)) t(i) GROUP BY ALL
  ) GROUP BY p, e
),
book{n + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{n} b LEFT JOIN mean{n} m ON b.p = m.p AND b.e = m.e
)""")
    steps = ",\n".join(parts)
    return f"""
WITH {steps},
digest AS (
  SELECT sha256(string_agg(array_to_string([CAST(CAST(x AS BIGINT) AS VARCHAR) FOR x IN c], ','), ',' ORDER BY p, e)) AS codebooks_sha256
  FROM book{rounds}
),
coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(lower(lpad(to_hex(best.e), 2, '0')), '' ORDER BY p) AS code,
         CAST(sum(best.d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, digest
"""


def oracle_sql() -> dict[str, str]:
    return {"op10_line_dedup": OP10, "op11_hard_negatives": OP11, "op12_vector_codes": _vector_codes()}
