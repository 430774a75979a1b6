"""SQL for the queries on personal data, clusters and ranked search."""

from __future__ import annotations

_DECIMAL = "(0*([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5]))"

#: Kind, its place in reports, pattern, and what the matched text (``hit``) must meet.
_KINDS = (
    ("email", 1, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    ("ip", 2, r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", rf"regexp_full_match(hit, '{_DECIMAL}(\.{_DECIMAL}){{3}}')"),
    (
        "card", 3, r"[0-9](?:[\x20-]?[0-9])+",
        "len(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, len(digits) + 1), lambda i:"
        " CASE WHEN (len(digits) - i) % 2 = 0 THEN CAST(digits[i] AS INT)"
        " ELSE 2 * CAST(digits[i] AS INT) - CASE WHEN CAST(digits[i] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0",
    ),
    ("phone", 4, r"\+[0-9][\x20().0-9-]+[0-9]", "len(digits) BETWEEN 8 AND 15"),
    (
        "url", 5,
        r"(?:https?|ftp)://[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?(?:/[A-Za-z0-9._~%/?#&=+-]*)?", "true",
    ),
    (
        "account", 6, r"(?:account|acct|iban|passport|ssn)[\x20:#=]{1,3}[A-Z]{0,2}[0-9][0-9A-Z-]{4,32}",
        "len(regexp_replace(hit, '[^0-9]', '', 'g')) >= 6",
    ),
)

_MATCHES = "\n  UNION ALL ".join(
    f"SELECT row, '{kind}' AS kind, {place} AS place, regexp_extract_all(t, '{pattern}') AS hits,"
    f" string_split_regex(t, '{pattern}') AS gaps FROM texts"
    for kind, place, pattern, _ in _KINDS
)

# Matches and the texts between them give the offsets. A span of an account leaves out its cue.
OP11_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
matches AS (
  {_MATCHES}),
each AS (
  SELECT row, kind, place, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap, generate_subscripts(hits, 1) AS i
  FROM matches WHERE len(hits) > 0),
placed AS (
  SELECT *, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY row, kind ORDER BY i) AS BIGINT) AS stop,
    regexp_replace(hit, '[^0-9]', '', 'g') AS digits
  FROM each),
good AS (
  SELECT row, kind, place, stop,
    stop - length(CASE WHEN kind = 'account' THEN regexp_replace(hit, '^[a-z]+[\\x20:#=]+', '') ELSE hit END) AS start
  FROM placed WHERE CASE kind {" ".join(f"WHEN '{kind}' THEN {check}" for kind, _, _, check in _KINDS)} END),
summed AS (
  SELECT row, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
    count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY place, start) FILTER (place <= 4) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY place, start) AS spans
  FROM good GROUP BY row)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN summed USING (row)
"""


def _assigned(n: int) -> str:
    """Nearest centroid of every vector under the centroids of round ``n``."""
    return f"""
near{n} AS (
  SELECT row, v, arg_min(struct_pack(c := cluster, d := d), (d, cluster)) AS best FROM (
    SELECT row, k.v, cluster, CAST(list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM kept k CROSS JOIN centroids{n} c)
  GROUP BY row, v)"""


def _moved(n: int) -> str:
    """Centroids of round ``n`` from the vectors assigned in the round before."""
    return f"""
means{n} AS (
  SELECT cluster, list(m ORDER BY i) AS v FROM (
    SELECT best.c AS cluster, i, CAST(floor(CAST(sum(v[i]) AS DOUBLE) / count(*)) AS BIGINT) AS m
    FROM near{n - 1}, range(1, 65) AS dims(i) GROUP BY best.c, i)
  GROUP BY cluster),
centroids{n} AS (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM centroids{n - 1} c LEFT JOIN means{n} m USING (cluster))"""


OP12_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND list_count(embedding) = 64 AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
centroids0 AS (
  SELECT CAST(row_number() OVER first - 1 AS INT) AS cluster, v FROM kept
  WINDOW first AS (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) QUALIFY row_number() OVER first <= 16),
{",".join(_assigned(n) + "," + _moved(n + 1) for n in range(3))},
{_assigned(3)},
found AS (SELECT k.vec_id, n.best.c AS cluster, n.best.d AS distance FROM near3 n JOIN kept k USING (row))
SELECT vec_id, f.cluster, distance, CAST(sum(distance) OVER (PARTITION BY f.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM found f JOIN centroids3 c ON c.cluster = f.cluster
"""

_TERMS = (
    r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

OP13_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, {_TERMS.format("text")} AS terms FROM documents),
sizes AS (SELECT row, doc_id, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
counted AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) GROUP BY row, term),
wanted AS (
  SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS.format("text")}) AS term FROM benchmark WHERE item_id IS NOT NULL)),
weighted AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM counted, whole WHERE term IN (SELECT term FROM wanted) GROUP BY term, docs),
scored AS (
  SELECT item_id, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
  FROM wanted JOIN weighted USING (term) JOIN counted USING (term) JOIN sizes USING (row), whole
  GROUP BY item_id, row)
SELECT item_id, CAST(row_number() OVER best AS INT) AS rank, doc_id, score FROM scored JOIN sizes USING (row) WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) QUALIFY row_number() OVER best <= 10
"""

NEW_SQL = {"op11_anchor_expansion": OP11_SQL, "op12_centroid_clusters": OP12_SQL, "op13_document_scan": OP13_SQL}
