"""SQL of the vector clustering queries: every round measures every distance."""

from __future__ import annotations

_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_DISTANCE = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _floored_mean(width: int) -> str:
    s = ", ".join(f"(sum(x[{i}]) - ((sum(x[{i}]) % count(*)) + count(*)) % count(*)) // count(*)" for i in range(1, width + 1))
    return f"CAST([{s}] AS BIGINT[])"


def _integers(scale: int) -> str:
    return f"list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"


def code_sql(parts: int, entries: int, rounds: int, scale: int, dims: int) -> str:
    """Lloyd rounds of product codes for vectors of ``dims`` components."""
    w = dims // parts
    links = [
        f"q AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, {_integers(scale)} AS v FROM embeddings WHERE {_FINITE})",
        f"parts AS (SELECT r, p, v[p * {w} + 1 : p * {w} + {w}] AS x FROM q, range({parts}) t(p))",
        f"book0 AS (SELECT p, r - 1 AS k, x AS c FROM parts WHERE r <= {entries})",
    ]
    for i in range(rounds + 1):
        links.append(f"near{i} AS (SELECT r, p, any_value(x) AS x, min((CAST({_DISTANCE} AS BIGINT), k)) AS best FROM parts JOIN book{i} USING (p) GROUP BY r, p)")
        if i < rounds:
            links.append(f"mean{i} AS (SELECT p, best[2] AS k, {_floored_mean(w)} AS m FROM near{i} GROUP BY p, best[2])")
            links.append(f"book{i + 1} AS (SELECT p, k, coalesce(m, c) AS c FROM book{i} LEFT JOIN mean{i} USING (p, k))")
    links.append(f"rows AS (SELECT r, string_agg(lower(lpad(hex(best[2]), 2, '0')), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM near{rounds} GROUP BY r)")
    links.append("labels_ AS (SELECT label AS l, CAST(sum(error) AS BIGINT) AS label_error FROM rows JOIN q USING (r) GROUP BY label)")
    links.append(f"digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM book{rounds})")
    return "WITH " + ",\n".join(links) + "\nSELECT vec_id, code, error, label_error, codebooks_sha256 FROM rows JOIN q USING (r) JOIN labels_ ON label IS NOT DISTINCT FROM l CROSS JOIN digest"


def cluster_sql(clusters: int, rounds: int, dims: int, scale: int, seed: str) -> str:
    """Lloyd rounds of whole vectors."""
    links = [
        f"q AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) AS r, vec_id, {_integers(scale)} AS x FROM embeddings WHERE len(embedding) = {dims} AND {_FINITE})",
        f"middle0 AS (SELECT r - 1 AS k, x AS c FROM q WHERE r <= {clusters})",
    ]
    for i in range(rounds + 1):
        links.append(f"near{i} AS (SELECT r, any_value(x) AS x, min((CAST({_DISTANCE} AS BIGINT), k)) AS best FROM q CROSS JOIN middle{i} GROUP BY r)")
        if i < rounds:
            links.append(f"mean{i} AS (SELECT best[2] AS k, {_floored_mean(dims)} AS m FROM near{i} GROUP BY best[2])")
            links.append(f"middle{i + 1} AS (SELECT k, coalesce(m, c) AS c FROM middle{i} LEFT JOIN mean{i} USING (k))")
    links.append(f"found AS (SELECT r, CAST(best[2] AS INTEGER) AS cluster, best[1] AS distance FROM near{rounds})")
    return "WITH " + ",\n".join(links) + f"""
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM found JOIN q USING (r) JOIN middle{rounds} ON k = cluster"""
