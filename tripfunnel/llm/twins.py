"""SQL twins of the operators that SQL can state as a whole."""

from __future__ import annotations


def _clusters(k: int = 16, rounds: int = 3, scale: int = 64, dims: int = 64) -> str:
    """Rounds of exact integer k-means, one pair of common tables each."""
    distance = "list_sum([(x[1] - x[2]) * (x[1] - x[2]) for x in list_zip(kept.v, c{n}.v)])::BIGINT"
    steps = []
    for n in range(rounds + 1):
        steps.append(
            f"""d{n} AS (
      SELECT kept.n, c{n}.c, {distance.format(n=n)} AS distance FROM kept, c{n}),
    a{n} AS (
      SELECT n, arg_min(c, (distance, c)) AS c, min(distance) AS distance FROM d{n} GROUP BY n)"""
        )
        if n < rounds:
            steps.append(
                f"""s{n} AS (
      SELECT c, i, sum(x)::HUGEINT AS s, count(*) AS m FROM (
        SELECT a{n}.c, unnest(kept.v) AS x, unnest(range({dims})) AS i FROM a{n} JOIN kept USING (n)) GROUP BY c, i),
    m{n} AS (
      SELECT c, list((((s - ((s % m) + m) % m)) // m)::BIGINT ORDER BY i) AS v FROM s{n} GROUP BY c),
    c{n + 1} AS (
      SELECT c{n}.c, coalesce(m{n}.v, c{n}.v) AS v FROM c{n} LEFT JOIN m{n} ON m{n}.c = c{n}.c)"""
            )
    body = ",\n    ".join(steps)
    return f"""
    WITH kept AS (
      SELECT row_number() OVER () AS n, vec_id, [floor({scale} * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
      WHERE len(embedding) = {dims} AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    c0 AS (
      SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM (
        SELECT sha256('1:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT {k})),
    {body},
    inside AS (SELECT c, sum(distance)::BIGINT AS inertia FROM a{rounds} GROUP BY c)
    SELECT kept.vec_id, a.c::INTEGER AS cluster, a.distance, inside.inertia AS cluster_inertia,
      (SELECT sum(inertia) FROM inside)::BIGINT AS inertia, sha256(array_to_string(f.v, ',')) AS centroid_sha256
    FROM a{rounds} a JOIN kept USING (n) JOIN inside USING (c) JOIN c{rounds} f USING (c)"""


_LINES = """
    WITH texts AS (
      SELECT row_number() OVER () AS n, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    lines AS (
      SELECT n, doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM (SELECT n, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM texts)),
    common AS (
      SELECT k, max(doc_id) AS owner FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
    marked AS (
      SELECT l.n, l.doc_id, l.i, l.line, c.k IS NOT NULL AND l.doc_id <> c.owner AS gone FROM lines l LEFT JOIN common c ON c.k = l.k)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY n, doc_id"""

_NEGATIVES = """
    WITH part AS (
      SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v
      FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
      SELECT a.n AS a, b.n AS b, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
        coalesce(list_sum([x[1] * x[2] for x in list_zip(a.v, b.v)]), 0)::BIGINT AS score
      FROM part a JOIN part b ON a.vec_id % 100 = 0 AND a.n <> b.n),
    positives AS (
      SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, id, b) AS nth FROM scored WHERE same),
    windows AS (
      SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.a, p.nth ORDER BY s.score DESC, s.id, s.b)::INTEGER AS rank
      FROM positives p JOIN scored s ON s.a = p.a AND NOT s.same
        AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
      WHERE p.nth <= 5)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 5"""

TWINS = {
    "op11_threshold_clusters": _clusters(),
    "op12_line_bitmaps": _LINES,
    "op13_hard_negatives": _NEGATIVES,
}
