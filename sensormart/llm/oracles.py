"""Queries as DuckDB SQL, where SQL can express them."""

WARC = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes
    FROM pages
), f AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS first FROM p
)
SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

MIXING = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5(concat_ws(':', 'mix', doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 15))::BIGINT AS place
    FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
    FROM sized GROUP BY source
), weighted AS (
    SELECT *, CASE rank % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
           3 * source_size AS cap
    FROM totals
), shares AS (
    SELECT *, sum(source_size) OVER ()::DOUBLE AS total,
           coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS held,
           sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS flowing
    FROM weighted
), level AS (
    SELECT total - held AS rest, flowing FROM shares
    WHERE (total - held) * weight / flowing <= cap ORDER BY cap / weight, rank LIMIT 1
), aims AS (
    SELECT source, rank, weight, source_size,
           CASE WHEN rest * weight / level.flowing > cap THEN cap::DOUBLE ELSE rest * weight / level.flowing END AS target
    FROM shares, level
), queued AS (
    SELECT s.doc_id, s.size, s.place, a.rank, a.weight, a.source_size, a.target,
           sum(s.size) OVER (PARTITION BY a.rank ORDER BY s.place, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS upto
    FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source
), copies AS (
    SELECT doc_id, size, place, rank, e, (e * source_size + upto)::DOUBLE / weight AS finish
    FROM queued, range(3) r(e) WHERE size > 0
), taken AS (
    SELECT doc_id, count(*) AS n FROM (
        SELECT doc_id, sum(size) OVER (ORDER BY finish, rank, e, place, doc_id, size) AS used FROM copies
    ) WHERE used <= (SELECT sum(size) FROM sized) GROUP BY doc_id
)
SELECT q.doc_id, q.size, q.source_size, q.target, (q.size * coalesce(t.n, 0))::BIGINT AS taken
FROM queued q LEFT JOIN taken t ON q.doc_id = t.doc_id
"""

VECTORS = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
), links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reached AS (
    SELECT vec_id, vec_id AS root FROM embeddings
    UNION
    SELECT l.y, r.root FROM reached r JOIN links l ON l.x = r.vec_id
), least AS (SELECT vec_id, min(root) AS component_id FROM reached GROUP BY vec_id),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN counts ON x = vec_id
"""

MINHASH = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_distinct([array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)]) END AS s
    FROM words
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS c
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (SELECT x, y FROM common WHERE 100 * c >= 75 * (nx + ny - c)),
reached AS (
    SELECT doc_id, doc_id AS root FROM documents
    UNION
    SELECT l.y, r.root FROM reached r JOIN links l ON l.x = r.doc_id
), least AS (SELECT doc_id, min(root) AS component_id FROM reached GROUP BY doc_id)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM sets s JOIN least l ON l.doc_id = s.doc_id
"""


def _clusters(rounds: int = 10) -> str:
    """Every round as two steps: the nearest centroid of each vector, and the means."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
    SELECT r, any_value(vec_id) AS vec_id, min({{'d': d, 'k': k}}) AS best FROM (
        SELECT r, vec_id, k, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(v, c)])::BIGINT AS d
        FROM kept, c{n}
    ) GROUP BY r
)""")
        if n < rounds:
            steps.append(f"""c{n + 1} AS MATERIALIZED (
    SELECT c{n}.k, coalesce(m.c, c{n}.c) AS c FROM c{n} LEFT JOIN (
        SELECT k, list(x ORDER BY i) AS c FROM (
            SELECT best.k AS k, i, floor(sum(v[i]) / count(*)) AS x
            FROM a{n} JOIN kept USING (r), range(1, 65) s(i) GROUP BY ALL
        ) GROUP BY k
    ) m ON m.k = c{n}.k
)""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = 64
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR)) - 1 AS k, v AS c
    FROM kept ORDER BY k LIMIT 8
), {", ".join(steps)}
SELECT vec_id, best.k::INTEGER AS cluster, best.d AS distance,
       (sum(best.d) OVER (PARTITION BY best.k))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string([x::BIGINT::VARCHAR for x in c], ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON best.k = k
"""


CLUSTERS = _clusters()

SEARCH = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM documents
), sized AS (SELECT r, doc_id, t, len(t) AS terms FROM d WHERE len(t) > 0),
totals AS (SELECT count(*)::HUGEINT AS docs, sum(terms)::HUGEINT AS size FROM sized),
items AS (
    SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), asked AS (SELECT i, item_id, term, count(*) AS q FROM items GROUP BY ALL),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM sized) GROUP BY ALL),
wanted AS (SELECT * FROM held SEMI JOIN asked USING (term)),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM wanted, totals GROUP BY term
), lengths AS (SELECT r, doc_id, (100 - 75 + ((75 * terms::HUGEINT * docs) // size))::BIGINT AS m FROM sized, totals),
scores AS (
    SELECT i, item_id, r, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN wanted USING (term) JOIN lengths USING (r) GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
