"""SQL counterparts of the registered queries, where SQL can express them."""



def _rounds(n: int) -> str:
    """The assignments and moves of n rounds, and the last assignment, as one chain of table expressions."""
    out = ""
    for i in range(n + 1):
        out += f"""
        , away{i} AS MATERIALIZED (
            SELECT v, cluster, sum((x - c) * (x - c)) AS d FROM parts JOIN centroids{i} USING (dim) GROUP BY ALL
        ), placed{i} AS MATERIALIZED (
            SELECT v, min(d) AS d, arg_min(cluster, d * 1000 + cluster) AS cluster FROM away{i} GROUP BY v
        )"""
        if i < n:
            out += f"""
        , centroids{i + 1} AS MATERIALIZED (
            SELECT cluster, dim, coalesce((s - ((s % n) + n) % n) // n, c) AS c
            FROM centroids{i} LEFT JOIN (
                SELECT cluster, dim, sum(x) AS s, count(*) AS n FROM placed{i} JOIN parts USING (v) GROUP BY ALL
            ) USING (cluster, dim)
        )"""
    return out


ORACLES = {
    "op13_hadamard_clusters": f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS v, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS xs
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS MATERIALIZED (
            SELECT v, unnest(xs) AS x, unnest(range(64)) AS dim FROM kept
        ), chosen AS (
            SELECT v, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster FROM kept
            QUALIFY cluster < 40
        ), centroids0 AS MATERIALIZED (
            SELECT cluster, dim, x AS c FROM chosen JOIN parts USING (v)
        ) {_rounds(5)}
        , digests AS (
            SELECT cluster, sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM centroids5 GROUP BY cluster
        )
        SELECT vec_id, cluster::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
               (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
        FROM placed5 JOIN kept USING (v) JOIN digests USING (cluster)
    """,
    "op11_debruijn_collocations": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]'
            )) AS piece FROM documents
        ), lists AS MATERIALIZED (
            SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS ws FROM pieces
        ), grams AS (
            SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS g
            FROM lists, (SELECT unnest(range(1, 6)) AS k)
        ), counts AS MATERIALIZED (
            SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang
        ), candidates AS MATERIALIZED (
            SELECT *, string_split(g, ' ') AS ws FROM counts WHERE k >= 2 AND f >= 100
        ), inner_parts AS (
            SELECT lang, f, m, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS g
            FROM candidates, (SELECT unnest(range(2, 5)) AS m) WHERE m < k
        ), around AS (
            SELECT lang, g, max(f) AS most FROM inner_parts GROUP BY ALL
        ), cuts AS (
            SELECT c.lang, c.g, c.f, c.k, j, array_to_string(ws[:j], ' ') AS x, array_to_string(ws[j + 1:], ' ') AS y
            FROM candidates c LEFT JOIN around o ON c.lang = o.lang AND c.g = o.g, (SELECT unnest(range(1, 5)) AS j)
            WHERE j < c.k AND coalesce(100 * most < 100 * c.f, true)
        ), rated AS (
            SELECT cuts.lang, cuts.g AS phrase, cuts.f AS a, x.f AS l, y.f AS r, n, j,
                   (1000::HUGEINT * cuts.f * n) // (x.f::HUGEINT * y.f) AS score
            FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.g = cuts.x JOIN counts y ON y.lang = cuts.lang AND y.g = cuts.y
            JOIN totals ON totals.lang = cuts.lang
            QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.g ORDER BY score, j) = 1
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n,
               score::BIGINT AS score
        FROM rated QUALIFY rank <= 2000
    """,
    "op10_relational_chat": """
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), marked AS (
            SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before,
                   length(regexp_replace(role, '<(\\\\*)\\|', '<\\1\\\\|', 'g')) AS role_chars,
                   length(regexp_replace(text, '<(\\\\*)\\|', '<\\1\\\\|', 'g')) AS text_chars
            FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               sum(text_chars + CASE WHEN before = role THEN length('<|part|>')
                   ELSE length('<|end|><|turn|><|text|>') + role_chars END)::BIGINT AS formatted_chars
        FROM marked GROUP BY conv_id
    """,
}
