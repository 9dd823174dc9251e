"""SQL for DuckDB that computes the results of some queries, each in a plain way of its own."""

#: Lower-cases A-Z only.
_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_DECONTAMINATION_WORDS = (
    "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_DECONTAMINATION_WORDS.format("text")} AS w FROM documents),
b AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, {_DECONTAMINATION_WORDS.format("text")} AS w
    FROM benchmark WHERE item_id IS NOT NULL
),
phrases AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n,
        array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p
    FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0
),
places AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
    FROM d, (SELECT DISTINCT n FROM phrases) AS s, unnest(range(1, len(w) - n + 2)) AS t(i)
),
hits AS (
    SELECT doc_id, item_id, i, places.n FROM places JOIN phrases
    ON places.p = phrases.p AND places.n = phrases.n
),
words AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, n)) AS t(k)
    GROUP BY doc_id
),
items AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
    FROM hits GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

NEIGHBOURS = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score
    FROM v AS q JOIN v AS c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_PLAIN_WORDS = r"[^\x20\x09-\x0D]+"

SIMILARITY = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '{_PLAIN_WORDS}') AS w FROM documents
),
sets AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') AS s
    FROM d, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM sets AS a JOIN sets AS b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM common JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
    WHERE 100 * common.n >= 90 * (x.n + y.n - common.n)
),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM d
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
),
least_of AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d JOIN least_of ON d.doc_id = least_of.doc_id LEFT JOIN sizes ON d.doc_id = sizes.doc_id
"""

REPEATS = f"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_PLAIN_WORDS}') AS w FROM documents
),
windows AS (
    SELECT doc_id, i, row_number() OVER (
        PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i
    ) AS turn
    FROM d, unnest(range(1, len(w) - 18)) AS t(i)
),
gone AS (
    SELECT DISTINCT doc_id, i + k AS i FROM windows, unnest(range(0, 20)) AS t(k) WHERE turn > 1
),
words AS (SELECT doc_id, i, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(i)),
kept AS (
    SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS text, count(*) AS n
    FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i
    GROUP BY words.doc_id
)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

FILTER_AUDIT = r"""
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
f AS (
    SELECT d.doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
        regexp_matches(text, '[#$%&*|]') AS d,
        coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false) AS e,
        coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic
    FROM d LEFT JOIN (
        SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
        FROM labels GROUP BY doc_id
    ) AS l ON l.doc_id = d.doc_id
),
fails AS (
    SELECT part, good, toxic, map {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS m,
        a::INT + b::INT + c::INT + d::INT + e::INT AS n_failed, count(*) AS n
    FROM f GROUP BY ALL
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
    FROM letters p, letters q, letters r, letters s, letters t
    WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
),
steps AS (
    SELECT filter_order, step, filter_order[step] AS x, filter_order[1:step - 1] AS before
    FROM orders, unnest(range(1, 6)) AS u(step)
),
seen AS (
    SELECT *, m[x] AS failing,
        len(list_filter(string_split(before, ''), lambda y: m[y])) > 0 AS gone
    FROM fails, steps
),
counts AS (
    SELECT part, filter_order, step, x,
        sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN gone AND failing THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN failing AND n_failed = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN NOT gone AND failing AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN NOT gone AND failing AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
    FROM seen GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, sum(removed) OVER (PARTITION BY part, x)::BIGINT AS shapley
FROM counts
"""

def _clustering(k: int = 16, rounds: int = 3) -> str:
    """One pair of tables a round: the nearest centroid of each vector, then the means."""
    nearest = """
n{0} AS MATERIALIZED (
    SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
        SELECT r, c, sum((x - y) * (x - y)) AS d FROM v JOIN c{0} USING (j) GROUP BY r, c
    ) GROUP BY r
)"""
    means = """
c{1} AS MATERIALIZED (
    SELECT c, j, coalesce(m, y) AS y FROM c{0} LEFT JOIN (
        SELECT c, j, floor(sum(x) / count(*))::BIGINT AS m FROM v JOIN n{0} USING (r) GROUP BY c, j
    ) USING (c, j)
)"""
    steps = [s.format(i, i + 1) for i in range(rounds) for s in (nearest, means)]
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, embedding AS e FROM embeddings
    WHERE len(embedding) = 64
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
),
v AS MATERIALIZED (
    SELECT r, j, floor(64 * CAST(e[j] AS DOUBLE))::BIGINT AS x FROM kept, unnest(range(1, 65)) AS t(j)
),
c0 AS MATERIALIZED (
    SELECT n - 1 AS c, j, x AS y FROM (
        SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id), e) AS n FROM kept
        WHERE vec_id IS NOT NULL
    ) JOIN v USING (r) WHERE n <= {k}
),
{",".join(steps)},
{nearest.format(rounds)},
digests AS (
    SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY j)) AS s FROM c{rounds} GROUP BY c
)
SELECT vec_id, c::INT AS cluster, d::BIGINT AS distance,
    (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
    (sum(d) OVER ())::BIGINT AS inertia, s AS centroid_sha256
FROM n{rounds} JOIN kept USING (r) JOIN digests USING (c)
"""


CLUSTERING = _clustering()

ORACLES = {
    "op2_decontamination": DECONTAMINATION,
    "op4_ngram_jaccard_join": SIMILARITY,
    "op9_substring_dedup": REPEATS,
    "op10_nearest_neighbours": NEIGHBOURS,
    "op11_filter_audit": FILTER_AUDIT,
    "op13_centroid_clustering": CLUSTERING,
}
