"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

#: Word windows joined as text: ten words, or the whole of a shorter item.
OP2 = r"""
WITH item_words AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id,
           regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
          FROM item_words WHERE len(w) > 0)
), doc_words AS (
    SELECT doc_id,
           coalesce(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
), places AS (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
), found AS (
    SELECT p.doc_id, p.i, p.n, v.item_id
    FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM places) p
    JOIN windows v ON v.win = p.win AND v.n = p.n
), hit AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY 1
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY 1
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

#: Shingles joined as text, pairs with a common one, and whatever links reach.
OP7 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, coalesce(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+'), []) AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c >= 80 * (x.n + y.n - c)
), ends AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT r.doc_id, e.b FROM reach r JOIN ends e ON e.a = r.other
)
SELECT w.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM words w LEFT JOIN sizes z ON z.doc_id = w.doc_id JOIN reach r ON r.doc_id = w.doc_id GROUP BY w.doc_id
"""

#: Rounds written one after the other; distance and number are compared together.
_ROUND = """
a{r} AS MATERIALIZED (
    SELECT row, min({{'d': d, 'n': num}}) AS best
    FROM (SELECT row, num, list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
          FROM vectors x, c{r} c)
    GROUP BY row
)"""
_MOVE = """
c{s} AS MATERIALIZED (
    SELECT num, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
        SELECT num, list(CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END ORDER BY i) AS v
        FROM (SELECT best.n AS num, i, sum(v[i])::BIGINT AS s, count(*) AS n
              FROM a{r} JOIN vectors USING (row), range(1, 65) t(i) GROUP BY 1, 2)
        GROUP BY num
    ) m USING (num)
)"""
_ROUNDS = 5
OP12 = (
    """
WITH kept AS (
    SELECT vec_id, embedding FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), vectors AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v,
           row_number() OVER (ORDER BY vec_id) AS row
    FROM kept
), c0 AS MATERIALIZED (
    SELECT v, row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS num
    FROM vectors WHERE vec_id IS NOT NULL ORDER BY num LIMIT 40
),"""
    + ",".join(_ROUND.format(r=r) + "," + _MOVE.format(r=r, s=r + 1) for r in range(_ROUNDS))
    + ","
    + _ROUND.format(r=_ROUNDS)
    + f"""
SELECT vec_id, CAST(best.n AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.n) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{_ROUNDS} JOIN vectors USING (row) JOIN c{_ROUNDS} c ON c.num = best.n
"""
)

ORACLE: dict[str, str] = {"op2_decontaminate": OP2, "op7_jaccard_join": OP7, "op12_clusters": OP12}
