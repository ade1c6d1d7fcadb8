"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from loomline.llm import centroids

#: Checksums by the bytes of an id and a run; words one deletion, or one replaced letter, apart.
SPELLING = """
WITH RECURSIVE crc AS MATERIALIZED (
    SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
        lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
    GROUP BY ALL
), bytes AS (
    SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs
), hashed AS (
    SELECT run, n, xor(list_reduce(
        list_concat([4294967295], list_transform(range(length(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
    FROM bytes, crc
), words AS MATERIALIZED (
    SELECT CASE WHEN h % 97 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, sum(n)::BIGINT AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3
), cuts AS MATERIALIZED (
    SELECT word, length(word) AS len, i, word[1 : i] || word[i + 2 :] AS cut
    FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
), pairs AS (
    SELECT a.word AS word, b.word AS other FROM cuts a JOIN cuts b ON a.len = b.len AND a.i = b.i AND a.cut = b.cut AND a.word <> b.word
    UNION
    SELECT a.word, w.word FROM cuts a JOIN words w ON a.cut = w.word
    UNION
    SELECT w.word, a.word FROM cuts a JOIN words w ON a.cut = w.word
), best AS (
    SELECT p.word, count(*) AS n_near, min((-w.n, p.other)) AS b FROM pairs p JOIN words w ON w.word = p.other GROUP BY 1
), judged AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b[1] >= 2 * w.n THEN b[2] END AS form,
           CASE WHEN -b[1] >= 2 * w.n THEN -b[1] END AS form_n
    FROM words w LEFT JOIN best USING (word)
), steps AS (
    SELECT word, word AS root, form AS next FROM judged
    UNION ALL
    SELECT s.word, j.word, j.form FROM steps s JOIN judged j ON j.word = s.next
)
SELECT j.word, j.form, s.root, j.n, j.n_near, j.form_n FROM judged j JOIN steps s ON s.word = j.word AND s.next IS NULL
"""


def _rounds() -> str:
    """Ten rounds of assignment and means, then the last assignment."""
    out = []
    for r in range(centroids.ROUNDS + 1):
        out.append(f"""a{r} AS MATERIALIZED (
    SELECT vec, vec_id, x, d[1] AS distance, d[2] AS cluster FROM (
        SELECT v.vec, any_value(v.vec_id) AS vec_id, any_value(v.x) AS x,
               min((list_sum(list_transform(range(1, {centroids.DIMENSIONS + 1}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT, c.j)) AS d
        FROM kept v, c{r} c GROUP BY v.vec))""")
        if r < centroids.ROUNDS:
            out.append(f"""m{r} AS (
    SELECT cluster, i, floor_div(sum(x[i]), count(*)) AS m
    FROM a{r}, range(1, {centroids.DIMENSIONS + 1}) AS g(i) GROUP BY cluster, i
), c{r + 1} AS MATERIALIZED (
    SELECT c.j, coalesce(n.x, c.x) AS x FROM c{r} c
    LEFT JOIN (SELECT cluster, list(m ORDER BY i) AS x FROM m{r} GROUP BY cluster) n ON n.cluster = c.j)""")
    text = ",\n".join(out)
    # sum - mod, with a modulus that is never negative, divides without a remainder
    return text.replace("floor_div(sum(x[i]), count(*))", "((sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT")


CENTROIDS = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS vec, vec_id, list_transform(embedding, lambda e: floor({centroids.SCALE} * e::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE len(embedding) = {centroids.DIMENSIONS} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h) - 1 AS j, x
    FROM (SELECT x, sha256('{centroids.SEED}:' || vec_id) AS h FROM kept ORDER BY h LIMIT {centroids.K})
), {_rounds()}, sums AS (
    SELECT cluster, sum(distance)::BIGINT AS s FROM a{centroids.ROUNDS} GROUP BY cluster
)
SELECT a.vec_id, a.cluster::INTEGER AS cluster, a.distance, s.s AS cluster_inertia, (SELECT sum(s) FROM sums)::BIGINT AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{centroids.ROUNDS} a JOIN c{centroids.ROUNDS} c ON c.j = a.cluster JOIN sums s ON s.cluster = a.cluster
"""
