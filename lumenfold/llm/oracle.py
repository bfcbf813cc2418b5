"""The operators' results in DuckDB SQL, where SQL can express them."""

WORDS = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = f"""
WITH item AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {WORDS.format(text="coalesce(text, '')")} AS w FROM benchmark
), phrase AS (
    SELECT DISTINCT item, n, array_to_string(list_slice(w, pos, pos + n - 1), ' ') AS phrase
    FROM (SELECT item, w, least(len(w), 10) AS n, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS pos
          FROM item WHERE len(w) > 0)
), doc AS (
    SELECT row_number() OVER () AS r, doc_id, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents
), place AS (
    SELECT r, n, pos, array_to_string(list_slice(w, pos, pos + n - 1), ' ') AS phrase
    FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS pos
          FROM doc, (SELECT DISTINCT n FROM phrase) WHERE len(w) >= n)
), found AS (
    SELECT r, pos, n, item FROM place JOIN phrase USING (n, phrase)
), hit AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(pos, pos + n - 1)) AS p FROM found) GROUP BY r
), listed AS (
    SELECT r, list(item ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
), word AS (
    SELECT r, unnest(w) AS term, unnest(generate_series(0, len(w) - 1)) AS pos FROM doc
), used AS (
    SELECT DISTINCT phrase, unnest(string_split(phrase, ' ')) AS term, unnest(generate_series(0, n - 1)) AS off FROM phrase
), ranked AS (
    SELECT phrase, term, off, coalesce(n, 0) AS n,
           row_number() OVER (PARTITION BY phrase ORDER BY coalesce(n, 0), term, off) AS k
    FROM used LEFT JOIN (SELECT term, count(*) AS n FROM word GROUP BY term) USING (term)
), rarest AS (
    SELECT a.phrase, a.term AS term1, a.off AS off1, coalesce(b.term, a.term) AS term2, coalesce(b.off, a.off) AS off2
    FROM ranked a LEFT JOIN ranked b ON a.phrase = b.phrase AND b.k = 2 WHERE a.k = 1 AND a.n > 0
), close AS (
    SELECT DISTINCT x.r, phrase.item FROM rarest
    JOIN word x ON x.term = term1 JOIN word y ON y.r = x.r AND y.term = term2 JOIN phrase ON phrase.phrase = rarest.phrase
    WHERE abs((x.pos - off1) - (y.pos - off2)) <= 3
), n_close AS (
    SELECT r, count(*) AS n_near FROM close ANTI JOIN (SELECT DISTINCT r, item FROM found) USING (r, item) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near, 0) AS n_near
FROM doc LEFT JOIN hit USING (r) LEFT JOIN listed USING (r) LEFT JOIN n_close USING (r)
"""

TOPK = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.e, d.e) AS BIGINT) AS score,
           row_number() OVER (PARTITION BY q.r ORDER BY list_inner_product(q.e, d.e) DESC, d.vec_id, d.r) AS rank
    FROM v q JOIN v d ON q.r <> d.r WHERE q.vec_id % 20 = 0
) WHERE rank <= 20
"""

_ROUND = """
), a{n} AS (
    SELECT r, arg_min(c, (d, c)) AS c FROM (
        SELECT r, c, list_inner_product(k.e, k.e) - 2 * list_inner_product(v.e, k.e) AS d FROM v, c{n} k) GROUP BY r
), c{m} AS (
    SELECT k.c, coalesce(mean.e, k.e) AS e FROM c{n} k LEFT JOIN (
        SELECT c, list(m ORDER BY i) AS e FROM (
            SELECT c, i, floor(sum(x) / count(*)) AS m
            FROM (SELECT a{n}.c, unnest(v.e) AS x, unnest(generate_series(1, 64)) AS i FROM v JOIN a{n} USING (r)) GROUP BY c, i)
        GROUP BY c) mean USING (c)
"""

CENTROIDS = (
    """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = 64
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
    SELECT row_number() OVER (ORDER BY name, e) - 1 AS c, e
    FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS name, e FROM v ORDER BY name, e LIMIT 16)
"""
    + "".join(_ROUND.format(n=n, m=n + 1) for n in range(3))
    + """
), near AS (
    SELECT r, any_value(vec_id) AS vec_id, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
        SELECT v.r, v.vec_id, k.c,
               list_inner_product(v.e, v.e) - 2 * list_inner_product(v.e, k.e) + list_inner_product(k.e, k.e) AS d
        FROM v, c3 k) GROUP BY r
)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       (SELECT sha256(array_to_string(list_transform(k.e, lambda x: CAST(x AS BIGINT)), ',')) FROM c3 k WHERE k.c = near.c)
           AS centroid_sha256
FROM near
"""
)

ALL = {"op3_topk_search": TOPK, "op10_decontaminate": DECONTAMINATE, "op13_centroid_clusters": CENTROIDS}
