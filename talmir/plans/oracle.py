"""The same results as plain SQL over the given tables, written pair by pair.

Nothing here follows the operators' plans: distances are computed for every pair, means by
windows, samples by one filter. Spark's own random start of k-means cannot be foreseen; there
the expected rows are what must hold for any start.
"""

from __future__ import annotations

RATINGS = """ratings AS (
  SELECT l_partkey AS product, o_custkey AS "user", l_quantity AS rating,
         (o_orderdate::DATE - DATE '1970-01-01')::BIGINT * 86400 AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

NORMS = f"""{RATINGS},
norms AS (
  SELECT product, trunc(rating) - avg(trunc(rating)) OVER (PARTITION BY "user") AS norm
  FROM ratings)"""

POINTS = """points AS (
  SELECT vec_id, embedding::DOUBLE[] AS x, label AS cluster FROM embeddings)"""

MEANS = f"""{POINTS},
coordinates AS (
  SELECT cluster AS cid, i, avg(x[i]) AS m
  FROM points, range(1, 65) r(i) GROUP BY cluster, i),
means AS (SELECT cid, list(m ORDER BY i) AS c FROM coordinates GROUP BY cid)"""

WORDS = "words AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents)"

WORD_COUNT = f"WITH {WORDS} SELECT word, count(*) AS cnt FROM words GROUP BY word"

TOP = f"""WITH {NORMS}
SELECT product, round(max(norm), 6) AS max_norm FROM norms
GROUP BY product ORDER BY max(norm) DESC, product LIMIT 10"""


def _distance(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) ** 2))"


def _draw(seed: str, key: str = "vec_id") -> str:
    return f"('0x' || substr(md5({key} || ':' || {seed}), 1, 13))::BIGINT / 4503599627370496.0"


def _silhouette(points: str, t: str, seeds: str) -> str:
    """CTEs sizes, sample and scores (seed, vec_id, cluster, a, b, s) over all points."""
    return f"""
sizes AS (SELECT cluster, count(*) AS n FROM {points} GROUP BY cluster),
seeds AS (SELECT seed FROM {seeds}),
sample AS (
  SELECT seed, vec_id, x, cluster FROM {points} JOIN sizes USING (cluster), seeds
  WHERE {_draw("seed")} < {t}::DOUBLE / n),
pairs AS (
  SELECT seeds.seed, p.vec_id, p.cluster, z.cluster AS other,
         coalesce(sum({_distance("p.x", "q.x")}), 0) / least({t}::DOUBLE, any_value(z.n)) AS m
  FROM {points} p CROSS JOIN sizes z CROSS JOIN seeds
  LEFT JOIN sample q ON q.cluster = z.cluster AND q.seed = seeds.seed
  GROUP BY seeds.seed, p.vec_id, p.cluster, z.cluster),
bounds AS (
  SELECT seed, vec_id, cluster, max(m) FILTER (other = cluster) AS a,
         min(m) FILTER (other <> cluster) AS b
  FROM pairs GROUP BY seed, vec_id, cluster),
scores AS (
  SELECT *, CASE WHEN greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END AS s
  FROM bounds)"""


def _lloyd(k: int, steps: int, seed: int) -> str:
    """CTEs c0 to c<steps> (cid, c)."""
    ctes = [
        f"""
c0 AS (
  SELECT row_number() OVER (ORDER BY md5(vec_id || ':' || {seed}), vec_id) - 1 AS cid, x AS c
  FROM points ORDER BY cid LIMIT {k})"""
    ]
    for step in range(1, steps + 1):
        ctes.append(
            f"""
a{step} AS ({_nearest(f"c{step - 1}")}),
m{step} AS (
  SELECT cluster AS cid, i, avg(x[i]) AS m FROM a{step}, range(1, 65) r(i)
  GROUP BY cluster, i),
c{step} AS (
  SELECT cid, coalesce(moved.c, old.c) AS c
  FROM c{step - 1} old
  LEFT JOIN (SELECT cid, list(m ORDER BY i) AS c FROM m{step} GROUP BY cid) moved USING (cid))"""
        )
    return ",".join(ctes)


def _nearest(centres: str) -> str:
    return f"""
  SELECT vec_id, x, arg_min(cid, (d, cid))::INT AS cluster
  FROM (SELECT vec_id, x, cid, {_distance("x", "c")} AS d FROM points, {centres})
  GROUP BY vec_id, x"""


def _sweep(ks: range, steps: int, m: int, seed: int) -> str:
    parts = []
    for k in ks:
        parts.append(
            f"""(WITH {POINTS}, {_lloyd(k, steps, seed)},
assigned AS ({_nearest(f"c{steps}")}),
{_silhouette("assigned", f"({m}.0 / {k})", f"(SELECT {seed} AS seed)")}
SELECT {k}::INT AS k, count(*) AS n, round(avg(s), 5) AS silhouette FROM scores)"""
        )
    return "\nUNION ALL\n".join(parts)


ONE_SEED = "(SELECT 7 AS seed)"
SCORED = f"WITH {POINTS}, {_silhouette('points', '20', ONE_SEED)}"

TRIALS = f"""WITH {POINTS}, {_silhouette("points", "20", "(SELECT range::INT AS seed FROM range(5))")},
trials AS (
  SELECT seed AS trial, count(*) AS n, avg(s) AS approx, count(q.vec_id) AS n_sample,
         avg(s) FILTER (q.vec_id IS NOT NULL) AS exact
  FROM scores LEFT JOIN (SELECT seed, vec_id FROM sample) q USING (seed, vec_id)
  GROUP BY seed)"""


def _reviews(parts: str) -> str:
    return f"""WITH {RATINGS},
bag AS (
  SELECT "user", product, rating, count(*) AS copies FROM ratings
  GROUP BY "user", product, rating),
placed AS (
  SELECT *, floor({_draw("0", "product || ':' || rating")} * {parts})::INT AS part FROM bag)
SELECT "user", part, sum(copies)::BIGINT AS n_reviews,
       string_agg(product || ':' || rating || ':' || copies, ',' ORDER BY product, rating)
         AS reviews
FROM placed GROUP BY "user", part"""


WHOLE_POINTS = """w AS (
  SELECT list_transform(embedding[1:3], lambda x: floor(x::DOUBLE * 4)::BIGINT::DOUBLE) AS x, label AS cluster
  FROM embeddings),
points AS (
  SELECT x, cluster, array_to_string(x, ',') AS p,
         row_number() OVER (PARTITION BY x, cluster) - 1 AS copy,
         row_number() OVER () AS n FROM w),
numbered AS (SELECT x, cluster, p || ':' || cluster || ':' || copy AS vec_id FROM points)"""

WHOLE_LINES = """w AS (
  SELECT list_transform(embedding[1:3], lambda x: floor(x::DOUBLE * 4)::BIGINT) AS p, label FROM embeddings)"""

WHOLE_SCORED = f"WITH {WHOLE_POINTS}, {_silhouette('numbered', '20', ONE_SEED)}"

NORMALIZED = f"WITH {NORMS} SELECT product, round(norm, 6) AS norm FROM norms"

ORACLE_SQL: dict[str, str] = {
    "read_lines": r"""
SELECT value, count(*) AS n
FROM (SELECT unnest(string_split_regex(text, '\r\n|\r|\n')) AS value FROM documents)
GROUP BY value""",
    "read_ratings": f"""WITH {RATINGS}
SELECT product::VARCHAR AS product, "user"::VARCHAR AS "user", rating, ts FROM ratings""",
    "read_labelled_points": """
SELECT label AS cluster, (i - 1)::INT AS dim, embedding[i]::VARCHAR::DOUBLE AS x
FROM embeddings, range(1, 65) r(i)""",
    "read_points": """
SELECT (i - 1)::INT AS dim, embedding[i]::VARCHAR::DOUBLE AS x
FROM embeddings, range(1, 65) r(i)""",
    "partition_into": "SELECT 8::BIGINT AS n_partitions, count(*) AS n_rows FROM orders",
    "last_review_per_document": """
SELECT ts::DATE::VARCHAR AS doc, user_id AS "user",
       arg_max(event_type, (ts, event_id)) AS product, arg_max(value, (ts, event_id)) AS rating
FROM events GROUP BY 1, 2""",
    "write_result": TOP,
    "doc_word_count": f"""WITH {WORDS}
SELECT doc_id, word, count(*) AS cnt FROM words GROUP BY doc_id, word""",
    "word_count": WORD_COUNT,
    "word_count_salted": WORD_COUNT,
    "word_count_salted_groupby": WORD_COUNT,
    "word_count_by_partition": WORD_COUNT,
    "num_documents": "SELECT count(*) AS num_documents FROM documents",
    "num_distinct_words": f"""WITH {WORDS}
SELECT count(DISTINCT word) AS num_distinct_words FROM words""",
    "avg_distinct_word_length": f"""WITH {WORDS}
SELECT avg(length(word)) AS avg_distinct_word_length FROM (SELECT DISTINCT word FROM words)""",
    "truncated_rating_sum": """
SELECT event_type, sum(trunc(value)::BIGINT)::BIGINT AS total FROM events GROUP BY event_type""",
    "reviews_by_user": _reviews("1"),
    "reviews_by_user_parts": _reviews("3"),
    "user_totals": f"""WITH {RATINGS}
SELECT "user", product, (sum(trunc(rating)) OVER w)::BIGINT AS total,
       count(*) OVER w AS n, rating
FROM ratings WINDOW w AS (PARTITION BY "user")""",
    "normalize_ratings": NORMALIZED,
    "normalize_ratings_hot_users": NORMALIZED,
    "max_normalized_rating": f"""WITH {NORMS}
SELECT product, round(max(norm), 6) AS max_norm FROM norms GROUP BY product""",
    "top_products": TOP,
    "preview": f"""WITH {RATINGS}
SELECT product, "user", rating FROM ratings ORDER BY product, "user", rating LIMIT 7""",
    "pairwise_squared_distance": f"""WITH {MEANS}
SELECT vec_id, cluster, round({_distance("x", "c")}, 6) AS d
FROM points JOIN means ON cid = cluster""",
    "cluster_sizes": "SELECT label AS cluster, count(*) AS n FROM embeddings GROUP BY label",
    "sample_clusters": f"{SCORED} SELECT vec_id, cluster FROM sample",
    "sample_sizes": f"""{SCORED}
SELECT cluster, count(*) AS n_sampled FROM sample GROUP BY cluster""",
    "silhouette_points": f"""{SCORED}
SELECT vec_id, cluster, round(a, 6) AS a, round(b, 6) AS b, round(s, 6) AS s FROM scores""",
    "silhouette_undrawn": f"""
WITH {POINTS}, {_silhouette("points", "1", "(SELECT range::INT AS seed FROM range(3))")}
SELECT seed, vec_id, round(s, 6) AS s FROM scores""",
    "approx_silhouette": f"""{SCORED}
SELECT count(*) AS n, round(avg(s), 5) AS silhouette FROM scores""",
    "exact_sample_silhouette": f"""{SCORED}
SELECT count(*) AS n, round(avg(s), 5) AS silhouette
FROM scores SEMI JOIN sample USING (seed, vec_id)""",
    "silhouette_trials": f"""{TRIALS}
SELECT trial, n, round(approx, 5) AS approx, n_sample, round(exact, 5) AS exact FROM trials""",
    "repeated_silhouette": f"""{TRIALS}
SELECT count(*) AS trials, round(avg(approx), 5) AS approx, round(avg(exact), 5) AS exact
FROM trials""",
    "lloyd_kmeans": f"""WITH {POINTS}, {_lloyd(4, 2, 1)}
SELECT cid::INT AS cid, (i - 1)::INT AS dim, round(c[i], 6) AS x FROM c2, range(1, 65) r(i)""",
    "assign_clusters": f"""WITH {MEANS}
SELECT vec_id, cluster FROM ({_nearest("means")})""",
    "k_sweep": _sweep(range(2, 5), 2, 50, 1),
    "kmeans_random": """
SELECT 4::BIGINT AS n_centres, count(*) AS n_points, 0.0::DOUBLE AS shift FROM embeddings""",
    "k_sweep_random": """
SELECT k::INT AS k, count(*) AS n, true AS in_range FROM embeddings, (VALUES (2), (3)) t(k) GROUP BY k""",
    "sample_clusters_no_id": f"""{WHOLE_SCORED}
SELECT array_to_string(x::BIGINT[], ',') AS p, cluster, count(*) AS n FROM sample GROUP BY 1, 2""",
    "approx_silhouette_no_id": f"""{WHOLE_SCORED}
SELECT count(*) AS n, round(avg(s), 5) AS silhouette FROM scores""",
    "last_review_per_document_from_text": """
SELECT ts::DATE::VARCHAR AS doc, user_id AS "user",
       arg_max(event_type, (ts, event_id)) AS product, arg_max(value, (ts, event_id)) AS rating
FROM events GROUP BY 1, 2""",
    "rejected_ratings": f"""WITH {RATINGS}
SELECT product || ',' || "user" || ',none,' || ts AS value, count(*) AS n FROM ratings
WHERE product % 10 = 0 GROUP BY 1""",
    "review_pages": f"""WITH {RATINGS},
bag AS (
  SELECT "user", product, rating, count(*) AS copies FROM ratings
  GROUP BY "user", product, rating),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY product, rating) - 1 AS place FROM bag)
SELECT "user", (place // 10)::BIGINT AS page, sum(copies)::BIGINT AS n_reviews,
       string_agg(product || ':' || rating || ':' || copies, ',' ORDER BY product, rating) AS reviews
FROM ranked GROUP BY 1, 2""",
    "rejected_labelled_points": f"""WITH {WHOLE_LINES}
SELECT p[1] % 3 <> 0 AS accepted, count(*) AS n,
       array_to_string(p, ',') || ',' || CASE WHEN p[1] % 3 = 0 THEN 'none' ELSE label::VARCHAR END AS line
FROM w GROUP BY 1, 3""",
    "rejected_points": f"""WITH {WHOLE_LINES}
SELECT p[1] % 3 <> 0 AS accepted, count(*) AS n,
       CASE WHEN p[1] % 3 = 0 THEN array_to_string(p, ' ') || ' nan' ELSE array_to_string(p, ',') END AS line
FROM w GROUP BY 1, 3""",
    "sample_in_one_pass": f"{SCORED} SELECT vec_id, cluster FROM sample",
    "assign_clusters_in_blocks": f"""WITH {MEANS}
SELECT vec_id, cluster FROM ({_nearest("means")})""",
    "normalize_ratings_missing": f"""WITH {RATINGS},
given AS (SELECT product, "user", CASE WHEN rating % 4 <> 0 THEN trunc(rating) END AS rating FROM ratings)
SELECT product, round(rating - avg(rating) OVER (PARTITION BY "user"), 6) AS norm FROM given""",
}
