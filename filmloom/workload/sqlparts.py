"""SQL expressions that several statements share."""

from __future__ import annotations

from filmloom.functions.text import english_stop_words

STOPS = ", ".join("'" + w.replace("'", "''") + "'" for w in english_stop_words())


def tfidf_sql(source: str, key: str, text: str, max_features: int, prefix: str = "") -> str:
    """Expressions ending in ``{prefix}tfidf`` (key, term, weight)."""
    p = prefix
    return f"""{p}words AS (
  SELECT {key}, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM {source}),
{p}counts AS (SELECT {key}, term, count(*) AS tf FROM {p}words WHERE term NOT IN ({STOPS}) GROUP BY 1, 2),
{p}vocab AS (SELECT term, count(*) AS df, sum(tf) AS total FROM {p}counts GROUP BY term ORDER BY total DESC, term LIMIT {max_features}),
{p}raw AS (
  SELECT {key}, term, tf * (ln((1.0::DOUBLE + (SELECT count(*) FROM {source})) / (1.0::DOUBLE + df)) + 1.0::DOUBLE) AS w
  FROM {p}counts JOIN {p}vocab USING (term)),
{p}tfidf AS (SELECT {key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM {p}raw)"""


# Best-liked unseen train films per user: pop_ranked (user_id, movie_id, score, rank).
POPULAR = """pop AS (SELECT movie_id, CAST(count(*) AS DOUBLE) AS score FROM train GROUP BY movie_id),
pop_ranked AS (
  SELECT user_id, movie_id, score, rank FROM (
    SELECT u.user_id, p.movie_id, p.score,
           row_number() OVER (PARTITION BY u.user_id ORDER BY p.score DESC, p.movie_id) AS rank
    FROM (SELECT DISTINCT user_id FROM train) u, pop p
    WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.movie_id = p.movie_id))
  WHERE rank <= 20)"""

# Cosine of mean TF-IDF rows: tfidf_ranked (user_id, movie_id, score, rank), 36 deep.
TFIDF_RANKED = (
    tfidf_sql("movies_s", "movie_id", "title || ' ' || genre_names", 3000, "m_")
    + """,
prof AS (SELECT user_id, term, sum(weight) AS w FROM train JOIN m_tfidf USING (movie_id) GROUP BY 1, 2),
unit AS (SELECT user_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY user_id)) AS w FROM prof),
dots AS (SELECT user_id, movie_id, sum(w * weight) AS score FROM unit JOIN m_tfidf USING (term) GROUP BY 1, 2),
tfidf_ranked AS (
  SELECT user_id, movie_id, score, rank FROM (
    SELECT u.user_id, m.movie_id, round(coalesce(d.score, 0), 6) AS score,
           row_number() OVER (PARTITION BY u.user_id ORDER BY round(coalesce(d.score, 0), 6) DESC, m.movie_id) AS rank
    FROM (SELECT DISTINCT user_id FROM unit) u CROSS JOIN movies_s m
    LEFT JOIN dots d ON d.user_id = u.user_id AND d.movie_id = m.movie_id
    WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.movie_id = m.movie_id))
  WHERE rank <= 36)"""
)

EMBEDDED = """emb AS (SELECT vec_id AS movie_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
cells AS (SELECT movie_id, unnest(range(1, len(vec) + 1)) AS pos, unnest(vec) AS x FROM emb)"""

# Rating-weighted mean of the embedded films: fold_ranked, 36 deep, plus random films otherwise.
FOLD_RANKED = (
    EMBEDDED
    + """,
fold AS (
  SELECT user_id, list(x ORDER BY pos) AS vec FROM (
    SELECT user_id, pos, sum(rating * x) / sum(rating) AS x FROM ratings_s JOIN cells USING (movie_id) GROUP BY 1, 2)
  GROUP BY user_id),
fold_ranked AS (
  SELECT user_id, movie_id, score, rank FROM (
    SELECT f.user_id, e.movie_id, round(list_dot_product(f.vec, e.vec), 6) AS score,
           row_number() OVER (PARTITION BY f.user_id ORDER BY round(list_dot_product(f.vec, e.vec), 6) DESC, e.movie_id) AS rank
    FROM fold f CROSS JOIN emb e
    WHERE NOT EXISTS (SELECT 1 FROM ratings_s r WHERE r.user_id = f.user_id AND r.movie_id = e.movie_id))
  WHERE rank <= 36)"""
)

# Cosine to the mean of positively rated films, popular films otherwise: cold_ranked, 30 deep.
COLD_RANKED = (
    EMBEDDED
    + """,
favs AS (SELECT user_id, movie_id FROM pos WHERE movie_id IN (SELECT movie_id FROM emb)),
prof_c AS (
  SELECT user_id, list(x ORDER BY pos) AS vec FROM (
    SELECT user_id, pos, avg(x) AS x FROM favs JOIN cells USING (movie_id) GROUP BY 1, 2) GROUP BY user_id),
unit_p AS (SELECT user_id, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS vec FROM prof_c),
unit_e AS (SELECT movie_id, list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec))) AS vec FROM emb),
cold_content AS (
  SELECT user_id, movie_id, score, rank FROM (
    SELECT p.user_id, e.movie_id, round(list_dot_product(p.vec, e.vec), 6) AS score,
           row_number() OVER (PARTITION BY p.user_id ORDER BY round(list_dot_product(p.vec, e.vec), 6) DESC, e.movie_id) AS rank
    FROM unit_p p CROSS JOIN unit_e e
    WHERE NOT EXISTS (SELECT 1 FROM favs f WHERE f.user_id = p.user_id AND f.movie_id = e.movie_id))
  WHERE rank <= 30),
cold_popular AS (
  SELECT c.c_custkey AS user_id, m.movie_id, CAST(NULL AS DOUBLE) AS score, m.rank FROM customer c
  CROSS JOIN (SELECT movie_id, row_number() OVER (ORDER BY popularity DESC, movie_id) AS rank FROM movies_s) m
  WHERE m.rank <= 30 AND c.c_custkey NOT IN (SELECT user_id FROM favs)),
cold_ranked AS (
  SELECT *, 'content-based' AS strategy FROM cold_content UNION ALL SELECT *, 'popular' FROM cold_popular)"""
)

# Metrics of ``ranked`` (model, user_id, movie_id, rank) against test films known to train.
METRICS = """known AS (SELECT user_id, movie_id FROM test WHERE movie_id IN (SELECT movie_id FROM train)),
rel AS (SELECT user_id, count(*) AS n_rel FROM known GROUP BY user_id),
hits AS (
  SELECT r.model, r.user_id, r.rank, CASE WHEN k.user_id IS NULL THEN 0 ELSE 1 END AS hit
  FROM ranked r LEFT JOIN known k ON k.user_id = r.user_id AND k.movie_id = r.movie_id),
per_user AS (
  SELECT model, user_id, k, hits / len AS "precision", hits / n_rel AS recall,
         dcg / list_sum([1 / log2(i + 1) for i in range(1, least(k, n_rel) + 1)]) AS ndcg
  FROM (
    SELECT model, user_id, k, n_rel, CAST(count(*) AS DOUBLE) AS len, CAST(sum(hit) AS DOUBLE) AS hits,
           sum(CASE WHEN hit = 1 THEN 1 / log2(rank + 1) ELSE 0 END) AS dcg
    FROM hits JOIN rel USING (user_id) CROSS JOIN (VALUES (10), (20)) ks(k)
    WHERE rank <= k GROUP BY model, user_id, k, n_rel))"""

POPULAR_MODEL = POPULAR + ",\nranked AS (SELECT 'popular' AS model, user_id, movie_id, rank FROM pop_ranked)"
TWO_MODELS = (
    POPULAR
    + ",\n"
    + TFIDF_RANKED
    + """,
ranked AS (SELECT 'popular' AS model, user_id, movie_id, rank FROM pop_ranked
  UNION ALL SELECT 'content', user_id, movie_id, rank FROM tfidf_ranked WHERE rank <= 20)"""
)
