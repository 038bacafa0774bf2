"""Recommendation lists for all users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.functions.text import content_text
from filmloom.functions.vectors import mean_vector
from filmloom.models.linear import fold_in
from filmloom.operators.features import tfidf
from filmloom.operators.interactions import binarize_positive, rescale_1_5
from filmloom.operators.relational import top_k_per_group
from filmloom.plans import lifecycle, recommend
from filmloom.session import cut_lineage
from filmloom.sources import surrogates as s
from filmloom.sources.surrogates import with_views
from filmloom.workload.features import dense_features
from filmloom.workload.joins import split
from filmloom.workload.registry import query
from filmloom.workload.sqlparts import COLD_RANKED, EMBEDDED, FOLD_RANKED, POPULAR, TFIDF_RANKED

_COLUMNS = "user_id, movie_id, score, CAST(rank AS INTEGER) AS rank"


def _item_vectors(spark: SparkSession, d: str) -> DataFrame:
    return s.embeddings(spark, d).select("movie_id", F.col("embedding").alias("vec"))


def _customers(spark: SparkSession, d: str) -> DataFrame:
    return s.table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))


@query("recommend_popular", with_views(["split"], POPULAR) + f"SELECT {_COLUMNS} FROM pop_ranked WHERE rank <= 10")
def recommend_popular(spark: SparkSession, d: str) -> DataFrame:
    return recommend.recommend_popular(split(spark, d)[0], 10)


def _tfidf_lists(spark: SparkSession, d: str, k: int) -> DataFrame:
    movies = s.movies(spark, d)
    terms = tfidf(movies, "movie_id", content_text(F.col("title"), F.col("genre_names")))
    return recommend.recommend_tfidf(split(spark, d)[0], terms, movies, k)


@query(
    "recommend_tfidf",
    with_views(["split", "movies"], TFIDF_RANKED) + f"SELECT {_COLUMNS} FROM tfidf_ranked WHERE rank <= 20",
)
def recommend_tfidf(spark: SparkSession, d: str) -> DataFrame:
    return _tfidf_lists(spark, d, 20)


@query(
    "recommend_from_liked",
    with_views(["split", "movies"], EMBEDDED)
    + """, years AS (SELECT movie_id, CAST(release_year AS DOUBLE) AS y FROM movies_s JOIN emb USING (movie_id)),
span AS (SELECT min(y) AS lo, max(y) AS hi FROM years),
feat AS (SELECT e.movie_id, list_append(e.vec, (y - lo) / (hi - lo)) AS vec FROM emb e JOIN years USING (movie_id), span),
fcells AS (SELECT movie_id, unnest(range(1, len(vec) + 1)) AS pos, unnest(vec) AS x FROM feat),
titles AS (SELECT lower(trim(title)) AS k, max(movie_id) AS movie_id FROM movies_s
  WHERE movie_id IN (SELECT movie_id FROM feat) GROUP BY 1),
liked AS (SELECT DISTINCT t.user_id, i.movie_id FROM train t JOIN movies_s m USING (movie_id) JOIN titles i ON i.k = lower(trim(m.title))),
prof AS (SELECT user_id, list(x ORDER BY pos) AS vec FROM (
  SELECT user_id, pos, avg(x) AS x FROM liked JOIN fcells USING (movie_id) GROUP BY 1, 2) GROUP BY user_id),
scored AS (
  SELECT p.user_id, f.movie_id, round(list_dot_product(
    list_transform(p.vec, lambda x: x / sqrt(list_dot_product(p.vec, p.vec))),
    list_transform(f.vec, lambda x: x / sqrt(list_dot_product(f.vec, f.vec)))), 6) AS score
  FROM prof p CROSS JOIN feat f
  WHERE NOT EXISTS (SELECT 1 FROM liked l WHERE l.user_id = p.user_id AND l.movie_id = f.movie_id))
SELECT user_id, movie_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) AS rank FROM scored) WHERE rank <= 5""",
)
def recommend_from_liked(spark: SparkSession, d: str) -> DataFrame:
    movies = s.movies(spark, d)
    liked = split(spark, d)[0].join(movies.select("movie_id", "title"), "movie_id").select("user_id", "title")
    return recommend.recommend_from_liked(liked, dense_features(spark, d), movies, 5)


def _cold_lists(spark: SparkSession, d: str, k: int, users: DataFrame | None = None) -> DataFrame:
    favorites = binarize_positive(s.ratings(spark, d))
    return recommend.recommend_cold_start(
        favorites, _item_vectors(spark, d), s.movies(spark, d), k, users=_customers(spark, d) if users is None else users
    )


@query(
    "recommend_cold_start",
    with_views(["pos", "movies"], COLD_RANKED) + f"SELECT {_COLUMNS}, strategy FROM cold_ranked WHERE rank <= 10",
)
def recommend_cold_start(spark: SparkSession, d: str) -> DataFrame:
    return _cold_lists(spark, d, 10)


@query(
    "recommend_genre_overlap",
    with_views(["movies"])
    + """, g AS (SELECT DISTINCT movie_id, trim(unnest(string_split(genre_names, '|'))) AS genre FROM movies_s),
seeds AS (SELECT movie_id AS seed_id FROM movies_s UNION SELECT 1000000000 + n_nationkey FROM nation),
scored AS (SELECT a.movie_id AS seed_id, b.movie_id, CAST(count(*) AS DOUBLE) AS score
  FROM g a JOIN g b ON a.genre = b.genre AND a.movie_id <> b.movie_id GROUP BY 1, 2),
best AS (SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, movie_id) AS rank FROM scored)
SELECT seed_id, movie_id, score, CAST(rank AS INTEGER) AS rank FROM best WHERE rank <= 12
UNION ALL
SELECT seed_id, movie_id, NULL, CAST(rank AS INTEGER) FROM seeds
CROSS JOIN (SELECT movie_id, row_number() OVER (ORDER BY movie_id) AS rank FROM movies_s)
WHERE rank <= 12 AND seed_id NOT IN (SELECT movie_id FROM movies_s)""",
)
def recommend_genre_overlap(spark: SparkSession, d: str) -> DataFrame:
    movies = s.movies(spark, d)
    seeds = movies.select(F.col("movie_id").alias("seed_id")).union(
        s.table(spark, d, "nation").select((F.col("n_nationkey") + 1_000_000_000).cast("bigint"))
    )
    return recommend.recommend_genre_overlap(movies, seeds, 12)


@query(
    "fold_in_user",
    with_views(["ratings"], FOLD_RANKED)
    + "SELECT user_id, CAST(pos AS BIGINT) AS pos, round(x, 9) AS x FROM (SELECT user_id, unnest(range(1, len(vec) + 1)) AS pos, unnest(vec) AS x FROM fold)",
)
def fold_in_user(spark: SparkSession, d: str) -> DataFrame:
    vectors = fold_in(s.ratings(spark, d), _item_vectors(spark, d))
    cells = vectors.select("user_id", F.posexplode("vec").alias("pos", "x"))
    return cells.select("user_id", (F.col("pos") + 1).cast("bigint").alias("pos"), F.round("x", 9).alias("x"))


@query(
    "recommend_fold_in",
    with_views(["ratings", "movies"], FOLD_RANKED)
    + f"""SELECT {_COLUMNS} FROM fold_ranked WHERE rank <= 12
UNION ALL
SELECT c_custkey, movie_id, NULL, CAST(rank AS INTEGER) FROM customer
CROSS JOIN (SELECT movie_id, row_number() OVER (ORDER BY md5(movie_id || '-42'), movie_id) AS rank FROM movies_s)
WHERE rank <= 12 AND c_custkey NOT IN (SELECT user_id FROM fold)""",
)
def recommend_fold_in(spark: SparkSession, d: str) -> DataFrame:
    return recommend.recommend_fold_in(
        s.ratings(spark, d), _item_vectors(spark, d), s.movies(spark, d), 12, users=_customers(spark, d)
    )


@query(
    "recommend_hybrid",
    with_views(["split", "movies"], TFIDF_RANKED + ",\n" + FOLD_RANKED)
    + """, c AS (SELECT user_id, movie_id, 1 - (rank - 1) / count(*) OVER (PARTITION BY user_id) AS s FROM tfidf_ranked WHERE rank <= 36),
f AS (SELECT user_id, movie_id, 1 - (rank - 1) / count(*) OVER (PARTITION BY user_id) AS s FROM fold_ranked WHERE rank <= 36),
both_s AS (SELECT coalesce(c.user_id, f.user_id) AS user_id, coalesce(c.movie_id, f.movie_id) AS movie_id,
  round(0.5 * coalesce(f.s, 0) + 0.5 * coalesce(c.s, 0), 6) AS score
  FROM c FULL JOIN f ON c.user_id = f.user_id AND c.movie_id = f.movie_id)
SELECT user_id, movie_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) AS rank FROM both_s) WHERE rank <= 12""",
)
def recommend_hybrid(spark: SparkSession, d: str) -> DataFrame:
    ratings, vectors = s.ratings(spark, d), _item_vectors(spark, d)
    collab = recommend.recommend_factors(
        fold_in(ratings, vectors), vectors, 36, seen=ratings.select("user_id", "movie_id")
    )
    return recommend.recommend_hybrid(_tfidf_lists(spark, d, 36), collab, 0.5, 12)


@query(
    "recommend_factors",
    with_views(["split"], EMBEDDED)
    + """, uf AS (SELECT user_id, list(x ORDER BY pos) AS vec FROM (
  SELECT user_id, pos, avg(x) AS x FROM train JOIN cells USING (movie_id) GROUP BY 1, 2) GROUP BY user_id),
scored AS (
  SELECT u.user_id, e.movie_id, round(list_dot_product(u.vec, e.vec), 6) AS score FROM uf u CROSS JOIN emb e
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.movie_id = e.movie_id))
SELECT user_id, movie_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) AS rank FROM scored) WHERE rank <= 20""",
)
def recommend_factors(spark: SparkSession, d: str) -> DataFrame:
    train, _ = split(spark, d)
    vectors = _item_vectors(spark, d)
    users = mean_vector(train.join(vectors, "movie_id"), "user_id", "vec")
    return recommend.recommend_factors(users, vectors, 20, seen=train)


_STAGE = """CASE WHEN n_ratings = 0 THEN 'new' WHEN n_ratings <= 5 THEN 'cold_start'
  WHEN n_ratings <= 20 THEN 'warm_start' ELSE 'mature' END"""
_STRATEGY = """CASE WHEN n_ratings <= 5 THEN 'content-based' WHEN n_ratings <= 20 THEN 'hybrid' ELSE 'collaborative' END"""


def _stages(spark: SparkSession, d: str) -> DataFrame:
    orders = s.table(spark, d, "orders").select(F.col("o_custkey").alias("user_id"))
    return lifecycle.user_stage(orders, _customers(spark, d))


@query("user_stage", with_views(["history"]) + f"SELECT user_id, n_ratings, {_STAGE} AS stage FROM history_s")
def user_stage(spark: SparkSession, d: str) -> DataFrame:
    return _stages(spark, d)


@query(
    "route_strategy",
    with_views(["history"]) + f"SELECT user_id, n_ratings, {_STAGE} AS stage, {_STRATEGY} AS strategy FROM history_s",
)
def route_strategy(spark: SparkSession, d: str) -> DataFrame:
    return lifecycle.route_strategy(_stages(spark, d))


_MESSAGE = "CASE strategy " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in lifecycle.MESSAGES.items()) + " END"


@query(
    "recommend_routed",
    with_views(["split", "movies", "history"], COLD_RANKED + ",\n" + POPULAR.replace("rank <= 20", "rank <= 30"))
    + f""", stages AS (SELECT user_id, n_ratings, {_STAGE} AS stage, {_STRATEGY} AS strategy FROM history_s),
c AS (SELECT user_id, movie_id, 1 - (rank - 1) / count(*) OVER (PARTITION BY user_id) AS s FROM cold_ranked WHERE rank <= 30),
p AS (SELECT user_id, movie_id, 1 - (rank - 1) / count(*) OVER (PARTITION BY user_id) AS s FROM pop_ranked WHERE rank <= 30),
blend AS (SELECT coalesce(c.user_id, p.user_id) AS user_id, coalesce(c.movie_id, p.movie_id) AS movie_id,
  round(0.5 * coalesce(p.s, 0) + 0.5 * coalesce(c.s, 0), 6) AS score
  FROM c FULL JOIN p ON c.user_id = p.user_id AND c.movie_id = p.movie_id),
lists AS (
  SELECT user_id, movie_id, rank, strategy AS source, 'content-based' AS wanted FROM cold_ranked WHERE rank <= 10
  UNION ALL SELECT user_id, movie_id, rank, 'hybrid', 'hybrid' FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) AS rank FROM blend) WHERE rank <= 10
  UNION ALL SELECT user_id, movie_id, rank, 'collaborative', 'collaborative' FROM pop_ranked WHERE rank <= 10)
SELECT l.user_id, movie_id, CAST(rank AS INTEGER) AS rank, stage, strategy,
  CAST(CASE strategy WHEN 'content-based' THEN 0.7 WHEN 'hybrid' THEN 0.8 ELSE 0.95 END AS DOUBLE) AS confidence, n_ratings,
  CASE WHEN source = 'popular' THEN '{lifecycle.FALLBACK_MESSAGE}' ELSE {_MESSAGE} END AS message
FROM lists l JOIN stages s ON s.user_id = l.user_id AND s.strategy = l.wanted""",
)
def recommend_routed(spark: SparkSession, d: str) -> DataFrame:
    train = split(spark, d)[0]
    return lifecycle.recommend_routed(
        cut_lineage(_stages(spark, d)),
        lambda users: _cold_lists(spark, d, 30, users),
        lambda users: recommend.recommend_popular(train, 30, users),
        10,
    )


@query(
    "default_method",
    with_views(["history"])
    + "SELECT user_id, n_ratings, CASE WHEN n_ratings >= 15 THEN 'collaborative' ELSE 'content' END AS method FROM history_s",
)
def default_method(spark: SparkSession, d: str) -> DataFrame:
    return lifecycle.default_method(s.history(spark, d)).select("user_id", "n_ratings", "method")


@query(
    "rated_movies",
    with_views(["ratings", "movies"])
    + "SELECT user_id, movie_id, title, genre_names, rating FROM ratings_s JOIN movies_s USING (movie_id)",
)
def rated_movies(spark: SparkSession, d: str) -> DataFrame:
    return lifecycle.rated_movies(s.ratings(spark, d), s.movies(spark, d))


@query(
    "favorite_movies",
    with_views(["pos", "movies"]) + "SELECT user_id, movie_id, title, genre_names FROM pos JOIN movies_s USING (movie_id)",
)
def favorite_movies(spark: SparkSession, d: str) -> DataFrame:
    return lifecycle.favorite_movies(binarize_positive(s.ratings(spark, d)), s.movies(spark, d))


@query(
    "rescale_1_5",
    with_views(["ratings"])
    + """, top AS (SELECT * FROM (
  SELECT user_id, movie_id, rating AS score, row_number() OVER (PARTITION BY user_id ORDER BY rating, movie_id) AS rank FROM ratings_s) WHERE rank <= 10),
ends AS (SELECT *, min(score) OVER (PARTITION BY user_id) AS lo, max(score) OVER (PARTITION BY user_id) AS hi FROM top)
SELECT user_id, movie_id, round(CASE WHEN hi = lo THEN 3.0 ELSE 1 + 4 * (score - lo) / (hi - lo) END, 9) AS rating FROM ends""",
)
def rescale(spark: SparkSession, d: str) -> DataFrame:
    rated = s.ratings(spark, d).select("user_id", "movie_id", F.col("rating").alias("score"))
    top = top_k_per_group(rated, "user_id", [F.asc("score"), F.asc("movie_id")], 10)
    return rescale_1_5(top).select("user_id", "movie_id", F.round("rating", 9).alias("rating"))


@query(
    "genre_overlap",
    with_views(["movies"])
    + """SELECT a.movie_id, CAST(len(list_intersect(string_split(a.genre_names, '|'), string_split(b.genre_names, '|'))) AS INTEGER) AS overlap
FROM movies_s a JOIN movies_s b ON b.movie_id = a.movie_id + 1""",
)
def genre_overlap(spark: SparkSession, d: str) -> DataFrame:
    from filmloom.functions.text import genre_list

    movies = s.movies(spark, d)
    left = movies.select("movie_id", F.array_distinct(genre_list(F.col("genre_names"))).alias("a"))
    right = movies.select((F.col("movie_id") - 1).alias("movie_id"), genre_list(F.col("genre_names")).alias("b"))
    return left.join(right, "movie_id").select("movie_id", F.size(F.array_intersect("a", "b")).alias("overlap"))
