"""Graph operators and fitted models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.models import explicit, graph, linear, ranking_loss
from filmloom.operators.features import identity_plus_features, tfidf
from filmloom.operators.interactions import random_split
from filmloom.operators.metrics import rating_errors
from filmloom.operators.relational import index_ids
from filmloom.plans.recommend import recommend_bpr_content as bpr_lists
from filmloom.plans.recommend import recommend_factors
from filmloom.session import StepTables, cut_lineage
from filmloom.sources import surrogates as s
from filmloom.sources.surrogates import with_views
from filmloom.workload.aggregates import _EDGES_SQL
from filmloom.workload.features import dense_features
from filmloom.workload.joins import split
from filmloom.workload.registry import query

_GRAPH_SQL = (
    _EDGES_SQL
    + """,
deg AS (SELECT dst AS node, count(*) AS n FROM edges GROUP BY dst),
graph AS (SELECT src, dst, (1 / sqrt(a.n)) * (1 / sqrt(b.n)) AS weight
  FROM edges JOIN deg a ON a.node = src JOIN deg b ON b.node = dst)"""
)


@query("bipartite_graph", with_views(["split"], _GRAPH_SQL) + "SELECT src, dst, round(weight, 9) AS weight FROM graph")
def bipartite_graph(spark: SparkSession, d: str) -> DataFrame:
    return graph.bipartite_graph(split(spark, d)[0]).withColumn("weight", F.round("weight", 9))


@query(
    "propagate",
    with_views(["split"], _GRAPH_SQL)
    + """, e0 AS (SELECT node, (node % 7) / 7.0::DOUBLE AS x, (node % 11) / 11.0::DOUBLE AS y FROM deg),
e1 AS (SELECT dst AS node, sum(weight * x) AS x, sum(weight * y) AS y FROM graph JOIN e0 ON node = src GROUP BY dst),
e2 AS (SELECT dst AS node, sum(weight * x) AS x, sum(weight * y) AS y FROM graph JOIN e1 ON node = src GROUP BY dst),
e3 AS (SELECT dst AS node, sum(weight * x) AS x, sum(weight * y) AS y FROM graph JOIN e2 ON node = src GROUP BY dst)
SELECT node, round(sum(x) / 4, 9) AS x, round(sum(y) / 4, 9) AS y FROM (
  SELECT * FROM e0 UNION ALL SELECT * FROM e1 UNION ALL SELECT * FROM e2 UNION ALL SELECT * FROM e3) GROUP BY node""",
)
def propagate(spark: SparkSession, d: str) -> DataFrame:
    edges = cut_lineage(graph.bipartite_graph(split(spark, d)[0]))
    node = F.col("node")
    start = edges.select(F.col("dst").alias("node")).distinct().withColumn("vec", F.array(node % 7 / 7.0, node % 11 / 11.0))
    spread = graph.propagate(edges, start, layers=3)
    return spread.select("node", F.round(F.col("vec")[0], 9).alias("x"), F.round(F.col("vec")[1], 9).alias("y"))


@query(
    "sample_negatives",
    with_views(["split"])
    + """, idx AS (SELECT movie_id, row_number() OVER (ORDER BY md5(CAST(movie_id AS VARCHAR)), movie_id) - 1 AS idx
  FROM (SELECT DISTINCT movie_id FROM train)),
draws AS (
  SELECT user_id, movie_id, r,
    CAST('0x' || substr(md5(user_id || '-' || movie_id || '-0-' || r || '-42'), 1, 12) AS BIGINT) % (SELECT count(*) FROM idx) AS idx
  FROM train CROSS JOIN range(0, 33) t(r)),
fresh AS (
  SELECT d.user_id, d.movie_id, i.movie_id AS neg_id, r FROM draws d JOIN idx i USING (idx)
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = d.user_id AND t.movie_id = i.movie_id))
SELECT user_id, movie_id, arg_min(neg_id, r) AS neg_id FROM fresh GROUP BY 1, 2""",
)
def sample_negatives(spark: SparkSession, d: str) -> DataFrame:
    train, _ = split(spark, d)
    return graph.sample_negatives(train, train.select("movie_id").distinct())


def _summary(kind: str, factors: DataFrame, key: str) -> DataFrame:
    """Factor tables in a flat form: one row per vector."""
    from filmloom.functions.vectors import norm

    return factors.select(F.lit(kind).alias("kind"), F.col(key).cast("bigint").alias("id"), norm(F.col("vec")).alias("norm"))


def _both(users: DataFrame, items: DataFrame) -> DataFrame:
    return _summary("user", users, "user_id").unionByName(_summary("item", items, "movie_id"))


@query("train_svd")
def train_svd(spark: SparkSession, d: str) -> DataFrame:
    users, items, _ = linear.train_svd(split(spark, d)[0], k=50, tol=1e-2)
    return _both(users, items)


@query("recommend_svd")
def recommend_svd(spark: SparkSession, d: str) -> DataFrame:
    train, _ = split(spark, d)
    users, items, _ = linear.train_svd(train, k=50, tol=1e-2)
    return recommend_factors(users, items, 20, seen=train)


@query("train_explicit_mf")
def train_explicit_mf(spark: SparkSession, d: str) -> DataFrame:
    """Fit on the train part of a random split, errors on the rest."""
    marked = random_split(s.ratings(spark, d))
    model = explicit.train_explicit_mf(marked.where("is_train"), rank=100, epochs=30)
    held_out = marked.where("NOT is_train").select("user_id", "movie_id", "rating")
    return rating_errors(explicit.predict_ratings(model, held_out))


@query("recommend_explicit")
def recommend_explicit(spark: SparkSession, d: str) -> DataFrame:
    ratings = s.ratings(spark, d)
    return explicit.recommend_explicit(explicit.train_explicit_mf(ratings, rank=100, epochs=30), ratings, 10)


@query("refit_with_user")
def refit_with_user(spark: SparkSession, d: str) -> DataFrame:
    ratings = s.ratings(spark, d)
    return explicit.refit_with_user(ratings, s.movies(spark, d), rank=100, epochs=30)


def _ranking_lists(train: DataFrame, k: int = 20, **fit: object) -> DataFrame:
    model = ranking_loss.train_ranking(train, **fit)
    seen = train.select("user_id", "movie_id")
    return recommend_factors(model.users, model.items, k, seen=seen)


@query(
    "ranking_step",
    with_views(["split"])
    + """, idx AS (SELECT movie_id, row_number() OVER (ORDER BY md5(CAST(movie_id AS VARCHAR)), movie_id) - 1 AS film
  FROM (SELECT DISTINCT movie_id FROM train)),
keys AS (SELECT 'feature' AS kind, film AS id, md5(film || '-0-42') AS h, 0.0::DOUBLE AS tail FROM idx
  UNION ALL SELECT DISTINCT 'user', user_id, md5(user_id || '-0-43'), 1.0::DOUBLE FROM train),
w AS (SELECT kind, id, tail, list_transform([1, 9, 17, 25], lambda p: (CAST('0x' || substr(h, p, 8) AS BIGINT) + 1) / 4294967297.0::DOUBLE) AS w FROM keys),
st AS (SELECT kind, id, [sqrt(-2 * ln(w[1])) * 0.25 * cos(2 * pi() * w[2]), sqrt(-2 * ln(w[1])) * 0.25 * sin(2 * pi() * w[2]),
                         sqrt(-2 * ln(w[3])) * 0.25 * cos(2 * pi() * w[4]), sqrt(-2 * ln(w[3])) * 0.25 * sin(2 * pi() * w[4]), tail] AS vec FROM w),
pairs AS (SELECT user_id, movie_id, film FROM train JOIN idx USING (movie_id)),
n AS (SELECT count(*) AS n FROM idx),
drawn AS (SELECT p.user_id, p.film, r, CAST('0x' || substr(md5(p.user_id || '-' || p.movie_id || '-0-' || r || '-42'), 1, 12) AS BIGINT) % n AS other
  FROM pairs p CROSS JOIN range(1, 11) t(r) CROSS JOIN n),
open_ AS (SELECT d.* FROM drawn d JOIN st u ON u.kind = 'user' AND u.id = d.user_id JOIN st i ON i.kind = 'feature' AND i.id = d.film
  JOIN st j ON j.kind = 'feature' AND j.id = d.other
  WHERE list_inner_product(u.vec, i.vec) - list_inner_product(u.vec, j.vec) < 1.0
    AND NOT EXISTS (SELECT 1 FROM pairs p WHERE p.user_id = d.user_id AND p.film = d.other)),
first AS (SELECT user_id, film, min(r) AS draw, arg_min(other, r) AS other FROM open_ GROUP BY 1, 2),
sized AS (SELECT f.*, least(10.0::DOUBLE, ln(greatest(1, (n - 1) // draw))) AS size FROM first f CROSS JOIN n),
g AS (SELECT s.user_id, s.film, s.other, size, u.vec AS vu, i.vec AS vi, j.vec AS vj
  FROM sized s JOIN st u ON u.kind = 'user' AND u.id = s.user_id JOIN st i ON i.kind = 'feature' AND i.id = s.film
  JOIN st j ON j.kind = 'feature' AND j.id = s.other WHERE size > 0),
parts AS (SELECT 'user' AS kind, user_id AS id, pos, CASE WHEN pos < 5 THEN size * (vj[pos] - vi[pos]) ELSE 0 END AS x FROM g CROSS JOIN range(1, 6) t(pos)
  UNION ALL SELECT 'feature', film, pos, -size * vu[pos] FROM g CROSS JOIN range(1, 6) t(pos)
  UNION ALL SELECT 'feature', other, pos, size * vu[pos] FROM g CROSS JOIN range(1, 6) t(pos)),
summed AS (SELECT kind, id, pos, sum(x) AS x FROM parts GROUP BY 1, 2, 3),
grads AS (SELECT kind, id, list(x ORDER BY pos) AS x, 1.0::DOUBLE + sum(x * x) / 5 AS total FROM summed GROUP BY 1, 2),
moved AS (SELECT st.kind, st.id, coalesce(total, 1.0) AS total,
    CASE WHEN x IS NULL THEN vec ELSE list_transform([1, 2, 3, 4, 5], lambda p: vec[p] - 0.05::DOUBLE * x[p] / sqrt(total)) END AS vec
  FROM st LEFT JOIN grads USING (kind, id))
SELECT kind, id, round(vec[1], 6) AS x0, round(vec[2], 6) AS x1, round(vec[3], 6) AS x2, round(vec[4], 6) AS x3, round(vec[5], 6) AS x4,
  round(total, 6) AS total FROM moved""",
)
def ranking_step(spark: SparkSession, d: str) -> DataFrame:
    """State of a WARP model of four dimensions after one step over all interactions."""
    train, _ = split(spark, d)
    tables = StepTables(spark)
    films = tables.save(index_ids(train.select("movie_id").distinct(), "movie_id", "film"), "films")
    pairs = tables.save(ranking_loss.interactions(train, films, None), "pairs")
    users = pairs.select(F.col("user").alias("id")).distinct()
    state = tables.save(ranking_loss.start_state(users, films.select(F.col("film").alias("id")), 4, 42), "state")
    catalog = ranking_loss.Catalog(films, None, films, films.count(), users.count())
    own = state.where("kind = 'user'").select(F.col("id").alias("user"), "vec")
    gradient = ranking_loss.gradients(pairs, pairs, own, catalog.vectors(state, 5), catalog, "warp", 0, 42, 4)
    moved = ranking_loss.adagrad(state, gradient, 0.05, 5)
    return moved.select("kind", "id", *[F.round(F.col("vec")[i], 6).alias(f"x{i}") for i in range(5)], F.round("total", 6).alias("total"))


@query("train_warp")
def train_warp(spark: SparkSession, d: str) -> DataFrame:
    return _ranking_lists(split(spark, d)[0], loss="warp", epochs=10, batches=2)


@query("train_warp_features")
def train_warp_features(spark: SparkSession, d: str) -> DataFrame:
    train, _ = split(spark, d)
    genres = tfidf(s.movies(spark, d), "movie_id", F.col("genre_names"), max_features=200)
    features = identity_plus_features(train.select("movie_id").distinct(), genres)
    return _ranking_lists(train, loss="warp", features=features, epochs=10, batches=2)


@query("train_weighted_interactions")
def train_weighted_interactions(spark: SparkSession, d: str) -> DataFrame:
    """Ratings as weights, seen films kept in the lists."""
    rated = s.ratings(spark, d).select("user_id", "movie_id", "rating")
    model = ranking_loss.train_ranking(rated, loss="warp", dim=32, epochs=5, batches=2, weight="rating")
    return recommend_factors(model.users, model.items, 12)


def _bpr_model(spark: SparkSession, d: str):
    """Every film liked by a user of its own, described by its dense features."""
    cells = dense_features(spark, d).select("movie_id", F.posexplode("vec").alias("pos", "weight"))
    features = cells.select("movie_id", F.concat(F.lit("f"), F.col("pos")).alias("term"), "weight")
    own = features.select("movie_id").distinct().withColumn("user_id", F.col("movie_id"))
    return ranking_loss.train_ranking(own, loss="bpr", features=features, epochs=15, batches=2), features


@query("train_bpr_content")
def train_bpr_content(spark: SparkSession, d: str) -> DataFrame:
    model, _ = _bpr_model(spark, d)
    return _summary("item", model.items, "movie_id")


@query("recommend_bpr_content")
def recommend_bpr_content(spark: SparkSession, d: str) -> DataFrame:
    model, features = _bpr_model(spark, d)
    return bpr_lists(split(spark, d)[0], model, features, 5)


@query("train_graph_bpr")
def train_graph_bpr(spark: SparkSession, d: str) -> DataFrame:
    model = graph.train_graph(split(spark, d)[0], dim=64, layers=3, lr=0.001, epochs=10, batch_size=8192)
    return _both(model.users, model.items)
