"""Splits, ranking metrics and model comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.functions.text import content_text
from filmloom.models.linear import fold_in
from filmloom.operators import interactions, metrics
from filmloom.operators.features import tfidf
from filmloom.plans.comparison import long_metrics
from filmloom.plans.recommend import recommend_popular, recommend_tfidf
from filmloom.sources import surrogates as s
from filmloom.sources.surrogates import with_views
from filmloom.workload.joins import split
from filmloom.workload.registry import query
from filmloom.workload.sqlparts import EMBEDDED, METRICS, POPULAR_MODEL, TWO_MODELS


def _popular_model(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ranked, known test, train) of the popularity yardstick."""
    train, test = split(spark, d)
    ranked = recommend_popular(train, 20).select(F.lit("popular").alias("model"), "user_id", "movie_id", "rank")
    return ranked, interactions.drop_unseen_items(test, train), train


def _two_models(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    ranked, known, train = _popular_model(spark, d)
    movies = s.movies(spark, d)
    terms = tfidf(movies, "movie_id", content_text(F.col("title"), F.col("genre_names")))
    content = recommend_tfidf(train, terms, movies, 20)
    both = ranked.unionByName(content.select(F.lit("content").alias("model"), "user_id", "movie_id", "rank"))
    return both, known, train


@query("load_and_split", with_views(["split"]) + "SELECT user_id, movie_id FROM train")
def load_and_split(spark: SparkSession, d: str) -> DataFrame:
    return interactions.load_and_split(s.ratings(spark, d))[0]


@query(
    "random_split",
    with_views(["ratings"])
    + """SELECT user_id, movie_id,
  CAST(CAST('0x' || substr(md5(user_id || '-' || movie_id || '-37'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 < 0.8 AS is_train
FROM ratings_s""",
)
def random_split(spark: SparkSession, d: str) -> DataFrame:
    return interactions.random_split(s.ratings(spark, d)).select("user_id", "movie_id", "is_train")


def _per_user(metric: str):
    sql = with_views(["split"], POPULAR_MODEL + ",\n" + METRICS)
    return sql + f'SELECT user_id, k, round("{metric}", 9) AS "{metric}" FROM per_user'


def _metric(spark: SparkSession, d: str, metric: str) -> DataFrame:
    ranked, known, _ = _popular_model(spark, d)
    return metrics.user_metrics(ranked, known, (10, 20)).select("user_id", "k", F.round(metric, 9).alias(metric))


@query("precision_at_k", _per_user("precision"))
def precision_at_k(spark: SparkSession, d: str) -> DataFrame:
    return _metric(spark, d, "precision")


@query("recall_at_k", _per_user("recall"))
def recall_at_k(spark: SparkSession, d: str) -> DataFrame:
    return _metric(spark, d, "recall")


@query("ndcg_at_k", _per_user("ndcg"))
def ndcg_at_k(spark: SparkSession, d: str) -> DataFrame:
    return _metric(spark, d, "ndcg")


_MEAN_SQL = """SELECT model, k, count(*) AS n_users, round(avg("precision"), 9) AS "precision", round(avg(recall), 9) AS recall,
  round(avg(ndcg), 9) AS ndcg FROM per_user GROUP BY model, k"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({m: F.round(m, 9) for m in ("precision", "recall", "ndcg")})


@query("mean_metrics", with_views(["split"], POPULAR_MODEL + ",\n" + METRICS) + _MEAN_SQL)
def mean_metrics(spark: SparkSession, d: str) -> DataFrame:
    ranked, known, _ = _popular_model(spark, d)
    return _rounded(metrics.ranking_metrics(ranked, known))


@query("evaluate_model", with_views(["split", "movies"], TWO_MODELS + ",\n" + METRICS) + _MEAN_SQL)
def evaluate_model(spark: SparkSession, d: str) -> DataFrame:
    ranked, known, _ = _two_models(spark, d)
    return _rounded(metrics.ranking_metrics(ranked, known))


@query(
    "catalog_coverage",
    with_views(["split"], POPULAR_MODEL)
    + """SELECT model, n_shown, n_items, round(n_shown / n_items, 9) AS coverage FROM (
  SELECT model, count(DISTINCT movie_id) AS n_shown, (SELECT count(DISTINCT movie_id) FROM train) AS n_items
  FROM ranked GROUP BY model)""",
)
def catalog_coverage(spark: SparkSession, d: str) -> DataFrame:
    ranked, _, train = _popular_model(spark, d)
    return metrics.catalog_coverage(ranked, train).withColumn("coverage", F.round("coverage", 9))


@query(
    "segment_metrics",
    with_views(["split"], POPULAR_MODEL + ",\n" + METRICS)
    + """, sizes AS (SELECT user_id, count(*) AS n FROM train GROUP BY user_id),
seg AS (SELECT user_id, CASE WHEN n >= 20 THEN 'heavy (20+)' WHEN n >= 10 THEN 'light (10-19)'
  WHEN n >= 5 THEN 'cold (5-9)' ELSE 'below' END AS segment FROM sizes),
measured AS (SELECT model, segment, count(*) AS n_users, avg("precision") AS p, avg(recall) AS r, avg(ndcg) AS g
  FROM per_user JOIN seg USING (user_id) WHERE k = 10 GROUP BY 1, 2)
SELECT m.model, b.segment, coalesce(n_users, 0) AS n_users, round(p, 9) AS "precision", round(r, 9) AS recall, round(g, 9) AS ndcg
FROM (SELECT DISTINCT model FROM ranked) m
CROSS JOIN (VALUES ('cold (5-9)'), ('light (10-19)'), ('heavy (20+)'), ('below')) b(segment)
LEFT JOIN measured x ON x.model = m.model AND x.segment = b.segment""",
)
def segment_metrics(spark: SparkSession, d: str) -> DataFrame:
    ranked, known, train = _popular_model(spark, d)
    return _rounded(metrics.segment_metrics(ranked, known, train))


@query(
    "user_auc",
    with_views(["split"])
    + """, scored AS (
  SELECT r.user_id, r.movie_id, r.rating AS score, CASE WHEN x.user_id IS NULL THEN 0 ELSE 1 END AS pos
  FROM ratings_s r LEFT JOIN test x ON x.user_id = r.user_id AND x.movie_id = r.movie_id
  WHERE r.user_id IN (SELECT user_id FROM test)
    AND NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = r.user_id AND t.movie_id = r.movie_id)),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY user_id ORDER BY score)
    + (count(*) OVER (PARTITION BY user_id, score) - 1) / 2.0::DOUBLE AS avg_rank FROM scored),
sums AS (SELECT user_id, sum(pos) AS p, sum(1 - pos) AS n, sum(CASE WHEN pos = 1 THEN avg_rank ELSE 0 END) AS rs
  FROM ranked GROUP BY user_id)
SELECT user_id, CAST(p AS BIGINT) AS n_pos, CAST(n AS BIGINT) AS n_neg,
  round(coalesce((rs - p * (p + 1) / 2.0::DOUBLE) / nullif(p * n, 0), 0.5), 9) AS auc FROM sums WHERE p > 0""",
)
def user_auc(spark: SparkSession, d: str) -> DataFrame:
    train, test = split(spark, d)
    scores = s.ratings(spark, d).select("user_id", "movie_id", F.col("rating").alias("score"))
    return metrics.user_auc(scores, test, train).withColumn("auc", F.round("auc", 9))


@query(
    "factor_auc",
    with_views(["split"], EMBEDDED)
    + """, liked AS (SELECT user_id, pos, avg(x) AS x FROM train JOIN cells USING (movie_id) GROUP BY 1, 2),
u AS (SELECT user_id, list(x ORDER BY pos) AS vec FROM liked GROUP BY user_id),
scored AS (
  SELECT u.user_id, e.movie_id, round(list_inner_product(u.vec, e.vec), 6) AS score,
         CASE WHEN t.user_id IS NULL THEN 0 ELSE 1 END AS pos
  FROM u JOIN emb e ON true LEFT JOIN test t ON t.user_id = u.user_id AND t.movie_id = e.movie_id
  WHERE NOT EXISTS (SELECT 1 FROM train x WHERE x.user_id = u.user_id AND x.movie_id = e.movie_id)),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY user_id ORDER BY score)
    + (count(*) OVER (PARTITION BY user_id, score) - 1) / 2.0::DOUBLE AS avg_rank FROM scored),
sums AS (SELECT user_id, sum(pos) AS p, sum(1 - pos) AS n, sum(CASE WHEN pos = 1 THEN avg_rank ELSE 0 END) AS rs
  FROM ranked GROUP BY user_id)
SELECT user_id, CAST(p AS BIGINT) AS n_pos, CAST(n AS BIGINT) AS n_neg,
  round(coalesce((rs - p * (p + 1) / 2.0::DOUBLE) / nullif(p * n, 0), 0.5), 4) AS auc FROM sums WHERE p > 0""",
)
def factor_auc(spark: SparkSession, d: str) -> DataFrame:
    """Users as the mean of their train films' embeddings, measured over all embedded films."""
    train, test = split(spark, d)
    items = s.embeddings(spark, d).select("movie_id", F.transform("embedding", lambda x: x.cast("double")).alias("vec"))
    users = fold_in(train, items, weight=None)
    return metrics.factor_auc(users, items, test, train).withColumn("auc", F.round("auc", 4))


@query(
    "rating_errors",
    with_views(["ratings"])
    + """SELECT count(*) AS n, round(avg((rating - m) * (rating - m)), 9) AS mse, round(sqrt(avg((rating - m) * (rating - m))), 9) AS rmse
FROM ratings_s JOIN (SELECT movie_id, avg(rating) AS m FROM ratings_s GROUP BY movie_id) USING (movie_id)""",
)
def rating_errors(spark: SparkSession, d: str) -> DataFrame:
    rated = s.ratings(spark, d)
    means = rated.groupBy("movie_id").agg(F.avg("rating").alias("estimate"))
    errors = metrics.rating_errors(rated.join(means, "movie_id"))
    return errors.select("n", F.round("mse", 9).alias("mse"), F.round("rmse", 9).alias("rmse"))


_WIDE_SQL = """SELECT model,
  coalesce(printf('%.4f', max("precision") FILTER (k = 10)), 'N/A') AS "P@10",
  coalesce(printf('%.4f', max("precision") FILTER (k = 20)), 'N/A') AS "P@20",
  coalesce(printf('%.4f', max(recall) FILTER (k = 10)), 'N/A') AS "R@10",
  coalesce(printf('%.4f', max(recall) FILTER (k = 20)), 'N/A') AS "R@20",
  coalesce(printf('%.4f', max(ndcg) FILTER (k = 10)), 'N/A') AS "NDCG@10",
  coalesce(printf('%.4f', max(ndcg) FILTER (k = 20)), 'N/A') AS "NDCG@20",
  'N/A' AS "Train s"
FROM (SELECT model, k, avg("precision") AS "precision", avg(recall) AS recall, avg(ndcg) AS ndcg FROM per_user GROUP BY 1, 2)
GROUP BY model"""
_WIDE = ["P@10", "P@20", "R@10", "R@20", "NDCG@10", "NDCG@20", "Train s"]


@query("comparison_table", with_views(["split"], POPULAR_MODEL + ",\n" + METRICS) + _WIDE_SQL)
def comparison_table(spark: SparkSession, d: str) -> DataFrame:
    ranked, known, _ = _popular_model(spark, d)
    return metrics.comparison_table(long_metrics(metrics.user_metrics(ranked, known)), _WIDE)


@query("run_comparison", with_views(["split", "movies"], TWO_MODELS + ",\n" + METRICS) + _WIDE_SQL)
def run_comparison(spark: SparkSession, d: str) -> DataFrame:
    """The two models that have no random start, over every test user."""
    ranked, known, _ = _two_models(spark, d)
    return metrics.comparison_table(long_metrics(metrics.user_metrics(ranked, known)), _WIDE)
