"""Catalog and rating views over the benchmark tables.

The benchmark tables hold no films, so each catalog table has a view over them.
``CTES`` states the same views for a SQL engine.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.operators.relational import dedup_keep_first


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """(user_id, movie_id, rating, ts): one rating per pair, the earliest order line wins."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    rated = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        (F.ceil(F.col("l_quantity") / 5) / 2).alias("rating"),
        F.col("o_orderdate").alias("ts"),
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
    )
    first = dedup_keep_first(rated, ["user_id", "movie_id"], ["l_orderkey", "l_linenumber", "l_quantity"])
    return first.select("user_id", "movie_id", "rating", "ts")


def movies(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.concat_ws("|", "p_type", "p_brand").alias("genre_names"),
        (F.lit(1950) + F.col("p_size")).alias("release_year"),
        F.col("p_retailprice").alias("popularity"),
    )


def links(spark: SparkSession, folder: str) -> DataFrame:
    """Every tenth film has no catalog id, so the mapping join really drops rows."""
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        (key + 1_000_000).alias("movielens_id"), F.when(key % 10 != 0, key).alias("tmdb_id")
    )


def history(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    orders = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.count("*").alias("n_ratings")
    )
    return customers.join(orders, "user_id", "left").fillna(0, ["n_ratings"])


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("movie_id"), F.col("embedding")
    )


def rating_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", "user_id", "ts", "value", "props")


_RATINGS = """ratings_s AS (
  SELECT user_id, movie_id, rating, ts FROM (
    SELECT o_custkey AS user_id, l_partkey AS movie_id, ceil(l_quantity / 5) / 2 AS rating, o_orderdate AS ts,
           row_number() OVER (PARTITION BY o_custkey, l_partkey
                              ORDER BY l_orderkey, l_linenumber, l_quantity) AS rn
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE rn = 1)"""
_MOVIES = """movies_s AS (
  SELECT p_partkey AS movie_id, p_name AS title, p_type || '|' || p_brand AS genre_names,
         1950 + p_size AS release_year, p_retailprice AS popularity FROM part)"""
_LINKS = """links_s AS (
  SELECT p_partkey + 1000000 AS movielens_id,
         CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_partkey END AS tmdb_id FROM part)"""
_HISTORY = """history_s AS (
  SELECT c_custkey AS user_id, count(o_orderkey) AS n_ratings
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey)"""
_POSITIVES = """pos AS (SELECT DISTINCT user_id, movie_id FROM ratings_s WHERE rating >= 4.0)"""
_SPLIT = """placed AS (
  SELECT user_id, movie_id, count(*) OVER (PARTITION BY user_id) AS n,
         row_number() OVER (PARTITION BY user_id
                            ORDER BY md5(user_id || '-' || movie_id || '-42'), movie_id) AS position
  FROM pos),
labelled AS (
  SELECT user_id, movie_id, position <= greatest(1, floor(n * CAST(0.8 AS DOUBLE))) AS is_train
  FROM placed WHERE n >= 5),
train AS (SELECT user_id, movie_id FROM labelled WHERE is_train),
test AS (SELECT user_id, movie_id FROM labelled WHERE NOT is_train)"""

CTES = {
    "ratings": [_RATINGS],
    "movies": [_MOVIES],
    "links": [_LINKS],
    "history": [_HISTORY],
    "pos": [_RATINGS, _POSITIVES],
    "split": [_RATINGS, _POSITIVES, _SPLIT],
}


def with_views(names: list[str], extra: str = "") -> str:
    """``WITH`` clause with the named views and any further expressions."""
    parts: list[str] = []
    for name in names:
        parts += [part for part in CTES[name] if part not in parts]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"
