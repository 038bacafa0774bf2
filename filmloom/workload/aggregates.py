"""Aggregations, windows, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.functions.vectors import mean_vector
from filmloom.models import graph
from filmloom.operators import features, interactions, metrics, quality, relational
from filmloom.plans.recommend import genre_terms, popular_movies
from filmloom.sources import surrogates as s
from filmloom.sources.surrogates import with_views
from filmloom.workload.joins import split
from filmloom.workload.registry import query


@query(
    "user_interaction_counts",
    with_views(["pos"]) + "SELECT user_id, count(*) AS n_interactions FROM pos GROUP BY user_id",
)
def user_interaction_counts(spark: SparkSession, d: str) -> DataFrame:
    return interactions.user_interaction_counts(interactions.binarize_positive(s.ratings(spark, d)))


@query(
    "catalog_summary",
    with_views(["ratings"])
    + """SELECT (SELECT count(*) FROM part) AS n_movies, count(*) AS n_ratings,
  count(DISTINCT user_id) AS n_users, count(DISTINCT movie_id) AS n_rated FROM ratings_s""",
)
def catalog_summary(spark: SparkSession, d: str) -> DataFrame:
    n_movies = s.movies(spark, d).agg(F.count("*")).scalar()
    counted = s.ratings(spark, d).agg(
        F.count("*").alias("n_ratings"),
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("movie_id").alias("n_rated"),
    )
    return counted.withColumn("n_movies", n_movies)


@query(
    "items_per_user",
    with_views(["split"])
    + """SELECT user_id, CAST(floor(movie_id / 1024) AS BIGINT) AS chunk,
  string_agg(CAST(movie_id AS VARCHAR), ',' ORDER BY movie_id) AS movie_ids FROM train GROUP BY 1, 2""",
)
def items_per_user(spark: SparkSession, d: str) -> DataFrame:
    train, _ = split(spark, d)
    chunks = interactions.items_per_user(train)
    return chunks.withColumn("movie_ids", F.array_join(F.col("movie_ids").cast("array<string>"), ","))


@query(
    "minmax_scale",
    with_views(["movies"])
    + """SELECT movie_id, round((release_year - lo) / nullif(hi - lo, 0), 9) AS scaled FROM movies_s,
  (SELECT CAST(min(release_year) AS DOUBLE) AS lo, CAST(max(release_year) AS DOUBLE) AS hi FROM movies_s)""",
)
def minmax_scale(spark: SparkSession, d: str) -> DataFrame:
    scaled = features.minmax_scale(s.movies(spark, d), "release_year", "scaled", 1900)
    return scaled.select("movie_id", F.round("scaled", 9).alias("scaled"))


_LONG_EMBEDDINGS = """cells AS (
  SELECT vec_id AS movie_id, unnest(range(1, len(embedding) + 1)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"""


def _rounded(vectors: DataFrame, key: str) -> DataFrame:
    """Vectors in long form, so that they compare cell by cell."""
    cells = vectors.select(key, F.posexplode("vec").alias("pos", "x"))
    return cells.select(key, (F.col("pos") + 1).cast("bigint").alias("pos"), F.round("x", 9).alias("x"))


def _embedded_ratings(spark: SparkSession, d: str) -> DataFrame:
    rated = s.ratings(spark, d).select("user_id", "movie_id", "rating")
    return rated.join(s.embeddings(spark, d).withColumnRenamed("embedding", "vec"), "movie_id")


@query(
    "mean_vector",
    with_views(["ratings"], _LONG_EMBEDDINGS)
    + "SELECT user_id, pos, round(avg(x), 9) AS x FROM ratings_s JOIN cells USING (movie_id) GROUP BY user_id, pos",
)
def mean_of_items(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(mean_vector(_embedded_ratings(spark, d), "user_id", "vec"), "user_id")


@query(
    "weighted_mean_vector",
    with_views(["ratings"], _LONG_EMBEDDINGS)
    + """SELECT user_id, pos, round(sum(rating * x) / sum(rating), 9) AS x
FROM ratings_s JOIN cells USING (movie_id) GROUP BY user_id, pos""",
)
def weighted_mean_of_items(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(mean_vector(_embedded_ratings(spark, d), "user_id", "vec", weight="rating"), "user_id")


@query(
    "document_frequency",
    """WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2)
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM counts GROUP BY term""",
)
def document_frequency(spark: SparkSession, d: str) -> DataFrame:
    counts = features.term_counts(s.table(spark, d, "documents"), "doc_id", F.col("text"), stop_words=[])
    return features.document_frequency(counts)


@query(
    "genre_vocabulary",
    with_views(["movies"])
    + """SELECT DISTINCT trim(g) AS genre FROM (SELECT unnest(string_split(genre_names, '|')) AS g FROM movies_s)
ORDER BY genre LIMIT 15""",
)
def genre_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    genres = genre_terms(s.movies(spark, d)).select(F.col("term").alias("genre")).distinct()
    return genres.orderBy("genre").limit(15)


_EDGES_SQL = """ends AS (SELECT DISTINCT user_id * 2 AS u, movie_id * 2 + 1 AS i FROM train),
edges AS (SELECT u AS src, i AS dst FROM ends UNION ALL SELECT i, u FROM ends)"""


@query(
    "node_degree",
    with_views(["split"], _EDGES_SQL)
    + "SELECT dst AS node, count(*) AS degree, round(1 / sqrt(count(*)), 9) AS inv_sqrt FROM edges GROUP BY dst",
)
def node_degree(spark: SparkSession, d: str) -> DataFrame:
    train, _ = split(spark, d)
    degrees = graph.node_degree(graph.undirected_edges(train))
    return degrees.withColumn("inv_sqrt", F.round("inv_sqrt", 9))


@query("undirected_edges", with_views(["split"], _EDGES_SQL) + "SELECT src, dst FROM edges")
def undirected_edges(spark: SparkSession, d: str) -> DataFrame:
    train, _ = split(spark, d)
    return graph.undirected_edges(train)


@query(
    "row_l1_normalize",
    with_views(["ratings"])
    + "SELECT user_id, movie_id, round(rating / sum(rating) OVER (PARTITION BY movie_id), 9) AS weight FROM ratings_s",
)
def row_l1_normalize(spark: SparkSession, d: str) -> DataFrame:
    rated = s.ratings(spark, d).select("user_id", "movie_id", F.col("rating").alias("weight"))
    return features.row_l1_normalize(rated, "movie_id").withColumn("weight", F.round("weight", 9))


@query(
    "dedup_keep_first",
    """SELECT l_orderkey, l_partkey, l_quantity, l_shipmode FROM (
  SELECT l_orderkey, l_partkey, l_quantity, l_returnflag AS l_shipmode,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity, l_partkey, l_suppkey, l_extendedprice) AS rn
  FROM lineitem) WHERE rn = 1""",
)
def dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    lines = s.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        F.col("l_returnflag").alias("l_shipmode"),
    )
    first = relational.dedup_keep_first(
        lines, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_partkey", "l_suppkey", "l_extendedprice"]
    )
    return first.select("l_orderkey", "l_partkey", "l_quantity", "l_shipmode")


@query("split_per_user", with_views(["split"]) + "SELECT user_id, movie_id, is_train FROM labelled")
def split_per_user(spark: SparkSession, d: str) -> DataFrame:
    pairs = interactions.binarize_positive(s.ratings(spark, d))
    return interactions.label_split(pairs, min_interactions=5)


@query(
    "top_k_per_user",
    with_views(["ratings"])
    + """SELECT user_id, movie_id, rating, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, movie_id) AS rank FROM ratings_s) WHERE rank <= 10""",
)
def top_k_per_user(spark: SparkSession, d: str) -> DataFrame:
    rated = s.ratings(spark, d).select("user_id", "movie_id", "rating")
    return relational.top_k_per_group(rated, "user_id", [F.desc("rating"), F.asc("movie_id")], 10)


@query(
    "rank_score",
    with_views(["ratings"])
    + """, top AS (SELECT * FROM (
  SELECT user_id, movie_id, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, movie_id) AS rank FROM ratings_s) WHERE rank <= 10)
SELECT user_id, movie_id, round(1 - (rank - 1) / count(*) OVER (PARTITION BY user_id), 9) AS score FROM top""",
)
def rank_score(spark: SparkSession, d: str) -> DataFrame:
    scored = relational.rank_score(top_k_per_user(spark, d), "user_id", "rank", "score")
    return scored.select("user_id", "movie_id", F.round("score", 9).alias("score"))


_TOP_SQL = """top AS (SELECT * FROM (
  SELECT user_id, movie_id, row_number() OVER (PARTITION BY user_id ORDER BY movie_id) AS rank FROM ratings_s) WHERE rank <= 20)"""


@query(
    "dcg_terms",
    with_views(["split"], _TOP_SQL)
    + """SELECT t.user_id, t.movie_id, CAST(t.rank AS INTEGER) AS rank, CAST(x.user_id IS NOT NULL AS INTEGER) AS hit,
  round(CASE WHEN x.user_id IS NOT NULL THEN 1 / log2(t.rank + 1) ELSE 0 END, 9) AS gain
FROM top t LEFT JOIN test x ON x.user_id = t.user_id AND x.movie_id = t.movie_id""",
)
def dcg_terms(spark: SparkSession, d: str) -> DataFrame:
    _, test = split(spark, d)
    ranked = relational.top_k_per_group(
        s.ratings(spark, d).select("user_id", "movie_id"), "user_id", [F.asc("movie_id")], 20
    )
    return metrics.dcg_terms(ranked, test).withColumn("gain", F.round("gain", 9))


@query(
    "top_n",
    with_views(["ratings"])
    + "SELECT movie_id, count(*) AS n FROM ratings_s GROUP BY movie_id ORDER BY n DESC, movie_id LIMIT 50",
)
def top_n(spark: SparkSession, d: str) -> DataFrame:
    counts = s.ratings(spark, d).groupBy("movie_id").agg(F.count("*").alias("n"))
    return relational.top_n(counts, "n", 50, "movie_id")


@query(
    "popular_movies",
    with_views(["movies"])
    + """SELECT movie_id, title, popularity, CAST(row_number() OVER (ORDER BY popularity DESC, movie_id) AS INTEGER) AS rank
FROM movies_s ORDER BY popularity DESC, movie_id LIMIT 10""",
)
def popular(spark: SparkSession, d: str) -> DataFrame:
    return popular_movies(s.movies(spark, d), 10).select("movie_id", "title", "popularity", "rank")


@query("head_n", with_views(["movies"]) + "SELECT movie_id, title FROM movies_s ORDER BY movie_id LIMIT 12")
def head_n(spark: SparkSession, d: str) -> DataFrame:
    return relational.head_n(s.movies(spark, d), 12).select("movie_id", "title")


@query(
    "random_n",
    with_views(["movies"]) + "SELECT movie_id, title FROM movies_s ORDER BY md5(movie_id || '-42'), movie_id LIMIT 12",
)
def random_n(spark: SparkSession, d: str) -> DataFrame:
    return relational.random_n(s.movies(spark, d), 12).select("movie_id", "title")


@query(
    "sample_eval_users",
    with_views(["split"])
    + "SELECT user_id FROM (SELECT DISTINCT user_id FROM test) ORDER BY md5(user_id || '-42'), user_id LIMIT 300",
)
def sample_eval_users(spark: SparkSession, d: str) -> DataFrame:
    _, test = split(spark, d)
    return interactions.sample_eval_users(test)


@query(
    "orphan_examples",
    "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 10",
)
def orphan_examples(spark: SparkSession, d: str) -> DataFrame:
    orphans = quality.orphan_rows(s.table(spark, d, "documents"), s.table(spark, d, "labels").select("doc_id"), "doc_id")
    return quality.orphan_examples(orphans, "doc_id")


_EVENT_RATINGS = """added AS (
  SELECT user_id, movie_id, rating, ts FROM (
    SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS movie_id, value AS rating, ts,
      row_number() OVER (PARTITION BY user_id, json_extract_string(props, '$.k') ORDER BY ts DESC, value DESC) AS rn
    FROM events WHERE value BETWEEN 0.5 AND 5.0) WHERE rn = 1)"""


def event_ratings(spark: SparkSession, d: str) -> DataFrame:
    """Ratings of the event stream: the film is the number in the props."""
    return (
        s.rating_events(spark, d)
        .where("value BETWEEN 0.5 AND 5.0")
        .select(
            "user_id",
            F.get_json_object("props", "$.k").cast("bigint").alias("movie_id"),
            F.col("value").alias("rating"),
            "ts",
        )
    )


@query(
    "union_ratings",
    with_views(["ratings"], _EVENT_RATINGS)
    + """SELECT user_id, movie_id, rating FROM ratings_s UNION ALL
SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT), value FROM events WHERE value BETWEEN 0.5 AND 5.0""",
)
def union_ratings(spark: SparkSession, d: str) -> DataFrame:
    both = relational.union_ratings(s.ratings(spark, d), event_ratings(spark, d))
    return both.select("user_id", "movie_id", "rating")


@query(
    "key_overlap",
    with_views(["ratings"])
    + """SELECT count(*) AS n_keys, count(vec_id) AS n_found
FROM (SELECT DISTINCT movie_id FROM ratings_s) LEFT JOIN embeddings ON vec_id = movie_id""",
)
def key_overlap(spark: SparkSession, d: str) -> DataFrame:
    return relational.key_overlap(s.ratings(spark, d), s.embeddings(spark, d), "movie_id")


@query(
    "key_difference",
    with_views(["ratings"]) + "SELECT movie_id FROM ratings_s EXCEPT SELECT vec_id FROM embeddings",
)
def key_difference(spark: SparkSession, d: str) -> DataFrame:
    return relational.key_difference(s.ratings(spark, d), s.embeddings(spark, d), "movie_id")


@query(
    "upsert_ratings",
    with_views(["ratings"], _EVENT_RATINGS)
    + """SELECT user_id, movie_id, rating FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, movie_id ORDER BY ts DESC, src DESC, rating DESC) AS rn FROM (
    SELECT user_id, movie_id, rating, ts, 0 AS src FROM ratings_s UNION ALL
    SELECT user_id, movie_id, rating, ts, 1 FROM added)) WHERE rn = 1""",
)
def upsert_ratings(spark: SparkSession, d: str) -> DataFrame:
    merged = relational.upsert_ratings(s.ratings(spark, d), event_ratings(spark, d))
    return merged.select("user_id", "movie_id", "rating")


@query(
    "toggle_favorites",
    with_views(["split"])
    + """SELECT user_id, movie_id FROM (
  SELECT user_id, movie_id FROM train UNION ALL
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) FROM events UNION ALL
  SELECT user_id, movie_id FROM ratings_s)
GROUP BY 1, 2 HAVING count(*) % 2 = 1""",
)
def toggle_favorites(spark: SparkSession, d: str) -> DataFrame:
    train, _ = split(spark, d)
    clicks = s.rating_events(spark, d).select(
        "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("movie_id")
    )
    again = s.ratings(spark, d).select("user_id", "movie_id")
    return relational.toggle_favorites(train, clicks.unionByName(again))
