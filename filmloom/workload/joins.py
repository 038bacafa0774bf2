"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.functions.coercion import imdb_number
from filmloom.operators import cleaning, interactions, metrics, quality, relational
from filmloom.operators.scoring import score_all_pairs
from filmloom.plans import recommend
from filmloom.session import cut_lineage
from filmloom.sources import surrogates as s
from filmloom.sources.surrogates import with_views
from filmloom.workload.registry import query


def split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(train, test), stored once: everything downstream reads both several times."""
    pairs = interactions.binarize_positive(s.ratings(spark, d))
    return interactions.split_parts(cut_lineage(interactions.label_split(pairs, min_interactions=5)))


@query(
    "map_ratings_to_movies",
    with_views(["ratings", "links"])
    + """SELECT r.user_id, l.movielens_id, l.tmdb_id AS movie_id, r.rating FROM ratings_s r
JOIN links_s l ON l.movielens_id = r.movie_id + 1000000 WHERE l.tmdb_id IS NOT NULL""",
)
def map_ratings_to_movies(spark: SparkSession, d: str) -> DataFrame:
    raw = s.ratings(spark, d).select("user_id", (F.col("movie_id") + 1_000_000).alias("movielens_id"), "rating")
    return cleaning.map_ratings_to_movies(raw, s.links(spark, d)).select("user_id", "movielens_id", "movie_id", "rating")


@query(
    "join_by_imdb",
    with_views(["movies", "links"])
    + """SELECT title, movie_id, movielens_id FROM (
  SELECT title, movie_id, movielens_id, row_number() OVER (PARTITION BY title ORDER BY movie_id, movielens_id) AS rn
  FROM movies_s JOIN links_s ON tmdb_id = movie_id WHERE movie_id > 0) WHERE rn = 1""",
)
def join_by_imdb(spark: SparkSession, d: str) -> DataFrame:
    films = s.movies(spark, d).withColumn("imdb_id", F.concat(F.lit("tt"), F.lpad(F.col("movie_id").cast("string"), 7, "0")))
    links = s.links(spark, d).select("movielens_id", F.col("tmdb_id").alias("imdb_id"))
    return cleaning.join_by_imdb(films.drop("popularity"), links, imdb_number(films["imdb_id"]))


@query(
    "attach_titles",
    with_views(["ratings", "movies"])
    + """SELECT r.movie_id, m.title, count(*) AS n FROM ratings_s r LEFT JOIN movies_s m ON m.movie_id = r.movie_id
GROUP BY r.movie_id, m.title""",
)
def attach_titles(spark: SparkSession, d: str) -> DataFrame:
    counts = s.ratings(spark, d).groupBy("movie_id").agg(F.count("*").alias("n"))
    return counts.join(s.movies(spark, d).select("movie_id", "title"), "movie_id", "left").select("movie_id", "title", "n")


@query(
    "semi_join_catalog",
    with_views(["ratings"])
    + "SELECT user_id, movie_id, rating FROM ratings_s WHERE movie_id IN (SELECT vec_id FROM embeddings)",
)
def semi_join_catalog(spark: SparkSession, d: str) -> DataFrame:
    kept = cleaning.semi_join_catalog(s.ratings(spark, d), s.embeddings(spark, d))
    return kept.select("user_id", "movie_id", "rating")


@query(
    "semi_join_active_users",
    with_views(["pos"])
    + "SELECT user_id, movie_id FROM pos WHERE user_id IN (SELECT user_id FROM pos GROUP BY user_id HAVING count(*) >= 5)",
)
def semi_join_active_users(spark: SparkSession, d: str) -> DataFrame:
    pairs = interactions.binarize_positive(s.ratings(spark, d))
    return interactions.active_users(pairs, 5).select("user_id", "movie_id")


@query(
    "semi_join_mutual",
    with_views(["ratings", "movies"])
    + """, films AS (SELECT vec_id AS movie_id FROM embeddings),
rated AS (SELECT movie_id FROM films WHERE movie_id IN (SELECT movie_id FROM ratings_s))
SELECT movie_id, count(*) AS n_ratings FROM ratings_s
WHERE movie_id IN (SELECT movie_id FROM rated) GROUP BY movie_id""",
)
def semi_join_mutual(spark: SparkSession, d: str) -> DataFrame:
    films = s.table(spark, d, "embeddings").select(F.col("vec_id").alias("movie_id"))
    _, kept = cleaning.semi_join_mutual(films, s.ratings(spark, d))
    return kept.groupBy("movie_id").agg(F.count("*").alias("n_ratings"))


@query(
    "drop_unseen_items",
    with_views(["split"]) + "SELECT user_id, movie_id FROM test WHERE movie_id IN (SELECT movie_id FROM train)",
)
def drop_unseen_items(spark: SparkSession, d: str) -> DataFrame:
    train, test = split(spark, d)
    return interactions.drop_unseen_items(test, train)


@query(
    "orphan_rows",
    """SELECT 'documents' AS child, d.doc_id AS key FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.doc_id IS NULL
UNION ALL
SELECT 'events', e.event_id FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id WHERE c.c_custkey IS NULL""",
)
def orphan_rows(spark: SparkSession, d: str) -> DataFrame:
    docs = quality.orphan_rows(s.table(spark, d, "documents"), s.table(spark, d, "labels").select("doc_id"), "doc_id")
    events = quality.orphan_rows(s.table(spark, d, "events"), s.table(spark, d, "customer"), "user_id", "c_custkey")
    return docs.select(F.lit("documents").alias("child"), F.col("doc_id").alias("key")).unionByName(
        events.select(F.lit("events").alias("child"), F.col("event_id").alias("key"))
    )


@query(
    "exclude_seen",
    with_views(["split"])
    + "SELECT user_id, movie_id, rating FROM ratings_s r WHERE NOT EXISTS "
    "(SELECT 1 FROM train t WHERE t.user_id = r.user_id AND t.movie_id = r.movie_id)",
)
def exclude_seen(spark: SparkSession, d: str) -> DataFrame:
    train, _ = split(spark, d)
    candidates = s.ratings(spark, d).select("user_id", "movie_id", "rating")
    return relational.exclude_items(candidates, train, ["user_id", "movie_id"])


@query(
    "score_all_pairs",
    """WITH scored AS (
  SELECT q.vec_id AS user_id, i.vec_id AS movie_id,
         round(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])), 6) AS score
  FROM embeddings q, embeddings i)
SELECT user_id, movie_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, movie_id) AS rank FROM scored) WHERE rank <= 20""",
)
def score_pairs(spark: SparkSession, d: str) -> DataFrame:
    items = s.embeddings(spark, d).select("movie_id", F.col("embedding").alias("vec"))
    queries = items.withColumnRenamed("movie_id", "user_id")
    return score_all_pairs(queries, items, 20)


@query(
    "blend_outer",
    with_views(["split"])
    + """, a AS (SELECT user_id, movie_id, 1.0::DOUBLE AS collab FROM train),
b AS (SELECT user_id, movie_id, rating AS content FROM ratings_s)
SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.movie_id, b.movie_id) AS movie_id,
  coalesce(collab, 0) AS collab, coalesce(content, 0) AS content
FROM a FULL JOIN b ON a.user_id = b.user_id AND a.movie_id = b.movie_id""",
)
def blend_outer(spark: SparkSession, d: str) -> DataFrame:
    train, _ = split(spark, d)
    left = train.withColumn("collab", F.lit(1.0))
    right = s.ratings(spark, d).select("user_id", "movie_id", F.col("rating").alias("content"))
    return relational.blend_outer(left, right, ["user_id", "movie_id"], "collab", "content")


_SEGMENT_SQL = """CASE WHEN n_interactions >= 20 THEN 'heavy (20+)' WHEN n_interactions >= 10 THEN 'light (10-19)'
  WHEN n_interactions >= 5 THEN 'cold (5-9)' ELSE 'below' END"""


@query(
    "assign_segment",
    with_views(["split"])
    + f""", counts AS (SELECT user_id, count(*) AS n_interactions FROM train GROUP BY user_id)
SELECT user_id, n_interactions, {_SEGMENT_SQL} AS segment FROM counts""",
)
def assign_segment(spark: SparkSession, d: str) -> DataFrame:
    train, _ = split(spark, d)
    return metrics.assign_segment(interactions.user_interaction_counts(train))


@query(
    "index_ids",
    with_views(["split"])
    + """SELECT movie_id, row_number() OVER (ORDER BY md5(CAST(movie_id AS VARCHAR)), movie_id) - 1 AS idx
FROM (SELECT DISTINCT movie_id FROM train)""",
)
def index_ids(spark: SparkSession, d: str) -> DataFrame:
    train, _ = split(spark, d)
    return relational.index_ids(train, "movie_id")


@query(
    "title_index",
    with_views(["movies"]) + "SELECT lower(trim(title)) AS title_key, max(movie_id) AS movie_id FROM movies_s GROUP BY 1",
)
def title_index(spark: SparkSession, d: str) -> DataFrame:
    return recommend.title_index(s.movies(spark, d))


@query(
    "match_titles",
    with_views(["movies"])
    + """, q AS (
  SELECT DISTINCT upper(p_name) AS query FROM part
  UNION SELECT split_part(p_name, ' ', 1) || ' (1995)' FROM part
  UNION SELECT substr(p_name, 2, 4) FROM part
  UNION SELECT n_name FROM nation
  UNION SELECT '(' || r_name || ') Days' FROM region),
found AS (
  SELECT query,
    (SELECT min(movie_id) FROM movies_s WHERE lower(trim(title)) = lower(trim(query))) AS exact_id,
    (SELECT min(movie_id) FROM movies_s WHERE contains(lower(title), trim(split_part(lower(trim(query)), '(', 1)))) AS part_id
  FROM q)
SELECT query, coalesce(exact_id, part_id) AS movie_id, title,
  CASE WHEN exact_id IS NOT NULL THEN 'exact' WHEN part_id IS NOT NULL THEN 'partial' ELSE 'none' END AS "match"
FROM found LEFT JOIN movies_s ON movie_id = coalesce(exact_id, part_id)""",
)
def match_titles(spark: SparkSession, d: str) -> DataFrame:
    part = s.table(spark, d, "part")
    wanted = (
        part.select(F.upper("p_name").alias("query"))
        .union(part.select(F.concat(F.substring_index("p_name", " ", 1), F.lit(" (1995)"))))
        .union(part.select(F.substring("p_name", 2, 4)))
        .union(s.table(spark, d, "nation").select("n_name"))
        .union(s.table(spark, d, "region").select(F.concat(F.lit("("), "r_name", F.lit(") Days"))))
    )
    return recommend.match_titles(wanted, s.movies(spark, d))
