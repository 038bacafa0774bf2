"""Integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.operators import cleaning, quality
from filmloom.sources import surrogates as s
from filmloom.sources.surrogates import with_views
from filmloom.workload.joins import split
from filmloom.workload.registry import query
from filmloom.workload.rows import explode_keywords


def _fk_sql(child: str, child_key: str, parent: str, parent_key: str) -> str:
    orphans = f"SELECT c.{child_key} AS k FROM {child} c LEFT JOIN {parent} p ON p.{parent_key} = c.{child_key} WHERE p.{parent_key} IS NULL"
    return f"""SELECT '{child}.{child_key} -> {parent}.{parent_key}' AS relation,
  (SELECT count(*) FROM ({orphans})) AS n_invalid,
  coalesce((SELECT string_agg(CAST(k AS VARCHAR), ', ' ORDER BY k) FROM
    (SELECT DISTINCT k FROM ({orphans}) WHERE k IS NOT NULL ORDER BY k LIMIT 10)), '') AS examples"""


_RELATIONS = [
    ("documents", "doc_id", "labels", "doc_id"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("events", "user_id", "customer", "c_custkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("labels", "doc_id", "documents", "doc_id"),
]


@query("check_foreign_keys", "\nUNION ALL ".join(_fk_sql(*r) for r in _RELATIONS))
def check_foreign_keys(spark: SparkSession, d: str) -> DataFrame:
    names = sorted({t for r in _RELATIONS for t in (r[0], r[2])})
    return quality.check_foreign_keys({n: s.table(spark, d, n) for n in names}, _RELATIONS)


@query(
    "check_keyword_links",
    """WITH flat AS (SELECT p_partkey AS movie_id, CAST(p_size AS BIGINT) AS keyword_id FROM part
  UNION ALL SELECT p_partkey, length(p_type) + 1000 FROM part)
SELECT 'keyword_id' AS key, count(DISTINCT keyword_id) AS n_used, count(DISTINCT keyword_id) AS n_parents,
  CAST(0 AS BIGINT) AS n_missing, '' AS examples FROM flat
UNION ALL SELECT 'movie_id', count(DISTINCT movie_id), (SELECT count(DISTINCT vec_id) FROM embeddings),
  count(DISTINCT movie_id) FILTER (movie_id NOT IN (SELECT vec_id FROM embeddings)),
  coalesce((SELECT string_agg(CAST(m AS VARCHAR), ', ' ORDER BY m) FROM
    (SELECT DISTINCT movie_id AS m FROM flat WHERE movie_id NOT IN (SELECT vec_id FROM embeddings) ORDER BY m LIMIT 20)), '')
FROM flat""",
)
def check_keyword_links(spark: SparkSession, d: str) -> DataFrame:
    keywords, pairs = cleaning.normalize_keywords(explode_keywords(spark, d))
    return quality.check_keyword_links(s.embeddings(spark, d), keywords, pairs, fail=False)


@query(
    "check_rating_overlap",
    with_views(["ratings"])
    + "SELECT count(DISTINCT movie_id) AS n_keys, count(DISTINCT movie_id) AS n_found FROM ratings_s",
)
def check_rating_overlap(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.check_rating_overlap(s.movies(spark, d), s.ratings(spark, d))


@query(
    "check_constraints",
    with_views(["ratings"])
    + """SELECT 'lineitem' AS "table", 'unique l_orderkey, l_linenumber' AS "check",
  (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS n_violations
UNION ALL SELECT 'lineitem', 'not null l_orderkey', count(*) FILTER (l_orderkey IS NULL) FROM lineitem
UNION ALL SELECT 'lineitem', 'not null l_linenumber', count(*) FILTER (l_linenumber IS NULL) FROM lineitem
UNION ALL SELECT 'links', 'unique movielens_id', CAST(0 AS BIGINT)
UNION ALL SELECT 'links', 'not null movielens_id', CAST(0 AS BIGINT)
UNION ALL SELECT 'links', 'not null tmdb_id', count(*) FILTER (p_partkey % 10 = 0) FROM part
UNION ALL SELECT 'ratings', 'unique user_id, movie_id',
  (SELECT count(*) FROM (SELECT 1 FROM ratings_s GROUP BY user_id, movie_id HAVING count(*) > 1))
UNION ALL SELECT 'ratings', 'not null user_id', count(*) FILTER (user_id IS NULL) FROM ratings_s
UNION ALL SELECT 'ratings', 'not null movie_id', count(*) FILTER (movie_id IS NULL) FROM ratings_s
UNION ALL SELECT 'ratings', 'rating between 0.5 and 5.0', count(*) FILTER (rating NOT BETWEEN 0.5 AND 5.0) FROM ratings_s
UNION ALL SELECT 'events', 'rating between 0.5 and 5.0', count(*) FILTER (value NOT BETWEEN 0.5 AND 5.0) FROM events""",
)
def check_constraints(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_constraints(
        {
            "lineitem": s.table(spark, d, "lineitem"),
            "links": s.links(spark, d),
            "ratings": s.ratings(spark, d),
            "events": s.table(spark, d, "events").select(F.col("value").alias("rating")),
        },
        {
            "lineitem": ["l_orderkey", "l_linenumber"],
            "links": ["movielens_id"],
            "ratings": ["user_id", "movie_id"],
        },
        {"links": ["tmdb_id"]},
        ("ratings", "events"),
    )


@query(
    "check_leakage",
    with_views(["split"])
    + """SELECT 'ratings outside the catalog id system' AS "check",
  count(*) FILTER (movie_id NOT IN (SELECT p_partkey FROM part)) AS n_violations FROM ratings_s
UNION ALL SELECT 'unresolved links', count(*) FILTER (p_partkey % 10 = 0) FROM part
UNION ALL SELECT 'duplicate movies', (SELECT count(*) FROM (SELECT 1 FROM part GROUP BY p_partkey HAVING count(*) > 1))
UNION ALL SELECT 'duplicate ratings', (SELECT count(*) FROM (SELECT 1 FROM ratings_s GROUP BY user_id, movie_id HAVING count(*) > 1))
UNION ALL SELECT 'pairs in both train and test', (SELECT count(*) FROM (SELECT * FROM train INTERSECT SELECT * FROM test))""",
)
def check_leakage(spark: SparkSession, d: str) -> DataFrame:
    train, test = split(spark, d)
    return quality.check_leakage(s.movies(spark, d), s.ratings(spark, d), s.links(spark, d), train, test)


@query(
    "check_half_star",
    """SELECT count(*) AS n_ratings, count(*) FILTER (value * 2 <> floor(value * 2)) AS n_off_grid,
  count(*) FILTER (value NOT BETWEEN 0.5 AND 5.0) AS n_out_of_range FROM events""",
)
def check_half_star(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_half_star(s.table(spark, d, "events").select(F.col("value").alias("rating")))


_COUNTED = "UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{c}' AS "column", count({c}) AS n_values FROM {t} """
    for t, c in (("part", "p_name"), ("lineitem", "l_orderkey"), ("documents", "lang"))
)


@query(
    "filled_columns",
    f"""SELECT * FROM ({_COUNTED}) UNION ALL SELECT 'labels', 'toxic', count(toxic) FROM labels""",
)
def filled_columns(spark: SparkSession, d: str) -> DataFrame:
    chosen = {"part": ["p_name"], "lineitem": ["l_orderkey"], "documents": ["lang"], "labels": ["toxic"]}
    return quality.filled_columns({t: s.table(spark, d, t).select(*c) for t, c in chosen.items()})
