"""Scans, projections, filters and scalar functions."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.functions import coercion, literals, text
from filmloom.operators import cleaning, relational
from filmloom.plans.catalog import run_cleaning
from filmloom.plans.recommend import search_title
from filmloom.schemas import NAMED_ENTITY, PERSON_CAST, PERSON_CREW
from filmloom.session import shared_folder
from filmloom.sources import readers
from filmloom.sources import surrogates as s
from filmloom.sources.surrogates import with_views
from filmloom.sources.writers import write_cleaned, write_table
from filmloom.workload.registry import query

# Text cells as a raw file holds them, whole tables long.
_RAW_TEXT_SQL = """raw_text AS (
  SELECT CAST(p_partkey AS VARCHAR) AS cell FROM part
  UNION ALL SELECT p_name FROM part
  UNION ALL SELECT strftime(o_orderdate, '%Y-%m-%d') FROM orders
  UNION ALL SELECT CAST(l_quantity AS VARCHAR) FROM lineitem)"""


def _raw_text(spark: SparkSession, d: str) -> DataFrame:
    part, orders, lines = (s.table(spark, d, t) for t in ("part", "orders", "lineitem"))
    cells = [
        part.select(F.col("p_partkey").cast("string").alias("cell")),
        part.select(F.col("p_name").alias("cell")),
        orders.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("cell")),
        lines.select(F.col("l_quantity").cast("string").alias("cell")),
    ]
    return cells[0].union(cells[1]).union(cells[2]).union(cells[3])


@query("read_ratings", with_views(["ratings"]) + "SELECT user_id, movie_id, rating FROM ratings_s")
def read_ratings(spark: SparkSession, d: str) -> DataFrame:
    return readers.prune_ratings(s.ratings(spark, d))


@query(
    "read_ratings_max_rows",
    with_views(["ratings"]) + "SELECT user_id, movie_id, rating FROM ratings_s ORDER BY user_id, movie_id LIMIT 1000",
)
def read_ratings_max_rows(spark: SparkSession, d: str) -> DataFrame:
    return readers.prune_ratings(s.ratings(spark, d), max_rows=1000)


#: Films of a raw file, about 4 MB of credits.
_FILE_ROWS = 10_000


def _raw_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Raw-file layouts of the benchmark tables, every column text.

    Films are dealt out by their number: their texts are many times wider than the table, and a file whose cells hold line
    breaks is read by one task.
    """
    part = s.table(spark, d, "part")
    part = part.repartition(math.ceil(max(1, part.count()) / _FILE_ROWS))
    movies = part.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.concat(F.lit("tt0"), F.col("p_partkey")).alias("imdb_id"),
        F.col("p_name").alias("title"),
        F.col("p_name").alias("original_title"),
        F.lit("en").alias("original_language"),
        F.lit(" ").alias("overview"),
        F.lit(None).cast("string").alias("tagline"),
        F.lit("Released").alias("status"),
        F.lit(" FALSE").alias("adult"),
        F.lit("False").alias("video"),
        F.lit("0").alias("budget"),
        F.col("p_retailprice").cast("string").alias("revenue"),
        F.col("p_size").cast("string").alias("runtime"),
        F.col("p_size").cast("string").alias("vote_count"),
        F.lit("7.5").alias("vote_average"),
        F.col("p_retailprice").cast("string").alias("popularity"),
        F.concat((F.lit(1950) + F.col("p_size")).cast("string"), F.lit("-01-15")).alias("release_date"),
        F.concat(F.lit("[{'id': 1, 'name': '"), "p_type", F.lit("'}, {'id': 2, 'name': '"), "p_brand", F.lit("'}]")).alias("genres"),
        F.lit("[]").alias("production_companies"),
        F.lit("[{'iso_3166_1': 'US', 'name': 'United States of America'}]").alias("production_countries"),
        F.lit("[{'iso_639_1': 'en', 'name': 'English'}]").alias("spoken_languages"),
    )
    credits_ = part.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.concat(
            F.lit("[{'cast_id': 1, 'id': "), F.col("p_size"), F.lit(", 'name': ' "), "p_brand",
            F.lit(" ', 'character': '"), "p_type",
            F.lit("', 'order': 0, 'gender': 2, 'profile_path': None}, {'cast_id': 2, 'id': "),
            F.col("p_size") + 100, F.lit(", 'name': '"), "p_name",
            F.lit("', 'character': '', 'order': 1, 'gender': 0, 'profile_path': '/p.jpg'}]"),
        ).alias("cast"),
        F.concat(
            F.lit('[{"id": '), F.col("p_size"), F.lit(', "name": "'), "p_brand",
            F.lit('", "department": "Directing", "job": "Director", "gender": 1, "profile_path": null}]'),
        ).alias("crew"),
    )
    keywords = part.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.concat(
            F.lit("[{'id': "), F.col("p_size"), F.lit(", 'name': 'size "), F.col("p_size"), F.lit("'}, {'id': "),
            F.length("p_type") + 1000, F.lit(", 'name': 'len "), F.length("p_type"), F.lit("'}]"),
        ).alias("keywords"),
    )
    lines = s.table(spark, d, "lineitem")
    orders = s.table(spark, d, "orders")
    ratings = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("userId"),
        (F.col("l_partkey") + 1_000_000).cast("string").alias("movieId"),
        (F.floor(F.col("l_quantity") / 4.5) / 2).cast("string").alias("rating"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string").alias("timestamp"),
    )
    links = s.links(spark, d).select(
        F.col("movielens_id").cast("string").alias("movieId"),
        F.col("tmdb_id").cast("string").alias("imdbId"),
        F.col("tmdb_id").cast("string").alias("tmdbId"),
    )
    return movies, credits_, keywords, ratings, links


_RAW_RATINGS_SQL = """raw_ratings AS (
  SELECT o_custkey AS user_id, l_partkey + 1000000 AS movielens_id, floor(l_quantity / 4.5) / 2 AS rating,
         CAST(epoch(o_orderdate) AS BIGINT) AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ratings_clean AS (
  SELECT user_id, movielens_id, ts, rating FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, movielens_id ORDER BY ts, rating) AS rn
    FROM raw_ratings WHERE rating BETWEEN 0.5 AND 5.0) WHERE rn = 1),
ratings_final AS (
  SELECT user_id, tmdb_id AS movie_id, movielens_id, rating, ts
  FROM ratings_clean JOIN links_s USING (movielens_id) WHERE tmdb_id IS NOT NULL)"""


@query(
    "write_cleaned",
    with_views(["links"], _RAW_RATINGS_SQL)
    + """SELECT 'movies' AS "table", count(*) AS n_rows FROM part
UNION ALL SELECT 'ratings', count(*) FROM ratings_final
UNION ALL SELECT 'ratings_clean', count(*) FROM ratings_clean
UNION ALL SELECT 'links_clean', count(*) FROM part
UNION ALL SELECT 'cast_clean', 2 * count(*) FROM part
UNION ALL SELECT 'crew_clean', count(*) FROM part
UNION ALL SELECT 'keywords_clean', 2 * count(*) FROM part
UNION ALL SELECT 'movies_clean', count(*) FROM part""",
)
def write_cleaned_tables(spark: SparkSession, d: str) -> DataFrame:
    """Cleans the raw layouts, writes all eight tables and counts what was written."""
    from filmloom.plans.catalog import clean_tables

    tables = clean_tables(*_raw_tables(spark, d))
    paths = write_cleaned(tables, f"{shared_folder(spark)}/cleaned-{uuid.uuid4().hex}")
    counts = None
    for name, path in paths.items():
        one = spark.read.parquet(path).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def _cleaned_files(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    """The raw layouts as CSV files, cleaned from there: the folder of the cleaned tables and what each step dropped."""
    folder = f"{shared_folder(spark)}/raw-{uuid.uuid4().hex}"
    for name, df in zip(("movies_metadata", "credits", "keywords", "ratings", "links"), _raw_tables(spark, d)):
        write_table(df, f"{folder}/{name}.csv", "csv")
    return f"{folder}/clean", run_cleaning(spark, folder, f"{folder}/clean")[1]


@query(
    "clean_files_dropped",
    with_views(["links"], _RAW_RATINGS_SQL)
    + """, n AS (SELECT (SELECT count(*) FROM part) AS p, (SELECT count(*) FROM raw_ratings) AS raw,
    (SELECT count(*) FROM raw_ratings WHERE rating BETWEEN 0.5 AND 5.0) AS valid, (SELECT count(*) FROM ratings_clean) AS clean,
    (SELECT count(*) FROM ratings_clean JOIN links_s USING (movielens_id) WHERE tmdb_id IS NOT NULL) AS linked,
    (SELECT count(*) FROM ratings_final WHERE movie_id IN (SELECT p_partkey FROM part)) AS found,
    (SELECT count(*) FROM (SELECT DISTINCT user_id, movie_id FROM ratings_final)) AS pairs),
steps AS (
  SELECT unnest([
    {'t': 'credits', 's': 'read', 'b': p, 'n': p}, {'t': 'credits', 's': 'whole id', 'b': p, 'n': p}, {'t': 'credits', 's': 'distinct id', 'b': p, 'n': p},
    {'t': 'movies', 's': 'read', 'b': p, 'n': p}, {'t': 'movies', 's': 'distinct id', 'b': p, 'n': p}, {'t': 'movies', 's': 'whole id', 'b': p, 'n': p},
    {'t': 'keywords', 's': 'read', 'b': p, 'n': p}, {'t': 'keywords', 's': 'whole id', 'b': p, 'n': p}, {'t': 'keywords', 's': 'distinct id', 'b': p, 'n': p},
    {'t': 'ratings', 's': 'read', 'b': raw, 'n': raw}, {'t': 'ratings', 's': 'valid', 'b': raw, 'n': valid},
    {'t': 'ratings', 's': 'distinct pair', 'b': valid, 'n': clean},
    {'t': 'links', 's': 'read', 'b': p, 'n': p}, {'t': 'links', 's': 'whole id', 'b': p, 'n': p}, {'t': 'links', 's': 'distinct id', 'b': p, 'n': p},
    {'t': 'catalog', 's': 'read', 'b': p, 'n': p}, {'t': 'catalog', 's': 'distinct id', 'b': p, 'n': p},
    {'t': 'rated', 's': 'read', 'b': clean, 'n': clean}, {'t': 'rated', 's': 'linked', 'b': clean, 'n': linked},
    {'t': 'rated', 's': 'in catalog', 'b': linked, 'n': found}, {'t': 'rated', 's': 'distinct pair', 'b': found, 'n': pairs}]) AS x FROM n)
SELECT x.t AS "table", x.s AS step, x.b AS n_before, x.n AS n_rows, x.b - x.n AS n_dropped FROM steps""",
)
def clean_files_dropped(spark: SparkSession, d: str) -> DataFrame:
    return _cleaned_files(spark, d)[1].drop("place")


@query(
    "clean_files_ratings",
    with_views(["links"], _RAW_RATINGS_SQL) + "SELECT user_id, movie_id, movielens_id, rating, ts FROM ratings_final",
)
def clean_files_ratings(spark: SparkSession, d: str) -> DataFrame:
    """Final ratings after a way through CSV files."""
    final = readers.read_table(spark, f"{_cleaned_files(spark, d)[0]}/ratings")
    return final.select("user_id", "movie_id", "movielens_id", "rating", F.unix_timestamp("timestamp").alias("ts"))


@query(
    "clean_files_movies",
    """SELECT p_partkey AS movie_id, p_name AS title, false AS adult, CAST(NULL AS DOUBLE) AS budget,
  p_retailprice AS revenue, CAST(p_size AS DOUBLE) AS runtime, 1950 + p_size AS release_year,
  p_type || '|' || p_brand AS genres, CAST(NULL AS VARCHAR) AS overview FROM part""",
)
def clean_files_movies(spark: SparkSession, d: str) -> DataFrame:
    """Final films after a way through CSV files."""
    final = readers.read_table(spark, f"{_cleaned_files(spark, d)[0]}/movies")
    return final.select(
        "movie_id", "title", "adult", "budget", "revenue", "runtime", "release_year",
        F.array_join("genre_names", "|").alias("genres"), "overview",
    )


@query(
    "clean_files_people",
    """SELECT 'cast' AS kind, p_partkey AS movie_id, p_size AS person_id, p_brand AS name, p_type AS part FROM part
UNION ALL SELECT 'cast', p_partkey, p_size + 100, p_name, '' FROM part
UNION ALL SELECT 'crew', p_partkey, p_size, p_brand, 'Director' FROM part
UNION ALL SELECT 'keyword', p_partkey, p_size, 'size ' || p_size, NULL FROM part
UNION ALL SELECT 'keyword', p_partkey, length(p_type) + 1000, 'len ' || length(p_type), NULL FROM part""",
)
def clean_files_people(spark: SparkSession, d: str) -> DataFrame:
    """Cast, crew and keywords after a way through CSV files."""
    folder = _cleaned_files(spark, d)[0]
    cast, crew, words = (readers.read_table(spark, f"{folder}/{t}_clean") for t in ("cast", "crew", "keywords"))
    person = [F.col("person_id").cast("bigint").alias("person_id"), "name"]
    return (
        cast.select(F.lit("cast").alias("kind"), "movie_id", *person, F.col("character").alias("part"))
        .unionByName(crew.select(F.lit("crew").alias("kind"), "movie_id", *person, F.col("job").alias("part")))
        .unionByName(
            words.select(
                F.lit("keyword").alias("kind"), "movie_id", F.col("keyword_id").cast("bigint").alias("person_id"),
                F.col("keyword").alias("name"), F.lit(None).cast("string").alias("part"),
            )
        )
    )


@query(
    "clean_movies",
    """SELECT p_partkey AS id, p_name AS title, false AS adult, CAST(NULL AS DOUBLE) AS budget,
  p_retailprice AS revenue, CAST(p_size AS DOUBLE) AS runtime, 1950 + p_size AS release_year,
  p_type || '|' || p_brand AS genres, 'US' AS countries, CAST(NULL AS VARCHAR) AS overview FROM part""",
)
def clean_movies(spark: SparkSession, d: str) -> DataFrame:
    cleaned = cleaning.clean_movies(_raw_tables(spark, d)[0], ["title"])
    return cleaned.select(
        "id", "title", "adult", "budget", "revenue", "runtime", "release_year",
        F.array_join("genre_names", "|").alias("genres"),
        F.array_join("production_country_codes", "|").alias("countries"),
        "overview",
    )


@query(
    "clean_ratings",
    with_views(["links"], _RAW_RATINGS_SQL) + "SELECT user_id, movielens_id, rating, ts FROM ratings_clean",
)
def clean_ratings(spark: SparkSession, d: str) -> DataFrame:
    cleaned = cleaning.clean_ratings(_raw_tables(spark, d)[3], ["timestamp", "rating"])
    return cleaned.select(
        F.col("userId").alias("user_id"),
        F.col("movieId").alias("movielens_id"),
        "rating",
        F.unix_timestamp("timestamp").alias("ts"),
    )


@query(
    "build_final",
    with_views(["links"], _RAW_RATINGS_SQL) + "SELECT user_id, movie_id, movielens_id, rating, ts FROM ratings_final",
)
def build_final(spark: SparkSession, d: str) -> DataFrame:
    movies, _, _, ratings, links = _raw_tables(spark, d)
    _, final = cleaning.build_final(
        cleaning.clean_movies(movies, ["title"]),
        cleaning.clean_ratings(ratings, ["timestamp", "rating"]),
        cleaning.clean_links(links, ["imdbId", "tmdbId"]),
    )
    return final.select("user_id", "movie_id", "movielens_id", "rating", F.unix_timestamp("timestamp").alias("ts"))


@query(
    "explode_cast",
    """SELECT p_partkey AS movie_id, 1 AS cast_id, p_size AS person_id, p_brand AS name, p_type AS "character",
  0 AS "order", 2 AS gender, NULL AS profile_path FROM part
UNION ALL SELECT p_partkey, 2, p_size + 100, p_name, '', 1, 0, '/p.jpg' FROM part""",
)
def explode_cast(spark: SparkSession, d: str) -> DataFrame:
    people = cleaning.explode_cast(_raw_tables(spark, d)[1], ["cast"])
    whole = ("cast_id", "person_id", "order", "gender")
    return people.withColumns({c: F.col(c).cast("int") for c in whole})


@query(
    "explode_crew",
    """SELECT p_partkey AS movie_id, p_size AS person_id, p_brand AS name, 'Directing' AS department,
  'Director' AS job, 1 AS gender, CAST(NULL AS VARCHAR) AS profile_path FROM part""",
)
def explode_crew(spark: SparkSession, d: str) -> DataFrame:
    people = cleaning.explode_crew(_raw_tables(spark, d)[1], ["crew"])
    return people.withColumns({c: F.col(c).cast("int") for c in ("person_id", "gender")})


_KEYWORDS_SQL = """flat AS (
  SELECT p_partkey AS movie_id, CAST(p_size AS BIGINT) AS keyword_id, 'size ' || p_size AS keyword FROM part
  UNION ALL SELECT p_partkey, length(p_type) + 1000, 'len ' || length(p_type) FROM part)"""


@query("explode_keywords", f"WITH {_KEYWORDS_SQL} SELECT movie_id, keyword_id, keyword FROM flat")
def explode_keywords(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.explode_keywords(_raw_tables(spark, d)[2], ["keywords"])


@query(
    "normalize_keywords",
    f"""WITH {_KEYWORDS_SQL},
names AS (SELECT keyword_id, arg_min(keyword, (movie_id, keyword)) AS name FROM flat GROUP BY keyword_id),
pairs AS (SELECT DISTINCT movie_id, keyword_id FROM flat)
SELECT keyword_id, name, count(*) AS n_movies FROM names JOIN pairs USING (keyword_id) GROUP BY keyword_id, name""",
)
def normalize_keywords(spark: SparkSession, d: str) -> DataFrame:
    keywords, pairs = cleaning.normalize_keywords(explode_keywords(spark, d))
    return keywords.join(pairs, "keyword_id").groupBy("keyword_id", "name").agg(F.count("*").alias("n_movies"))


@query(
    "rename_columns",
    "SELECT l_orderkey AS user_id, l_partkey AS movie_id, l_quantity AS rating FROM lineitem",
)
def rename_columns(spark: SparkSession, d: str) -> DataFrame:
    renamed = s.table(spark, d, "lineitem").withColumnsRenamed(
        {"l_orderkey": "user_id", "l_partkey": "movie_id", "l_quantity": "rating"}
    )
    return renamed.select("user_id", "movie_id", "rating")


@query("keep_existing", "SELECT p_partkey, p_name, p_size FROM part")
def keep_existing(spark: SparkSession, d: str) -> DataFrame:
    return relational.keep_existing(s.table(spark, d, "part"), ["p_partkey", "p_name", "backdrop_path", "p_size"])


@query(
    "coerce_numeric",
    f"WITH {_RAW_TEXT_SQL} SELECT TRY_CAST(cell AS DOUBLE) AS number, count(*) AS n FROM raw_text GROUP BY 1",
)
def coerce_numeric(spark: SparkSession, d: str) -> DataFrame:
    return (
        _raw_text(spark, d)
        .select(coercion.coerce_numeric(F.col("cell")).alias("number"))
        .groupBy("number")
        .agg(F.count("*").alias("n"))
    )


@query(
    "coerce_id",
    f"""WITH {_RAW_TEXT_SQL}
SELECT CAST(TRY_CAST(cell AS DOUBLE) AS BIGINT) AS id, count(*) AS n FROM raw_text
WHERE TRY_CAST(cell AS DOUBLE) IS NOT NULL GROUP BY 1""",
)
def coerce_id(spark: SparkSession, d: str) -> DataFrame:
    keyed = _raw_text(spark, d).select(coercion.coerce_id(F.col("cell")).alias("id")).where("id IS NOT NULL")
    return keyed.groupBy("id").agg(F.count("*").alias("n"))


@query(
    "zero_to_null",
    "SELECT l_orderkey, l_partkey, l_linenumber, nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax FROM lineitem",
)
def zero_to_null(spark: SparkSession, d: str) -> DataFrame:
    return s.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        coercion.zero_to_null(F.col("l_discount")).alias("discount"),
        coercion.zero_to_null(F.col("l_tax")).alias("tax"),
    )


@query(
    "range_to_null",
    """SELECT l_orderkey, l_partkey, l_linenumber,
  CASE WHEN l_quantity * 20 BETWEEN 1 AND 600 THEN l_quantity * 20 END AS runtime FROM lineitem""",
)
def range_to_null(spark: SparkSession, d: str) -> DataFrame:
    return s.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        coercion.range_to_null(F.col("l_quantity") * 20, 1, 600).alias("runtime"),
    )


@query("valid_rating_filter", "SELECT event_id, user_id, value AS rating FROM events WHERE value BETWEEN 0.5 AND 5.0")
def valid_rating_filter(spark: SparkSession, d: str) -> DataFrame:
    return s.rating_events(spark, d).where(cleaning.valid_rating(F.col("value"))).select(
        "event_id", "user_id", F.col("value").alias("rating")
    )


@query("drop_null_keys", with_views(["links"]) + "SELECT movielens_id, tmdb_id FROM links_s WHERE tmdb_id IS NOT NULL")
def drop_null_keys(spark: SparkSession, d: str) -> DataFrame:
    return s.links(spark, d).dropna(subset=["movielens_id", "tmdb_id"])


@query("binarize_positive", with_views(["pos"]) + "SELECT user_id, movie_id FROM pos")
def binarize_positive(spark: SparkSession, d: str) -> DataFrame:
    from filmloom.operators.interactions import binarize_positive as binarize

    return binarize(s.ratings(spark, d))


@query("lookup_by_id", with_views(["movies"]) + "SELECT movie_id, title, genre_names FROM movies_s WHERE movie_id = 42")
def lookup_by_id(spark: SparkSession, d: str) -> DataFrame:
    return s.movies(spark, d).where(F.col("movie_id") == 42).select("movie_id", "title", "genre_names")


@query(
    "search_title",
    with_views(["movies"])
    + "SELECT movie_id, title FROM movies_s WHERE contains(lower(title), 'ring') ORDER BY movie_id LIMIT 25",
)
def search(spark: SparkSession, d: str) -> DataFrame:
    return search_title(s.movies(spark, d), "RING", 25).select("movie_id", "title")


@query(
    "exclude_items",
    with_views(["pos"])
    + "SELECT user_id, movie_id, rating FROM ratings_s r WHERE NOT EXISTS "
    "(SELECT 1 FROM pos p WHERE p.user_id = r.user_id AND p.movie_id = r.movie_id)",
)
def exclude_items(spark: SparkSession, d: str) -> DataFrame:
    rated = s.ratings(spark, d).select("user_id", "movie_id", "rating")
    return relational.exclude_items(rated, binarize_positive(spark, d), ["user_id", "movie_id"])


@query(
    "tag_strategy",
    with_views(["movies"]) + "SELECT movie_id, title, 'popular' AS strategy, 'content-based' AS recommendation_strategy FROM movies_s",
)
def tag_strategy(spark: SparkSession, d: str) -> DataFrame:
    tags = {"strategy": F.lit("popular"), "recommendation_strategy": F.lit("content-based")}
    return s.movies(spark, d).select("movie_id", "title").withColumns(tags)


@query(
    "parse_literal_list",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 1 AS n_objects FROM events",
)
def parse_literal_list(spark: SparkSession, d: str) -> DataFrame:
    items = literals.parse_literal_list(F.concat(F.lit("["), F.col("props"), F.lit("]")), _EVENT_PROPS)
    return s.rating_events(spark, d).select(
        "event_id", items[0]["k"].cast("bigint").alias("k"), F.size(items).alias("n_objects")
    )


_EVENT_PROPS = "array<struct<k:string>>"


@query(
    "extract_names",
    "SELECT p_partkey AS movie_id, p_type || '|' || p_brand AS names, 'size' || p_size AS first_code FROM part",
)
def extract_names(spark: SparkSession, d: str) -> DataFrame:
    objects = F.concat(
        F.lit('[{"id": 1, "name": "'), "p_type", F.lit('"}, {"id": 2}, {"name": "'), "p_brand",
        F.lit('", "iso_639_1": "size'), F.col("p_size"), F.lit('"}]'),
    )
    parsed = literals.parse_literal_list(objects, NAMED_ENTITY)
    return s.table(spark, d, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.array_join(literals.extract_names(parsed), "|").alias("names"),
        literals.extract_first(parsed, "iso_639_1").alias("first_code"),
    )


@query("extract_first", "SELECT p_partkey AS movie_id, p_type AS first_name, CAST(NULL AS VARCHAR) AS absent FROM part")
def extract_first(spark: SparkSession, d: str) -> DataFrame:
    objects = F.concat(F.lit("[{'name': '"), "p_type", F.lit("'}, {'name': '"), "p_brand", F.lit("'}]"))
    parsed = literals.parse_literal_list(objects, NAMED_ENTITY)
    return s.table(spark, d, "part").select(
        F.col("p_partkey").alias("movie_id"),
        literals.extract_first(parsed).alias("first_name"),
        literals.extract_first(parsed, "iso_3166_1").alias("absent"),
    )


@query(
    "text_to_boolean",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS flag FROM orders""",
)
def text_to_boolean(spark: SparkSession, d: str) -> DataFrame:
    status = F.col("o_orderstatus")
    word = F.when(status == "F", F.lit(" TRUE ")).when(status == "O", F.lit("False")).otherwise(F.lit("junk"))
    return s.table(spark, d, "orders").select("o_orderkey", coercion.text_to_boolean(word).alias("flag"))


@query(
    "clean_text",
    "SELECT c_custkey, trim(c_name) AS name, substr(trim(c_mktsegment), 1, 4) AS segment, lower(c_mktsegment) AS low FROM customer",
)
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    padded = F.concat(F.lit(" \t"), "c_mktsegment", F.lit("\n "))
    return s.table(spark, d, "customer").select(
        "c_custkey",
        coercion.clean_text(F.col("c_name")).alias("name"),
        coercion.clean_text(padded, 4).alias("segment"),
        F.lower(coercion.clean_text(padded)).alias("low"),
    )


@query(
    "parse_release",
    f"""WITH {_RAW_TEXT_SQL}, dated AS (
  SELECT CASE WHEN regexp_full_match(cell, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') THEN TRY_CAST(cell AS DATE) END AS day FROM raw_text)
SELECT strftime(day, '%Y-%m-%d') AS release_date, CAST(year(day) AS INTEGER) AS release_year, count(*) AS n FROM dated GROUP BY ALL""",
)
def parse_release(spark: SparkSession, d: str) -> DataFrame:
    day = _raw_text(spark, d).select(coercion.parse_release(F.col("cell")).alias("day"))
    dated = day.select(F.date_format("day", "yyyy-MM-dd").alias("release_date"), F.year("day").alias("release_year"))
    return dated.groupBy("release_date", "release_year").agg(F.count("*").alias("n"))


@query(
    "epoch_to_timestamp",
    "SELECT o_orderkey, strftime(date_trunc('second', o_orderdate), '%Y-%m-%d %H:%M:%S') AS ts FROM orders",
)
def epoch_to_timestamp(spark: SparkSession, d: str) -> DataFrame:
    seconds = F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string")
    return s.table(spark, d, "orders").select(
        "o_orderkey", F.date_format(coercion.epoch_to_timestamp(seconds), "yyyy-MM-dd HH:mm:ss").alias("ts")
    )


@query(
    "genre_list",
    with_views(["movies"])
    + "SELECT movie_id, replace(genre_names, '|', ';') AS genres, replace(genre_names, '|', ';') AS from_literal FROM movies_s",
)
def genre_list(spark: SparkSession, d: str) -> DataFrame:
    literal = F.concat(F.lit("['"), F.replace("genre_names", F.lit("|"), F.lit("', '")), F.lit("']"))
    return s.movies(spark, d).select(
        "movie_id",
        F.array_join(text.genre_list(F.col("genre_names")), ";").alias("genres"),
        F.array_join(text.genre_list(literal), ";").alias("from_literal"),
    )


@query(
    "year_from_title",
    with_views(["movies"]) + "SELECT movie_id, release_year AS year, CAST(NULL AS INTEGER) AS none FROM movies_s",
)
def year_from_title(spark: SparkSession, d: str) -> DataFrame:
    titled = F.concat("title", F.lit(" ("), F.col("release_year"), F.lit(")"))
    return s.movies(spark, d).select(
        "movie_id", text.year_from_title(titled).alias("year"), text.year_from_title(F.col("title")).alias("none")
    )


@query("imdb_number", "SELECT p_partkey AS movie_id, nullif(p_partkey, 0) AS imdb_number FROM part")
def imdb_number(spark: SparkSession, d: str) -> DataFrame:
    imdb = F.concat(F.lit("tt"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    return s.table(spark, d, "part").select(
        F.col("p_partkey").alias("movie_id"), coercion.imdb_number(imdb).alias("imdb_number")
    )


@query(
    "content_text",
    with_views(["movies"]) + "SELECT movie_id, lower(title) || ' ' || lower(genre_names) AS content, lower(title) AS title_only FROM movies_s",
)
def content_text(spark: SparkSession, d: str) -> DataFrame:
    return s.movies(spark, d).select(
        "movie_id",
        text.content_text(F.col("title"), F.col("genre_names")).alias("content"),
        text.content_text(F.col("title"), F.lit("NaN")).alias("title_only"),
    )


@query(
    "poster_url",
    "SELECT page_id, CASE WHEN trim(url) <> '' THEN 'https://image.tmdb.org/t/p/w342' || url END AS poster, "
    "CAST(NULL AS VARCHAR) AS blank FROM pages",
)
def poster_url(spark: SparkSession, d: str) -> DataFrame:
    return s.table(spark, d, "pages").select(
        "page_id", text.poster_url(F.col("url")).alias("poster"), text.poster_url(F.lit("  ")).alias("blank")
    )


@query(
    "movie_label",
    with_views(["movies"])
    + "SELECT title || ' (' || release_year || ') · ID ' || movie_id AS label, title || ' (?) · ID ' || movie_id AS unknown FROM movies_s",
)
def movie_label(spark: SparkSession, d: str) -> DataFrame:
    key, title = F.col("movie_id"), F.col("title")
    return s.movies(spark, d).select(
        text.movie_label(title, F.col("release_year"), key).alias("label"),
        text.movie_label(title, F.lit(None).cast("int"), key).alias("unknown"),
    )


@query(
    "digits_to_id",
    """SELECT c_custkey, coalesce(TRY_CAST(nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), '') AS BIGINT), -1) AS digits,
  CAST(-1 AS BIGINT) AS none FROM customer""",
)
def digits_to_id(spark: SparkSession, d: str) -> DataFrame:
    return s.table(spark, d, "customer").select(
        "c_custkey",
        coercion.digits_to_id(F.col("c_name")).alias("digits"),
        coercion.digits_to_id(F.regexp_replace("c_mktsegment", "[0-9]", "")).alias("none"),
    )


@query(
    "format_metrics",
    with_views(["ratings"])
    + """SELECT movie_id, round(avg(rating), 4) AS mean, format('{:,}', count(*) * 1000) AS shown
FROM ratings_s GROUP BY movie_id""",
)
def format_metrics(spark: SparkSession, d: str) -> DataFrame:
    return s.ratings(spark, d).groupBy("movie_id").agg(
        F.round(F.avg("rating"), 4).alias("mean"), text.thousands(F.count("*") * 1000).alias("shown")
    )


@query(
    "preview_table",
    """SELECT c_custkey, CASE WHEN length(c_name || c_mktsegment) > 20 THEN substr(c_name || c_mktsegment, 1, 20) || '…'
  ELSE c_name || c_mktsegment END AS shown FROM customer""",
)
def preview(spark: SparkSession, d: str) -> DataFrame:
    return s.table(spark, d, "customer").select(
        "c_custkey", text.preview(F.concat("c_name", "c_mktsegment"), 20).alias("shown")
    )
