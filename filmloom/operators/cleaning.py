"""Raw text tables to typed, keyed tables.

File order decides which duplicate survives, but a distributed read has none,
so every cleaner takes ``order_by``: the columns that make up a total order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.functions.coercion import (
    clean_text,
    coerce_id,
    coerce_numeric,
    epoch_to_timestamp,
    parse_release,
    range_to_null,
    text_to_boolean,
    zero_to_null,
)
from filmloom.functions.literals import extract_names, parse_literal_list
from filmloom.operators.relational import dedup_keep_first, keep_existing, key_overlap
from filmloom.schemas import NAMED_ENTITY, PERSON_CAST, PERSON_CREW, RATING_MAX, RATING_MIN

Order = list[Column | str]
#: Called with the name of a step and its rows; hands the rows on.
Watch = Callable[[str, DataFrame], DataFrame]

# Names and order of the cleaned film columns.
MOVIE_COLUMNS = [
    "id", "imdb_id", "title", "original_title", "original_language", "overview", "tagline", "status",
    "adult", "video", "budget", "revenue", "runtime", "vote_count", "vote_average", "popularity",
    "release_date", "release_year", "genre_names", "production_company_names",
    "production_country_codes", "spoken_language_codes", "poster_path", "backdrop_path", "homepage",
    "belongs_to_collection",
]


def unwatched(step: str, df: DataFrame) -> DataFrame:
    return df


def _keyed(raw: DataFrame, column: str = "id") -> DataFrame:
    return raw.withColumn(column, coerce_id(F.col(column))).where(F.col(column).isNotNull())


def clean_movies(raw: DataFrame, order_by: Order, watch: Watch = unwatched) -> DataFrame:
    """Typed films, one per id. Duplicates are judged on the raw id text, as in the file."""
    distinct = watch("movies: distinct id", dedup_keep_first(watch("movies: read", raw), ["id"], order_by))
    first = watch("movies: whole id", _keyed(distinct))
    names = {
        "genre_names": ("genres", "name"),
        "production_company_names": ("production_companies", "name"),
        "production_country_codes": ("production_countries", "iso_3166_1"),
        "spoken_language_codes": ("spoken_languages", "iso_639_1"),
    }
    number = {c: coerce_numeric(F.col(c)) for c in ("vote_count", "vote_average", "popularity")}
    typed = first.withColumns(
        {
            **number,
            "budget": zero_to_null(coerce_numeric(F.col("budget"))),
            "revenue": zero_to_null(coerce_numeric(F.col("revenue"))),
            "runtime": range_to_null(coerce_numeric(F.col("runtime")), 1, 600),
            "release_date": parse_release(F.col("release_date")),
            "release_year": F.year(parse_release(F.col("release_date"))),
            "adult": text_to_boolean(F.col("adult")),
            "video": text_to_boolean(F.col("video")),
            "original_language": clean_text(F.col("original_language"), 10),
            **{c: clean_text(F.col(c)) for c in ("status", "title", "original_title")},
            **{c: F.nullif(clean_text(F.col(c)), F.lit("")) for c in ("overview", "tagline")},
            **{
                out: extract_names(parse_literal_list(F.col(src), NAMED_ENTITY), key)
                for out, (src, key) in names.items()
            },
        }
    )
    return keep_existing(typed, MOVIE_COLUMNS)


def _text(value: Column) -> Column:
    return clean_text(F.coalesce(value, F.lit("")))


def distinct_films(raw: DataFrame, order_by: Order, watch: Watch = unwatched, table: str = "credits") -> DataFrame:
    """Rows with a whole film id, one per film."""
    keyed = watch(f"{table}: whole id", _keyed(watch(f"{table}: read", raw)))
    return watch(f"{table}: distinct id", dedup_keep_first(keyed, ["id"], order_by))


def explode_cast(raw: DataFrame, order_by: Order) -> DataFrame:
    """One row per cast member; films without people give no row."""
    return cast_rows(distinct_films(raw, order_by))


def cast_rows(first: DataFrame) -> DataFrame:
    people = first.select(
        F.col("id").alias("movie_id"), F.explode(parse_literal_list(F.col("cast"), PERSON_CAST)).alias("p")
    )
    return people.select(
        "movie_id",
        coerce_id(F.col("p.cast_id")).alias("cast_id"),
        coerce_id(F.col("p.id")).alias("person_id"),
        _text(F.col("p.name")).alias("name"),
        _text(F.col("p.character")).alias("character"),
        coerce_id(F.col("p.order")).alias("order"),
        coerce_id(F.col("p.gender")).alias("gender"),
        F.col("p.profile_path").alias("profile_path"),
    )


def explode_crew(raw: DataFrame, order_by: Order) -> DataFrame:
    return crew_rows(distinct_films(raw, order_by))


def crew_rows(first: DataFrame) -> DataFrame:
    people = first.select(
        F.col("id").alias("movie_id"), F.explode(parse_literal_list(F.col("crew"), PERSON_CREW)).alias("p")
    )
    return people.select(
        "movie_id",
        coerce_id(F.col("p.id")).alias("person_id"),
        _text(F.col("p.name")).alias("name"),
        _text(F.col("p.department")).alias("department"),
        _text(F.col("p.job")).alias("job"),
        coerce_id(F.col("p.gender")).alias("gender"),
        F.col("p.profile_path").alias("profile_path"),
    )


def clean_credits(raw: DataFrame, order_by: Order) -> tuple[DataFrame, DataFrame]:
    return explode_cast(raw, order_by), explode_crew(raw, order_by)


def explode_keywords(raw: DataFrame, order_by: Order, watch: Watch = unwatched) -> DataFrame:
    """(movie_id, keyword_id, keyword), one row per keyword of a film."""
    first = distinct_films(raw, order_by, watch, "keywords")
    words = first.select(
        F.col("id").alias("movie_id"), F.explode(parse_literal_list(F.col("keywords"), NAMED_ENTITY)).alias("k")
    )
    return words.select(
        "movie_id", coerce_id(F.col("k.id")).alias("keyword_id"), _text(F.col("k.name")).alias("keyword")
    )


def normalize_keywords(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """keywords(keyword_id, name) and movie_keywords; the name of the lowest film id wins."""
    known = flat.where(F.col("keyword_id").isNotNull() & F.col("movie_id").isNotNull())
    name = F.min_by("keyword", F.struct("movie_id", "keyword"))
    keywords = known.groupBy("keyword_id").agg(name.alias("name"))
    return keywords, known.select("movie_id", "keyword_id").distinct()


def valid_rating(rating: Column) -> Column:
    return rating.isNotNull() & rating.between(RATING_MIN, RATING_MAX)


def typed_ratings(raw: DataFrame) -> DataFrame:
    """Row-wise part of rating cleaning; also runs on a stream."""
    typed = raw.withColumns(
        {
            "userId": coerce_id(F.col("userId")),
            "movieId": coerce_id(F.col("movieId")),
            "rating": coerce_numeric(F.col("rating")),
            "timestamp": epoch_to_timestamp(F.col("timestamp")),
        }
    )
    return typed.where(
        valid_rating(F.col("rating")) & F.col("userId").isNotNull() & F.col("movieId").isNotNull()
    )


def clean_ratings(raw: DataFrame, order_by: Order, watch: Watch = unwatched) -> DataFrame:
    valid = watch("ratings: valid", typed_ratings(watch("ratings: read", raw)))
    return watch("ratings: distinct pair", dedup_keep_first(valid, ["userId", "movieId"], order_by))


def clean_links(raw: DataFrame, order_by: Order, watch: Watch = unwatched) -> DataFrame:
    typed = watch("links: read", raw).withColumns({c: coerce_id(F.col(c)) for c in ("movieId", "imdbId", "tmdbId")})
    keyed = watch("links: whole id", typed.where(F.col("movieId").isNotNull()))
    return watch("links: distinct id", dedup_keep_first(keyed, ["movieId"], order_by))


def map_ratings_to_movies(ratings: DataFrame, links: DataFrame) -> DataFrame:
    """Ratings under the catalog id; ratings without a resolvable link drop out.

    Links are one row per catalog film, far fewer than ratings; whether they are
    broadcast is decided by the optimizer from their real size.
    """
    resolved = links.where(F.col("movielens_id").isNotNull() & F.col("tmdb_id").isNotNull())
    resolved = resolved.groupBy("movielens_id").agg(F.min("tmdb_id").alias("movie_id"))
    return ratings.join(resolved, "movielens_id")


def semi_join_catalog(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    return ratings.join(movies.select("movie_id"), "movie_id", "left_semi")


def join_by_imdb(films: DataFrame, links: DataFrame, imdb_number: Column) -> DataFrame:
    """Films matched to links by the number inside their imdb id, one per title."""
    keyed = films.withColumn("imdb_number", imdb_number).where(F.col("imdb_number").isNotNull())
    joined = keyed.join(links, keyed["imdb_number"] == links["imdb_id"])
    return dedup_keep_first(
        joined.select("title", "movie_id", "movielens_id"), ["title"], ["movie_id", "movielens_id"]
    )


def semi_join_mutual(films: DataFrame, ratings: DataFrame, key: str = "movie_id") -> tuple[DataFrame, DataFrame]:
    """Films that have ratings, and the ratings of those films."""
    rated = films.join(ratings.select(key).distinct(), key, "left_semi")
    return rated, ratings.join(rated.select(key), key, "left_semi")


def check_rating_overlap(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """Counts of rated films and of those with metadata; raises when they differ."""
    counted = key_overlap(ratings, movies, "movie_id")
    row = counted.first()
    if row["n_found"] != row["n_keys"]:
        raise ValueError(
            f"{row['n_keys'] - row['n_found']} of {row['n_keys']} ratings.movie_id values are not in movies"
        )
    return counted


def build_final(
    movies: DataFrame, ratings: DataFrame, links: DataFrame, watch: Watch = unwatched
) -> tuple[DataFrame, DataFrame]:
    """Films and ratings under one id system: (movies, ratings)."""
    keyed = watch("catalog: read", movies).withColumnRenamed("id", "movie_id").where(F.col("movie_id").isNotNull())
    whole = F.to_json(F.struct(*keyed.columns))
    final_movies = watch("catalog: distinct id", dedup_keep_first(keyed, ["movie_id"], ["title", whole]))
    renamed = watch("rated: read", ratings).withColumnsRenamed({"userId": "user_id", "movieId": "movielens_id"})
    mapping = links.withColumnsRenamed({"movieId": "movielens_id", "tmdbId": "tmdb_id"})
    linked = watch("rated: linked", map_ratings_to_movies(renamed, mapping))
    catalog = movies.select(F.col("id").alias("movie_id")).where("movie_id IS NOT NULL").distinct()  # a watch counts one use
    mapped = watch("rated: in catalog", semi_join_catalog(linked, catalog))
    final_ratings = dedup_keep_first(
        mapped.select("user_id", "movie_id", "movielens_id", "rating", "timestamp"),
        ["user_id", "movie_id"],
        ["movielens_id", "timestamp", "rating"],
    )
    return final_movies, watch("rated: distinct pair", final_ratings)
