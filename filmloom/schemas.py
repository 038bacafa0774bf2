"""Fixed table layouts, keys and relations of the cleaned catalog."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_STR, _INT, _SHORT, _BOOL = T.StringType(), T.IntegerType(), T.ShortType(), T.BooleanType()
_NAMES = T.ArrayType(_STR)

MOVIES = _table(
    movie_id=_INT,
    imdb_id=_STR,
    title=_STR,
    original_title=_STR,
    original_language=_STR,
    overview=_STR,
    tagline=_STR,
    status=_STR,
    adult=_BOOL,
    video=_BOOL,
    budget=T.DecimalType(20, 2),
    revenue=T.DecimalType(20, 2),
    runtime=T.DecimalType(6, 1),
    vote_count=T.DecimalType(12, 1),
    vote_average=T.DecimalType(4, 2),
    popularity=T.DecimalType(12, 6),
    release_date=T.DateType(),
    release_year=_SHORT,
    genre_names=_NAMES,
    production_company_names=_NAMES,
    production_country_codes=_NAMES,
    spoken_language_codes=_NAMES,
    poster_path=_STR,
    homepage=_STR,
    belongs_to_collection=_STR,
)
RATINGS = _table(
    user_id=_INT,
    movie_id=_INT,
    movielens_id=_INT,
    rating=T.DecimalType(3, 1),
    timestamp=T.TimestampType(),
)
LINKS = _table(movielens_id=_INT, imdb_id=_INT, tmdb_id=_INT)
CAST_MEMBERS = _table(
    movie_id=_INT,
    cast_id=_INT,
    person_id=_INT,
    name=_STR,
    character=_STR,
    order=_INT,
    gender=_SHORT,
    profile_path=_STR,
)
CREW_MEMBERS = _table(
    movie_id=_INT,
    person_id=_INT,
    name=_STR,
    department=_STR,
    job=_STR,
    gender=_SHORT,
    profile_path=_STR,
)
KEYWORDS = _table(keyword_id=_INT, name=_STR)
MOVIE_KEYWORDS = _table(movie_id=_INT, keyword_id=_INT)
PROFILES = _table(
    email=_STR,
    favorite_genres=_NAMES,
    age_preference=_STR,
    ratings=T.MapType(_STR, T.DoubleType()),
    favorites=T.ArrayType(_INT),
)

TABLES = {
    "movies": MOVIES,
    "ratings": RATINGS,
    "links": LINKS,
    "cast_members": CAST_MEMBERS,
    "crew_members": CREW_MEMBERS,
    "keywords": KEYWORDS,
    "movie_keywords": MOVIE_KEYWORDS,
}

PRIMARY_KEYS = {
    "movies": ["movie_id"],
    "ratings": ["user_id", "movie_id"],
    "links": ["movielens_id"],
    "cast_members": ["movie_id", "cast_id", "person_id", "order"],
    "crew_members": ["movie_id", "person_id", "department", "job"],
    "keywords": ["keyword_id"],
    "movie_keywords": ["movie_id", "keyword_id"],
}

# Besides the primary keys.
NOT_NULL = {
    "movies": ["title"],
    "ratings": ["movielens_id", "rating"],
    "cast_members": ["name"],
    "crew_members": ["name"],
    "keywords": ["name"],
}

RATING_MIN, RATING_MAX, RATING_STEP = 0.5, 5.0, 0.5

# (child table, child column, parent table, parent column)
RELATIONS = [
    ("ratings", "movie_id", "movies", "movie_id"),
    ("movie_keywords", "movie_id", "movies", "movie_id"),
    ("movie_keywords", "keyword_id", "keywords", "keyword_id"),
    ("cast_members", "movie_id", "movies", "movie_id"),
    ("crew_members", "movie_id", "movies", "movie_id"),
]

# Columns a loaded table must at least have.
EXPECTED_COLUMNS = {
    "movies": ["imdb_id", "movie_id", "title"],
    "ratings": ["movie_id", "movielens_id", "rating", "timestamp", "user_id"],
    "links": ["imdb_id", "movielens_id", "tmdb_id"],
    "cast_members": ["movie_id", "name", "person_id"],
    "crew_members": ["movie_id", "name", "person_id"],
    "keywords": ["keyword_id", "name"],
    "movie_keywords": ["keyword_id", "movie_id"],
}

# Raw CSV columns; every one is read as text and coerced afterwards.
RAW_COLUMNS = {
    "movies_metadata": [
        "adult", "belongs_to_collection", "budget", "genres", "homepage", "id", "imdb_id",
        "original_language", "original_title", "overview", "popularity", "poster_path",
        "production_companies", "production_countries", "release_date", "revenue", "runtime",
        "spoken_languages", "status", "tagline", "title", "video", "vote_average", "vote_count",
    ],
    "credits": ["cast", "crew", "id"],
    "keywords": ["id", "keywords"],
    "ratings": ["userId", "movieId", "rating", "timestamp"],
    "links": ["movieId", "imdbId", "tmdbId"],
}

PERSON_CAST = T.ArrayType(
    T.StructType(
        [
            T.StructField(name, _STR)
            for name in ("cast_id", "id", "name", "character", "order", "gender", "profile_path")
        ]
    )
)
PERSON_CREW = T.ArrayType(
    T.StructType(
        [T.StructField(name, _STR) for name in ("id", "name", "department", "job", "gender", "profile_path")]
    )
)
NAMED_ENTITY = T.ArrayType(
    T.StructType([T.StructField(name, _STR) for name in ("id", "name", "iso_3166_1", "iso_639_1")])
)
