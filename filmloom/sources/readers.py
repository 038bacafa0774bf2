"""Reading raw and cleaned files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.schemas import PROFILES, RATINGS


def _csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Every column as text: types are coerced later, so bad cells become null."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    return reader.option("multiLine", multi_line).option("inferSchema", False).csv(path)


def read_movies_raw(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, multi_line=True)


def read_credits_raw(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, multi_line=True)


def read_keywords_raw(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, multi_line=True)


def read_ratings_raw(spark: SparkSession, path: str) -> DataFrame:
    """No line breaks inside cells, so the file stays splittable."""
    return _csv(spark, path)


def read_links_raw(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system of the path itself, whatever it is."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def empty_typed(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".csv"):
        return _csv(spark, path, multi_line=True)
    return spark.read.parquet(path)


def read_first_existing(
    spark: SparkSession,
    candidates: list[tuple[str, dict[str, str]]],
    schema: T.StructType | None = None,
) -> DataFrame:
    """The first path that exists, with its own column renames applied.

    Without any, an empty frame of ``schema``, or an error naming the paths.
    """
    for path, renames in candidates:
        if path_exists(spark, path):
            return read_table(spark, path).withColumnsRenamed(renames)
    if schema is not None:
        return empty_typed(spark, schema)
    raise FileNotFoundError(f"none of these exist: {', '.join(p for p, _ in candidates)}")


def read_ratings(spark: SparkSession, folder: str, max_rows: int | None = None) -> DataFrame:
    """(user_id, movie_id, rating) of the final table, else of the cleaned one."""
    found = read_first_existing(
        spark,
        [
            (f"{folder}/ratings", {}),
            (f"{folder}/ratings.csv", {}),
            (f"{folder}/ratings_clean", {"userId": "user_id", "movieId": "movie_id"}),
            (f"{folder}/ratings_clean.csv", {"userId": "user_id", "movieId": "movie_id"}),
        ],
        RATINGS,
    )
    return prune_ratings(found, max_rows)


def prune_ratings(ratings: DataFrame, max_rows: int | None = None) -> DataFrame:
    """The three columns every model needs; ``max_rows`` takes the first keys in order."""
    pruned = ratings.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("movie_id").cast("bigint").alias("movie_id"),
        F.col("rating").cast("double").alias("rating"),
    ).dropna()
    return pruned if max_rows is None else pruned.orderBy("user_id", "movie_id").limit(max_rows)


def read_movielens(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Raw films and ratings as they are; fails when either file is absent."""
    paths = [f"{folder}/movies.csv", f"{folder}/ratings.csv"]
    absent = [p for p in paths if not path_exists(spark, p)]
    if absent:
        raise FileNotFoundError(f"raw files missing: {', '.join(absent)}")
    return _csv(spark, paths[0], multi_line=True), _csv(spark, paths[1])


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROFILES).option("multiLine", True).json(path)


def profiles_to_ratings(profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rating and favourite rows of the profiles' maps and lists."""
    rated = profiles.select("email", F.explode("ratings").alias("_movie", "rating"))
    ratings = rated.select("email", F.col("_movie").try_cast("bigint").alias("movie_id"), "rating")
    favorites = profiles.select("email", F.explode("favorites").alias("movie_id"))
    return ratings.where("movie_id IS NOT NULL"), favorites.withColumn("movie_id", F.col("movie_id").cast("bigint"))


def preview_table(df: DataFrame, width: int = 30) -> tuple[int, DataFrame]:
    """Row count and the first row in display form."""
    from filmloom.functions.text import preview

    shown = df.limit(1).select(*[preview(F.col(f"`{c}`"), width).alias(c) for c in df.columns])
    return df.count(), shown
