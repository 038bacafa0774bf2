"""Titles, genres, labels and tokens."""

from __future__ import annotations

import glob
import os
import zipfile

import pyspark
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from filmloom.functions.coercion import strip

POSTER_PREFIX = "https://image.tmdb.org/t/p/w342"
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def genre_list(genres: Column) -> Column:
    """``Action|Drama`` or ``['Action', 'Drama']`` -> array of names."""
    bare = F.regexp_replace(F.coalesce(genres, F.lit("")), r"^[\[\]]+|[\[\]]+$", "")
    parts = F.split(F.regexp_replace(bare, "['\"]", ""), r"[|,]")
    return F.filter(F.transform(parts, strip), lambda name: name != "")


def year_from_title(title: Column) -> Column:
    return F.nullif(F.regexp_extract(title, r"\(([0-9]{4})\)", 1), F.lit("")).try_cast("int")


def _blank_if_missing(text: Column) -> Column:
    lowered = F.lower(strip(F.coalesce(text, F.lit(""))))
    return F.when(lowered.isin("nan", "none"), F.lit("")).otherwise(lowered)


def content_text(title: Column, genres: Column) -> Column:
    """Lower-cased title and genres in one string, missing parts left out."""
    return strip(F.concat_ws(" ", _blank_if_missing(title), _blank_if_missing(genres)))


def poster_url(path: Column) -> Column:
    return F.when(strip(path) != "", F.concat(F.lit(POSTER_PREFIX), path))


def movie_label(title: Column, year: Column, movie_id: Column) -> Column:
    shown = F.coalesce(F.nullif(year, F.lit(0)).cast("string"), F.lit("?"))
    return F.concat(title, F.lit(" ("), shown, F.lit(") · ID "), movie_id.cast("string"))


def preview(value: Column, width: int = 30) -> Column:
    """Display form of a value: ``NULL`` or at most ``width`` characters and an ellipsis."""
    text = value.cast("string")
    cut = F.concat(F.substring(text, 1, width), F.lit("…"))
    return F.coalesce(F.when(F.length(text) > width, cut).otherwise(text), F.lit("NULL"))


def thousands(number: Column, digits: int = 0) -> Column:
    return F.format_number(number, digits)


def tokens(text: Column) -> Column:
    """Words of at least two letters, digits or underscores, lower-cased."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))


def english_stop_words() -> list[str]:
    """Spark ML's own English stop list."""
    if SparkSession.getActiveSession() is not None:
        from pyspark.ml.feature import StopWordsRemover

        return sorted(StopWordsRemover.loadDefaultStopWords("english"))
    # No session yet: the same list from the library's own archive.
    homes = [os.path.dirname(pyspark.__file__), os.environ.get("SPARK_HOME", "")]
    jar = next(j for home in homes for j in glob.glob(os.path.join(home, "jars", "spark-mllib_*.jar")))
    with zipfile.ZipFile(jar) as archive:
        listing = archive.read("org/apache/spark/ml/feature/stopwords/english.txt").decode("utf-8")
    return sorted(set(listing.split("\n")) - {""})
