"""The cleaning job: raw CSV folder in, eight keyed tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from filmloom.operators import cleaning
from filmloom.operators.relational import observed
from filmloom.session import cut_lineage
from filmloom.sources import readers
from filmloom.sources.writers import write_cleaned


def clean_tables(
    movies: DataFrame,
    credits_: DataFrame,
    keywords: DataFrame,
    ratings: DataFrame,
    links: DataFrame,
) -> dict[str, DataFrame]:
    """The eight outputs. Among duplicates the smallest row text wins, which any
    cluster reproduces; files carry no usable position."""

    def whole_row(df: DataFrame):
        return [F.to_json(F.struct(*df.columns))]

    movies_clean = cleaning.clean_movies(movies, whole_row(movies))
    cast, crew = cleaning.clean_credits(credits_, whole_row(credits_))
    ratings_clean = cleaning.clean_ratings(ratings, ["timestamp", "rating"])
    links_clean = cleaning.clean_links(links, ["imdbId", "tmdbId"])
    movies_final, ratings_final = cleaning.build_final(movies_clean, ratings_clean, links_clean)
    return {
        "movies_clean": movies_clean,
        "cast_clean": cast,
        "crew_clean": crew,
        "keywords_clean": cleaning.explode_keywords(keywords, whole_row(keywords)),
        "ratings_clean": ratings_clean,
        "links_clean": links_clean,
        "movies": movies_final,
        "ratings": ratings_final,
    }


class StepCounts:
    """Row counts of named steps, taken while the tables are written."""

    def __init__(self) -> None:
        self.watches: dict[str, Observation] = {}

    def __call__(self, step: str, df: DataFrame) -> DataFrame:
        df, self.watches[step] = observed(df, step)
        return df

    def table(self, spark: SparkSession) -> DataFrame:
        """(table, step, n_before, n_rows, n_dropped) in the order of the steps; a table's first step drops nothing."""
        rows, last = [], {}
        for place, (name, watch) in enumerate(self.watches.items()):
            table, step = name.split(": ")
            n = watch.get["rows"]
            before = last.get(table, n)
            rows.append((place, table, step, before, n, before - n))
            last[table] = n
        return spark.createDataFrame(rows, "place int, table string, step string, n_before long, n_rows long, n_dropped long")


def run_cleaning(spark: SparkSession, raw: str, out: str, fmt: str = "parquet") -> tuple[dict[str, int], DataFrame]:
    """Read, clean, check and write: the rows written per table, and what every step dropped.

    Counts are observed while the tables are written, without extra passes. Each raw file is read once: cast and crew
    share their films' checkpoint, and the final tables are built from the cleaned ones as written (for a CSV result, whose
    types are gone, from a checkpoint).
    """
    movies, credits_, keywords, ratings, links = (
        reader(spark, f"{raw}/{name}.csv")
        for reader, name in (
            (readers.read_movies_raw, "movies_metadata"),
            (readers.read_credits_raw, "credits"),
            (readers.read_keywords_raw, "keywords"),
            (readers.read_ratings_raw, "ratings"),
            (readers.read_links_raw, "links"),
        )
    )

    def whole_row(df: DataFrame):
        return [F.to_json(F.struct(*df.columns))]

    steps = StepCounts()
    films = cut_lineage(cleaning.distinct_films(credits_, whole_row(credits_), steps))
    tables = {
        "movies_clean": cleaning.clean_movies(movies, whole_row(movies), steps),
        "cast_clean": cleaning.cast_rows(films),
        "crew_clean": cleaning.crew_rows(films),
        "keywords_clean": cleaning.explode_keywords(keywords, whole_row(keywords), steps),
        "ratings_clean": cleaning.clean_ratings(ratings, ["timestamp", "rating"], steps),
        "links_clean": cleaning.clean_links(links, ["imdbId", "tmdbId"], steps),
    }
    shared = ("movies_clean", "ratings_clean", "links_clean")
    if fmt != "parquet":
        tables |= {name: cut_lineage(tables[name]) for name in shared}
    watched = {name: observed(df, f"rows_{name}") for name, df in tables.items()}
    paths = write_cleaned({name: df for name, (df, _) in watched.items()}, out, fmt)
    cleaned = [readers.read_table(spark, paths[name]) if fmt == "parquet" else tables[name] for name in shared]
    final = dict(zip(("movies", "ratings"), cleaning.build_final(*cleaned, steps)))
    if fmt != "parquet":
        final = {name: cut_lineage(df) for name, df in final.items()}
    finals = {name: observed(df, f"rows_{name}") for name, df in final.items()}
    paths |= write_cleaned({name: df for name, (df, _) in finals.items()}, out, fmt)
    written = {name: readers.read_table(spark, paths[name]) for name in finals} if fmt == "parquet" else final
    cleaning.check_rating_overlap(written["movies"], written["ratings"])
    return {name: watch.get["rows"] for name, (_, watch) in (watched | finals).items()}, steps.table(spark)


def clean_catalog(spark: SparkSession, raw: str, out: str, fmt: str = "parquet") -> dict[str, int]:
    """Rows written per table by ``run_cleaning``."""
    return run_cleaning(spark, raw, out, fmt)[0]
